"""DataFrame -> DataFrame operators by layer.

silver    typing, cleaning, reproducible de-duplication, rejection audit
marts     Gold aggregates (hourly, zones, weekday/weekend, vendors, batches)
features  feature table, raw-input and upload features, scoring casts
quality   profiles, quantiles, correlations, error slices, histograms, top-k
quantiles exact quantiles and large top-n with bounded memory
sampling  hash and Bernoulli splits and samples
ml        assembler, scaler, linear model, tree, comparison, persistence
scoring   scoring and the batch scoring job
"""
