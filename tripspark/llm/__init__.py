"""Training-data operators (license scan, token output, near-dedup, token
counts, decontamination, packing, suffix-array dedup, LM scoring, URL filter,
quality rules) and the queries that apply them.

Nothing outside this subpackage imports it.
"""
