"""tripspark: trip analytics as composable PySpark DataFrame operators.

Layers: Bronze (raw, append-only) -> Silver (typed, cleaned, deduplicated)
-> Gold (marts, features) -> models -> predictions -> quality reports.
Every operator is ``f(df, **params) -> DataFrame`` with no action inside;
sinks and model fits are the only places that run jobs.
"""

__version__ = "0.1.0"
