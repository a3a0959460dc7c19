"""Column-level building blocks (built-in Spark expressions only)."""

from tripspark.functions.timecols import (  # noqa: F401
    as_timestamp, day_name, day_of_week, epoch_seconds, hour_of_day, minutes_between,
    weekend_from_day_name, weekend_from_day_number, year_month,
)
from tripspark.functions.bins import chain_distance_bin, right_open_distance_bin, bin_order  # noqa: F401
from tripspark.functions.hashing import hash_percent, hash_order_key  # noqa: F401
