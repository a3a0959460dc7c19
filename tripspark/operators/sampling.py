"""Splits and samples.

Hash-based variants depend only on a row key, so they pick the same rows
on any cluster size; the Bernoulli forms keep Spark's ``sample`` /
``randomSplit`` semantics (partition-dependent) for parity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tripspark.functions import hash_order_key, hash_percent
from tripspark.operators.features import MissingColumnsError
from tripspark.operators.quantiles import smallest_n
from tripspark.schemas import ROW_ID, SEED, TRAIN_PERCENT


def row_key(df: DataFrame, key: str | None = None) -> str:
    """The column that identifies a row: ``key``, else the id the ingest
    assigned, else the source's ``event_id``."""
    for name in ([key] if key else [ROW_ID, "event_id"]):
        if name in df.columns:
            return name
    raise MissingColumnsError(f"no row key: name one, or keep {ROW_ID!r} from the ingest")


def split_flag(df: DataFrame, key: str | None = None, train_percent: int = TRAIN_PERCENT,
               seed: int | None = None) -> DataFrame:
    """X3 (hash form): ``is_train`` from the key's hash bucket 0..99."""
    return df.withColumn("is_train", hash_percent(F.col(row_key(df, key)), seed) < train_percent)


def hash_split(df: DataFrame, key: str | None = None, train_percent: int = TRAIN_PERCENT,
               seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Disjoint train/test frames that together hold every row."""
    p = hash_percent(F.col(row_key(df, key)), seed)
    return df.where(p < train_percent), df.where(p >= train_percent)


def random_split(df: DataFrame, weights=(0.8, 0.2), seed: int = SEED):
    """X3 (Spark form): ``randomSplit`` as in the training job."""
    return df.randomSplit(list(weights), seed=seed)


def hash_sample(df: DataFrame, percent: float, key: str | None = None, seed: int | None = None) -> DataFrame:
    """X1/X2 (hash form): rows whose key hashes below ``percent`` of 100.
    Map-only, no shuffle."""
    if not 0 <= percent <= 100:
        raise ValueError("percent must be within [0, 100]")
    return df.where(hash_percent(F.col(row_key(df, key)), seed) < percent)


def bernoulli_sample(df: DataFrame, fraction: float, seed: int = SEED) -> DataFrame:
    """X1 (Spark form): ``sample(False, fraction, seed)``; fraction >= 1
    keeps every row."""
    if fraction >= 1.0:
        return df
    return df.sample(False, fraction, seed=seed)


def fixed_size_sample(df: DataFrame, n: int, key: str | None = None, seed: int | None = None) -> DataFrame:
    """``min(n, rows)`` rows, chosen by the order of a key hash (the
    limit is the feature). The first 13 hex digits of the hash (52 bits,
    exact as a double) lead the order, so a large ``n`` is cut by a
    threshold instead of a top-n funnel (``smallest_n``)."""
    key = row_key(df, key)
    digest = hash_order_key(F.col(key), seed)
    lead = F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
    return smallest_n(df, n, [digest, F.col(key)], lead)


_STATE = ("_priority", "_digest")
SPREAD = 64  # sub-groups that a state's group is cut into first


def sample_state(df: DataFrame, n: int, by: Sequence[str], key: str | None = None, seed: int | None = None,
                 weight: str | None = None) -> DataFrame:
    """X4 as a mergeable state: of each ``by`` group (a month, say) the ``n``
    rows of smallest priority, with ``_priority`` and ``_digest``. Stored once
    per group, :func:`merged_sample` draws from any set of groups without
    their rows.

    The priority is -ln(1 - u) / weight, u being the key's hash as a fraction:
    the n smallest are a sample without replacement in which a row's chance
    of being drawn next is in proportion to its weight. Without a weight the
    order is that of :func:`fixed_size_sample`. Rows whose weight is null, NaN
    or not above 0 are never drawn. At most ``SPREAD * n`` rows of a group,
    however large, meet in one task.
    """
    key = row_key(df, key)
    digest = hash_order_key(F.col(key), seed)
    share = F.conv(F.substring("_digest", 1, 13), 16, 10).cast("bigint") / float(1 << 52)
    w = F.lit(1.0) if weight is None else F.col(weight).cast("double")
    rows = df.withColumn("_digest", digest).withColumn("_priority", -F.log(1 - share) / F.when((w > 0) & ~F.isnan(w), w))
    order = [*_STATE, key]
    part = Window.partitionBy(*by, F.pmod(F.xxhash64("_digest"), F.lit(SPREAD))).orderBy(*order)
    some = rows.where("_priority IS NOT NULL").withColumn("_rank", F.row_number().over(part)).where(F.col("_rank") <= n)
    whole = Window.partitionBy(*by).orderBy(*order)
    return some.withColumn("_rank", F.row_number().over(whole)).where(F.col("_rank") <= n).drop("_rank")


def merged_sample(states: DataFrame, n: int, key: str | None = None) -> DataFrame:
    """``min(n, rows)`` rows of all groups of stored states, which must hold
    at least ``n`` rows per group (or all of it)."""
    key = row_key(states, key)
    return smallest_n(states, n, [*map(F.col, _STATE), F.col(key)], F.col("_priority")).drop(*_STATE)
