"""Exact quantiles with bounded memory, computed on executors.

The exact q-quantile of n values is the ceil(q * n)-th smallest (the rule
``percentile_approx`` follows when its sketch is exact, and DuckDB's
``quantile_disc`` too). A sketch exact for all n would need memory that
grows with the data, so the value is found by narrowing an open interval:

1. a ``percentile_approx`` sketch of accuracy ``accuracy`` (memory fixed by
   that number) over the values strictly inside the interval gives two
   values ``lo <= hi`` around the wanted rank;
2. one pass counts the values below ``lo``, equal to ``lo``, between the
   two, and equal to ``hi``. If the wanted rank falls on a run of equal
   values, that value is the answer; otherwise the search goes on strictly
   inside the part that holds the rank. Every round leaves out at least one
   run of equal values, so it always ends, however the values repeat;
3. once at most ``max_candidates`` values are left inside, a lazy
   ``percentile_approx`` with an accuracy above their number is exact, and
   its memory is bounded by ``max_candidates``.

Steps 1-2 are small aggregate jobs (one row back each); all targets of all
columns share each pass.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tripspark.session import checkpointed

DEFAULT_ACCURACY = 10000
DEFAULT_MAX_CANDIDATES = 1_000_000


@dataclass
class _Target:
    col: str
    prob: float
    rank: int            # 1-based rank wanted among non-null values
    inside: int          # values strictly inside (low, high)
    low: float | None = None
    high: float | None = None
    below: int = 0       # values at or below low
    value: float | None = None
    found: bool = False

    def x(self) -> Column:
        return F.col(self.col).cast("double")

    def within(self) -> Column:
        cond = self.x().isNotNull()
        if self.low is not None:
            cond = cond & (self.x() > F.lit(self.low))
        if self.high is not None:
            cond = cond & (self.x() < F.lit(self.high))
        return cond

    def inner_prob(self) -> float:
        return (self.rank - self.below - 0.5) / self.inside


def _sketch_pass(df: DataFrame, targets: list[_Target], accuracy: int) -> list[tuple[float, float]]:
    """Two values inside each target's interval, around its rank."""
    eps = 3.0 / accuracy
    exprs = []
    for i, t in enumerate(targets):
        probs = F.array(F.lit(max(0.0, t.inner_prob() - eps)), F.lit(min(1.0, t.inner_prob() + eps)))
        exprs.append(F.percentile_approx(F.when(t.within(), t.x()), probs, accuracy).alias(f"b{i}"))
    row = df.select(*exprs).first()
    return [tuple(row[f"b{i}"]) for i in range(len(targets))]


def _count_pass(df: DataFrame, targets: list[_Target], edges: list[tuple[float, float]]) -> None:
    """Settle each target whose rank falls on an edge value; move the others
    to the part of their interval that holds the rank."""
    exprs = []
    for i, (t, (lo, hi)) in enumerate(zip(targets, edges)):
        for name, cond in (("l", t.x() < F.lit(lo)), ("a", t.x() == F.lit(lo)),
                           ("m", (t.x() > F.lit(lo)) & (t.x() < F.lit(hi))),
                           ("z", (t.x() == F.lit(hi)) & F.lit(lo != hi))):
            exprs.append(F.count_if(t.within() & cond).alias(f"{name}{i}"))
    row = df.select(*exprs).first()
    for i, (t, (lo, hi)) in enumerate(zip(targets, edges)):
        less, at_lo, mid, at_hi = (row[f"{n}{i}"] for n in "lamz")
        rank = t.rank - t.below
        if rank <= less:
            t.high, t.inside = lo, less
        elif rank <= less + at_lo:
            t.value, t.found = lo, True
        elif rank <= less + at_lo + mid:
            t.below += less + at_lo
            t.low, t.high, t.inside = lo, hi, mid
        elif rank <= less + at_lo + mid + at_hi:
            t.value, t.found = hi, True
        else:
            t.below += less + at_lo + mid + at_hi
            t.low, t.inside = hi, t.inside - (less + at_lo + mid + at_hi)


def _narrow(df: DataFrame, targets: list[_Target], accuracy: int, max_candidates: int) -> None:
    """Narrow every target to a value, or to ``max_candidates`` values."""
    while big := [t for t in targets if not t.found and t.inside > max_candidates]:
        _count_pass(df, big, _sketch_pass(df, big, accuracy))


def _final_value(t: _Target, final_accuracy: int) -> Column:
    if t.found:
        return F.lit(t.value)
    return F.percentile_approx(F.when(t.within(), t.x()), F.lit(t.inner_prob()), final_accuracy)


def kth_smallest(df: DataFrame, col: str, k: int, accuracy: int = DEFAULT_ACCURACY,
                 max_candidates: int = DEFAULT_MAX_CANDIDATES,
                 materialize: bool = True) -> tuple[int, float | None]:
    """(number of non-null values, exact k-th smallest as double or None if
    there are fewer than k). Runs the passes eagerly."""
    if materialize:
        df = checkpointed(df.select(col))
    total = df.select(F.count(F.col(col))).first()[0]
    if total < k or k < 1:
        return total, None
    t = _Target(col, k / total, k, total)
    _narrow(df, [t], accuracy, max_candidates)
    return total, df.select(_final_value(t, 2 * max_candidates + 1)).first()[0]


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                    accuracy: int = DEFAULT_ACCURACY,
                    max_candidates: int = DEFAULT_MAX_CANDIDATES,
                    materialize: bool = True) -> DataFrame:
    """Exact quantiles as (column, prob, value double); value is null for a
    column without non-null values. See the module docstring.

    ``materialize``: the projected columns are written to the shared
    ``spark.checkpoint.dir`` before the passes, so each pass reads them
    instead of recomputing the input's lineage (and a lost executor does
    not send the search back to the source).
    """
    cols, probs = list(cols), [float(p) for p in probs]
    if materialize:
        df = checkpointed(df.select(*cols))
    counts = df.select(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    targets = [_Target(c, p, max(1, math.ceil(p * counts[c])), counts[c]) for c in cols for p in probs
               if counts[c] > 0]
    _narrow(df, targets, accuracy, max_candidates)
    final_accuracy = 2 * max_candidates + 1
    exprs = [F.struct(F.lit(t.col).alias("column"), F.lit(t.prob).alias("prob"),
                      _final_value(t, final_accuracy).alias("value")) for t in targets]
    missing = [(c, p) for c in cols for p in probs if counts[c] == 0]
    for c, p in missing:
        exprs.append(F.struct(F.lit(c).alias("column"), F.lit(p).alias("prob"),
                              F.lit(None).cast("double").alias("value")))
    one = df.agg(*[e.alias(f"q{i}") for i, e in enumerate(exprs)], F.count(F.lit(1)))
    return one.select(F.explode(F.array(*[F.col(f"q{i}") for i in range(len(exprs))])).alias("q")) \
        .select("q.column", "q.prob", "q.value")


def as_row(long: DataFrame, col: str, probs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """(column, prob, value) rows of one column -> one row, a column per
    probability (a global aggregate over at most len(probs) rows)."""
    sel = long.where(F.col("column") == col)
    return sel.agg(*[F.max(F.when(F.col("prob") == F.lit(float(p)), F.col("value"))).alias(n)
                     for p, n in zip(probs, names)])


# Below this many rows a plain ``orderBy().limit()`` (TakeOrderedAndProject)
# is cheap: each map task sends at most n rows to the final task.
DIRECT_TOP_N = 1000


def smallest_n(df: DataFrame, n: int, order: Sequence[Column], lead: Column,
               direct_max: int = DIRECT_TOP_N) -> DataFrame:
    """The first ``n`` rows by ``order``, exactly, without funnelling
    ``n`` rows per partition into one task when ``n`` is large.

    ``lead`` is a numeric expression that never decreases along ``order``
    (e.g. the first sort key). The n-th smallest ``lead`` value is found
    with the bounded search above; only rows at or below it (plus null
    leads, which sort first) go on to the final top-n, about ``n`` rows
    plus ties.
    """
    if n <= direct_max:
        return df.orderBy(*order).limit(n)
    keyed = df.withColumn("_lead", lead.cast("double"))
    _, threshold = kth_smallest(keyed, "_lead", n)
    if threshold is not None:
        keyed = keyed.where(F.col("_lead").isNull() | (F.col("_lead") <= F.lit(threshold)))
    return keyed.orderBy(*order).limit(n).drop("_lead")
