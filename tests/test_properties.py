"""Property tests: exact quantiles and threshold top-n against brute force
on random inputs; the approximate quantile within its rank-error bound."""

from __future__ import annotations

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tripspark.operators import quality as Q
from tripspark.operators.quantiles import exact_quantiles, smallest_n

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
values = st.lists(st.integers(min_value=-50, max_value=50).map(float), min_size=1, max_size=400)
probs = st.lists(st.sampled_from([0.0, 0.01, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]), min_size=1, max_size=4,
                 unique=True)


@SETTINGS
@given(vals=values, ps=probs)
def test_exact_quantiles_match_brute_force(spark, vals, ps):
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(3)
    got = {r.prob: r.value for r in exact_quantiles(df, ["x"], ps, accuracy=20, max_candidates=25,
                                                    materialize=False).collect()}
    s = sorted(vals)
    assert got == {p: s[max(1, math.ceil(p * len(s))) - 1] for p in ps}


@SETTINGS
@given(vals=values, n=st.integers(min_value=1, max_value=450))
def test_smallest_n_matches_brute_force(spark, vals, n):
    rows = [(i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "id bigint, v double").repartition(3)
    got = [(r.id, r.v) for r in smallest_n(df, n, [F.col("v"), F.col("id")], F.col("v"), direct_max=2).collect()]
    assert got == sorted(rows, key=lambda t: (t[1], t[0]))[:n]


@SETTINGS
@given(vals=st.lists(st.floats(min_value=-1e3, max_value=1e3), min_size=50, max_size=400))
def test_approx_quantile_rank_error_is_bounded(spark, vals):
    accuracy = 20
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    s, n = sorted(vals), len(vals)
    for r in Q.quantiles(df, ["x"], [0.1, 0.5, 0.9], accuracy=accuracy).collect():
        lo = sum(1 for v in s if v < r.value) + 1          # first rank of the value
        hi = sum(1 for v in s if v <= r.value)             # last rank of the value
        target = math.ceil(r.prob * n)
        assert lo - n / accuracy - 1 <= target <= hi + n / accuracy + 1
