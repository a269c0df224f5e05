"""Distributed exact percentiles against numpy's linear interpolation."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kestrel.operators.quantiles import exact_percentiles

PROBS = [0.0, 0.025, 0.25, 0.5, 0.75, 0.975, 1.0]


def test_grouped_with_a_hot_group(spark):
    rng = np.random.default_rng(3)
    hot = rng.integers(0, 50, 3000).astype(float)  # many ties
    cold = rng.normal(size=41)
    rows = [("hot", float(v)) for v in hot] + [("cold", float(v)) for v in cold] + [("one", 5.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    got = {r.g: r for r in exact_percentiles(df, "v", PROBS, ["g"], partitions=6).collect()}
    for name, vals in (("hot", hot), ("cold", cold), ("one", np.array([5.0]))):
        exp = np.percentile(vals, [p * 100 for p in PROBS])
        for i, p in enumerate(PROBS):
            assert got[name][i + 1] == pytest.approx(exp[i], rel=1e-12, abs=1e-12)


def test_ungrouped_ignores_nulls(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)] + [(None,)], "v double")
    r = exact_percentiles(df, "v", [0.5, 0.9], names=["med", "p90"]).collect()[0]
    assert r.med == 5.0 and r.p90 == pytest.approx(9.0)


def test_matches_spark_percentile(spark):
    df = spark.range(997).select((F.pmod(F.col("id") * 7919, F.lit(1013)) / 3.0).alias("v"))
    mine = exact_percentiles(df, "v", [0.1, 0.5, 0.9], names=["a", "b", "c"]).collect()[0]
    ref = df.agg(F.percentile("v", [0.1, 0.5, 0.9]).alias("p")).collect()[0].p
    assert [mine.a, mine.b, mine.c] == pytest.approx(ref, rel=1e-12)


def test_percentiles_of_many_values_without_exchange_reuse(spark):
    df = spark.range(500_000).select((F.pmod(F.xxhash64("id"), F.lit(10_000_019)) / 7.0).alias("v"))
    ref = df.agg(F.percentile("v", [0.1, 0.5, 0.9]).alias("p")).collect()[0].p
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            got = exact_percentiles(df, "v", [0.1, 0.5, 0.9], names=["a", "b", "c"], partitions=16).collect()[0]
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
        assert [got.a, got.b, got.c] == pytest.approx(ref, rel=1e-12)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(-5, 5).map(lambda v: v / 4)),
                     min_size=1, max_size=60),
       parts=st.integers(1, 7))
def test_percentiles_match_numpy_random(spark, vals, parts):
    df = spark.createDataFrame(vals, "g string, v double")
    probs = [0.0, 0.1, 0.5, 0.9, 1.0]
    got = {r.g: r for r in exact_percentiles(df, "v", probs, ["g"], partitions=parts).collect()}
    for g in {x[0] for x in vals}:
        exp = np.percentile([x[1] for x in vals if x[0] == g], [p * 100 for p in probs])
        assert [got[g][i + 1] for i in range(len(probs))] == pytest.approx(list(exp), abs=1e-12)
