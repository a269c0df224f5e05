"""Clustered bootstrap: determinism, degenerate cases, coverage."""

import pytest
from pyspark.sql import functions as F

from kestrel.operators import bootstrap

GROUPS = ("Control", "Variant_A", "Variant_B")
SCHEMA = "customer_id long, experiment_group string, total_events long, purchase_events long"


def test_identical_customers_zero_width(spark):
    rows = []
    for c in range(30):
        rows += [(c, "Control", 10, 1), (c, "Variant_A", 10, 2), (c, "Variant_B", 10, 3)]
    ci = {r.comparison: r for r in bootstrap.bootstrap_ci(
        bootstrap.bootstrap_replicates(spark.createDataFrame(rows, SCHEMA), GROUPS, 50, 42), GROUPS).collect()}
    a = ci["Variant_A vs Control"]
    assert a.ci_2_5pct == a.ci_97_5pct == a.median_lift_pp == pytest.approx(10.0)
    assert a.n_valid_replicates == 50


def test_one_customer_per_arm_null_replicates_counted(spark):
    rows = [(1, "Control", 10, 1), (2, "Variant_A", 10, 2), (3, "Variant_B", 10, 3)]
    reps = bootstrap.bootstrap_replicates(spark.createDataFrame(rows, SCHEMA), GROUPS, 200, 7)
    ci = {r.comparison: r for r in bootstrap.bootstrap_ci(reps, GROUPS).collect()}
    n_null = reps.filter(F.col("lift_1").isNull()).count()
    assert 0 < n_null < 200
    assert ci["Variant_A vs Control"].n_valid_replicates == 200 - n_null


def _counts(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    arm = F.when(F.pmod("event_id", F.lit(5)) < 3, "Control").when(F.pmod("event_id", F.lit(5)) == 3, "Variant_A") \
        .otherwise("Variant_B")
    return (ev.groupBy(F.col("user_id").alias("customer_id"), arm.alias("experiment_group"))
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_if(F.col("event_type") == "purchase").alias("purchase_events")))


def _customers(spark, n):
    """Counts of n customers with several value columns."""
    ids = spark.range(n).select((F.col("id") * 7 + 3).alias("customer_id"), F.explode(F.array(*[F.lit(g) for g in GROUPS])).alias("experiment_group"))
    return ids.select("customer_id", "experiment_group", (F.pmod(F.xxhash64("customer_id", "experiment_group"), F.lit(9)) + 1).alias("total_events"),
                      F.pmod(F.xxhash64("customer_id", "experiment_group"), F.lit(3)).alias("purchase_events"))


@pytest.mark.parametrize("n", [20_000, 100_000])
def test_dense_index_is_row_number_with_value_columns(spark, n):
    """At sizes where range bounds are sampled, and with columns one branch does not read."""
    matrix = bootstrap.customer_matrix(_customers(spark, n), GROUPS)
    try:
        for reuse, parts in (("true", "8"), ("false", "64")):
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            got = bootstrap.indexed_matrix(matrix)
            bad = got.where((F.col("customer_id") != F.col("idx") * 7 + 3) | (F.col("n_customers") != n))
            assert bad.count() == 0 and got.select("idx").distinct().count() == n
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_replicates_do_not_depend_on_plan_settings(spark, monkeypatch):
    """Partitions, exchange reuse, index ranges (1 to 61) and blocks of draws give the same replicates."""
    def run(n, **extra):
        return sorted(tuple(r) for r in bootstrap.bootstrap_replicates(_customers(spark, n), GROUPS, 10, 42, **extra).collect())

    try:
        base, small = run(20_000), run(2_000)
        for parts, reuse in (("1", "true"), ("8", "false"), ("61", "true")):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            spark.conf.set("spark.sql.exchange.reuse", reuse)
            assert run(20_000) == base
        for ranges in (1, 3, 61):
            assert run(2_000, range_rows=-(-2_000 // ranges)) == small
        monkeypatch.setattr(bootstrap, "DRAWS_AT_ONCE", 300)
        assert run(2_000, range_rows=700) == small
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_draws_spread_over_tasks_without_the_driver(spark):
    """No range row or draw passes the driver, and one range alone still gives work to every task."""
    import inspect
    source = inspect.getsource(bootstrap._draw_sums)
    assert not any(x in source for x in ("toArrow", "collect(", "broadcast(", "toPandas"))
    plan = bootstrap.bootstrap_replicates(_customers(spark, 500), GROUPS, 40, 1)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in plan


@pytest.mark.parametrize("method", ["draws", "poisson"])
def test_null_and_text_customers_are_clusters(spark, method):
    rows = [(None, "Control", 10, 1), (None, "Variant_A", 10, 2), ("a", "Control", 5, 1), ("b", "Variant_A", 5, 2), ("b", "Variant_B", 9, 3)]
    for kind, ids in (("string", {"a": "a", "b": "b"}), ("long", {"a": 1, "b": -5}), ("int", {"a": 7, "b": 8})):
        own = [(ids.get(c), *rest) for c, *rest in rows]
        reps = bootstrap.bootstrap_replicates(spark.createDataFrame(own, SCHEMA.replace("customer_id long", f"customer_id {kind}")), GROUPS, 60, 3, method=method)
        got = reps.collect()
        assert len(got) == 60 and any(r.lift_1 is not None for r in got)
        again = bootstrap.bootstrap_replicates(spark.createDataFrame(own[::-1], SCHEMA.replace("customer_id long", f"customer_id {kind}")).repartition(3),
                                               GROUPS, 60, 3, method=method).collect()
        assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, again), key=repr)


def test_replicates_match_plain_python(spark):
    import numpy as np
    counts = _customers(spark, 500)
    m = bootstrap.customer_matrix(counts, GROUPS).orderBy("customer_id").toPandas()[["n0", "x0", "n1", "x1", "n2", "x2"]].to_numpy()
    for r in bootstrap.bootstrap_replicates(counts, GROUPS, 20, 7).collect():
        s = m[bootstrap.draw_hash(r.rep * 500 + np.arange(500), 7) % 500].sum(0)
        assert r.lift_1 == pytest.approx((s[3] / s[2] - s[1] / s[0]) * 100)


def test_no_customers(spark):
    reps = bootstrap.bootstrap_replicates(spark.createDataFrame([], SCHEMA), GROUPS, 5, 42).collect()
    assert len(reps) == 5 and all(r.lift_1 is None for r in reps)


def test_ci_covers_point_lift(spark):
    counts = _counts(spark)
    tot = {r.experiment_group: r for r in counts.groupBy("experiment_group").agg(
        F.sum("total_events").alias("n"), F.sum("purchase_events").alias("x")).collect()}
    point = (tot["Variant_B"].x / tot["Variant_B"].n - tot["Control"].x / tot["Control"].n) * 100
    ci = {r.comparison: r for r in bootstrap.bootstrap_ci(
        bootstrap.bootstrap_replicates(counts, GROUPS, 400, 42), GROUPS).collect()}
    b = ci["Variant_B vs Control"]
    assert b.ci_2_5pct <= point <= b.ci_97_5pct


def test_dense_index(spark):
    m = spark.createDataFrame([(c * 13 % 101,) for c in range(101)], "customer_id long")
    got = {r.customer_id: r.idx for r in bootstrap.indexed_matrix(m.repartition(6)).collect()}
    assert got == {c: i for i, c in enumerate(sorted(got))}


def test_poisson_weights_agree_with_exact_draws(spark):
    """Same centre and spread as exact resampling; independent of partitioning."""
    import numpy as np
    counts = _customers(spark, 3000)
    a, b = ([r.lift_2 for r in bootstrap.bootstrap_replicates(counts, GROUPS, 300, 42, method=m).orderBy("rep").collect()] for m in ("draws", "poisson"))
    assert np.std(b) == pytest.approx(np.std(a), rel=0.25) and abs(np.mean(a) - np.mean(b)) < np.std(a) / 3
    again = bootstrap.bootstrap_replicates(counts.repartition(7), GROUPS, 300, 42, method="poisson").orderBy("rep").collect()
    assert [r.lift_2 for r in again] == b


@pytest.mark.parametrize("n", [7, 1000, 1 << 20])
def test_draw_hash_uniform_and_independent(spark, n):
    """Chi-square of idx counts over 10 bins and lag-1 correlation of draws."""
    import numpy as np
    m = 200_000
    idx = bootstrap.draw_hash(np.arange(m), 42) % n
    bins = min(n, 10)
    counts = np.bincount(idx * bins // n, minlength=bins)
    exp = [m * len(range(-(-b * n // bins), -(-(b + 1) * n // bins))) / n for b in range(bins)]
    chi2 = sum((c - e) ** 2 / e for c, e in zip(counts, exp))
    assert chi2 < 40  # df <= 9: p < 1e-5 would be ~ 37
    assert abs(np.corrcoef(idx[1:], idx[:-1])[0, 1]) < 0.02


def test_draw_hash_large_ids_distinct():
    import numpy as np
    hs = bootstrap.draw_hash((1 << 40) + np.arange(50_000), 42)
    assert len(set(hs.tolist())) == len(hs) and hs.min() >= 0 and hs.max() < (1 << 62)


def test_ci_width_close_to_cluster_robust_interval(spark):
    """Delta-method cluster-robust s.e. of the rate difference (customers as
    clusters) vs the bootstrap 95% interval width."""
    import numpy as np
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    arm = F.when(F.pmod("event_id", F.lit(5)) < 3, "Control").when(F.pmod("event_id", F.lit(5)) == 3, "Variant_A") \
        .otherwise("Variant_B")
    counts = (ev.groupBy(F.col("user_id").alias("customer_id"), arm.alias("experiment_group"))
              .agg(F.count(F.lit(1)).alias("total_events"),
                   F.count_if(F.col("event_type") == "purchase").alias("purchase_events")))
    m = bootstrap.customer_matrix(counts, GROUPS).toPandas()
    n_c, x_c, n_b, x_b = (m[c].to_numpy(float) for c in ("n0", "x0", "n2", "x2"))
    r_c, r_b = x_c.sum() / n_c.sum(), x_b.sum() / n_b.sum()
    psi = (x_b - r_b * n_b) / n_b.sum() - (x_c - r_c * n_c) / n_c.sum()
    se_pp = 100 * np.sqrt((psi ** 2).sum())
    ci = {r.comparison: r for r in bootstrap.bootstrap_ci(
        bootstrap.bootstrap_replicates(counts, GROUPS, 2000, 42), GROUPS).collect()}["Variant_B vs Control"]
    width = ci.ci_97_5pct - ci.ci_2_5pct
    assert width == pytest.approx(2 * 1.959964 * se_pp, rel=0.15)
