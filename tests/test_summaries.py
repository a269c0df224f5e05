"""Mergeable daily summaries and the SQL functions."""

import math

import pytest
from pyspark.sql import functions as F

from kestrel.functions import labels, sql_functions
from kestrel.operators import funnel, sketches

STEPS = ("view", "click", "purchase")


@pytest.fixture(scope="module")
def events(spark):
    """40 days of events of 3,000 customers (some without number, channel or day)."""
    e = spark.range(60_000).select(
        F.when(F.col("id") % 97 != 0, F.pmod(F.xxhash64("id"), F.lit(3000))).alias("customer_id"),
        F.element_at(F.array(*map(F.lit, (*STEPS, "bounce"))), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(4)) + 1).cast("int")).alias("event_type"),
        F.when(F.col("id") % 89 != 0, F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(cast(id % 40 as int))")).alias("timestamp"))
    return e.cache()


def test_distinct_counts_of_spans_stay_within_the_bound(events):
    stored = sketches.daily_sketches(events, ["customer_id", "event_type"])
    week = F.date_trunc("week", "day")
    for span, days in ((week, F.date_trunc("week", F.to_date("timestamp"))), (F.lit(0), F.lit(0))):
        got = {(r.span, r.measure): r.n_distinct for r in sketches.merged_distinct(stored, span.alias("span")).collect()}
        want = events.groupBy(days.alias("span")).agg(F.count_distinct("customer_id").alias("n")).collect()
        for r in want:
            assert abs(got[r.span, "customer_id"] - r.n) <= max(1, sketches.ERROR_BOUND * r.n)
            assert got[r.span, "event_type"] == 4


def test_bitmap_funnel_of_any_span_equals_the_direct_one(spark, events):
    customers = spark.range(0, 3000, 2).select(F.col("id").alias("customer_id"), F.concat(F.lit("c"), F.col("id") % 3).alias("acquisition_channel"))
    numbers = sketches.number_customers(customers.unionByName(customers.limit(5)), 7)  # repeated customers are one
    stored = sketches.daily_reach_bitmaps(events, numbers, STEPS)
    for first, last in (("2024-01-01", "2024-01-01"), ("2024-01-03", "2024-01-20"), ("2023-01-01", "2025-01-01")):
        days = stored.where(F.col("day").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        own = events.where(F.to_date("timestamp").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
        want = funnel.funnel_by_channel(funnel.customer_step_reach(own, STEPS), customers, STEPS)
        key = lambda r: (r.acquisition_channel, r.step_idx, r.customers_reached)
        assert sorted(map(key, sketches.span_funnel(days, STEPS).collect())) == sorted(map(key, want.collect()))
    # one row per day, channel, step and bucket of customers, whatever the number of events
    assert stored.count() <= 40 * 3 * 3 and "acquisition_channel" in stored.columns


def test_bitmaps_of_many_buckets(spark):
    customers = spark.range(100_000).select(F.col("id").alias("customer_id"), F.lit("c").alias("acquisition_channel"))
    events = spark.range(100_000).where("id % 3 = 0").select(F.col("id").alias("customer_id"), F.lit("view").alias("event_type"),
                                                             F.lit("2024-01-01").cast("timestamp_ntz").alias("timestamp"))
    got = {r.step_name: r.customers_reached for r in sketches.span_funnel(
        sketches.daily_reach_bitmaps(events, sketches.number_customers(customers), STEPS), STEPS).collect()}
    assert got == {"view": 33_334, "click": 0, "purchase": 0}


def test_sql_functions_equal_the_columns(spark):
    spark.createDataFrame([(0, "a", 10, 2), (1, "b", 20, 9), (2, "c", None, None)], "arm_idx int, experiment_group string, total_events long, purchase_events long") \
        .createOrReplaceTempView("arm_totals")
    spark.sql("SELECT 1L AS event_id, 1L AS customer_id, TIMESTAMP_NTZ'2024-01-01' AS `timestamp`").createOrReplaceTempView("fct_events")
    for database in (None, "kestrel_functions"):
        sql_functions.register(spark, database, tables=not database)  # permanent table functions need permanent views
        at = f"{database}." if database else ""
        for z in (0.0, 0.5, -1.96, 6.0, 30.0):
            p = spark.sql(f"SELECT {at}normal_p({z}D)").first()[0]
            assert p == pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-11)
        for x, dof, want in ((3.0, 2, math.exp(-1.5)), (5.0, 4, math.exp(-2.5) * 3.5), (4.0, 1, math.erfc(math.sqrt(2.0))),
                             (4.0, 3, math.erfc(math.sqrt(2.0)) + math.exp(-2.0) * math.sqrt(2.0) / math.gamma(1.5))):
            assert spark.sql(f"SELECT {at}chi_square_p({x}D, {dof})").first()[0] == pytest.approx(want, rel=1e-11)
        if database:
            continue
        rows = spark.sql(f"SELECT * FROM {at}arm_tests(0.05D) ORDER BY pair_idx").collect()
        assert [(r.group_a, r.group_b) for r in rows] == [("a", "b"), ("a", "c"), ("b", "c")] and rows[1].z_stat is None
        assert spark.sql(f"SELECT derived_session_id FROM {at}customer_sessions(30D)").first()[0] == "1-1"
    assert spark.sql("SELECT two_proportion_z(10, 1, 0, 0)").first()[0] is None
    values = [None, 0.0, 5e-5, 1e-4, 0.00012345, 0.012345, 0.5, 0.03125, 0.0003125, 0.99995, 1.0, 0.1, 2 ** -12]
    got = spark.createDataFrame([(v,) for v in values], "p double").selectExpr("p", "p_label(p) AS s").withColumn("c", labels.format_p(F.col("p"))).collect()
    assert all(r.s == r.c for r in got)
    opened = "SELECT opens_session(a, b, 30D) FROM VALUES (TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:30:00'), " \
             "(TIMESTAMP_NTZ'2024-01-01 00:00:00', TIMESTAMP_NTZ'2024-01-01 00:30:00.000001'), (NULL, TIMESTAMP_NTZ'2024-01-01') AS t(a, b)"
    assert [r[0] for r in spark.sql(opened).collect()] == [False, True, False]
