"""Funnel: hand-derived counts, rounding and non-monotone traps."""

import pytest
from pyspark.sql import functions as F

from kestrel.operators import funnel

STEPS = ("view", "click", "add_to_cart", "purchase")
#: what each customer did, letter by letter: v(iew), c(lick), a(dd to cart), p(urchase), b(ounce)
HISTORY = {21: "vvb", 22: "vcvc", 23: "vcab", 24: "vcap", 25: "bb", 26: "vcappp", 27: "p", 28: "vca"}
CHANNEL = {21: "Social", 22: "Social", 23: "Search", 24: "Search", 25: "Search", 26: "Social", 27: "Direct", 28: "Search"}
NAMES = dict(zip("vcapb", (*STEPS, "bounce")))


@pytest.fixture
def events(spark):
    return spark.createDataFrame([(c, NAMES[x]) for c, h in HISTORY.items() for x in h], "customer_id long, event_type string")


@pytest.fixture
def reach(events):
    return funnel.customer_step_reach(events, STEPS)


def test_reach_is_what_each_customer_did(reach):
    got = {r.customer_id: tuple(r[s] for s in STEPS) for r in reach.collect()}
    assert got == {c: tuple(x in h for x in "vcap") for c, h in HISTORY.items() if set(h) - {"b"}}


def test_overall_funnel(reach):
    rows = sorted(funnel.overall_funnel(reach, STEPS).collect(), key=lambda r: r.step_idx)
    assert [r.customers_reached for r in rows] == [6, 5, 4, 3]
    assert [r.pct_of_customers for r in rows] == [85.71, 71.43, 57.14, 42.86]  # of the 7 with a step
    assert [r.step_over_step_pct for r in rows] == [100.0, 83.33, 80.0, 75.0]
    assert [r.drop_off_pct for r in rows] == [0.0, 16.67, 20.0, 25.0]


def test_worst_step(spark, reach):
    assert tuple(funnel.biggest_drop_off_step(funnel.overall_funnel(reach, STEPS)).first()) == ("purchase", 25.0)
    tied = spark.createDataFrame([(i, True, i < 4, i < 2, i < 1) for i in range(8)], "customer_id long, " + ", ".join(f"{s} boolean" for s in STEPS))
    assert funnel.biggest_drop_off_step(funnel.overall_funnel(tied, STEPS)).first().step_name == "click"  # three halvings: the first


def test_bounces_share(events):
    n = sum(map(len, HISTORY.values()))
    bounces = sum(h.count("b") for h in HISTORY.values())
    assert funnel.bounce_rate(events).first().bounce_rate_pct == pytest.approx(100 * bounces / n, abs=0.005)


def test_channels(spark, reach):
    customers = spark.createDataFrame(list(CHANNEL.items()), "customer_id long, acquisition_channel string")
    by = funnel.funnel_by_channel(reach, customers, STEPS)
    got = {(r.acquisition_channel, r.step_name): (r.customers_reached, r.pct_of_signups) for r in by.collect()}
    assert got[("Direct", "view")] == (0, 0.0) and got[("Direct", "purchase")] == (1, 100.0)
    assert got[("Social", "click")] == (2, 66.67) and got[("Search", "add_to_cart")] == (3, 100.0)  # 25 only bounced
    assert [(r.acquisition_channel, r.pct_of_signups) for r in funnel.channel_conversion(by).collect()] == \
        [("Direct", 100.0), ("Search", 33.33), ("Social", 33.33)]


def test_profile_gives_the_same_reach(events, reach):
    from kestrel.plans import reports
    table = reports.activity_profile(events.withColumn("experiment_group", F.lit("Control")), STEPS)
    assert sorted(map(tuple, reports.reach_of(table, STEPS).select(*reach.columns).collect())) == sorted(map(tuple, reach.collect()))


def test_half_even_rounding_matches_published_share(spark):
    """97,725 of 100,000 -> 97.72 (numpy), not 97.73 (half-up)."""
    reach = spark.range(100000).select(F.col("id").alias("customer_id"), F.lit(True).alias("view"),
                                       (F.col("id") < 97725).alias("click"))
    rows = {r.step_name: r for r in funnel.overall_funnel(reach, ("view", "click")).collect()}
    assert rows["click"].pct_of_customers == 97.72
    assert rows["click"].step_over_step_pct == 97.72


def test_purchase_without_view_and_empty_previous_step(spark):
    ev = spark.createDataFrame([(1, "purchase"), (2, "purchase"), (3, "view")], "customer_id long, event_type string")
    rows = {r.step_name: r for r in funnel.overall_funnel(funnel.customer_step_reach(ev, STEPS), STEPS).collect()}
    assert rows["add_to_cart"].customers_reached == 0
    assert rows["purchase"].step_over_step_pct is None  # previous step 0 -> NULL, no error
    assert rows["click"].drop_off_pct == 100.0


def test_revenue_per_converted(spark):
    tx = spark.createDataFrame([(1, 0, "10.00"), (1, 0, "5.00"), (2, 0, "30.00"), (2, 1, "99.00"), (3, 0, None)],
                               "customer_id long, refund_flag int, gross_revenue string") \
        .withColumn("gross_revenue", F.col("gross_revenue").cast("decimal(10,2)"))
    assert funnel.revenue_per_converted_customer(tx).collect()[0][0] == 22.5


def test_bounce_only_customer_denominators(spark, events):
    """T2: a bounce-only customer is absent from the reach table (dataframe
    denominator) but counted in the SQL funnel's total_customers."""
    from kestrel.plans.sql_queries import LIFECYCLE_FUNNEL
    assert funnel.customer_step_reach(events, STEPS).count() == 7
    events.createOrReplaceTempView("fct_events")
    row = spark.sql(LIFECYCLE_FUNNEL).collect()[0]
    assert row.total_customers == 8 and row.view_count == 6 and row.purchase_count == 3
    spark.catalog.dropTempView("fct_events")
