"""Report marts: the KPI row (A18/A19), the funnel regression alerts (E3) and
the mart bundle the dashboard reads (S11/S12)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.config import BOUNCE, DRIVER, PURCHASE, Profile
from kestrel.functions.rounding import pct, round_np
from kestrel.operators import bootstrap, experiment, funnel
from kestrel.operators.common import one_row
from kestrel.session import materialize as materialize_df

REGRESSION_THRESHOLD_PP = 2.0


def activity_profile(events: DataFrame, steps=DRIVER.steps) -> DataFrame:
    """Per (customer, arm): event, purchase and bounce counts and a flag per step - all that
    the funnel and experiment marts need, from one pass over the events."""
    et = F.col("event_type")
    return events.groupBy("customer_id", "experiment_group").agg(
        F.count(F.lit(1)).alias("total_events"), F.count_if(et == PURCHASE).alias("purchase_events"),
        F.count_if(et == BOUNCE).alias("bounces"), *[F.bool_or(F.coalesce(et == s, F.lit(False))).alias(s) for s in steps])


def reach_of(profile_table: DataFrame, steps=DRIVER.steps) -> DataFrame:
    """The reach table (``funnel.customer_step_reach``) from the activity profile."""
    per = profile_table.groupBy("customer_id").agg(*[F.bool_or(s).alias(s) for s in steps])
    return per.where(reduce(lambda a, b: a | b, [F.col(s) for s in steps]))


def kpi_summary(events: DataFrame, transactions: DataFrame, profile: Profile = DRIVER,
                activity: DataFrame | None = None) -> DataFrame:
    """One row: chi-square result, bounce rate, revenue per converted customer,
    first-step reach (``total_customers``, as the original defines it), the
    reach denominator, final-step reach and share, and the worst step. Events are
    scanned once, for the activity profile."""
    if activity is None:
        activity = materialize_df(activity_profile(events, profile.steps), "kpi-activity")
    reach = reach_of(activity, profile.steps)
    overall = funnel.overall_funnel(reach, profile.steps)
    last = len(profile.steps) - 1
    reach_stats = overall.agg(
        F.max(F.when(F.col("step_idx") == 0, F.col("customers_reached"))).alias("total_customers"),
        F.max(F.when(F.col("step_idx") == last, F.col("customers_reached"))).alias("ever_purchased"),
        F.max(F.when(F.col("step_idx") == last, F.col("pct_of_customers"))).alias("ever_purchased_pct"))
    denom = reach.agg(F.count(F.lit(1)).alias("denominator_customers"))
    worst = funnel.biggest_drop_off_step(overall).select(F.col("step_name").alias("worst_step"),
                                                         F.col("drop_off_pct").alias("worst_drop_off_pct"))
    totals = experiment.group_totals(activity, profile.groups)
    chi = experiment.chi_square_test(totals, profile.groups).select(
        "chi2", F.col("p_value").alias("chi2_p_value"), F.col("dof").alias("chi2_dof"))
    bounce = activity.agg(round_np(pct(F.sum("bounces"), F.sum("total_events"))).alias("bounce_rate_pct"))
    revenue = funnel.revenue_per_converted_customer(transactions)
    return one_row([chi, bounce, revenue, reach_stats, denom, worst])


def funnel_regression_alerts(events: DataFrame, steps=DRIVER.steps,
                             threshold_pp: float = REGRESSION_THRESHOLD_PP) -> DataFrame:
    """Week-over-week funnel comparison: per ISO week the share of that week's
    active customers reaching each step; a row per (week, step) with the change
    against the week before (seven days earlier; NULL if that week has no events) and
    ``alert`` when it fell by more than the threshold. ``partial_week`` marks the weeks
    that the data cover in part (its first and last); they raise no alert, nor does a
    week after one. The per-step window runs over weeks only (bounded by the time span)."""
    wk = events.withColumn("week_start", F.to_date(F.date_trunc("week", F.col("timestamp"))))
    et = F.col("event_type")
    reach = (wk.filter(et.isin(list(steps)))
             .groupBy("week_start", "customer_id")
             .agg(F.min(F.to_date("timestamp")).alias("first_day"), F.max(F.to_date("timestamp")).alias("last_day"),
                  *[F.bool_or(et == s).alias(s) for s in steps]))
    weekly = reach.groupBy("week_start").agg(F.count(F.lit(1)).alias("total"), F.min("first_day").alias("first_day"),
                                             F.max("last_day").alias("last_day"), *[F.count_if(F.col(s)).alias(s) for s in steps])
    rows = F.array(*[F.struct(F.lit(i).alias("step_idx"), F.lit(s).alias("step_name"), F.col(s).alias("reached"))
                     for i, s in enumerate(steps)])
    long = weekly.select("week_start", "total", "first_day", "last_day", F.inline(rows)) \
        .withColumn("pct_of_customers", round_np(pct(F.col("reached"), F.col("total"))))
    w = Window.partitionBy("step_idx").orderBy("week_start")
    every = Window.partitionBy("step_idx")
    adjacent = F.lag("week_start").over(w) == F.date_sub("week_start", 7)
    partial = (F.min("first_day").over(every) > F.col("week_start")) | (F.max("last_day").over(every) < F.date_add("week_start", 6))
    return (long.withColumn("partial_week", partial)
            .withColumn("prev_pct_of_customers", F.when(adjacent, F.lag("pct_of_customers").over(w)))
            .withColumn("_prev_partial", F.lag("partial_week").over(w))
            .withColumn("change_pp", round_np(F.col("pct_of_customers") - F.col("prev_pct_of_customers")))
            .withColumn("alert", F.coalesce((F.col("change_pp") < F.lit(-threshold_pp)) & ~F.col("partial_week") & ~F.col("_prev_partial"),
                                            F.lit(False)))
            .select("week_start", F.col("step_idx").cast("int").alias("step_idx"), "step_name",
                    F.col("reached").cast("bigint").alias("customers_reached"),
                    F.col("total").cast("bigint").alias("active_customers"),
                    "pct_of_customers", "prev_pct_of_customers", "change_pp", "partial_week", "alert"))


def build_marts(tables: dict[str, DataFrame], profile: Profile = DRIVER) -> dict[str, DataFrame]:
    """The six dashboard marts, named and shaped like the original snapshot files, from the star
    tables (of a warehouse, or raw ones).

    Each mart is written by its own action; the activity profile they share is written
    once to the shared checkpoint folder, so the events are scanned once."""
    activity = materialize_df(activity_profile(tables["fct_events"], profile.steps), "mart-activity")
    reach = reach_of(activity, profile.steps)
    counts = activity.select("customer_id", "experiment_group", "total_events", "purchase_events")
    totals = experiment.group_totals(counts, profile.groups)
    ci = bootstrap.bootstrap_ci(bootstrap.bootstrap_replicates(counts, profile.groups, profile.n_boot, profile.seed),
                                profile.groups)
    return {
        "funnel_overall": funnel.overall_funnel(reach, profile.steps).orderBy("step_idx"),
        "funnel_by_channel": funnel.funnel_by_channel(reach, tables["dim_customers"], profile.steps),
        "ab_test_totals": totals.orderBy("arm_idx"),
        "ab_test_pairwise": experiment.pairwise_tests(totals, profile.groups, profile.alpha).orderBy("pair_idx"),
        "ab_test_bootstrap": ci.orderBy("cmp_idx").select(
            "comparison", "median_lift_pp", F.col("ci_2_5pct").alias("ci_2.5pct"),
            F.col("ci_97_5pct").alias("ci_97.5pct")),
        "summary_stats": kpi_summary(tables["fct_events"], tables["fct_transactions"], profile, activity),
    }
