"""Customer-lifecycle funnel: did a customer ever reach each step?

Plan shape: events -> filter(step IN ...) pushed to the Parquet scan ->
partial aggregation per customer (map-side combine, so a customer holding a
third of all events costs one row per map task) -> shuffle on customer_id ->
final ``bool_or`` per step. Funnel totals are a global aggregate over that
(partial again), so only one row per task reaches the final reducer. The
4-step "previous step" ratio is computed in wide form before unpivoting, so no
window without a partition is needed.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.config import BOUNCE, FUNNEL_STEPS, PURCHASE
from kestrel.functions.rounding import pct, round_np


def customer_step_reach(events: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """One row per customer with any step event; one boolean column per step.

    Customers whose only events are outside the steps (e.g. bounce) are absent;
    a step nobody reached is an all-false column.
    """
    et = F.col("event_type")
    return (events.select("customer_id", "event_type")
            .filter(et.isin(list(steps)))
            .groupBy("customer_id")
            .agg(*[F.bool_or(et == s).alias(s) for s in steps]))


def _step_rows(counts: dict[str, Column], steps: Sequence[str]) -> Column:
    """Array of (step_idx, step_name, customers_reached, prev_reached) structs."""
    rows = []
    for i, s in enumerate(steps):
        prev = counts[steps[i - 1]] if i > 0 else F.lit(None).cast("bigint")
        rows.append(F.struct(F.lit(i).alias("step_idx"), F.lit(s).alias("step_name"),
                             counts[s].alias("customers_reached"), prev.alias("prev_reached")))
    return F.array(*rows)


def overall_funnel(reach: DataFrame, steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """step_idx, step_name, customers_reached, pct_of_customers, step_over_step_pct, drop_off_pct.

    The denominator is the number of rows of ``reach``. The first step's ratio is
    100; a previous step of 0 gives NULL (not an error, not inf).
    """
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(F.col(s)).alias(s) for s in steps]
    wide = reach.agg(*aggs)
    counts = {s: F.col(s) for s in steps}
    long = wide.select(F.col("total"), F.explode(_step_rows(counts, steps)).alias("r")).select("total", "r.*")
    sos = F.when(F.col("step_idx") == 0, F.lit(100.0)).otherwise(
        round_np(pct(F.col("customers_reached"), F.col("prev_reached"))))
    return (long.select(
        F.col("step_idx").cast("int").alias("step_idx"),
        F.col("step_name"),
        F.col("customers_reached").cast("bigint").alias("customers_reached"),
        round_np(pct(F.col("customers_reached"), F.col("total"))).alias("pct_of_customers"),
        sos.alias("step_over_step_pct"))
        .withColumn("drop_off_pct", round_np(F.lit(100.0) - F.col("step_over_step_pct"))))


def biggest_drop_off_step(overall: DataFrame) -> DataFrame:
    """The step (first excluded) with the largest drop-off; ties -> lower step index."""
    return (overall.filter(F.col("step_idx") > 0)
            .orderBy(F.desc_nulls_last("drop_off_pct"), F.asc("step_idx"))
            .limit(1)
            .select("step_name", "drop_off_pct"))


def bounce_rate(events: DataFrame) -> DataFrame:
    """Share of all events that are bounces, in percent, 2 dp (numpy rounding)."""
    et = F.col("event_type")
    return (events.select("event_type")
            .agg(F.count_if(et == BOUNCE).alias("b"), F.count(F.lit(1)).alias("n"))
            .select(round_np(pct(F.col("b"), F.col("n"))).alias("bounce_rate_pct")))


def funnel_by_channel(reach: DataFrame, customers: DataFrame,
                      steps: Sequence[str] = FUNNEL_STEPS) -> DataFrame:
    """Per channel and step: customers_reached and pct_of_signups.

    The denominator is the channel's customers present in ``reach`` (not all
    signups). ``reach`` leaves its aggregation hash-partitioned on customer_id,
    so the join shuffles only the customer side; the channel aggregation is
    partial (one row per channel per task).
    """
    joined = reach.join(customers.select("customer_id", "acquisition_channel"), "customer_id", "inner")
    aggs = [F.count(F.lit(1)).alias("total")] + [F.count_if(F.col(s)).alias(s) for s in steps]
    wide = joined.groupBy("acquisition_channel").agg(*aggs)
    counts = {s: F.col(s) for s in steps}
    return (wide.select("acquisition_channel", "total", F.explode(_step_rows(counts, steps)).alias("r"))
            .select(F.col("acquisition_channel"),
                    F.col("r.step_idx").cast("int").alias("step_idx"),
                    F.col("r.step_name").alias("step_name"),
                    F.col("r.customers_reached").cast("bigint").alias("customers_reached"),
                    round_np(pct(F.col("r.customers_reached"), F.col("total"))).alias("pct_of_signups"))
            .orderBy("acquisition_channel", "step_idx"))


def channel_conversion(by_channel: DataFrame, final_step: str = PURCHASE) -> DataFrame:
    """Ever-reached-final-step rate per channel, highest first."""
    return (by_channel.filter(F.col("step_name") == final_step)
            .select("acquisition_channel", "customers_reached", "pct_of_signups")
            .orderBy(F.desc("pct_of_signups"), F.asc("acquisition_channel")))


def revenue_per_converted_customer(transactions: DataFrame) -> DataFrame:
    """Mean over customers of their summed non-refund, non-null revenue (2 dp).

    Sums stay DECIMAL so the result does not depend on partitioning.
    """
    per_customer = (transactions
                    .filter((F.col("refund_flag") == 0) & F.col("gross_revenue").isNotNull())
                    .groupBy("customer_id")
                    .agg(F.sum("gross_revenue").alias("customer_total")))
    return per_customer.agg(
        round_np(F.avg("customer_total").cast("double")).alias("avg_revenue_per_converted_customer"))
