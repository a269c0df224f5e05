"""Revenue per event by arm: each transaction goes to the purchase event it follows.

Rule: a transaction belongs to the latest purchase event of the same customer and product (neither of them null) that is
not later than it and at most ``window_days`` earlier; of several at one time, the one with the largest event id. Its
revenue counts for that event's arm when it is no refund and has an amount.

As-of match: events and transactions are one range-sorted table (customer, product, time, events first), written once. Within a
range partition a window carries the last event forward; what the first (customer, product) of a partition carries over comes from a table of
one row per partition. So a hot customer or product is cut wherever the bounds fall, no pair of events and transactions is ever
formed beyond the result, and there is no join of either side with the other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kestrel.config import EXPERIMENT_GROUPS, PURCHASE
from kestrel.operators.quantiles import staged_order
from kestrel.operators.sessions import micros

US_PER_DAY = 86_400_000_000
WINDOW_DAYS = 30


def last_before(rows: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, label: str, partitions: int | None = None) -> DataFrame:
    """Adds ``_last``: the latest non-null ``value`` of rows with the same keys up to and including the row."""
    staged = staged_order(rows, [*keys, *order], label, partitions)
    here = Window.partitionBy("_pid", *keys).orderBy("_pos").rowsBetween(Window.unboundedPreceding, 0)  # within one range partition
    local = staged.withColumn("_last", F.last(value, ignorenulls=True).over(here))
    group = F.struct(*keys)
    edges = local.groupBy("_pid").agg(F.min_by(group, "_pos").alias("first"), F.max_by(F.struct(group.alias("key"), F.col("_last").alias("last")), "_pos").alias("end"))
    # from here on one row per partition; partitions between two that share a key hold nothing else
    same_end = Window.partitionBy("end.key").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("reached", F.struct(F.col("end.key").alias("key"), F.last("end.last", ignorenulls=True).over(same_end).alias("last")))
    prior = F.lag("reached").over(Window.partitionBy(F.lit(0)).orderBy("_pid"))
    carried = edges.withColumn("prior", prior).select("_pid", "first", F.when(F.col("prior.key").eqNullSafe(F.col("first")), F.col("prior.last")).alias("_carried"))
    out = local.join(carried, "_pid")
    return (out.withColumn("_last", F.coalesce("_last", F.when(group.eqNullSafe(F.col("first")), F.col("_carried"))))
            .drop("_pid", "_pos", "first", "_carried"))


def attribute_transactions(events: DataFrame, transactions: DataFrame, window_days: float = WINDOW_DAYS, partitions: int | None = None) -> DataFrame:
    """Every transaction with ``event_id`` and ``experiment_group`` of its purchase event (null if it has none): transaction_id,
    customer_id, product_id, refund_flag, gross_revenue, event_id, experiment_group, seconds_after."""
    none = F.lit(None)
    ev = events.where(F.col("event_type") == PURCHASE).where(F.col("customer_id").isNotNull() & F.col("product_id").isNotNull())
    ev = ev.where(F.col("timestamp").isNotNull()).select(
        "customer_id", "product_id", micros(events, "timestamp").alias("us"), F.lit(0).alias("kind"), F.col("event_id").alias("id"),
        F.struct(F.col("event_id"), F.col("experiment_group"), micros(events, "timestamp").alias("us")).alias("event"),
        none.cast("int").alias("refund_flag"), none.cast("decimal(38,2)").alias("gross_revenue"))
    tx = transactions.select("customer_id", "product_id", micros(transactions, "timestamp").alias("us"), F.lit(1).alias("kind"),
                             F.col("transaction_id").alias("id"), none.cast(ev.schema["event"].dataType).alias("event"),
                             F.col("refund_flag").cast("int"), F.col("gross_revenue").cast("decimal(38,2)"))
    lasts = last_before(ev.unionByName(tx), ["customer_id", "product_id"], ["us", "kind", "id"], "event", "attribution", partitions)
    after = F.col("us") - F.col("_last.us")
    found = F.when(after <= int(window_days * US_PER_DAY), F.col("_last"))
    return (lasts.where("kind = 1").withColumn("_found", found)
            .select(F.col("id").alias("transaction_id"), "customer_id", "product_id", "refund_flag", "gross_revenue", F.col("_found.event_id"),
                    F.col("_found.experiment_group"), F.when(F.col("_found").isNotNull(), after / F.lit(1e6)).alias("seconds_after")))


def revenue_per_event(events: DataFrame, transactions: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS, window_days: float = WINDOW_DAYS,
                      partitions: int | None = None) -> DataFrame:
    """Per arm: events, purchase events, matched transactions, revenue, revenue per event, and its lift over the first arm in percent."""
    matched = attribute_transactions(events, transactions, window_days, partitions)
    counts = events.where(F.col("experiment_group").isin(list(groups))).groupBy("experiment_group").agg(
        F.count("*").alias("total_events"), F.count_if(F.col("event_type") == PURCHASE).alias("purchase_events"))
    paid = (F.col("refund_flag") == 0) & F.col("gross_revenue").isNotNull()
    sums = matched.where(F.col("event_id").isNotNull()).groupBy("experiment_group").agg(
        F.count("*").alias("matched_transactions"), F.coalesce(F.sum(F.when(paid, F.col("gross_revenue"))), F.lit(0)).cast("decimal(38,2)").alias("revenue"))
    arms = F.array(*[F.struct(F.lit(i).alias("arm_idx"), F.lit(g).alias("experiment_group")) for i, g in enumerate(groups)])
    rows = counts.sparkSession.range(1).select(F.inline(arms)).join(counts, "experiment_group", "left").join(sums, "experiment_group", "left")
    rows = rows.select("arm_idx", "experiment_group", F.coalesce("total_events", F.lit(0)).alias("total_events"),
                       F.coalesce("purchase_events", F.lit(0)).alias("purchase_events"), F.coalesce("matched_transactions", F.lit(0)).alias("matched_transactions"),
                       F.coalesce(F.col("revenue").cast("double"), F.lit(0.0)).alias("revenue"))
    rows = rows.withColumn("revenue_per_event", F.try_divide("revenue", F.col("total_events").cast("double")))
    base = F.max(F.when(F.col("arm_idx") == 0, F.col("revenue_per_event"))).over(Window.partitionBy(F.lit(0)))  # a row per arm
    return rows.withColumn("lift_pct", F.round(F.try_divide(F.col("revenue_per_event") - base, base) * 100, 6)).withColumn(
        "revenue_per_event", F.round("revenue_per_event", 9))
