"""Daily summaries that merge: distinct counts and funnel reach of any span of days without its events.

Distinct counts: one HLL sketch per day and measure (2**LG_K registers, a few kilobytes); the union of days estimates the
distinct count of the span within a known error (the registers are those of all its rows counted together; the estimator of a union
is not the one of a single pass, so the two numbers may differ within that error).

Reach: customers are numbered densely once; per day, step, channel and bucket of 32,768 numbers a bitmap says who was there. The
funnel of a span is the OR of its days' bitmaps and a count of bits: exact, and as large as the
customers, not the events. Rows without a customer or a day belong to no bitmap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kestrel.config import FUNNEL_STEPS
from kestrel.functions.rounding import pct, round_np
from kestrel.operators.quantiles import dense_index

LG_K = 12
#: Four standard errors of a sketch of 2**LG_K registers (1.04 / sqrt(2**LG_K) each).
ERROR_BOUND = 4 * 1.04 / 2 ** (LG_K / 2)


def day(ts_col: str = "timestamp") -> Column:
    return F.to_date(ts_col)


def daily_sketches(events: DataFrame, measures: Sequence[str], ts_col: str = "timestamp", lg_k: int = LG_K) -> DataFrame:
    """(day, measure, n_rows, sketch): per day one sketch of each column's distinct non-null values."""
    aggs = [F.struct(F.lit(m).alias("measure"), F.count(m).alias("n_rows"), F.hll_sketch_agg(F.col(m).cast("string"), lg_k).alias("sketch")) for m in measures]
    wide = events.groupBy(day(ts_col).alias("day")).agg(*(a.alias(f"_{i}") for i, a in enumerate(aggs)))
    return wide.select("day", F.inline(F.array(*(F.col(f"_{i}") for i in range(len(aggs))))))


def merged_distinct(sketches: DataFrame, *by: Column) -> DataFrame:
    """Rows and estimated distinct values per measure of the days together, by any grouping of days."""
    return sketches.groupBy(*by, "measure").agg(F.sum("n_rows").alias("n_rows"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"))


def number_customers(customers: DataFrame, partitions: int | None = None) -> DataFrame:
    """customer_id, acquisition_channel and a dense number from 0: the bit that stands for the customer in every bitmap."""
    known = customers.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(F.min("acquisition_channel").alias("acquisition_channel"))
    return dense_index(known, ["customer_id"], "number", "_n", partitions).drop("_n")


def daily_reach_bitmaps(events: DataFrame, numbers: DataFrame, steps: Sequence[str] = FUNNEL_STEPS, ts_col: str = "timestamp") -> DataFrame:
    """(day, acquisition_channel, step_name, bucket, bitmap). A customer's events of a day and step are one row before the join."""
    once = (events.where(F.col("event_type").isin(list(steps))).select(day(ts_col).alias("day"), "customer_id", F.col("event_type").alias("step_name"))
            .where(F.col("day").isNotNull()).distinct())
    bit = F.col("number") + 1  # buckets hold 1 to 32,768, and so on
    return (once.join(numbers, "customer_id")
            .groupBy("day", "acquisition_channel", "step_name", F.bitmap_bucket_number(bit).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bitmap")))


def span_funnel(bitmaps: DataFrame, steps: Sequence[str], *span: Column) -> DataFrame:
    """Funnel by channel of each span of days (any grouping of ``day``; none: all days): step_idx, step_name,
    customers_reached and pct_of_customers of those the channel had in any step of the span."""
    names = [f"span_{i}" for i in range(len(span))] if len(span) > 1 else ["span"][:len(span)]
    days = bitmaps.select(*(s.alias(n) for s, n in zip(span, names)), "acquisition_channel", "bucket", "step_name", "bitmap")
    bits = {s: F.bitmap_or_agg(F.when(F.col("step_name") == s, F.col("bitmap"))) for s in steps}
    merged = days.groupBy(*names, "acquisition_channel", "bucket").agg(F.bitmap_or_agg("bitmap").alias("_any"), *(b.alias(s) for s, b in bits.items()))
    counted = merged.groupBy(*names, "acquisition_channel").agg(
        F.sum(F.bitmap_count("_any")).alias("total"), *(F.sum(F.coalesce(F.bitmap_count(F.col(s)), F.lit(0))).alias(s) for s in steps))
    rows = F.array(*(F.struct(F.lit(i).alias("step_idx"), F.lit(s).alias("step_name"), F.col(s).alias("customers_reached")) for i, s in enumerate(steps)))
    return counted.select(*names, "acquisition_channel", "total", F.inline(rows)).select(
        *names, "acquisition_channel", "step_idx", "step_name", "customers_reached", round_np(pct(F.col("customers_reached"), F.col("total"))).alias("pct_of_customers"))
