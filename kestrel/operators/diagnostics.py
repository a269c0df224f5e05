"""Data-quality diagnostics the analysed application states as findings (D1-D3)
and the describe() table of sessions (A15)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.config import SESSION_GAP_MINUTES
from kestrel.functions.rounding import pct
from kestrel.operators.quantiles import WEIGHT, exact_percentiles

QUARTILES = (0.25, 0.5, 0.75)


def _share_multi(df: DataFrame, key: str, member: str, label: str) -> DataFrame:
    """For each ``key``, count distinct ``member``; report how many keys have more than one.

    ``countDistinct`` inside a grouped aggregation is planned as two partial
    aggregations (key, member) then key, so a hot key is pre-aggregated per task.
    """
    per_key = df.groupBy(key).agg(F.countDistinct(member).alias("_n"))
    return per_key.agg(
        F.count(F.lit(1)).alias(f"n_{label}"),
        F.count_if(F.col("_n") > 1).alias(f"n_{label}_multi"),
        F.round(pct(F.count_if(F.col("_n") > 1), F.count(F.lit(1))), 6).alias(f"pct_{label}_multi"))


def session_sharing(events: DataFrame) -> DataFrame:
    """D1: share of source session_id values used by more than one customer."""
    return _share_multi(events, "session_id", "customer_id", "session_ids")


def group_stickiness(events: DataFrame) -> DataFrame:
    """D3: share of customers seen in more than one experiment arm."""
    return _share_multi(events, "customer_id", "experiment_group", "customers")


def gap_profile(gaps: DataFrame, threshold_minutes: float = SESSION_GAP_MINUTES) -> DataFrame:
    """D2: median gap between a customer's consecutive events, share under the
    threshold - all from one aggregation over the ranked gap frequencies."""
    g, w = F.col("gap_minutes"), F.col(WEIGHT)
    n = F.sum(w)
    under = F.sum(F.when(g < threshold_minutes, w).otherwise(0))
    out = exact_percentiles(gaps, "gap_minutes", [0.5], names=["median_gap_minutes"],
                            extra=[n.cast("bigint").alias("n_gaps"),
                                   F.round(pct(under, n), 6).alias("pct_gaps_under_threshold")])
    return out.select("n_gaps", "pct_gaps_under_threshold",
                      F.round("median_gap_minutes", 6).alias("median_gap_minutes"),
                      F.round(F.col("median_gap_minutes") / 1440.0, 6).alias("median_gap_days"))


def session_describe(summary: DataFrame) -> DataFrame:
    """count, mean, sample std, min, quartiles (exact, linear), max of
    duration_minutes and n_events - pandas ``describe()`` as one row per metric.

    The two metrics are stacked with ``inline`` (one pass over the sessions);
    moments come from the same aggregation as the quartiles, over the value
    frequency table, with DECIMAL sums (values have at most 2 decimals), so
    the sums and n*sum(v^2) - sum(v)^2 are exact before the final division.
    """
    metrics = ["duration_minutes", "n_events"]
    stacked = summary.select(F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("v")) for m in metrics])))
    w = F.col(WEIGHT)
    v = F.col("v").cast("decimal(18,2)")
    n, s1, s2 = F.sum(w), F.sum(v * w), F.sum(v * v * w)
    # n*s2 - s1^2 is exact in DECIMAL; only the final division is floating point
    centered = (n.cast("decimal(20,0)") * s2 - s1 * s1).cast("double")
    var = centered / (n.cast("double") * (n - 1).cast("double"))
    extra = [n.cast("bigint").alias("count"),
             F.round(s1.cast("double") / n.cast("double"), 6).alias("mean"),
             F.round(F.sqrt(var), 6).alias("std"),
             F.min("v").alias("min"), F.max("v").alias("max")]
    q = exact_percentiles(stacked, "v", QUARTILES, ["metric"], names=["p25", "p50", "p75"], extra=extra)
    return q.select("metric", "count", "mean", "std", "min",
                    *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "max")
