"""Event-level experiment evaluation: sufficient statistics, arm totals,
Pearson chi-square, Bonferroni-corrected pooled z-tests, report rows and a
sample-ratio-mismatch check.

Everything past ``customer_group_counts`` works on one row per arm; the arms
are a parameter (the list fixes their order). Arm statistics are laid out as
one wide row so tests are plain column expressions - no window, no join.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kestrel.config import ALPHA, EXPERIMENT_GROUPS, PURCHASE
from kestrel.functions.labels import format_p, versus, yes_no
from kestrel.functions.rounding import round_np
from kestrel.functions.stats import with_chi2_survival, with_two_proportion_z


def customer_group_counts(events: DataFrame, success_type: str = PURCHASE) -> DataFrame:
    """Per (customer, arm): all events and success events. Partial aggregation
    keeps a hot customer to one row per arm per map task."""
    return (events.groupBy("customer_id", "experiment_group")
            .agg(F.count(F.lit(1)).alias("total_events"),
                 F.count_if(F.col("event_type") == success_type).alias("purchase_events")))


def _arm_list(spark, groups: Sequence[str]) -> DataFrame:
    """The fixed arm list as a tiny frame (arm_idx, experiment_group)."""
    rows = F.array(*[F.struct(F.lit(i).alias("arm_idx"), F.lit(g).alias("experiment_group"))
                     for i, g in enumerate(groups)])
    return spark.range(1).select(F.inline(rows))


def group_totals(counts: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS) -> DataFrame:
    """Per listed arm, in list order: totals and purchase rate. Unknown arms are
    dropped; a listed arm with no rows gives a row of NULLs."""
    sums = (counts.filter(F.col("experiment_group").isin(list(groups)))
            .groupBy("experiment_group")
            .agg(F.sum("total_events").cast("bigint").alias("total_events"),
                 F.sum("purchase_events").cast("bigint").alias("purchase_events")))
    # both sides have at most len(groups) rows
    arms = _arm_list(counts.sparkSession, groups)
    return (arms.join(F.broadcast(sums), "experiment_group", "left")
            .select("arm_idx", "experiment_group", "total_events", "purchase_events",
                    F.try_divide(F.col("purchase_events").cast("double"), F.col("total_events")).alias("purchase_rate")))


def _wide(totals: DataFrame, groups: Sequence[str]) -> DataFrame:
    """One row: n0, x0, n1, x1, ... in arm-list order."""
    g = F.col("experiment_group")
    aggs = []
    for i, name in enumerate(groups):
        aggs += [F.max(F.when(g == name, F.col("total_events"))).alias(f"n{i}"),
                 F.max(F.when(g == name, F.col("purchase_events"))).alias(f"x{i}")]
    return totals.agg(*aggs)


def _with_chi2(wide: DataFrame, k: int) -> DataFrame:
    """Pearson statistic from the wide row, staged: totals, then expected counts
    per cell, then the sum (each intermediate is computed once)."""
    n = [F.col(f"n{i}").cast("double") for i in range(k)]
    x = [F.col(f"x{i}").cast("double") for i in range(k)]
    df = wide.withColumn("_N", sum(n[1:], n[0])).withColumn("_X", sum(x[1:], x[0]))
    df = df.withColumn("_F", F.col("_N") - F.col("_X"))
    for i in range(k):
        df = (df.withColumn(f"_es{i}", F.try_divide(F.col("_X") * n[i], F.col("_N")))
                .withColumn(f"_ef{i}", F.try_divide(F.col("_F") * n[i], F.col("_N"))))
    terms = [F.try_divide(F.pow(x[i] - F.col(f"_es{i}"), F.lit(2)), F.col(f"_es{i}"))
             + F.try_divide(F.pow((n[i] - x[i]) - F.col(f"_ef{i}"), F.lit(2)), F.col(f"_ef{i}")) for i in range(k)]
    return df.withColumn("chi2", sum(terms[1:], terms[0]))


def chi_square_test(totals: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS) -> DataFrame:
    """Pearson chi-square on the 2 x k table (success / not by arm), no continuity
    correction; NULL when an arm is missing or an expected count is 0 (no
    purchases at all, nothing but purchases, an arm without events)."""
    dof = len(groups) - 1
    df = with_chi2_survival(_with_chi2(_wide(totals, groups), len(groups)), "chi2", dof, "_p")
    return df.select(F.round("chi2", 9).alias("chi2"), F.round("_p", 12).alias("p_value"),
                     F.lit(dof).alias("dof"))


def pairwise_tests(totals: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS,
                   alpha: float = ALPHA) -> DataFrame:
    """All arm pairs in list order, pooled two-sided z-test, Bonferroni alpha/m,
    significant = p < alpha/m (strict); lift in percentage points (b - a). With a
    missing arm the pair has NULL z, p and significance: no test was run."""
    pairs = list(combinations(range(len(groups)), 2))
    b_alpha = alpha / len(pairs)
    wide = _wide(totals, groups)
    rows = F.array(*[F.struct(F.lit(i).alias("pair_idx"),
                              F.lit(groups[a]).alias("group_a"), F.lit(groups[b]).alias("group_b"),
                              F.col(f"n{a}").alias("n_a"), F.col(f"x{a}").alias("x_a"),
                              F.col(f"n{b}").alias("n_b"), F.col(f"x{b}").alias("x_b"))
                     for i, (a, b) in enumerate(pairs)])
    long = with_two_proportion_z(wide.select(F.inline(rows)), "n_a", "x_a", "n_b", "x_b")
    return long.select(
        "pair_idx", "group_a", "group_b", "rate_a", "rate_b",
        ((F.col("rate_b") - F.col("rate_a")) * F.lit(100.0)).alias("absolute_lift_pp"),
        F.round("z_stat", 9).alias("z_stat"),
        F.round("p_value", 12).alias("p_value"),
        F.lit(b_alpha).alias("bonferroni_alpha"),
        (F.col("p_value") < F.lit(b_alpha)).alias("significant"))


def two_proportion_test(totals: DataFrame, group_a: str, group_b: str) -> DataFrame:
    """One pooled z-test between two named arms."""
    wide = with_two_proportion_z(_wide(totals, [group_a, group_b]), "n0", "x0", "n1", "x1")
    return wide.select(F.lit(group_a).alias("group_a"), F.lit(group_b).alias("group_b"), "rate_a", "rate_b",
                       F.round("z_stat", 9).alias("z_stat"), F.round("p_value", 12).alias("p_value"))


def experiment_report(pairwise: DataFrame) -> DataFrame:
    """Dashboard rows: comparison, lift (2 dp), p-value label, Yes/No."""
    return pairwise.select(
        "pair_idx",
        versus(F.col("group_a"), F.col("group_b")).alias("comparison"),
        round_np(F.col("absolute_lift_pp")).alias("lift_pp"),
        format_p(F.col("p_value")).alias("p_value_label"),
        yes_no(F.col("significant")).alias("significant_bonferroni"))


def sample_ratio_test(totals: DataFrame, groups: Sequence[str] = EXPERIMENT_GROUPS,
                      expected: Sequence[float] = (0.6, 0.2, 0.2)) -> DataFrame:
    """Goodness-of-fit chi-square of arm event counts against the planned split."""
    if len(expected) != len(groups):
        raise ValueError("one expected share per arm")
    total = sum(expected)
    shares = [s / total for s in expected]
    n = [F.col(f"n{i}").cast("double") for i in range(len(groups))]
    df = _wide(totals, groups).withColumn("_N", sum(n[1:], n[0]))
    terms = [F.try_divide(F.pow(n[i] - F.col("_N") * F.lit(s), F.lit(2)), F.col("_N") * F.lit(s)) for i, s in enumerate(shares)]
    dof = len(groups) - 1
    df = with_chi2_survival(df.withColumn("chi2", sum(terms[1:], terms[0])), "chi2", dof, "_p")
    return df.select(F.round("chi2", 9).alias("chi2"), F.round("_p", 12).alias("p_value"), F.lit(dof).alias("dof"))
