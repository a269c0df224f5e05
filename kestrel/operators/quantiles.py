"""Exact percentiles (linear interpolation) without gathering a column into one task.

``percentile()`` keeps a value->count map per group and merges it in one task;
over an event-sized column (all gaps, all sessions) that is one task holding
everything. Here the same numbers come from distributed prefix sums:

1. value -> weight table per group (partial aggregation);
2. range-partition and sort it by (group, value) and write that once, with the
   partition id and position; within each range partition a window gives the
   weight before each value, and a per-partition total table turns that into the
   global rank interval [before, before + weight) of every distinct value and the
   group size n (both read the one written table, so they agree on the bounds);
3. the ranks the interpolation needs, floor/ceil of q*(n-1), are columns, so
   one aggregation per group picks the two values and interpolates. Callers may
   add their own aggregates (counts, moments) to that same pass.

Interpolation matches ``numpy.percentile`` / Spark ``percentile`` / DuckDB
``quantile_cont``: v[lo] + (v[hi] - v[lo]) * (pos - lo), pos = q * (n - 1).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.session import materialize

WEIGHT = "_w"


def staged_order(df: DataFrame, order: Sequence[str], label: str, partitions: int | None = None) -> DataFrame:
    """``df`` range-partitioned and sorted by ``order``, written once, with the range
    partition ``_pid`` and the position ``_pos`` in it as stored columns.

    Range bounds are sampled when the exchange runs, so two evaluations (or two
    branches pruned to different columns) may cut differently: everything that
    follows must read the same written table.
    """
    n_parts = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    position = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(ranged.withColumn("_pid", F.spark_partition_id()).withColumn("_pos", position), label)


def dense_index(df: DataFrame, order: Sequence[str], index: str = "idx", total: str = "n_rows",
                partitions: int | None = None) -> DataFrame:
    """Adds the 0-based rank by ``order`` and the row count, without a one-task row_number:
    position in the range partition plus the sizes of the partitions before it (a
    table of one row per partition). Ties in ``order`` get consecutive ranks."""
    staged = staged_order(df, order, "dense-index", partitions)
    sizes = staged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_size")).withColumn("_all", F.lit(0))
    w = Window.partitionBy("_all")
    offsets = sizes.select("_pid", F.coalesce(F.sum("_size").over(w.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)).alias("_off"), F.sum("_size").over(w).alias(total))
    return (staged.join(offsets, "_pid").withColumn(index, F.col("_off") + F.col("_pos"))
            .drop("_pid", "_pos", "_off"))


def global_ranks(freq: DataFrame, value_col: str, weight_col: str, group_cols: Sequence[str],
                 partitions: int | None = None) -> DataFrame:
    """Adds ``_before`` (total weight of smaller values in the group) and ``_n``
    (group total weight). A distributed prefix sum over a table that is written once:
    range partitions keep each task bounded even when one group holds most rows."""
    groups = list(group_cols)
    staged = staged_order(freq, [*groups, value_col], "ranks", partitions)
    w_local = (Window.partitionBy("_pid", *groups).orderBy("_pos")
               .rowsBetween(Window.unboundedPreceding, -1))
    local = staged.withColumn("_local", F.coalesce(F.sum(weight_col).over(w_local), F.lit(0).cast("long")))
    part_tot = staged.groupBy("_pid", *groups).agg(F.sum(weight_col).alias("_tot"))
    w_off = Window.partitionBy(*groups).orderBy("_pid")
    offsets = (part_tot
               .withColumn("_off", F.coalesce(F.sum("_tot").over(w_off.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0).cast("long")))
               .withColumn("_n", F.sum("_tot").over(Window.partitionBy(*groups))))
    # the size of offsets follows the number of groups, so the planner chooses the join by its size
    joined = local.join(offsets.select("_pid", *groups, "_off", "_n"), ["_pid", *groups], "inner")
    return joined.withColumn("_before", F.col("_off") + F.col("_local")).drop("_pid", "_pos", "_off", "_local")


def ranked_frequencies(df: DataFrame, value_col: str, group_cols: Sequence[str] = (),
                       partitions: int | None = None) -> tuple[DataFrame, list[str]]:
    """Distinct (group, value) with weight ``_w``, rank ``_before`` and group size ``_n``."""
    groups = list(group_cols) or ["_g"]
    base = df if group_cols else df.withColumn("_g", F.lit(0))
    freq = (base.filter(F.col(value_col).isNotNull())
            .groupBy(*groups, value_col).agg(F.count(F.lit(1)).alias(WEIGHT)))
    return global_ranks(freq, value_col, WEIGHT, groups, partitions), groups


def pick_percentiles(ranked: DataFrame, groups: Sequence[str], value_col: str, probs: Sequence[float],
                     names: Sequence[str], extra: Sequence[Column] = ()) -> DataFrame:
    """One aggregation over the ranked frequency table: the interpolated
    percentiles plus any ``extra`` aggregate columns (which may use ``_w``)."""
    v, lo_b, w = F.col(value_col).cast("double"), F.col("_before"), F.col(WEIGHT)
    aggs = []
    for i, q in enumerate(probs):
        pos = F.lit(float(q)) * (F.col("_n") - 1).cast("double")
        lo, hi = F.floor(pos), F.ceil(pos)
        aggs += [F.max(F.when((lo >= lo_b) & (lo < lo_b + w), v)).alias(f"_lo{i}"),
                 F.max(F.when((hi >= lo_b) & (hi < lo_b + w), v)).alias(f"_hi{i}"),
                 F.max(pos - lo).alias(f"_f{i}")]
    picked = ranked.groupBy(*groups).agg(*aggs, *extra)
    extra_names = [c for c in picked.columns if c not in groups and not c.startswith(("_lo", "_hi", "_f"))]
    outs = [(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(nm)
            for i, nm in enumerate(names)]
    return picked.select(*groups, *outs, *extra_names)


def exact_percentiles(df: DataFrame, value_col: str, probs: Sequence[float],
                      group_cols: Sequence[str] = (), names: Sequence[str] | None = None,
                      partitions: int | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per group with one column per probability (NULLs ignored)."""
    names = list(names or [f"p{int(round(q * 1000)):04d}" for q in probs])
    ranked, groups = ranked_frequencies(df, value_col, group_cols, partitions)
    out = pick_percentiles(ranked, groups, value_col, probs, names, extra)
    return out if group_cols else out.drop("_g")
