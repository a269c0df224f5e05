"""Result marts: writers (S11, S12) and a reader with live/snapshot fallback (S13, S14).

Marts are small by construction (steps x channels, arms, comparisons), so each
is written as a single file; the computation behind them stays distributed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import path_exists

CSV_MARTS = ("funnel_overall", "funnel_by_channel", "ab_test_totals", "ab_test_bootstrap")
JSON_MARTS = ("ab_test_pairwise", "summary_stats")

MART_SCHEMAS = {
    "funnel_overall": "step_name string, customers_reached bigint, pct_of_customers double, "
                      "step_over_step_pct double, drop_off_pct double",
    "funnel_by_channel": "acquisition_channel string, step_name string, customers_reached bigint, "
                         "pct_of_signups double",
    "ab_test_totals": "experiment_group string, total_events bigint, purchase_events bigint, purchase_rate double",
    "ab_test_bootstrap": "comparison string, median_lift_pp double, `ci_2.5pct` double, `ci_97.5pct` double",
    "ab_test_pairwise": "group_a string, group_b string, rate_a double, rate_b double, absolute_lift_pp double, "
                        "z_stat double, p_value double, significant boolean",
    "summary_stats": "chi2 double, chi2_p_value double, chi2_dof int, bounce_rate_pct double, "
                     "avg_revenue_per_converted_customer double, total_customers bigint",
}


def _conform(df: DataFrame, name: str) -> DataFrame:
    schema = T._parse_datatype_string(MART_SCHEMAS[name])
    return df.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])


def write_marts(marts: dict[str, DataFrame], out_dir: str) -> dict[str, str]:
    paths = {}
    for name, df in marts.items():
        path = f"{out_dir.rstrip('/')}/{name}"
        one = _conform(df, name).coalesce(1)
        if name in CSV_MARTS:
            one.write.mode("overwrite").option("header", True).csv(path)
        else:
            one.write.mode("overwrite").json(path)
        paths[name] = path
    return paths


def read_mart(spark: SparkSession, out_dir: str, name: str) -> DataFrame:
    schema = MART_SCHEMAS[name]
    path = f"{out_dir.rstrip('/')}/{name}"
    if name in CSV_MARTS:
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_marts(spark: SparkSession, snapshot_dir: str, live: Callable[[], dict[str, DataFrame]] | None = None,
               warehouse_dir: str | None = None) -> dict[str, DataFrame]:
    """Live marts when the warehouse exists (``live()`` computes them, only then), else the
    snapshot files; each frame carries a ``mode`` column. Existence is asked of the path's
    own store. Neither warehouse nor any snapshot is an error, not an empty result."""
    if warehouse_dir and live is not None and path_exists(spark, f"{warehouse_dir.rstrip('/')}/manifests"):
        return {k: _conform(v, k).withColumn("mode", F.lit("live")) for k, v in live().items()}
    found = {k: read_mart(spark, snapshot_dir, k).withColumn("mode", F.lit("snapshot")) for k in MART_SCHEMAS
             if path_exists(spark, f"{snapshot_dir.rstrip('/')}/{k}")}
    if not found:
        raise FileNotFoundError(f"no warehouse and no mart snapshot in {snapshot_dir}")
    return found
