"""Driver tables -> the star schema the analytics run on (FIXTURES.md §4).

The driver's tables carry no arm, device, campaign or bounce columns, so each
is derived by a fixed deterministic rule from existing columns. The rules are
listed in FIXTURES.md and mirrored independently in the DuckDB oracle. All
derivations are narrow projections: no shuffle, and Catalyst prunes what a
query does not use.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.sources.tables import read_table


def _case(key: Column, values: list) -> Column:
    """CASE key WHEN 0 THEN values[0] ... ; None entries give NULL."""
    expr = None
    for i, v in enumerate(values):
        lit = F.lit(v) if v is not None else F.lit(None).cast("string")
        expr = F.when(key == i, lit) if expr is None else expr.when(key == i, lit)
    return expr


def fct_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_projection(read_table(spark, sf_dir, "events"))


def events_projection(e: DataFrame) -> DataFrame:
    """Driver ``events`` columns -> ``fct_events`` columns (works on batch and stream)."""
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return e.select(
        eid.alias("event_id"),
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("customer_id"),
        F.pmod(eid, F.lit(1000)).alias("session_id"),
        F.when(F.col("event_type") == "error", F.lit("bounce")).otherwise(F.col("event_type")).alias("event_type"),
        F.when(F.pmod(eid, F.lit(7)) == 0, F.lit(None).cast("bigint"))
         .otherwise(F.pmod(eid * 31, F.lit(200))).alias("product_id"),
        _case(F.pmod(eid, F.lit(4)), ["mobile", "desktop", "tablet", None]).alias("device_type"),
        _case(F.pmod(eid, F.lit(6)), ["Organic", "ORGANIC", "paid search", "Social", "EMAIL", "Partner"])
        .alias("traffic_source"),
        F.pmod(k, F.lit(25)).alias("campaign_id"),
        _case(F.pmod(eid, F.lit(3)), ["home", "product", "checkout"]).alias("page_category"),
        F.col("value").cast("decimal(8,2)").alias("session_duration_sec"),
        F.when(F.pmod(eid, F.lit(5)) < 3, F.lit("Control"))
         .when(F.pmod(eid, F.lit(5)) == 3, F.lit("Variant_A"))
         .otherwise(F.lit("Variant_B")).alias("experiment_group"),
    )


def customer_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The two columns the funnel needs, without the nation lookup."""
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("acquisition_channel"))


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    # nation has 25 rows by definition of the schema: a fixed bound, safe to broadcast
    n = F.broadcast(read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name"))
    key = F.col("c_custkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        key.alias("customer_id"),
        F.date_add(F.lit("2023-01-01").cast("date"), F.pmod(key, F.lit(365)).cast("int")).alias("signup_date"),
        F.col("n_name").alias("country"),
        (F.lit(18) + F.pmod(key, F.lit(60))).cast("int").alias("age"),
        F.when(F.pmod(key, F.lit(2)) == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.when(F.col("c_acctbal") < 2500, F.lit("Bronze"))
         .when(F.col("c_acctbal") < 6000, F.lit("Silver")).otherwise(F.lit("Gold")).alias("loyalty_tier"),
        F.col("c_mktsegment").alias("acquisition_channel"),
    )


def valid_customer_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers accepted by the load (the driver rule: positive balance)."""
    c = read_table(spark, sf_dir, "customer")
    return c.filter(F.col("c_acctbal") > 0).select(F.col("c_custkey").alias("customer_id"))


def dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("base_price"),
        F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(key, F.lit(1000)).cast("int")).alias("launch_date"),
        (F.col("p_retailprice") >= 1500).cast("int").alias("is_premium"),
    )


def dim_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = F.broadcast(read_table(spark, sf_dir, "region"))  # 5 rows by schema definition
    key = F.col("n_nationkey")
    start = F.date_add(F.lit("2024-01-01").cast("date"), key.cast("int"))
    return n.join(r, n.n_regionkey == r.r_regionkey, "inner").select(
        key.cast("bigint").alias("campaign_id"),
        F.col("r_name").alias("channel"),
        F.col("n_name").alias("objective"),
        start.alias("start_date"),
        F.date_add(start, 6).alias("end_date"),
        F.concat(F.lit("tier-"), F.col("n_regionkey").cast("string")).alias("target_segment"),
        (F.pmod(key, F.lit(5)) / 100).cast("decimal(6,4)").alias("expected_uplift"),
    )


def fct_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    missing = F.pmod(key, F.lit(10)) == 0
    return o.select(
        key.alias("transaction_id"),
        F.col("o_orderdate").alias("timestamp"),
        F.col("o_custkey").alias("customer_id"),
        F.when(missing, F.lit(None).cast("bigint")).otherwise(F.pmod(key, F.lit(200))).alias("product_id"),
        (F.lit(1) + F.pmod(key, F.lit(5))).cast("int").alias("quantity"),
        (F.pmod(key, F.lit(4)) * F.lit(0.05)).cast("decimal(5,4)").alias("discount_applied"),
        F.when(missing, F.lit(None).cast("decimal(10,2)"))
         .otherwise(F.col("o_totalprice").cast("decimal(10,2)")).alias("gross_revenue"),
        F.pmod(key, F.lit(25)).alias("campaign_id"),
        (F.col("o_orderstatus") == "P").cast("int").alias("refund_flag"),
    )


def register_views(spark: SparkSession, sf_dir: str) -> None:
    """Temp views with the warehouse table names, for the SQL-text operators."""
    fct_events(spark, sf_dir).createOrReplaceTempView("fct_events")
    fct_transactions(spark, sf_dir).createOrReplaceTempView("fct_transactions")
    dim_customers(spark, sf_dir).createOrReplaceTempView("dim_customers")
    dim_products(spark, sf_dir).createOrReplaceTempView("dim_products")
    dim_campaigns(spark, sf_dir).createOrReplaceTempView("dim_campaigns")
