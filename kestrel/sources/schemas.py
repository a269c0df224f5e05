"""The warehouse star schema as explicit StructTypes (no inference anywhere).

``nullable=False`` marks a NOT NULL contract; PRIMARY KEY and FOREIGN KEY
contracts are listed beside each table.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, S = T.LongType(), T.IntegerType(), T.StringType()
D, TS = T.DateType(), T.TimestampNTZType()


def _f(name, dtype, nullable=False):
    return T.StructField(name, dtype, nullable)


DIM_CUSTOMERS = T.StructType([
    _f("customer_id", L), _f("signup_date", D), _f("country", S), _f("age", I),
    _f("gender", S), _f("loyalty_tier", S), _f("acquisition_channel", S)])

DIM_PRODUCTS = T.StructType([
    _f("product_id", L), _f("category", S), _f("brand", S), _f("base_price", T.DecimalType(10, 2)),
    _f("launch_date", D), _f("is_premium", I)])

DIM_CAMPAIGNS = T.StructType([
    _f("campaign_id", L), _f("channel", S), _f("objective", S), _f("start_date", D), _f("end_date", D),
    _f("target_segment", S), _f("expected_uplift", T.DecimalType(6, 4))])

FCT_TRANSACTIONS = T.StructType([
    _f("transaction_id", L), _f("timestamp", TS), _f("customer_id", L), _f("product_id", L, True),
    _f("quantity", I), _f("discount_applied", T.DecimalType(5, 4)), _f("gross_revenue", T.DecimalType(10, 2), True),
    _f("campaign_id", L), _f("refund_flag", I),
    _f("has_missing_product_or_revenue", I), _f("revenue_sign_mismatch", I)])

FCT_EVENTS = T.StructType([
    _f("event_id", L), _f("timestamp", TS), _f("customer_id", L), _f("session_id", L),
    _f("derived_session_id", S), _f("event_type", S), _f("product_id", L, True), _f("device_type", S, True),
    _f("traffic_source", S), _f("campaign_id", L), _f("page_category", S),
    _f("session_duration_sec", T.DecimalType(8, 2)), _f("experiment_group", S)])

TABLES = {
    "dim_customers": DIM_CUSTOMERS,
    "dim_products": DIM_PRODUCTS,
    "dim_campaigns": DIM_CAMPAIGNS,
    "fct_transactions": FCT_TRANSACTIONS,
    "fct_events": FCT_EVENTS,
}

PRIMARY_KEYS = {
    "dim_customers": "customer_id", "dim_products": "product_id", "dim_campaigns": "campaign_id",
    "fct_transactions": "transaction_id", "fct_events": "event_id",
}

# (child table, column) -> (parent table, column); campaign_id is deliberately not a key (0 = none)
FOREIGN_KEYS = {
    ("fct_transactions", "customer_id"): ("dim_customers", "customer_id"),
    ("fct_transactions", "product_id"): ("dim_products", "product_id"),
    ("fct_events", "customer_id"): ("dim_customers", "customer_id"),
    ("fct_events", "product_id"): ("dim_products", "product_id"),
}

# load order parents -> children (delete order is the reverse)
LOAD_ORDER = ("dim_customers", "dim_products", "dim_campaigns", "fct_transactions", "fct_events")


def not_null_columns(table: str) -> list[str]:
    return [f.name for f in TABLES[table].fields if not f.nullable]


def conform(df, table: str):
    """Select and cast to the declared schema (column order and types)."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TABLES[table].fields])
