"""Named queries over the driver tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Every query reads whole tables (no id subsets, prefixes or row caps); a LIMIT
appears only where top-k is the feature.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.config import DRIVER, VALID_EVENT_TYPES
from kestrel.operators import attribution, bootstrap, diagnostics, experiment, funnel, quality, quantiles, sessions, sketches
from kestrel.plans import increment, pipeline, reports, sql_queries, warehouse
from kestrel.session import materialize, shared_path
from kestrel.sources import csv, marts, schemas, star
from kestrel.sources.tables import read_table
from kestrel.streaming import numbered_sessions, sessions_stream

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
P = DRIVER


def query(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = fn
        return fn
    return deco


def _reach(spark, sf):
    return funnel.customer_step_reach(star.fct_events(spark, sf), P.steps)


@query("funnel_overall")
def q_funnel_overall(spark, sf):
    return funnel.overall_funnel(_reach(spark, sf), P.steps)


@query("scan_project")
def q_scan_project(spark, sf):
    """S6/S7: warehouse scan pruned to two columns (ReadSchema shows only them)."""
    return star.fct_events(spark, sf).select("customer_id", "event_type")


@query("funnel_reach")
def q_funnel_reach(spark, sf):
    return _reach(spark, sf)


@query("bounce_rate")
def q_bounce_rate(spark, sf):
    return funnel.bounce_rate(star.fct_events(spark, sf))


@query("funnel_by_channel")
def q_funnel_by_channel(spark, sf):
    return funnel.funnel_by_channel(_reach(spark, sf), star.customer_channels(spark, sf), P.steps)


@query("channel_conversion")
def q_channel_conversion(spark, sf):
    by_channel = funnel.funnel_by_channel(_reach(spark, sf), star.customer_channels(spark, sf), P.steps)
    return funnel.channel_conversion(by_channel, P.steps[-1])


@query("biggest_drop_off")
def q_biggest_drop_off(spark, sf):
    return funnel.biggest_drop_off_step(funnel.overall_funnel(_reach(spark, sf), P.steps))


@query("revenue_per_converted")
def q_revenue_per_converted(spark, sf):
    return funnel.revenue_per_converted_customer(star.fct_transactions(spark, sf))


def _sessionize(spark, sf, gap):
    return sessions.build_sessions(star.fct_events(spark, sf), gap)


@query("sessionize")
def q_sessionize(spark, sf):
    return _sessionize(spark, sf, P.gap_minutes)


@query("sessionize_gap360")
def q_sessionize_gap360(spark, sf):
    return _sessionize(spark, sf, 360)


@query("event_gaps")
def q_event_gaps(spark, sf):
    return sessions.event_gaps(star.fct_events(spark, sf)) \
        .select("event_id", "customer_id", "timestamp", "gap_minutes")


@query("session_summary")
def q_session_summary(spark, sf):
    return sessions.session_summary(_sessionize(spark, sf, P.gap_minutes))


@query("session_summary_gap360")
def q_session_summary_gap360(spark, sf):
    return sessions.session_summary(_sessionize(spark, sf, 360))


@query("session_counts")
def q_session_counts(spark, sf):
    ev = star.fct_events(spark, sf)
    return sessions.session_counts(ev, sessions.session_summary(_sessionize(spark, sf, P.gap_minutes)))


@query("session_describe")
def q_session_describe(spark, sf):
    return diagnostics.session_describe(sessions.session_summary(_sessionize(spark, sf, 360)))


@query("dq_session_sharing")
def q_dq_session_sharing(spark, sf):
    return diagnostics.session_sharing(star.fct_events(spark, sf))


@query("dq_gap_profile")
def q_dq_gap_profile(spark, sf):
    gaps = sessions.event_gaps(star.fct_events(spark, sf))
    return diagnostics.gap_profile(gaps, P.gap_minutes)


@query("dq_group_stickiness")
def q_dq_group_stickiness(spark, sf):
    return diagnostics.group_stickiness(star.fct_events(spark, sf))


def _counts(spark, sf):
    return experiment.customer_group_counts(star.fct_events(spark, sf))


def _totals(spark, sf):
    return experiment.group_totals(_counts(spark, sf), P.groups)


@query("customer_group_counts")
def q_customer_group_counts(spark, sf):
    return _counts(spark, sf)


@query("group_totals")
def q_group_totals(spark, sf):
    return _totals(spark, sf)


@query("chi_square")
def q_chi_square(spark, sf):
    return experiment.chi_square_test(_totals(spark, sf), P.groups)


@query("two_proportion_z")
def q_two_proportion_z(spark, sf):
    return experiment.two_proportion_test(_totals(spark, sf), P.groups[0], P.groups[-1])


@query("pairwise_z")
def q_pairwise_z(spark, sf):
    return experiment.pairwise_tests(_totals(spark, sf), P.groups, P.alpha)


@query("experiment_report")
def q_experiment_report(spark, sf):
    return experiment.experiment_report(experiment.pairwise_tests(_totals(spark, sf), P.groups, P.alpha))


@query("distinct_sketches")
def q_distinct_sketches(spark, sf):
    """Distinct customers, sessions and products per week and over all days from stored daily sketches: their exact number, and whether the merged
    estimate lies within the error bound of it and of the sketch of all rows counted together."""
    ev, measures = star.fct_events(spark, sf), ["customer_id", "session_id", "product_id"]
    stored = materialize(sketches.daily_sketches(ev, measures), "daily-sketches")
    week = F.date_trunc("week", "day").cast("date").cast("string")
    rows = ev.select(sketches.day().alias("day"), F.inline(F.array(*(F.struct(F.lit(m).alias("measure"), F.col(m).cast("string").alias("value")) for m in measures))))
    parts = []
    for span in (week, F.lit("all")):
        exact = rows.groupBy(span.alias("span"), "measure").agg(F.count_distinct("value").alias("n_exact"), F.hll_sketch_estimate(F.hll_sketch_agg("value", sketches.LG_K)).alias("direct"))
        parts.append(sketches.merged_distinct(stored, span.alias("span")).join(exact, ["span", "measure"]))
    both = parts[0].unionByName(parts[1])
    near = lambda a, b: F.abs(F.col(a) - F.col(b)) <= F.greatest(F.lit(1.0), sketches.ERROR_BOUND * F.col("n_exact"))
    return both.select("span", "measure", "n_rows", "n_exact", near("n_distinct", "n_exact").alias("within_bound"), near("n_distinct", "direct").alias("agrees_with_direct"))


@query("funnel_span_bitmaps")
def q_funnel_span_bitmaps(spark, sf):
    """The funnel by channel of every week and of all days, from stored daily bitmaps of customers."""
    numbers = sketches.number_customers(star.customer_channels(spark, sf))
    stored = materialize(sketches.daily_reach_bitmaps(star.fct_events(spark, sf), numbers, P.steps), "daily-bitmaps")
    weeks = sketches.span_funnel(stored, P.steps, F.date_trunc("week", "day").cast("date").cast("string"))
    return weeks.unionByName(sketches.span_funnel(stored, P.steps, F.lit("all")))


@query("sql_function_tests")
def q_sql_function_tests(spark, sf):
    """Pairwise tests, chi-square and labels by SQL functions of the catalog: the whole text is SQL."""
    return sql_queries.run_function_tests(spark, _totals(spark, sf), star.fct_events(spark, sf), P)


@query("sql_function_sessions")
def q_sql_function_sessions(spark, sf):
    return sql_queries.run_function_sessions(spark, _totals(spark, sf), star.fct_events(spark, sf), P)


#: The driver's orders lie 29 years before its events: for the attribution they move to start with the first day of events.
ORDER_SHIFT_DAYS, ATTRIBUTION_DAYS = 10592, 2500


def _moved_transactions(spark, sf):
    return star.fct_transactions(spark, sf).withColumn("timestamp", F.expr(f"timestamp + INTERVAL '{ORDER_SHIFT_DAYS}' DAY"))


@query("attributed_transactions")
def q_attributed_transactions(spark, sf):
    return attribution.attribute_transactions(star.fct_events(spark, sf), _moved_transactions(spark, sf), ATTRIBUTION_DAYS)


@query("revenue_per_event")
def q_revenue_per_event(spark, sf):
    return attribution.revenue_per_event(star.fct_events(spark, sf), _moved_transactions(spark, sf), P.groups, ATTRIBUTION_DAYS)


@query("srm_test")
def q_srm_test(spark, sf):
    return experiment.sample_ratio_test(_totals(spark, sf), P.groups, P.expected_shares)


@query("bootstrap_replicates")
def q_bootstrap_replicates(spark, sf):
    return bootstrap.bootstrap_replicates(_counts(spark, sf), P.groups, P.n_boot, P.seed)


@query("bootstrap_poisson")
def q_bootstrap_poisson(spark, sf):
    return bootstrap.bootstrap_replicates(_counts(spark, sf), P.groups, P.n_boot, P.seed, method="poisson")


@query("dense_index_orders")
def q_dense_index_orders(spark, sf):
    """J6 at the size of a whole table: rank of every order key without a one-task row_number."""
    return quantiles.dense_index(read_table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_orderkey"]) \
        .select("o_orderkey", "idx", "n_rows")


@query("bootstrap_ci")
def q_bootstrap_ci(spark, sf):
    reps = bootstrap.bootstrap_replicates(_counts(spark, sf), P.groups, P.n_boot, P.seed)
    return bootstrap.bootstrap_ci(reps, P.groups)


LINEITEM_KEY = ["l_orderkey", "l_linenumber"]


@query("dedupe_by_key")
def q_dedupe_by_key(spark, sf):
    return quality.dedupe_by_key(read_table(spark, sf, "lineitem"), LINEITEM_KEY)


@query("drop_any_null")
def q_drop_any_null(spark, sf):
    return quality.drop_any_null(quality.dedupe_by_key(star.fct_events(spark, sf), "event_id"))


@query("clean_customers")
def q_clean_customers(spark, sf):
    return quality.clean_dimension(star.dim_customers(spark, sf), "customer_id")


@query("orphan_semi_join")
def q_orphan_semi_join(spark, sf):
    return quality.orphan_filter(star.fct_transactions(spark, sf), star.valid_customer_ids(spark, sf))


@query("orphan_anti_count")
def q_orphan_anti_count(spark, sf):
    valid = star.valid_customer_ids(spark, sf)
    parts = [quality.orphans(df, valid).agg(F.lit(name).alias("table_name"),
                                            F.count(F.lit(1)).cast("bigint").alias("orphan_rows"))
             for name, df in (("fct_transactions", star.fct_transactions(spark, sf)),
                              ("fct_events", star.fct_events(spark, sf)))]
    return parts[0].unionByName(parts[1])


@query("domain_violations")
def q_domain_violations(spark, sf):
    """The original domain (no 'signup') applied to the driver events."""
    return quality.domain_violations(star.fct_events(spark, sf), VALID_EVENT_TYPES)


@query("flag_missing")
def q_flag_missing(spark, sf):
    return star.fct_transactions(spark, sf).select(
        "transaction_id", quality.missing_flag().alias("has_missing_product_or_revenue"))


@query("flag_refund_sign")
def q_flag_refund_sign(spark, sf):
    return star.fct_transactions(spark, sf).select(
        "transaction_id", quality.refund_sign_flag().alias("revenue_sign_mismatch"))


@query("normalize_source")
def q_normalize_source(spark, sf):
    return star.fct_events(spark, sf).select(
        "event_id", quality.normalize_case("traffic_source", P.traffic_sources).alias("traffic_source"))


@query("fill_unknown")
def q_fill_unknown(spark, sf):
    return star.fct_events(spark, sf).select("event_id", quality.fill_unknown("device_type").alias("device_type"))


@query("load_audit")
def q_load_audit(spark, sf):
    return pipeline.load_audit(spark, sf, P)


@query("pk_violations")
def q_pk_violations(spark, sf):
    raw = pipeline.raw_tables(spark, sf)
    tables = {t: (df, schemas.PRIMARY_KEYS[t]) for t, df in raw.items()}
    tables["lineitem"] = (read_table(spark, sf, "lineitem"), LINEITEM_KEY)
    return quality.pk_violations(tables)


@query("fk_violations")
def q_fk_violations(spark, sf):
    raw = pipeline.raw_tables(spark, sf)
    parents = {"dim_customers": star.valid_customer_ids(spark, sf), "dim_products": raw["dim_products"]}
    return quality.fk_violations([(c, col, raw[c], parents[p], pcol)
                                  for (c, col), (p, pcol) in schemas.FOREIGN_KEYS.items()])


@query("not_null_violations")
def q_not_null_violations(spark, sf):
    raw = pipeline.raw_tables(spark, sf)
    return quality.not_null_violations(
        {t: (df, [c for c in schemas.not_null_columns(t) if c in df.columns]) for t, df in raw.items()})


def _sql(name):
    def fn(spark, sf):
        return sql_queries.run_sql(spark, sf, name)
    fn.__name__ = f"q_{name}"
    return fn


for _name in sql_queries.QUERIES:
    REGISTRY[_name] = _sql(_name)


@query("kpi_summary")
def q_kpi_summary(spark, sf):
    return reports.kpi_summary(star.fct_events(spark, sf), star.fct_transactions(spark, sf), P)


def _csv_tables(spark, sf):
    """The driver tables written as the five raw CSVs and read back through the CSV scans."""
    folder = shared_path(spark, "raw-csv", uuid.uuid4().hex)
    return csv.read_raw_tables(spark, csv.write_raw_csv(pipeline.raw_tables(spark, sf), folder))


def _csv_query(table):
    def fn(spark, sf):
        folder = shared_path(spark, "raw-csv", uuid.uuid4().hex)
        csv.write_raw_csv({table: pipeline.raw_tables(spark, sf)[table]}, folder)
        return csv.read_raw_csv(spark, f"{folder}/{csv.ENTITY[table]}.csv", csv.ENTITY[table])
    return fn


for _table, _entity in csv.ENTITY.items():
    REGISTRY[f"csv_{_entity}"] = _csv_query(_table)


def _warehouse(spark, sf):
    """CSV -> clean -> contracts -> warehouse in the shared folder."""
    base, audit = shared_path(spark, "warehouse", uuid.uuid4().hex), []
    tables = pipeline.clean_tables(spark, _csv_tables(spark, sf), P, audit=audit)
    pipeline.load_to_warehouse(spark, tables, base, audit)
    return base


@query("csv_load_events")
def q_csv_load_events(spark, sf):
    return pipeline.read_warehouse(spark, _warehouse(spark, sf), "fct_events")


@query("csv_load_audit")
def q_csv_load_audit(spark, sf):
    """The audit that the load observed on its own writes and stored with its version."""
    return warehouse.audit_rows(spark, _warehouse(spark, sf))


def _value_text(df, column):
    """A value as text for a checksum: numbers and times in one spelling that any engine can give."""
    kind = df.schema[column].dataType.simpleString()
    if kind == "timestamp_ntz":
        return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return F.col(column).cast("string")


@query("warehouse_tables")
def q_warehouse_tables(spark, sf):
    """Every column of the catalog views over the loaded warehouse: rows, nulls, and the sum of the values' hashes
    (the first 15 hex digits of MD5), so that a changed value, a lost row or a swapped type shows."""
    base, db = _warehouse(spark, sf), f"kestrel_{uuid.uuid4().hex[:12]}"
    parts = []
    for name in warehouse.create_views(spark, db, base):
        df, table = spark.table(name), name.split(".")[1]
        digits = {c: F.conv(F.substring(F.md5(_value_text(df, c)), 1, 15), 16, 10).cast("decimal(38,0)") for c in df.columns}
        wide = df.agg(F.count("*").alias("n_rows"), *(F.struct(F.count_if(F.col(c).isNull()).alias("n_nulls"), F.sum(d).alias("checksum")).alias(c)
                                                      for c, d in digits.items()))
        parts.append(wide.select("n_rows", F.inline(F.array(*(F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"),
                                                                       F.col(c)["n_nulls"].alias("n_nulls"), F.col(c)["checksum"].cast("string").alias("checksum")) for c in df.columns)))))
    return reduce(lambda a, b: a.unionByName(b), parts).select("table_name", "column_name", "n_rows", "n_nulls", "checksum")


def _incremented(spark, sf):
    """A warehouse loaded from a CSV folder without the last day of events and of transactions, and some late events; then the rest as an
    increment that also sends some events again, corrected."""
    late, sent_again = F.col("event_id") % 211 == 0, F.col("event_id") % 499 == 0
    raw = pipeline.raw_tables(spark, sf)
    ev, tx = raw["fct_events"], raw["fct_transactions"]
    last = {t: df.agg(F.max(F.to_date("timestamp"))).first()[0] for t, df in (("ev", ev), ("tx", tx))}
    new = late | (F.to_date("timestamp") == F.lit(last["ev"]))
    folders = [shared_path(spark, "raw-csv", uuid.uuid4().hex) for _ in range(2)]
    csv.write_raw_csv(raw | {"fct_events": ev.where(~new), "fct_transactions": tx.where(F.to_date("timestamp") < F.lit(last["tx"]))}, folders[0])
    again = ev.where(new | sent_again).withColumn("page_category", F.when(sent_again, "corrected").otherwise(F.col("page_category")))
    csv.write_raw_csv({"fct_events": again, "fct_transactions": tx.where(F.to_date("timestamp") == F.lit(last["tx"]))}, folders[1])
    base = shared_path(spark, "warehouse", uuid.uuid4().hex)
    pipeline.run(spark, folders[0], base, P, from_csv=True)
    increment.run(spark, folders[1], base, P)
    return base


@query("load_increment_events")
def q_load_increment_events(spark, sf):
    """Events after a full load and an increment: the rows and session ids of one load over both inputs."""
    return pipeline.read_warehouse(spark, _incremented(spark, sf), "fct_events")


@query("load_increment_state")
def q_load_increment_state(spark, sf):
    """The customers' session state and transactions after the increment: last time, last session, transactions and revenue."""
    base = _incremented(spark, sf)
    tx = pipeline.read_warehouse(spark, base, "fct_transactions").groupBy("customer_id").agg(
        F.count("*").alias("n_transactions"), F.sum("gross_revenue").cast("double").alias("revenue"))
    return warehouse.read_table(spark, base, warehouse.STATE).join(tx, "customer_id", "full").select(
        "customer_id", "last_time", "last_seq", "n_transactions", "revenue")


def _mart_rows(marts_by_name):
    """Marts in long form: (mode, mart, row_key, measure, value) of every number, text columns joined as the row's key."""
    parts = []
    for name, df in marts_by_name.items():
        texts = [c for c, t in df.dtypes if t == "string" and c != "mode"]
        numbers = [c for c, t in df.dtypes if t not in ("string",)]
        key = F.concat_ws("/", *(F.col(f"`{c}`") for c in texts)) if texts else F.lit("")
        rows = F.array(*(F.struct(F.lit(c).alias("measure"), F.col(f"`{c}`").cast("double").alias("value")) for c in numbers))
        parts.append(df.select("mode", F.lit(name).alias("mart"), key.alias("row_key"), F.inline(rows)))
    return reduce(lambda a, b: a.unionByName(b), parts)


@query("marts_roundtrip")
def q_marts_roundtrip(spark, sf):
    """All six marts, twice: read live from the warehouse, and from the CSV and JSON snapshot that was written of them."""
    base = _warehouse(spark, sf)
    out = shared_path(spark, "marts", uuid.uuid4().hex)
    built = reports.build_marts(pipeline.read_warehouse_tables(spark, base), P)
    marts.write_marts(built, out)
    live = marts.read_marts(spark, out, live=lambda: built, warehouse_dir=base)
    snapshot = marts.read_marts(spark, out, live=lambda: built, warehouse_dir=f"{base}-none")
    return _mart_rows(live).unionByName(_mart_rows(snapshot))


@query("funnel_regression_alerts")
def q_funnel_regression_alerts(spark, sf):
    return reports.funnel_regression_alerts(star.fct_events(spark, sf), P.steps)


@query("stream_sessions")
def q_stream_sessions(spark, sf):
    return sessions_stream.run_stream_sessions(spark, sf, P.gap_minutes)


@query("stream_session_numbers")
def q_stream_session_numbers(spark, sf):
    return numbered_sessions.run_numbered_sessions(spark, sf, P.gap_minutes)


@query("stream_group_totals")
def q_stream_group_totals(spark, sf):
    return sessions_stream.run_stream_group_totals(spark, sf)
