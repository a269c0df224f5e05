"""The load: raw star tables (CSV folder or driver tables) -> cleaned tables ->
contracts -> warehouse.

Dimensions are de-duplicated, then stripped of null rows; facts are de-duplicated, the
event-type domain is checked (failing the job), orphans are dropped, flags and
normalisations are added, sessions are derived. Each raw table is scanned once: the audit
(rows in and out, copies, orphans, values changed) is observed on the write of the
cleaned rows, in its last stage, so recomputed tasks count once. The tables are then written under the
load's label, the contracts read them there, and one manifest makes all of them visible
(``warehouse``). So a refresh replaces all five tables or none, and readers never see a mixed warehouse.
"""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from kestrel.config import DRIVER, Profile
from kestrel.operators import quality, sessions
from kestrel.plans import warehouse
from kestrel.session import at_once, checkpoint_dir, lookup, materialize, scratch
from kestrel.sources import csv, schemas, star


def raw_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "dim_customers": star.dim_customers(spark, sf_dir),
        "dim_products": star.dim_products(spark, sf_dir),
        "dim_campaigns": star.dim_campaigns(spark, sf_dir),
        "fct_transactions": star.fct_transactions(spark, sf_dir),
        "fct_events": star.fct_events(spark, sf_dir),
    }


def _observed(df: DataFrame, table: str, metrics: dict[str, Column], keep: Column, audit: list | None, label: str) -> DataFrame:
    """Write the rows that ``keep`` marks, counting ``metrics`` over all rows on the way."""
    seen = Observation()
    counted = df.observe(seen, *(c.cast("bigint").alias(m) for m, c in metrics.items()))
    out = materialize(counted.filter(keep), label)
    if audit is not None:
        audit += [(table, m, seen.get[m] or 0) for m in metrics]
    return out


def clean_dimension(raw: DataFrame, table: str, audit: list | None) -> DataFrame:
    d = quality.dedupe_by_key(raw, schemas.PRIMARY_KEYS[table], copies_col="_copies")
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in raw.columns])
    return _observed(d, table, {"rows_in": F.sum("_copies"), "rows_out": F.count_if(complete)}, complete, audit, f"clean-{table}").drop("_copies")


def clean_dimensions(spark: SparkSession, raw: dict[str, DataFrame], audit: list | None) -> dict[str, DataFrame]:
    """The dimensions among the raw tables, cleaned side by side."""
    found: dict[str, list] = {t: [] for t in schemas.LOAD_ORDER if t in raw and t not in warehouse.PERIODS}
    checkpoint_dir(spark)  # named before the first steps ask for it at once
    out = at_once(spark, {t: partial(clean_dimension, raw[t], t, own) for t, own in found.items()})
    if audit is not None:
        audit += [row for own in found.values() for row in own]
    return out


def clean_facts(raw: dict[str, DataFrame], customers: DataFrame, profile: Profile, check_domain: bool, audit: list | None) -> tuple[DataFrame, DataFrame]:
    """(transactions, events without sessions), of accepted ``customers``, a written table. A broken event-type domain fails the load."""
    marker = lookup(customers.select("customer_id", F.lit(True).alias("_valid")), customers.count())
    ok = F.col("_valid").isNotNull()
    counts = {"rows_in": F.sum("_copies"), "rows_after_dedupe": F.count("*"), "orphan_rows": F.count_if(~ok), "rows_out": F.count_if(ok)}
    tx = quality.flag_transactions(quality.dedupe_by_key(raw["fct_transactions"], "transaction_id", copies_col="_copies"))
    flags = {c: F.sum(F.when(ok, F.col(c))) for c in ("has_missing_product_or_revenue", "revenue_sign_mismatch")}
    tx = tx.join(marker, "customer_id", "left")
    bad = F.coalesce(~F.col("event_type").isin(list(profile.valid_event_types)), F.lit(True))
    changed = quality.normalize_case("traffic_source", profile.traffic_sources) != F.col("traffic_source")
    tallies = {"domain_violations": F.count_if(bad), "device_type_filled": F.count_if(ok & F.col("device_type").isNull()),
               "traffic_source_normalized": F.count_if(ok & changed)}
    ev = quality.dedupe_by_key(raw["fct_events"], "event_id", copies_col="_copies").join(marker, "customer_id", "left")
    own_tx: list = []
    own: list = []
    done = at_once(tx.sparkSession, {"tx": partial(_observed, tx, "fct_transactions", counts | flags, ok, own_tx, "clean-transactions"),
                                     "ev": partial(_observed, ev, "fct_events", counts | tallies, ok, own, "clean-events")})
    tx, ev = done["tx"], done["ev"]
    if audit is not None:
        audit += own_tx
    if check_domain and dict((m, v) for _, m, v in own)["domain_violations"]:
        quality.raise_on_violations(domain=quality.domain_violations(quality.dedupe_by_key(raw["fct_events"], "event_id"), profile.valid_event_types))
    if audit is not None:
        audit += own
    ev = (ev.drop("_copies", "_valid").withColumn("traffic_source", quality.normalize_case("traffic_source", profile.traffic_sources))
          .withColumn("device_type", quality.fill_unknown("device_type")))
    return tx.drop("_copies", "_valid"), ev


def clean_tables(spark: SparkSession, raw: dict[str, DataFrame], profile: Profile = DRIVER,
                 check_domain: bool = True, audit: list | None = None) -> dict[str, DataFrame]:
    """Cleaned star tables from raw ones, written once each to the shared folder. ``audit`` receives
    (table, metric, value) of every table."""
    out = clean_dimensions(spark, raw, audit)
    tx, ev = clean_facts(raw, out["dim_customers"], profile, check_domain, audit)
    ev = sessions.build_sessions(ev, profile.gap_minutes).drop("session_seq")
    return {k: schemas.conform(v, k) for k, v in (out | {"fct_transactions": tx, "fct_events": ev}).items()}


def check_contracts(written: dict[str, DataFrame], parents: dict[str, DataFrame]) -> None:
    """Keys, null columns and references of the written tables, in one job."""
    if written:
        quality.raise_on_counts(quality.contract_counts(
            {t: (df, schemas.PRIMARY_KEYS[t], schemas.not_null_columns(t)) for t, df in written.items()},
            [(c, col, written[c], parents[p], pcol) for (c, col), (p, pcol) in schemas.FOREIGN_KEYS.items() if c in written]))


def customer_state(events: DataFrame) -> DataFrame:
    """Last time and session number of each customer: where the sessions of a next load go on."""
    seq = F.substring_index("derived_session_id", "-", -1).cast("bigint")
    return events.groupBy("customer_id").agg(F.max("timestamp").alias("last_time"), F.max(seq).alias("last_seq"))


def load_to_warehouse(spark: SparkSession, tables: dict[str, DataFrame], warehouse_dir: str, audit: list | None = None) -> dict[str, str]:
    """Idempotent full refresh, all tables or none, as a new version; the version before stays for its readers."""
    base, load = warehouse_dir.rstrip("/"), warehouse.new_load()
    before = warehouse.read_version(spark, base) or warehouse.Version()
    try:
        at_once(spark, {name: partial(warehouse.write_table, spark, base, name, tables[name], load) for name in schemas.LOAD_ORDER})
        written = {name: warehouse.read_load(spark, base, name, load) for name in schemas.LOAD_ORDER}
        check_contracts(written, written)
        warehouse.write_table(spark, base, warehouse.STATE, customer_state(written["fct_events"]), load)
        places = warehouse.places_of_load(written | {warehouse.STATE: warehouse.read_load(spark, base, warehouse.STATE, load)}, load)
        warehouse.commit(spark, base, warehouse.Version(before.number + 1, places, audit or []))
    except BaseException:
        warehouse.drop_load(spark, base, load)
        raise
    warehouse.vacuum(spark, base)
    return {name: f"{base}/data/{name}" for name in schemas.LOAD_ORDER}


def read_warehouse(spark: SparkSession, warehouse_dir: str, name: str) -> DataFrame:
    """A table of the newest version with its declared columns."""
    return schemas.conform(warehouse.read_table(spark, warehouse_dir, name), name)


def read_warehouse_tables(spark: SparkSession, warehouse_dir: str) -> dict[str, DataFrame]:
    """All star tables of a warehouse, the input of the analyses and marts."""
    return {name: read_warehouse(spark, warehouse_dir, name) for name in schemas.LOAD_ORDER}


def run(spark: SparkSession, source: str, warehouse_dir: str, profile: Profile = DRIVER, from_csv: bool = False) -> dict[str, str]:
    """CSV folder or driver tables -> clean -> contracts -> warehouse; intermediate tables are deleted."""
    with scratch(spark):
        raw = csv.read_raw_tables(spark, source) if from_csv else raw_tables(spark, source)
        audit: list = []
        return load_to_warehouse(spark, clean_tables(spark, raw, profile, audit=audit), warehouse_dir, audit)


def _long(df: DataFrame, table: str, metrics: list[str]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(table).alias("table_name"), F.lit(m).alias("metric"),
                              F.col(m).cast("bigint").alias("value")) for m in metrics])
    return df.select(F.inline(rows))


def load_audit(spark: SparkSession, sf_dir: str, profile: Profile = DRIVER) -> DataFrame:
    """Rows in/out per table and the data-quality tallies: (table_name, metric, value).

    For the facts, one pipeline per table: the de-duplication aggregation also
    counts the copies of each key (so rows in = sum of copies, no second scan),
    then a left join with the accepted customers marks orphans and a single
    aggregation produces every tally."""
    raw = raw_tables(spark, sf_dir)
    parts = []
    # Dimensions: one de-duplication pass each; copies per key give rows in, and
    # "no NULL in the kept copy" gives rows out. The customers are needed again as
    # the facts' parents, so their pass is written once.
    marker = None
    for name, key in (("dim_products", "product_id"), ("dim_campaigns", "campaign_id"),
                      ("dim_customers", "customer_id")):
        src = raw[name]
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in src.columns])
        d = quality.dedupe_by_key(src, key, copies_col="_copies").select(key, "_copies", complete.alias("_valid"))
        if name == "dim_customers":
            d = materialize(d, "audit-customers")
            marker = d.where("_valid").select(key, "_valid")
        parts.append(_long(d.agg(F.sum("_copies").alias("rows_in"), F.count_if("_valid").alias("rows_out")),
                           name, ["rows_in", "rows_out"]))

    tx = raw["fct_transactions"]
    tx_d = quality.flag_transactions(quality.dedupe_by_key(tx, "transaction_id", copies_col="_copies")) \
        .join(marker, "customer_id", "left")
    ok = F.col("_valid").isNotNull()
    parts.append(_long(tx_d.agg(
        F.sum("_copies").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_after_dedupe"),
        F.count_if(~ok).alias("orphan_rows"),
        F.count_if(ok).alias("rows_out"),
        F.sum(F.when(ok, F.col("has_missing_product_or_revenue"))).alias("has_missing_product_or_revenue"),
        F.sum(F.when(ok, F.col("revenue_sign_mismatch"))).alias("revenue_sign_mismatch")),
        "fct_transactions",
        ["rows_in", "rows_after_dedupe", "orphan_rows", "rows_out", "has_missing_product_or_revenue",
         "revenue_sign_mismatch"]))

    ev = raw["fct_events"]
    ev_d = quality.dedupe_by_key(ev, "event_id", copies_col="_copies").join(marker, "customer_id", "left")
    bad = F.coalesce(~F.col("event_type").isin(list(profile.valid_event_types)), F.lit(True))
    changed = quality.normalize_case("traffic_source", profile.traffic_sources) != F.col("traffic_source")
    parts.append(_long(ev_d.agg(
        F.sum("_copies").alias("rows_in"),
        F.count(F.lit(1)).alias("rows_after_dedupe"),
        F.count_if(bad).alias("domain_violations"),
        F.count_if(~ok).alias("orphan_rows"),
        F.count_if(ok).alias("rows_out"),
        F.count_if(ok & F.col("device_type").isNull()).alias("device_type_filled"),
        F.count_if(ok & changed).alias("traffic_source_normalized")),
        "fct_events",
        ["rows_in", "rows_after_dedupe", "domain_violations", "orphan_rows", "rows_out", "device_type_filled",
         "traffic_source_normalized"]))
    return reduce(DataFrame.unionByName, parts)
