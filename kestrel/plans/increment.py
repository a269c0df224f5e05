"""Refresh by increments: new rows are upserted into the newest version of a warehouse.

Keys. A dimension row replaces the one with its key. Facts are upserted by key too, also into other periods than the new row's: the
manifest holds each period's key range, so only periods whose range meets the increment's are asked for its
keys (one column of them). Periods that gain or lose rows are written anew, whole; all others stay the files they are.

Sessions go on over the load border. The state table has the last time and session number of each customer, so events that
do not lie before their customer's last time get the ids of one load over everything from the new rows and the state
alone. Customers with late or replaced events ("redone") are numbered again from their whole history; their periods
whose ids change are written anew.

Result: the tables that one load of all inputs gives, a later input's row standing for an earlier one with its key. Orphans are decided
against the customers known at the time of their load; they do not come back when their customer arrives later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.config import DRIVER, Profile
from kestrel.operators import sessions
from kestrel.plans import pipeline, warehouse
from kestrel.session import lookup, materialize, scratch
from kestrel.sources import csv, schemas

EVENTS = "fct_events"


def merge_dimension(spark: SparkSession, base: str, table: str, old: warehouse.Version, fresh: DataFrame) -> DataFrame:
    """The dimension with the new rows in place of those with their keys, written once."""
    key = schemas.PRIMARY_KEYS[table]
    kept = schemas.conform(warehouse.read_places(spark, base, table, old.places[table]), table)
    return materialize(kept.join(lookup(fresh.select(key), fresh.count()), key, "left_anti").unionByName(schemas.conform(fresh, table)), f"merged-{table}")


def _meeting(places: dict[str, list], lo, hi) -> dict[str, list]:
    """Periods whose key range meets [lo, hi]."""
    return {p: at for p, at in places.items() if lo is not None and at[1] is not None and at[1] <= hi and at[2] >= lo}


def replaced_rows(spark: SparkSession, base: str, table: str, places: dict[str, list], fresh: DataFrame) -> DataFrame:
    """Key, customer and period of the warehouse's rows that the new rows replace, written once."""
    key = schemas.PRIMARY_KEYS[table]
    lo, hi, n = fresh.agg(F.min(key), F.max(key), F.count("*")).first()
    held = warehouse.read_places(spark, base, table, _meeting(places, lo, hi)).select(key, "customer_id", "period")
    return materialize(held.join(lookup(fresh.select(key), n), key, "left_semi"), f"replaced-{table}")


def carried_sessions(fresh: DataFrame, n_fresh: int, state: DataFrame, n_state: int, gap_minutes: float) -> DataFrame:
    """``derived_session_id`` of new events none of which lies before its customer's last time: the sessions of the new rows
    by themselves, shifted by the customer's count so far, the first of them being the last old one if the gap allows. There are
    at most ``n_fresh`` new rows and ``n_state`` rows of state."""
    linked = sessions.build_sessions(fresh, gap_minutes)
    us = sessions.micros(fresh, "timestamp")
    first = fresh.groupBy("customer_id").agg(F.min(us).alias("_first"))
    last = state.select("customer_id", sessions.micros(state, "last_time").alias("_last"), "last_seq")
    goes_on = F.col("_first") - F.col("_last") <= int(round(gap_minutes * sessions.US_PER_MINUTE))
    shift = lookup(first, n_fresh).join(lookup(last, n_state), "customer_id").select("customer_id", (F.col("last_seq") - F.when(goes_on, 1).otherwise(0)).alias("_shift"))
    number = F.col("session_seq") + F.coalesce("_shift", F.lit(0))
    return (linked.join(lookup(shift, min(n_fresh, n_state)), "customer_id", "left")
            .withColumn("derived_session_id", F.concat_ws("-", F.col("customer_id").cast("string"), number.cast("string")))
            .drop("session_seq", "_shift"))


def merge_events(spark: SparkSession, base: str, old: warehouse.Version, fresh: DataFrame, gap_minutes: float) -> tuple[DataFrame, DataFrame, set]:
    """(rows of the periods to write, new state, those periods). ``fresh``: cleaned new events, a written table."""
    places = old.places[EVENTS]
    state = warehouse.read_places(spark, base, warehouse.STATE, old.places[warehouse.STATE])
    n_fresh, n_state = fresh.count(), sum(at[3] for at in old.places[warehouse.STATE].values())
    replaced = replaced_rows(spark, base, EVENTS, places, fresh)
    gone = lookup(replaced.select("event_id"), replaced.count())
    first = fresh.groupBy("customer_id").agg(F.min("timestamp").alias("_first"))
    early = (lookup(first, n_fresh).join(lookup(state, n_state), "customer_id")
             .where(F.col("_first") < F.col("last_time")).select("customer_id"))
    redone = materialize(early.unionByName(replaced.select("customer_id")).distinct(), "redone-customers")
    n_redone = redone.count()
    redone = lookup(redone, n_redone)
    ahead = fresh.join(redone, "customer_id", "left_anti")
    ahead = materialize(schemas.conform(carried_sessions(ahead, n_fresh, state, n_state, gap_minutes), EVENTS), "ahead-events")
    everything = warehouse.read_places(spark, base, EVENTS, places)
    touched = {r["p"] for r in fresh.select(warehouse.period_of(EVENTS).alias("p")).distinct().collect()}  # a row per period
    fresh_rows, changed, states = ahead, None, [pipeline.customer_state(ahead)]
    if n_redone:
        history = (everything.join(redone, "customer_id", "left_semi").join(gone, "event_id", "left_anti")
                   .withColumnRenamed("derived_session_id", "_old").drop("load"))
        again = history.unionByName(fresh.join(redone, "customer_id", "left_semi"), allowMissingColumns=True)
        again = materialize(sessions.build_sessions(again, gap_minutes).drop("session_seq"), "redone-events")
        changed = materialize(again.where(F.col("_old").isNotNull() & (F.col("_old") != F.col("derived_session_id")))
                              .select("event_id", "period", F.col("derived_session_id").alias("_new")), "renumbered-events")
        touched |= {r["period"] for t in (replaced, changed) for r in t.select("period").distinct().collect()}
        fresh_rows = fresh_rows.unionByName(schemas.conform(again.where(F.col("_old").isNull()), EVENTS))
        states.append(pipeline.customer_state(again))
    kept = warehouse.read_places(spark, base, EVENTS, {p: at for p, at in places.items() if p in touched})
    kept = kept.join(gone, "event_id", "left_anti")
    if changed is not None:
        kept = (kept.join(lookup(changed.select("event_id", "_new"), changed.count()), "event_id", "left")
                .withColumn("derived_session_id", F.coalesce("_new", "derived_session_id")))
    states.append(state.join(redone, "customer_id", "left_anti"))
    merged = states[0]
    for s in states[1:]:
        merged = merged.unionByName(s)
    merged = merged.groupBy("customer_id").agg(F.max("last_time").alias("last_time"), F.max("last_seq").alias("last_seq"))
    return schemas.conform(kept, EVENTS).unionByName(fresh_rows), merged, touched


def merge_transactions(spark: SparkSession, base: str, old: warehouse.Version, fresh: DataFrame) -> tuple[DataFrame, set]:
    table, places = "fct_transactions", old.places["fct_transactions"]
    replaced = replaced_rows(spark, base, table, places, fresh)
    touched = {r["p"] for r in fresh.select(warehouse.period_of(table).alias("p")).distinct().collect()}
    touched |= {r["period"] for r in replaced.select("period").distinct().collect()}
    kept = warehouse.read_places(spark, base, table, {p: at for p, at in places.items() if p in touched})
    kept = kept.join(lookup(replaced.select("transaction_id"), replaced.count()), "transaction_id", "left_anti")
    return schemas.conform(kept, table).unionByName(schemas.conform(fresh, table)), touched


def load_increment(spark: SparkSession, raw: dict[str, DataFrame], warehouse_dir: str, profile: Profile = DRIVER) -> warehouse.Version:
    """Clean the raw tables given (any of the five), merge them into the newest version and commit the next one.
    A warehouse without a version gets a full load."""
    base, load = warehouse_dir.rstrip("/"), warehouse.new_load()
    old = warehouse.read_version(spark, base)
    if old is None:
        raise FileNotFoundError(f"no warehouse in {base}: the first load is a full one")
    audit: list = []
    places = {t: dict(p) for t, p in old.places.items()}
    try:
        fresh = pipeline.clean_dimensions(spark, raw, audit)
        merged = {t: merge_dimension(spark, base, t, old, df) for t, df in fresh.items()}
        parents = {t: merged.get(t, warehouse.read_places(spark, base, t, places[t])) for t in schemas.LOAD_ORDER if t not in warehouse.PERIODS}
        none = {t: spark.createDataFrame([], csv.raw_schema(t)) for t in warehouse.PERIODS}
        tx, ev = pipeline.clean_facts(none | raw, parents["dim_customers"], profile, True, audit)
        written, touched = dict(merged), {}
        for t, df in merged.items():
            warehouse.write_table(spark, base, t, df, load)
        if EVENTS in raw:
            rows, state, touched[EVENTS] = merge_events(spark, base, old, materialize(ev, "fresh-events"), profile.gap_minutes)
            warehouse.write_table(spark, base, EVENTS, rows, load)
            warehouse.write_table(spark, base, warehouse.STATE, state, load)
        if "fct_transactions" in raw:
            rows, touched["fct_transactions"] = merge_transactions(spark, base, old, tx)
            warehouse.write_table(spark, base, "fct_transactions", rows, load)
        written |= {t: warehouse.read_load(spark, base, t, load) for t in touched}
        pipeline.check_contracts(written, parents)  # kept periods were checked by their own load; parents only gain keys
        if EVENTS in raw:
            written[warehouse.STATE] = warehouse.read_load(spark, base, warehouse.STATE, load)
        for t, new in warehouse.places_of_load(written, load).items():
            places[t] = {p: at for p, at in places[t].items() if p not in touched[t]} | new if t in touched else new
        version = warehouse.Version(old.number + 1, places, audit)
        warehouse.commit(spark, base, version)
    except BaseException:
        warehouse.drop_load(spark, base, load)
        raise
    warehouse.vacuum(spark, base)
    return version


def run(spark: SparkSession, folder: str, warehouse_dir: str, profile: Profile = DRIVER) -> warehouse.Version:
    """The raw CSVs that a folder has, merged into the warehouse; intermediate tables are deleted."""
    with scratch(spark):
        return load_increment(spark, csv.read_present_tables(spark, folder), warehouse_dir, profile)
