"""Versions of the warehouse, increments and sessions carried over loads."""

import os
import random
import re

import pytest
from pyspark.sql import functions as F

from kestrel import session
from kestrel.operators import quality
from kestrel.plans import increment, pipeline, warehouse
from kestrel.sources import csv, schemas

SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(str, df.collect()))


def tables(spark, base):
    return {t: rows(pipeline.read_warehouse(spark, base, t)) for t in schemas.LOAD_ORDER}


def files(base):
    return {os.path.join(d, f) for d, _, fs in os.walk(os.path.join(base, "data")) for f in fs if f.endswith(".parquet")}


def full(spark, raw, base):
    pipeline.load_to_warehouse(spark, pipeline.clean_tables(spark, raw), base)


def test_a_day_of_csv_gives_the_tables_of_one_load(spark, tmp_dir):
    raw = pipeline.raw_tables(spark, SF)
    one, two, folder = (os.path.join(tmp_dir, x) for x in ("one", "two", "csv"))
    full(spark, raw, one)
    last = F.to_date("timestamp") >= F.lit("2024-01-30").cast("date")
    month = F.date_trunc("month", "timestamp") >= F.lit("2001-08-01").cast("timestamp")
    full(spark, raw | {"fct_events": raw["fct_events"].where(~last), "fct_transactions": raw["fct_transactions"].where(~month)}, two)
    before = files(two)
    csv.write_raw_csv({"fct_events": raw["fct_events"].where(last), "fct_transactions": raw["fct_transactions"].where(month)}, folder)
    version = increment.run(spark, folder, two)
    assert tables(spark, two) == tables(spark, one)
    assert rows(warehouse.read_table(spark, two, warehouse.STATE)) == rows(warehouse.read_table(spark, one, warehouse.STATE))
    # the file list: nothing written before is gone or changed, and new files lie in the new day, the new month and the state only
    assert before <= files(two)
    new = {os.path.relpath(f, os.path.join(two, "data")).split("/load=")[0] for f in files(two) - before}
    assert new == {"fct_events/period=2024-01-30", "fct_transactions/period=2001-08", "customer_state"}
    kept = warehouse.read_version(spark, two, version.number - 1).places["fct_events"]
    assert all(version.places["fct_events"][p] == at for p, at in kept.items())
    audit = {(a.table_name, a.metric): a.value for a in warehouse.audit_rows(spark, two).collect()}
    assert audit["fct_events", "rows_in"] == raw["fct_events"].where(last).count() and "dim_customers" not in {t for t, _ in audit}


@pytest.mark.parametrize("seed", [1])
def test_any_split_of_the_events_gives_the_ids_of_one_load(spark, tmp_dir, seed):
    """Loads in any order of time, with late rows: the same ids, and the same state."""
    raw, r = pipeline.raw_tables(spark, SF), random.Random(seed)
    ev = raw["fct_events"]
    ids = [x.event_id for x in ev.select("event_id").orderBy("timestamp").collect()]
    # sessions of a few minutes so that late rows open, join and close them
    ev = ev.withColumn("timestamp", F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, event_id * 97 % 5000 * 20)"))
    raw = raw | {"fct_events": ev}
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    full(spark, raw, one)
    r.shuffle(ids)
    cuts = sorted(r.sample(range(1, len(ids)), 2))
    parts = [ids[a:b] for a, b in zip([0, *cuts], [*cuts, len(ids)])]
    for n, part in enumerate(parts):
        own = raw | {"fct_events": ev.where(F.col("event_id").isin(part))}
        if n:
            increment.load_increment(spark, {"fct_events": own["fct_events"]}, two)
        else:
            full(spark, own, two)
    assert tables(spark, two)["fct_events"] == tables(spark, one)["fct_events"]
    assert rows(warehouse.read_table(spark, two, warehouse.STATE)) == rows(warehouse.read_table(spark, one, warehouse.STATE))


def test_upsert_by_key_over_periods_and_dimensions(spark, tmp_dir):
    """A row sent again replaces the old one in whatever period that lies; a dimension row too; both are one load of the corrected rows."""
    raw = pipeline.raw_tables(spark, SF)
    moved = raw["fct_events"].withColumn("timestamp", F.expr("CASE WHEN event_id % 100 = 3 THEN timestamp + INTERVAL '5' DAY ELSE timestamp END")) \
        .withColumn("customer_id", F.expr("CASE WHEN event_id % 100 = 7 THEN customer_id + 1 ELSE customer_id END"))
    customers = raw["dim_customers"].withColumn("country", F.expr("CASE WHEN customer_id < 5 THEN 'Elsewhere' ELSE country END"))
    paid = raw["fct_transactions"].withColumn("quantity", F.expr("CASE WHEN transaction_id % 50 = 1 THEN 9 ELSE quantity END"))
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    full(spark, raw | {"fct_events": moved, "dim_customers": customers, "fct_transactions": paid}, one)
    full(spark, raw, two)
    increment.load_increment(spark, {"fct_events": moved.where("event_id % 100 IN (3, 7)"), "dim_customers": customers.where("customer_id < 5"),
                                     "fct_transactions": paid.where("transaction_id % 50 = 1")}, two)
    assert tables(spark, two) == tables(spark, one)
    assert rows(warehouse.read_table(spark, two, warehouse.STATE)) == rows(warehouse.read_table(spark, one, warehouse.STATE))
    again = warehouse.read_version(spark, two).number
    increment.load_increment(spark, {"fct_events": moved.where("event_id % 100 = 3")}, two)  # sent once more: nothing changes
    assert tables(spark, two) == tables(spark, one) and warehouse.read_version(spark, two).number == again + 1


def test_only_new_rows_and_the_state_are_read_for_rows_in_order(spark, tmp_dir, monkeypatch):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    last = F.to_date("timestamp") >= F.lit("2024-01-30").cast("date")
    full(spark, raw | {"fct_events": raw["fct_events"].where(~last)}, wh)
    read, real = [], warehouse.read_places
    old = warehouse.read_version(spark, wh).places["fct_events"]

    def spy(spark, base, table, places):
        df = real(spark, base, table, places)
        if table == "fct_events":
            read.append((df, set(places)))
        return df

    monkeypatch.setattr(warehouse, "read_places", spy)
    scanned = []
    write = warehouse.write_table

    def plan(spark, base, table, df, load):
        if table == "fct_events":
            scanned.append(df._jdf.queryExecution().optimizedPlan().toString())
        return write(spark, base, table, df, load)

    monkeypatch.setattr(warehouse, "write_table", plan)
    increment.load_increment(spark, {"fct_events": raw["fct_events"].where(last)}, wh)
    assert not any(f"period={p}" in text for text in scanned for p in old)


def test_a_load_killed_at_any_step_leaves_a_whole_warehouse(spark, tmp_dir, monkeypatch):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    full(spark, raw, wh)
    before, listed = tables(spark, wh), files(wh)
    changed = {"dim_products": raw["dim_products"].withColumn("brand", F.lit("new")), "fct_events": raw["fct_events"].where("event_id < 50")}

    class Killed(BaseException):
        pass

    calls = {"n": 0, "stop": 0}

    def counted(fn):
        def run(*a, **k):
            calls["n"] += 1
            if calls["n"] == calls["stop"]:
                raise Killed
            return fn(*a, **k)
        return run

    for name in ("write_table", "read_load", "places_of_load", "commit"):
        monkeypatch.setattr(warehouse, name, counted(getattr(warehouse, name)))
    monkeypatch.setattr(warehouse, "drop_load", lambda *a: None)  # a killed process cleans nothing up
    steps = 0
    for step in range(1, 40):
        calls.update(n=0, stop=step)
        try:
            increment.load_increment(spark, changed, wh)
        except Killed:
            steps += 1
            if step % 4 == 1:  # reading every table is slow: at each third step
                assert tables(spark, wh) == before
            assert warehouse.versions(spark, wh) == [1] and listed <= files(wh)
            continue
        break
    assert steps >= 6 and warehouse.versions(spark, wh) == [1, 2]
    assert set(warehouse.read_table(spark, wh, "dim_products").select("brand").distinct().toPandas()["brand"]) == {"new"}


def test_contracts_hold_before_an_increment_is_seen(spark, tmp_dir):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    full(spark, raw, wh)
    listed = files(wh)
    bad = raw["fct_events"].where("event_id = 5").withColumn("product_id", F.lit(10 ** 9).cast("bigint"))
    with pytest.raises(quality.ContractViolation, match="foreign key broken on fct_events.product_id"):
        increment.load_increment(spark, {"fct_events": bad}, wh)
    with pytest.raises(quality.ContractViolation, match="domain"):
        increment.load_increment(spark, {"fct_events": bad.withColumn("event_type", F.lit("none"))}, wh)
    assert files(wh) == listed and warehouse.versions(spark, wh) == [1]
    with pytest.raises(FileNotFoundError):
        increment.load_increment(spark, {"fct_events": bad}, os.path.join(tmp_dir, "nothing"))


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_many_rows_in_small_files_are_not_broadcast(spark):
    """Spark sees the size of the files only; the driver would build a table of all their rows."""
    n = session.LOOKUP_ROWS + 1
    side = session.materialize(spark.range(n).withColumnRenamed("id", "k"), "many-rows")
    facts = spark.range(5).select((F.col("id") * (n // 2)).alias("k"))
    assert "BroadcastHashJoin" in executed(facts.join(side, "k", "left_semi"))
    found = facts.join(session.lookup(side, side.count()), "k", "left_semi")
    assert "ShuffledHashJoin" in executed(found) and "BroadcastHashJoin" not in executed(found)
    assert found.count() == 3
    assert "BroadcastHashJoin" in executed(facts.join(session.lookup(side.limit(9), 9), "k", "left_semi"))  # few rows: as Spark likes


def test_no_table_that_grows_is_broadcast_by_a_load(spark, tmp_dir, monkeypatch):
    """Every join of a full load and an increment with late, moved and repeated rows, with all tables counting as large."""
    raw = pipeline.raw_tables(spark, SF)
    one, two = os.path.join(tmp_dir, "one"), os.path.join(tmp_dir, "two")
    late = F.col("event_id") % 50 == 3
    sent = {"fct_events": raw["fct_events"].withColumn("customer_id", F.expr("CASE WHEN event_id % 100 = 3 THEN customer_id + 1 ELSE customer_id END")),
            "dim_customers": raw["dim_customers"].withColumn("country", F.expr("CASE WHEN customer_id < 5 THEN 'Elsewhere' ELSE country END")),
            "fct_transactions": raw["fct_transactions"].withColumn("quantity", F.expr("CASE WHEN transaction_id % 50 = 1 THEN 9 ELSE quantity END"))}
    full(spark, raw | sent, one)
    monkeypatch.setattr(session, "LOOKUP_ROWS", 0, raising=False)
    plans = []

    def spy(module, name, frame):
        real = getattr(module, name)

        def run(*a, **k):
            plans.append(executed(a[frame]))
            return real(*a, **k)
        monkeypatch.setattr(module, name, run)

    for module, name, frame in ((pipeline, "materialize", 0), (increment, "materialize", 0), (warehouse, "write_table", 3), (quality, "raise_on_counts", 0)):
        spy(module, name, frame)
    full(spark, raw | {"fct_events": raw["fct_events"].where(~late | (F.col("event_id") % 100 == 3))}, two)
    increment.load_increment(spark, {"fct_events": sent["fct_events"].where(late), "dim_customers": sent["dim_customers"].where("customer_id < 5"),
                                     "fct_transactions": sent["fct_transactions"].where("transaction_id % 50 = 1")}, two)
    found = {kind: set(re.findall(kind + r" \[(\w+)#", "\n".join(plans))) for kind in ("BroadcastHashJoin", "ShuffledHashJoin")}
    assert found["BroadcastHashJoin"] <= {"_pid", "c_nationkey", "n_regionkey"}  # a row per partition, nations, regions
    assert {"customer_id", "event_id", "transaction_id", "_k"} <= found["ShuffledHashJoin"]
    assert tables(spark, two) == tables(spark, one)
    assert rows(warehouse.read_table(spark, two, warehouse.STATE)) == rows(warehouse.read_table(spark, one, warehouse.STATE))


def test_of_two_writers_one_fails(spark, tmp_dir):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    full(spark, raw, wh)
    version = warehouse.read_version(spark, wh)
    warehouse.commit(spark, wh, warehouse.Version(2, version.places))
    with pytest.raises(warehouse.ConcurrentLoad):
        warehouse.commit(spark, wh, warehouse.Version(2, version.places))
    assert warehouse.versions(spark, wh) == [1, 2] and len(os.listdir(os.path.join(wh, "manifests"))) <= 4  # with checksum files


def test_vacuum_keeps_what_the_newest_versions_hold(spark, tmp_dir):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    for _ in range(3):
        full(spark, raw, wh)
    assert warehouse.versions(spark, wh) == [2, 3]
    assert tables(spark, wh)["dim_products"] == rows(schemas.conform(warehouse.read_table(spark, wh, "dim_products", 2), "dim_products"))
    loads = {f.split("load=")[1].split("/")[0] for f in files(wh)}
    assert len(loads) == 2


def test_empty_increment(spark, tmp_dir):
    raw, wh = pipeline.raw_tables(spark, SF), os.path.join(tmp_dir, "wh")
    full(spark, raw, wh)
    before = tables(spark, wh)
    increment.load_increment(spark, {t: df.limit(0) for t, df in raw.items()}, wh)
    assert tables(spark, wh) == before


def test_load_writes_its_audit(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    pipeline.run(spark, SF, wh)
    assert rows(warehouse.audit_rows(spark, wh)) == rows(pipeline.load_audit(spark, SF))


def test_period_filter_prunes_folders(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    pipeline.run(spark, SF, wh)
    day = warehouse.read_table(spark, wh, "fct_events").where("period = '2024-01-05'")
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan and day.count() == \
        pipeline.read_warehouse(spark, wh, "fct_events").where("to_date(timestamp) = '2024-01-05'").count()
