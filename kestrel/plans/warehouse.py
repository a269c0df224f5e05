"""The warehouse: Parquet loads under a folder and one small manifest per version.

    <base>/data/<table>/[period=P/]load=L/part-*.parquet     written once, never changed
    <base>/manifests/v00000012.json                          which load holds each period of each table

A load writes its rows under its own label ``L`` and becomes visible when its manifest is created, a single
operation that fails if that version exists. So readers see all tables of one version or of the one before,
whatever step a load is killed at, and of two writers one fails. A version names, per table and period, the one
load that holds it: an increment writes only the periods it touches and points to the others where they are. Facts are
cut by ``PERIODS`` (events by day, transactions by month); a filter on ``period`` prunes folders. A manifest also holds
the key range of every period (so that an upsert can tell which periods may hold a key) and the load's audit.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.session import delete_path, path_exists, _hadoop
from kestrel.sources import schemas

#: How the facts are cut into periods (patterns of date_format).
PERIODS = {"fct_events": "yyyy-MM-dd", "fct_transactions": "yyyy-MM"}
#: Last time and session number of every customer: what sessions of the next load go on from.
STATE = "customer_state"
STATE_SCHEMA = T.StructType([T.StructField("customer_id", T.LongType()), T.StructField("last_time", T.TimestampNTZType()),
                             T.StructField("last_seq", T.LongType())])
_MANIFEST = re.compile(r"v(\d{8})\.json")


class ConcurrentLoad(Exception):
    """Another load committed the version that this one was to become."""


@dataclass
class Version:
    """``places``: table -> period ("" for a table without) -> [load, smallest key, largest key, rows]."""

    number: int = 0
    places: dict[str, dict[str, list]] = field(default_factory=dict)
    audit: list[tuple[str, str, int]] = field(default_factory=list)


def new_load() -> str:
    return uuid.uuid4().hex[:16]


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _hadoop(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []


def _read_text(spark: SparkSession, path: str) -> str:
    fs, hpath = _hadoop(spark, path)
    stream = fs.open(hpath)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def versions(spark: SparkSession, base: str) -> list[int]:
    return sorted(int(m[1]) for n in _names(spark, f"{base}/manifests") if (m := _MANIFEST.fullmatch(n)))


def read_version(spark: SparkSession, base: str, number: int | None = None) -> Version | None:
    """A committed version, the newest one by default; None where there is none."""
    base, known = base.rstrip("/"), versions(spark, base.rstrip("/"))
    if not known:
        return None
    number = known[-1] if number is None else number
    m = json.loads(_read_text(spark, f"{base}/manifests/v{number:08d}.json"))
    return Version(number, m["places"], [tuple(a) for a in m["audit"]])


def commit(spark: SparkSession, base: str, version: Version) -> None:
    """Make a version visible: its manifest is written beside and renamed to its name, which must be free."""
    text = json.dumps({"places": version.places, "audit": version.audit}, sort_keys=True)
    target, aside = f"{base}/manifests/v{version.number:08d}.json", f"{base}/manifests/_{uuid.uuid4().hex}"
    fs, hpath = _hadoop(spark, aside)
    out = fs.create(hpath, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(hpath, spark._jvm.org.apache.hadoop.fs.Path(target), none)  # without OVERWRITE: fails if it is there
    except Exception as exc:
        fs.delete(hpath, False)
        if path_exists(spark, target):
            raise ConcurrentLoad(f"version {version.number} of {base} was committed by another load") from exc
        raise


def _folder(table: str, period: str, load: str) -> str:
    return f"data/{table}/" + (f"period={period}/" if period else "") + f"load={load}"


def _schema(table: str) -> T.StructType:
    return STATE_SCHEMA if table == STATE else schemas.TABLES[table]


def period_of(table: str):
    return F.date_format("timestamp", PERIODS[table])


def write_table(spark: SparkSession, base: str, table: str, df: DataFrame, load: str) -> None:
    """Write rows under the load's label; facts cut by period and sorted by time, a hot period over several tasks."""
    if table not in PERIODS:
        df.write.parquet(f"{base}/{_folder(table, '', load)}")
        return
    key = schemas.PRIMARY_KEYS[table]
    df = df.withColumn("period", period_of(table)).withColumn("load", F.lit(load))
    df = df.repartitionByRange("period", "timestamp", key).sortWithinPartitions("period", "timestamp", key)
    df.write.mode("append").partitionBy("period", "load").parquet(f"{base}/data/{table}")


def read_places(spark: SparkSession, base: str, table: str, places: dict[str, list]) -> DataFrame:
    """Rows of the given periods, with ``period`` (and ``load``) as partition columns for facts."""
    base, schema = base.rstrip("/"), _schema(table)
    if table in PERIODS:
        schema = T.StructType([*schema.fields, T.StructField("period", T.StringType()), T.StructField("load", T.StringType())])
    if not places:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if table in PERIODS:
        reader = reader.option("basePath", f"{base}/data/{table}")
    return reader.parquet(*(f"{base}/{_folder(table, p, at[0])}" for p, at in sorted(places.items())))


def places_of_load(written: dict[str, DataFrame], load: str) -> dict[str, dict[str, list]]:
    """What a load has written (table -> its rows): per table and period its label, key range and rows, in one job (one row per
    table and period to the driver)."""
    parts = [df.groupBy(F.lit(t).alias("t"), (F.col("period") if t in PERIODS else F.lit("")).alias("p")).agg(
        F.min(key).alias("lo"), F.max(key).alias("hi"), F.count("*").alias("n"))
        for t, df in written.items() for key in (schemas.PRIMARY_KEYS.get(t, "customer_id"),)]
    places: dict = {t: {} if t in PERIODS else {"": [load, None, None, 0]} for t in written}
    if parts:
        for r in reduce(DataFrame.unionByName, parts).collect():
            places[r["t"]][r["p"]] = [load, r["lo"], r["hi"], r["n"]]
    return places


def _periods_of(spark: SparkSession, base: str, table: str, load: str) -> list[str]:
    fs, path = _hadoop(spark, f"{base}/data/{table}/period=*/load={load}")
    return [s.getPath().getParent().getName().removeprefix("period=") for s in fs.globStatus(path) or []]


def read_load(spark: SparkSession, base: str, table: str, load: str) -> DataFrame:
    if table not in PERIODS:
        return read_places(spark, base, table, {"": [load]})
    return read_places(spark, base, table, {p: [load] for p in _periods_of(spark, base, table, load)})


def read_table(spark: SparkSession, base: str, table: str, number: int | None = None) -> DataFrame:
    """A table of the warehouse (with ``period`` for facts), of the newest version by default."""
    version = read_version(spark, base, number)
    if version is None:
        raise FileNotFoundError(f"no warehouse in {base}")
    return read_places(spark, base, table, version.places[table]).drop("load")


def drop_load(spark: SparkSession, base: str, load: str) -> None:
    """Delete what a failed load has written; nothing refers to it."""
    for table in (*schemas.LOAD_ORDER, STATE):
        for period in _periods_of(spark, base, table, load) if table in PERIODS else [""]:
            delete_path(spark, f"{base}/{_folder(table, period, load)}")


def vacuum(spark: SparkSession, base: str, keep: int = 2) -> None:
    """Delete the manifests before the newest ``keep`` ones, then the loads that only those referred to."""
    base, known = base.rstrip("/"), versions(spark, base.rstrip("/"))
    live, gone = ({(t, p, at[0]) for n in part for t, ps in read_version(spark, base, n).places.items() for p, at in ps.items()}
                  for part in (known[-keep:], known[:-keep]))
    for n in known[:-keep]:
        delete_path(spark, f"{base}/manifests/v{n:08d}.json")
    for place in gone - live:
        delete_path(spark, f"{base}/{_folder(*place)}")


def audit_rows(spark: SparkSession, base: str, number: int | None = None) -> DataFrame:
    """The audit that a version's load took while writing: (table_name, metric, value)."""
    return spark.createDataFrame(read_version(spark, base, number).audit, "table_name string, metric string, value bigint")


def create_views(spark: SparkSession, database: str, base: str) -> list[str]:
    """The star schema in the catalog, as views of the newest version with the declared types; repeat it after a load. A view
    lists its files anew in every query, so no session reads a stale listing."""
    version, base = read_version(spark, base), base.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for table in schemas.LOAD_ORDER:
        columns = ", ".join(f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`" for f in schemas.TABLES[table].fields)
        folders = [_folder(table, p, at[0]).removeprefix(f"data/{table}/") for p, at in sorted(version.places[table].items())]
        where = f"{base}/data/{table}/" + (folders[0] if len(folders) == 1 else "{" + ",".join(folders) + "}")
        source = f"parquet.`{where}`" if folders else "VALUES (" + ", ".join("NULL" for _ in schemas.TABLES[table]) + ") AS t(" + \
            ", ".join(f"`{f.name}`" for f in schemas.TABLES[table].fields) + ") WHERE false"
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{table} AS SELECT {columns} FROM {source}")
    return [f"{database}.{t}" for t in schemas.LOAD_ORDER]
