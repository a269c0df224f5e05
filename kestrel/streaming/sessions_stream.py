"""Sessions and arm totals on a stream (E5).

``readStream`` over the event files -> star projection -> watermark ->
``dropDuplicatesWithinWatermark(event_id)`` -> ``session_window`` per customer.
Append mode emits a session once the watermark (max event time - delay) has
passed its end (last event + gap); state for closed sessions is dropped. A session
window merges events at most ``gap`` apart and splits beyond it - the batch rule.
When the input is complete, a closing pass moves the watermark past every event (a
marker row in a control folder that the same query reads), so the sessions still open
are emitted too and the result is the batch result.

State is kept in RocksDB, the batch is bounded by default, and events merge into sessions
within a task before the shuffle, so a hot customer sends sessions, not events. Rows behind
the watermark cannot be added any more; they are counted (``late_rows``) and, if any,
raise ``LateRows`` unless the caller accepts them: the result never depends silently
on file order. Each batch's count is kept beside the sink, so that it holds for any number of
batches and over restarts from the checkpoint; a committed batch without one raises too.

Arm totals are partial sums per batch over the de-duplicated stream, each batch in a folder
of its own (written again, if a batch is repeated, to the same one) and added up on
reading. Sinks are Parquet folders under the shared checkpoint folder, never the driver.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kestrel.config import PURCHASE, SESSION_GAP_MINUTES
from kestrel.session import _hadoop, path_exists, shared_path
from kestrel.sources.star import events_projection
from kestrel.sources.tables import SCHEMAS

FILES_PER_TRIGGER = 64
STATE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
         "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
         "spark.sql.streaming.numRecentProgressUpdates": "10000"}
#: Seconds between two looks at a running query's progress (it keeps the last 10,000 batches).
LOOK_S = 2
#: Event id of the marker row of the closing pass (event ids are not negative).
MARKER = -1


class LateRows(Exception):
    """Events arrived behind the watermark and were not counted."""


def event_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int = FILES_PER_TRIGGER,
                 control: str | None = None) -> DataFrame:
    """Streaming ``fct_events`` over ``events.parquet`` (a file, or a folder that gains files), and
    over the marker rows of the folder ``control``."""
    schema = SCHEMAS["events"]

    def read(path):
        return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(path)

    raw = read(f"{sf_dir.rstrip('/')}/[e]vents.parquet")  # a pattern that matches this name only
    if control:
        raw = raw.unionByName(read(control))
    return events_projection(raw).withColumn("event_time", F.col("timestamp").cast("timestamp"))


def _write_control(spark: SparkSession, control: str, close: bool) -> None:
    """An empty folder to read from at first; the marker row, far in the future, to close."""
    row = [(MARKER, MARKER, "marker", 0.0, '{"k": 0}')] if close else []
    df = spark.createDataFrame(row, "event_id bigint, user_id bigint, event_type string, value double, props string")
    df.select("event_id", F.expr("TIMESTAMP_NTZ'9000-01-01 00:00:00'").alias("ts"), "user_id", "event_type", "value", "props") \
        .write.mode("append").parquet(control)


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, path = _hadoop(spark, folder)
    return [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []


def _keep_late(spark: SparkSession, q, folder: str, seen: set) -> None:
    """An empty file ``batch-rows`` for each batch whose progress is known and not yet in ``seen``."""
    for p in q.recentProgress:
        p = json.loads(p if isinstance(p, str) else p.json)
        late = sum(op.get("numRowsDroppedByWatermark", 0) for op in p["stateOperators"])
        name = f"{p['batchId']}-{late}"
        if name not in seen:
            fs, path = _hadoop(spark, f"{folder}/{name}")
            fs.create(path, True).close()
            seen.add(name)


def _late(spark: SparkSession, out_dir: str) -> tuple[int, int]:
    """Rows dropped in all batches so far, and the number of committed batches of which it is not known."""
    kept: dict[int, int] = {}
    for name in _names(spark, f"{out_dir}/late"):
        batch, rows = map(int, name.split("-"))
        kept[batch] = max(rows, kept.get(batch, 0))
    commits = [int(n) for n in _names(spark, f"{out_dir}/_checkpoint/commits") if n.isdigit()]  # the last ones; ids have no gaps
    return sum(kept.values()), sum(b not in kept for b in range(max(commits, default=-1) + 1))


def _run(query_of, spark: SparkSession, accept_late: bool, out_dir: str) -> int:
    """Run a query to the end of its input; returns the rows dropped behind the watermark in all its batches,
    those before a restart included."""
    old = {k: spark.conf.get(k, None) for k in STATE}
    for k, v in STATE.items():
        spark.conf.set(k, v)
    try:
        q, seen = query_of().trigger(availableNow=True).start(), set()
        try:
            while not q.awaitTermination(LOOK_S):
                _keep_late(spark, q, f"{out_dir}/late", seen)
        finally:  # also of a query that failed: its committed batches are not run again
            _keep_late(spark, q, f"{out_dir}/late", seen)
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    late, unknown = _late(spark, out_dir)
    if (late or unknown) and not accept_late:
        raise LateRows(f"{late} row(s) behind the watermark, {unknown} batch(es) not counted: raise the delay or feed files in time order")
    return late


def stream_sessions(events: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES,
                    delay: str = "30 minutes") -> DataFrame:
    w = F.session_window("event_time", f"{gap_minutes} minutes")
    return (events.withWatermark("event_time", delay)
            .dropDuplicatesWithinWatermark(["event_id"])
            .groupBy(w.alias("session"), F.col("customer_id"))
            .agg(F.count(F.lit(1)).alias("n_events"),
                 F.count_if(F.col("event_type") == PURCHASE).alias("n_purchases"))
            .select("customer_id",
                    F.col("session.start").cast("timestamp_ntz").alias("session_start"),
                    F.col("session.end").cast("timestamp_ntz").alias("session_end"),
                    F.col("n_events").cast("bigint").alias("n_events"),
                    F.col("n_purchases").cast("bigint").alias("n_purchases")))


def run_stream_sessions(spark: SparkSession, sf_dir: str, gap_minutes: int = SESSION_GAP_MINUTES,
                        delay: str = "30 minutes", out_dir: str | None = None,
                        max_files_per_trigger: int = FILES_PER_TRIGGER, close: bool = True,
                        accept_late: bool = False) -> DataFrame:
    """Process everything available, then read the sink. ``close``: the input is complete,
    emit the sessions still open; without it they wait for more files."""
    out_dir = out_dir or shared_path(spark, "stream_sessions", uuid.uuid4().hex)
    control = f"{out_dir}/control"
    if not path_exists(spark, control):
        _write_control(spark, control, close=False)

    def query():
        events = event_stream(spark, sf_dir, max_files_per_trigger, control)
        return (stream_sessions(events, gap_minutes, delay).where(~F.col("customer_id").eqNullSafe(F.lit(MARKER)))
                .writeStream.format("parquet").outputMode("append")
                .option("path", f"{out_dir}/data").option("checkpointLocation", f"{out_dir}/_checkpoint"))

    _run(query, spark, accept_late, out_dir)
    if close:
        _write_control(spark, control, close=True)
        _run(query, spark, accept_late, out_dir)
    return spark.read.parquet(f"{out_dir}/data")


def run_stream_group_totals(spark: SparkSession, sf_dir: str, out_dir: str | None = None, delay: str = "1 day",
                            max_files_per_trigger: int = FILES_PER_TRIGGER, accept_late: bool = False) -> DataFrame:
    """Arm totals over the stream, repeated event ids (within the watermark) counted once."""
    out_dir = out_dir or shared_path(spark, "stream_group_totals", uuid.uuid4().hex)

    def add(batch: DataFrame, epoch: int) -> None:
        batch.groupBy("experiment_group").agg(
            F.count(F.lit(1)).alias("total_events"), F.count_if(F.col("event_type") == PURCHASE).alias("purchase_events")
        ).write.mode("overwrite").parquet(f"{out_dir}/data/epoch={epoch}")

    def query():
        events = event_stream(spark, sf_dir, max_files_per_trigger)
        return (events.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["event_id"])
                .writeStream.outputMode("append").foreachBatch(add).option("checkpointLocation", f"{out_dir}/_checkpoint"))

    _run(query, spark, accept_late, out_dir)
    return (spark.read.parquet(f"{out_dir}/data").groupBy("experiment_group")
            .agg(F.sum("total_events").alias("total_events"), F.sum("purchase_events").alias("purchase_events")))
