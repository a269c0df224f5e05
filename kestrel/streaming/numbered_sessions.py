"""Sessions with the batch form's running numbers, on a stream (E5).

Events become sessions by the session windows of ``sessions_stream`` (a hot customer's events merge
within a task before the shuffle), and a keyed state processor then gives each closed session of a customer the
next number. Its state is one number per customer; what a task holds is a customer's sessions of one batch.

Sessions close in the order of their start: a window is emitted once the watermark has passed its end, and no event
behind the watermark is added, so what closes later starts later. Hence the numbers are those of the batch
form (``session_summary``), for any order of files within the delay, any batches, and over a restart.

Defined results: an event without a time is in no session (a stream has no place for it); events of no
customer are one customer's, as in the batch form; repeated event ids within the watermark count once;
late rows raise as in ``sessions_stream``.
"""

from __future__ import annotations

import uuid

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor

from kestrel.config import SESSION_GAP_MINUTES
from kestrel.functions.rounding import round_np
from kestrel.session import path_exists, shared_path, ship_package
from kestrel.streaming import sessions_stream as base

_OUT = "customer string, session_seq bigint, start_us bigint, end_us bigint, n_events bigint"


class SessionNumbers(StatefulProcessor):
    """The next numbers for a customer's sessions that closed in this batch, by start."""

    def init(self, handle) -> None:
        self._last = handle.getValueState("last", "n bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802, N803 - names of the interface
        closed = pd.concat(list(rows), ignore_index=True).sort_values("start_us", ignore_index=True)
        before = self._last.get()[0] if self._last.exists() else 0
        self._last.update((before + len(closed),))
        yield pd.DataFrame({"customer": pd.Series([key[0]] * len(closed), dtype=object),
                            "session_seq": np.arange(before + 1, before + len(closed) + 1),
                            "start_us": closed["start_us"], "end_us": closed["end_us"], "n_events": closed["n_events"]})

    def close(self) -> None:
        pass


def number_sessions(sessions: DataFrame, gap_minutes: int = SESSION_GAP_MINUTES) -> DataFrame:
    """The rows of ``stream_sessions`` as rows of ``session_summary``. The key is the customer as text: with the
    windows' own key both operators would share a task, which the state store does not allow."""
    ship_package(sessions.sparkSession)
    us = {c: F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {c})") for c in ("session_start", "session_end")}
    numbered = (sessions.select(F.col("customer_id").cast("string").alias("customer"), us["session_start"].alias("start_us"),
                                (us["session_end"] - gap_minutes * 60_000_000).alias("end_us"), "n_events")
                .groupBy("customer").transformWithStateInPandas(SessionNumbers(), _OUT, "Append", "None"))
    time = {c: F.expr(f"timestampadd(MICROSECOND, {c}, TIMESTAMP_NTZ'1970-01-01 00:00:00')") for c in ("start_us", "end_us")}
    kind = sessions.schema["customer_id"].dataType
    return numbered.select(F.concat_ws("-", "customer", F.col("session_seq").cast("string")).alias("derived_session_id"),
                           F.col("customer").cast(kind).alias("customer_id"), time["start_us"].alias("start_ts"), time["end_us"].alias("end_ts"),
                           "n_events", round_np((F.col("end_us") - F.col("start_us")).cast("double") / F.lit(1e6) / F.lit(60.0)).alias("duration_minutes"))


def run_numbered_sessions(spark: SparkSession, sf_dir: str, gap_minutes: int = SESSION_GAP_MINUTES, delay: str = "30 minutes",
                          out_dir: str | None = None, max_files_per_trigger: int = base.FILES_PER_TRIGGER, close: bool = True,
                          accept_late: bool = False) -> DataFrame:
    """Process everything available, then read the sink. ``close`` as in ``run_stream_sessions``; a later run with the
    same ``out_dir`` reads only new files and goes on with the numbers."""
    out_dir = out_dir or shared_path(spark, "stream_numbers", uuid.uuid4().hex)
    control = f"{out_dir}/control"
    if not path_exists(spark, control):
        base._write_control(spark, control, close=False)

    def query():
        events = base.event_stream(spark, sf_dir, max_files_per_trigger, control)
        found = base.stream_sessions(events, gap_minutes, delay).where(~F.col("customer_id").eqNullSafe(F.lit(base.MARKER)))
        return (number_sessions(found, gap_minutes).writeStream.format("parquet").outputMode("append")
                .option("path", f"{out_dir}/data").option("checkpointLocation", f"{out_dir}/_checkpoint"))

    base._run(query, spark, accept_late, out_dir)
    if close:
        base._write_control(spark, control, close=True)
        base._run(query, spark, accept_late, out_dir)
    return spark.read.parquet(f"{out_dir}/data")
