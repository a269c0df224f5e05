"""Sessions derived from timestamps, and the per-customer event gap.

A plain ``Window.partitionBy(customer)`` sends a customer's whole history to one
task; one customer may hold a third of all rows, so no window over a customer
is used. Instead the events are range-partitioned and sorted by (customer, time)
once - a hot customer is cut wherever the range bounds fall - and linked while
they stream through the sorted partition: each event gets the previous time and
the number of sessions its customer has started in this partition. The linked
events are written once with their partition id. What is missing concerns only the
first customer of each partition: one row per partition (its first and last event)
says whether the partition before ends with the same customer, and how many
sessions that customer had by then; a join on the partition id adds it.

So the events are scanned and shuffled once, and no join or window is as large as
the events. The result does not depend on where partitions are cut.

Session rule: a new session starts at a customer's first event or
when the gap to the previous event is strictly greater than the threshold; equal
timestamps never open a session, so ids do not depend on tie order. An event
without a time sorts first and opens or closes no gap.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kestrel.config import SESSION_GAP_MINUTES
from kestrel.functions.rounding import round_np
from kestrel.operators.common import one_row
from kestrel.session import materialize, ship_package

US_PER_MINUTE = 60_000_000
_LINK = pa.struct([("_prev", pa.int64()), ("_seq", pa.int64()), ("_head", pa.bool_()), ("_pid", pa.int32()), ("_pos", pa.int64())])


def micros(df: DataFrame, ts_col: str) -> Column:
    """Microseconds since 1970-01-01 without time-zone shifts (NTZ stays wall-clock)."""
    dtype = df.schema[ts_col].dataType
    if isinstance(dtype, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts_col}`)")
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(F.col(ts_col))
    return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', "
                  f"to_timestamp_ntz(`{ts_col}`))")


def _link_sorted(gap_us: int):
    """Over customer and time of the rows of one sorted partition: ``_prev`` (previous time of the customer in it), ``_seq``
    (sessions started by its customer in it, from 1; from 0 for the partition's first
    customer, whose history may begin earlier), ``_head`` (is it that customer), ``_pid``, ``_pos``."""
    def run(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        pid, pos, runs, carry = TaskContext.get().partitionId(), 0, 0, None  # carry: customer, time, seq
        for who, us in batches:
            n = len(who)
            if not n:
                yield pa.array([], _LINK)
                continue
            timed, time = us.is_valid().to_numpy(zero_copy_only=False), pc.fill_null(us, 0).to_numpy()
            code = pc.dictionary_encode(who, null_encoding="encode").indices.to_numpy()
            new = np.r_[carry is None or who[0].as_py() != carry[0], code[1:] != code[:-1]]
            before = np.r_[carry[1] or 0 if carry else 0, time[:-1]]
            known = np.r_[carry is not None and carry[1] is not None, timed[:-1]] & ~new
            start = (known & timed & (time - before > gap_us)).cumsum()
            at = np.flatnonzero(new)
            base = np.ones(len(at), np.int64)
            if runs == 0 and len(at):
                base[0] = 0
            group = new.cumsum()
            seq = start + np.r_[carry[2] if carry else 0, base - start[at]][group]
            run_no = runs + group
            yield pa.StructArray.from_arrays(
                [pa.array(before, mask=~known), pa.array(seq), pa.array(run_no <= 1), pa.array(np.full(n, pid, np.int32)),
                 pa.array(np.arange(pos, pos + n))], fields=list(_LINK))
            runs, pos, carry = int(run_no[-1]), pos + n, (who[n - 1].as_py(), us[n - 1].as_py(), int(seq[-1]))
    return run


def link_events(events: DataFrame, gap_minutes: float | None = SESSION_GAP_MINUTES,
                customer_col: str = "customer_id", ts_col: str = "timestamp",
                tie_col: str | None = "event_id", partitions: int | None = None) -> DataFrame:
    """Adds ``_us`` (event time), ``prev_us`` (previous event time of the customer)
    and, when ``gap_minutes`` is given, ``session_seq`` (1-based). Runs the one shuffle."""
    gap_us = 0 if gap_minutes is None else int(round(gap_minutes * US_PER_MINUTE))
    n_parts = partitions or int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [customer_col, "_us", *([tie_col] if tie_col else [])]
    ordered = events.withColumn("_us", micros(events, ts_col)).repartitionByRange(n_parts, *order).sortWithinPartitions(*order)
    ship_package(events.sparkSession)
    # the workers see two columns; the other ones wait in the task, row for row
    link = F.arrow_udf(_link_sorted(gap_us), "_prev bigint, _seq bigint, _head boolean, _pid int, _pos bigint").asNondeterministic()
    linked = ordered.withColumn("_link", link(customer_col, "_us"))
    linked = materialize(linked.select(*ordered.columns, "_link.*"), "linked-events")
    row = F.struct(F.col(customer_col).alias("who"), F.col("_us").alias("us"), F.col("_seq").alias("seq"), F.col("_head").alias("head"))
    edges = linked.groupBy("_pid").agg(F.min_by(row, "_pos").alias("first"), F.max_by(row, "_pos").alias("last"))
    # from here on one row per partition
    w = Window.partitionBy(F.lit(0)).orderBy("_pid")
    before = F.lag("last").over(w)
    edges = (edges.withColumn("prior", before)
             .withColumn("same", F.col("prior").isNotNull() & F.col("first.who").eqNullSafe(F.col("prior.who")))
             .withColumn("opens", F.when(~F.col("same") | F.coalesce(F.col("first.us") - F.col("prior.us") > gap_us, F.lit(False)), 1).otherwise(0))
             .withColumn("segment", F.sum(F.when(F.col("last.head") & F.col("same"), 0).otherwise(1)).over(w))
             .withColumn("gained", F.col("last.seq") + F.when(F.col("last.head"), F.col("opens")).otherwise(0)))
    by_segment = Window.partitionBy("segment").orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)
    edges = edges.withColumn("reached", F.sum("gained").over(by_segment))
    carried = F.when(F.col("same"), F.lag("reached").over(w)).otherwise(0)
    edges = edges.select("_pid", (carried + F.col("opens")).alias("_add"), F.when(F.col("same"), F.col("prior.us")).alias("_prior"))
    out = (linked.join(edges, "_pid")
           .withColumn("prev_us", F.when(F.col("_pos") == 0, F.col("_prior")).otherwise(F.col("_prev"))))
    if gap_minutes is not None:
        out = out.withColumn("session_seq", F.col("_seq") + F.when(F.col("_head"), F.col("_add")).otherwise(0))
    return out.drop("_pid", "_pos", "_prev", "_seq", "_head", "_add", "_prior")


def build_sessions(events: DataFrame, gap_minutes: float = SESSION_GAP_MINUTES,
                   customer_col: str = "customer_id", ts_col: str = "timestamp",
                   partitions: int | None = None) -> DataFrame:
    """All input columns + ``session_seq`` + ``derived_session_id = "{customer}-{seq}"``."""
    tie = "event_id" if "event_id" in events.columns else None
    linked = link_events(events, gap_minutes, customer_col, ts_col, tie, partitions)
    return (linked.withColumn("derived_session_id",
                              F.concat_ws("-", F.col(customer_col).cast("string"),
                                          F.col("session_seq").cast("string")))
            .drop("_us", "prev_us"))


def event_gaps(events: DataFrame, customer_col: str = "customer_id", ts_col: str = "timestamp",
               partitions: int | None = None) -> DataFrame:
    """Each event with ``gap_minutes`` to the customer's previous event (NULL for the first)."""
    tie = "event_id" if "event_id" in events.columns else None
    linked = link_events(events, None, customer_col, ts_col, tie, partitions)
    gap = (F.col("_us") - F.col("prev_us")).cast("double") / F.lit(float(US_PER_MINUTE))
    return linked.withColumn("gap_minutes", gap).drop("_us", "prev_us")


def session_summary(sessioned: DataFrame, customer_col: str = "customer_id",
                    ts_col: str = "timestamp") -> DataFrame:
    """One row per derived session: customer, start, end, non-null event count,
    duration in minutes (2 dp, numpy rounding).

    Grouped on the integer pair (customer, seq) instead of the id string; the
    aggregation is partial, so a long session costs one row per map task.
    """
    g = sessioned.groupBy(customer_col, "session_seq").agg(
        F.min(ts_col).alias("start_ts"), F.max(ts_col).alias("end_ts"),
        F.count("event_id").alias("n_events"))
    dur_us = F.expr("timestampdiff(MICROSECOND, start_ts, end_ts)").cast("double")
    return g.select(
        F.concat_ws("-", F.col(customer_col).cast("string"), F.col("session_seq").cast("string"))
         .alias("derived_session_id"),
        F.col(customer_col).alias("customer_id"),
        "start_ts", "end_ts",
        F.col("n_events").cast("bigint").alias("n_events"),
        round_np(dur_us / F.lit(1e6) / F.lit(60.0)).alias("duration_minutes"))


def session_counts(events: DataFrame, sessioned_summary: DataFrame) -> DataFrame:
    """Events, distinct source session_id values, derived sessions."""
    src = events.agg(F.count(F.lit(1)).alias("n_events"),
                     F.countDistinct("session_id").alias("n_source_session_ids"))
    der = sessioned_summary.agg(F.count(F.lit(1)).alias("n_derived_sessions"))
    return one_row([src, der])
