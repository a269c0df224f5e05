"""Structured Streaming sessions and arm totals on a two-file event feed."""

import datetime as dt
import os

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from kestrel.streaming import sessions_stream

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


def _write(path, rows):
    cols = list(zip(*rows))
    table = pa.table({"event_id": pa.array(cols[0], pa.int64()), "ts": pa.array(cols[1], pa.timestamp("us")),
                      "user_id": pa.array(cols[2], pa.int64()), "event_type": pa.array(cols[3], pa.string()),
                      "value": pa.array(cols[4], pa.float64()), "props": pa.array(cols[5], pa.string())})
    pq.write_table(table, path)


def _feed(tmp_dir, late=False):
    m = dt.timedelta(minutes=1)
    folder = os.path.join(tmp_dir, "events.parquet")
    os.makedirs(folder)
    files = [[(1, T0, 1, "view", 1.0, '{"k": 1}'), (2, T0 + 10 * m, 1, "click", 1.0, '{"k": 2}'),
              (3, T0 - 60 * m, 2, "purchase", 1.0, '{"k": 3}')],
             [(4, T0 + 20 * m, 1, "purchase", 1.0, '{"k": 4}'),
              (2, T0 + 10 * m, 1, "click", 1.0, '{"k": 2}'),          # repeats event 2 in a later file
              (5, T0 + 240 * m, 3, "view", 1.0, '{"k": 5}')]]         # advances the watermark
    if late:
        files.append([(6, T0 - 50 * m, 4, "view", 1.0, '{"k": 6}')])  # hours behind it
    for i, rows in enumerate(files):
        _write(os.path.join(folder, f"part-{i}.parquet"), rows)
        os.utime(os.path.join(folder, f"part-{i}.parquet"), (1e9 + i, 1e9 + i))  # the order in which they are read
    _write(os.path.join(tmp_dir, "events_old.parquet"), [(9, T0, 9, "view", 1.0, '{"k": 9}')])  # another table


M = dt.timedelta(minutes=1)
ALL = {(1, T0): (T0 + 50 * M, 3, 1), (2, T0 - 60 * M): (T0 - 30 * M, 1, 1), (3, T0 + 240 * M): (T0 + 270 * M, 1, 0)}


def _sessions(df):
    return {(r.customer_id, r.session_start): (r.session_end, r.n_events, r.n_purchases) for r in df.collect()}


def test_stream_sessions_are_complete(spark, tmp_dir):
    _feed(tmp_dir)
    for files in (1, 64):
        out = sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, f"out{files}"), max_files_per_trigger=files)
        assert _sessions(out) == ALL  # the repeated event counted once, the last session closed


def test_open_sessions_wait_without_closing(spark, tmp_dir):
    _feed(tmp_dir)
    out = sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, "out"), max_files_per_trigger=1, close=False)
    assert _sessions(out) == {k: v for k, v in ALL.items() if k[0] != 3}


def test_late_rows_are_not_dropped_silently(spark, tmp_dir):
    _feed(tmp_dir, late=True)
    with pytest.raises(sessions_stream.LateRows):
        sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, "a"), max_files_per_trigger=1)
    accepted = sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, "b"), max_files_per_trigger=1, accept_late=True)
    assert _sessions(accepted) == ALL
    wide = sessions_stream.run_stream_sessions(spark, tmp_dir, 30, delay="1 day", out_dir=os.path.join(tmp_dir, "c"), max_files_per_trigger=1)
    assert _sessions(wide) == ALL | {(4, T0 - 50 * M): (T0 - 20 * M, 1, 0)}


def test_stream_group_totals(spark, tmp_dir):
    _feed(tmp_dir)
    out = sessions_stream.run_stream_group_totals(spark, tmp_dir, out_dir=os.path.join(tmp_dir, "tot"), max_files_per_trigger=1)
    assert {r.experiment_group: (r.total_events, r.purchase_events) for r in out.collect()} == \
        {"Control": (3, 0), "Variant_A": (1, 1), "Variant_B": (1, 1)}


def test_late_rows_of_early_batches_count(spark, tmp_dir):
    _feed(tmp_dir, late=True)
    folder = os.path.join(tmp_dir, "events.parquet")
    for i in (3, 4, 5):  # batches after the late row's, more than the progress records kept
        _write(os.path.join(folder, f"part-{i}.parquet"), [(10 + i, T0 + 240 * M, 5, "view", 1.0, '{"k": 5}')])
        os.utime(os.path.join(folder, f"part-{i}.parquet"), (1e9 + i, 1e9 + i))
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    try:
        with pytest.raises(sessions_stream.LateRows):
            sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, "s"), max_files_per_trigger=1)
        with pytest.raises(sessions_stream.LateRows):
            sessions_stream.run_stream_group_totals(spark, tmp_dir, os.path.join(tmp_dir, "g"), "30 minutes", max_files_per_trigger=1)
        assert spark.conf.get("spark.sql.streaming.numRecentProgressUpdates") == "1"
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")


def test_late_rows_count_after_a_restart(spark, tmp_dir):
    _feed(tmp_dir, late=True)
    out = os.path.join(tmp_dir, "out")
    sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=out, max_files_per_trigger=1, close=False, accept_late=True)
    with pytest.raises(sessions_stream.LateRows):  # nothing new to read: the row of the first run still counts
        sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=out, max_files_per_trigger=1)


def test_sessions_of_no_customer_are_kept(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "events.parquet")
    os.makedirs(folder)
    _write(os.path.join(folder, "part-0.parquet"), [(1, T0, None, "view", 1.0, '{"k": 1}'), (2, T0, 1, "view", 1.0, '{"k": 2}')])
    out = sessions_stream.run_stream_sessions(spark, tmp_dir, 30, out_dir=os.path.join(tmp_dir, "out"))
    assert _sessions(out) == {(c, T0): (T0 + 30 * M, 1, 0) for c in (None, 1)}
