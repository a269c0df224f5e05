"""Running session numbers on a stream against the batch form."""

import datetime as dt
import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kestrel.operators import sessions
from kestrel.sources.star import events_projection
from kestrel.streaming import numbered_sessions, sessions_stream

T0 = dt.datetime(2024, 1, 1)


def _write(folder, i, rows):
    table = pa.table({"event_id": pa.array([r[0] for r in rows], pa.int64()), "ts": pa.array([r[1] for r in rows], pa.timestamp("us")),
                      "user_id": pa.array([r[2] for r in rows], pa.int64()), "event_type": pa.array(["view"] * len(rows)),
                      "value": pa.array([1.0] * len(rows)), "props": pa.array(['{"k": 1}'] * len(rows))})
    path = os.path.join(folder, f"part-{i}.parquet")
    pq.write_table(table, path)
    os.utime(path, (1e9 + i, 1e9 + i))  # the order in which files are read


def _files(seed, n=600, files=6):
    """Events of a hot, of a missing and of some other customers, disordered by less than the delay."""
    rng = random.Random(seed)
    rows = [(i, T0 + dt.timedelta(minutes=rng.choice([0, 30, 31, 200]) + 7 * i), rng.choice([1, 1, 1, None, 2, 3, 4]) ) for i in range(n)]
    rows = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=rng.randrange(300)))
    return [rows[i * n // files:(i + 1) * n // files] for i in range(files)]


def _batch(spark, folder):
    got = sessions.session_summary(sessions.build_sessions(events_projection(spark.read.parquet(folder)), 30))
    return sorted(map(repr, got.collect()))


def _rows(df):
    return sorted(map(repr, df.collect()))


def test_numbers_equal_the_batch_form_over_a_restart(spark, tmp_dir):
    folder, out = os.path.join(tmp_dir, "events.parquet"), os.path.join(tmp_dir, "out")
    os.makedirs(folder)
    parts = _files(1)
    for i, rows in enumerate(parts[:4]):
        _write(folder, i, rows)
    run = dict(delay="1 day", out_dir=out, max_files_per_trigger=1)
    first = numbered_sessions.run_numbered_sessions(spark, tmp_dir, close=False, **run).count()
    for i, rows in enumerate(parts[4:], 4):
        _write(folder, i, rows)
    got = numbered_sessions.run_numbered_sessions(spark, tmp_dir, **run)
    want = _batch(spark, folder)
    assert _rows(got) == want and 0 < first < len(want)
    assert got.where(F.col("customer_id").isNull()).count() > 1  # sessions of no customer are numbered too


def test_repeated_events_count_once_and_late_rows_raise(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "events.parquet")
    os.makedirs(folder)
    hour = dt.timedelta(hours=1)
    _write(folder, 0, [(1, T0, 1), (2, T0 + 2 * hour, 1), (2, T0 + 2 * hour, 1)])
    out = numbered_sessions.run_numbered_sessions(spark, tmp_dir, out_dir=os.path.join(tmp_dir, "a"))
    assert [(r.derived_session_id, r.n_events) for r in out.orderBy("start_ts").collect()] == [("1-1", 1), ("1-2", 1)]
    _write(folder, 1, [(3, T0 + 30 * hour, 1)])
    _write(folder, 2, [(4, T0, 2)])
    _write(folder, 3, [(5, T0 + 31 * hour, 1)])
    with pytest.raises(sessions_stream.LateRows):
        numbered_sessions.run_numbered_sessions(spark, tmp_dir, out_dir=os.path.join(tmp_dir, "b"), max_files_per_trigger=1)
