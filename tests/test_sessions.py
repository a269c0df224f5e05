"""Sessionisation: hand-derived cases, boundaries, ties and cuts of a customer's history."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from kestrel.operators import sessions

DAY = dt.datetime(2023, 5, 9, 23, 0)
#: customer -> minutes after DAY of its events, in id order; sessions run over midnight
MINUTES = {8: [55, 0, 29, 300], 3: [70], 5: [10, 41, 72, 72]}


def ids(df):
    return {r.event_id: r.derived_session_id for r in df.collect()}


@pytest.fixture
def toy(spark):
    rows = [(100 * c + i, c, DAY + dt.timedelta(minutes=m)) for c, ms in MINUTES.items() for i, m in enumerate(ms)]
    return spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")


def test_sessions_by_hand(toy):
    assert ids(sessions.build_sessions(toy, 30)) == {
        801: "8-1", 802: "8-1", 800: "8-1", 803: "8-2", 300: "3-1", 500: "5-1", 501: "5-2", 502: "5-3", 503: "5-3"}
    assert set(ids(sessions.build_sessions(toy, 240)).values()) == {"8-1", "8-2", "3-1", "5-1"}


def test_summary_by_hand(toy):
    got = {r.derived_session_id: (r.start_ts, r.n_events, r.duration_minutes) for r in sessions.session_summary(sessions.build_sessions(toy, 30)).collect()}
    assert got["8-1"] == (DAY, 3, 55.0) and got["5-3"] == (DAY + dt.timedelta(minutes=72), 2, 0.0) and len(got) == 6


def test_events_without_time_or_customer(spark):
    rows = [(1, 1, None), (2, 1, DAY), (3, None, DAY), (4, None, DAY + dt.timedelta(hours=2)), (5, 1, DAY + dt.timedelta(hours=1))]
    df = spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")
    for parts in (1, 4):
        got = {r.event_id: r.session_seq for r in sessions.build_sessions(df, 30, partitions=parts).collect()}
        assert got == {1: 1, 2: 1, 5: 2, 3: 1, 4: 2}
    assert sessions.build_sessions(df.limit(0), 30).count() == 0


def test_plan_scans_events_once_and_joins_per_partition_only(spark):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("timestamp"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = sessions.build_sessions(ev, 30)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Window" in plan and "customer_id#" not in "".join(x for x in plan.splitlines() if "Window" in x)
    assert all("_pid" in x for x in plan.splitlines() if "Join" in x)


def test_exact_gap_boundary(spark):
    base = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(1, 7, base), (2, 7, base + dt.timedelta(minutes=30)),
            (3, 7, base + dt.timedelta(minutes=60, microseconds=1))]
    df = spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")
    got = ids(sessions.build_sessions(df, 30))
    assert got == {1: "7-1", 2: "7-1", 3: "7-2"}


def test_equal_timestamps_share_a_session_in_any_order(spark):
    t = dt.datetime(2024, 1, 1, 10, 0, 0)
    rows = [(2, 3, t + dt.timedelta(hours=5)), (1, 3, t + dt.timedelta(hours=5)), (0, 3, t)]
    df = spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")
    got = ids(sessions.build_sessions(df, 30))
    assert got[1] == got[2] == "3-2" and got[0] == "3-1"


@pytest.mark.parametrize("partitions", [1, 2, 7, 61])
def test_cuts_do_not_change_ids(spark, partitions):
    """A customer's history is cut wherever the range bounds fall; ids must not depend on it."""
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "event_id", F.col("user_id").alias("customer_id"), F.col("ts").alias("timestamp"))
    ref = ids(sessions.build_sessions(ev, 360))
    got = ids(sessions.build_sessions(ev.repartition(3), 360, partitions=partitions))
    assert got == ref


def test_hot_customer_cut_into_many_tasks(spark):
    """One customer with most rows, sessions crossing partition edges."""
    base = dt.datetime(2024, 1, 1)
    rows = [(i, 1, base + dt.timedelta(minutes=7 * i + (i % 5) * 11)) for i in range(600)]
    rows += [(1000 + i, 2, base + dt.timedelta(minutes=45 * i)) for i in range(40)]
    df = spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")
    got = ids(sessions.build_sessions(df, 30, partitions=9))
    # brute force in Python
    exp = {}
    for cust in (1, 2):
        evs = sorted([r for r in rows if r[1] == cust], key=lambda r: (r[2], r[0]))
        seq, prev = 0, None
        for eid, _, ts in evs:
            if prev is None or (ts - prev) > dt.timedelta(minutes=30):
                seq += 1
            exp[eid] = f"{cust}-{seq}"
            prev = ts
    assert got == exp


def test_event_gaps(toy):
    g = {r.event_id: r.gap_minutes for r in sessions.event_gaps(toy).collect()}
    assert g[801] is None and g[802] == 29.0 and g[803] == 245.0 and g[300] is None and g[503] == 0.0


def test_session_event_counts_add_up(spark):
    from kestrel.sources import star
    ev = star.fct_events(spark, "/root/testdata/sf0.01")
    for gap in (30, 360):
        summ = sessions.session_summary(sessions.build_sessions(ev, gap))
        assert summ.agg(F.sum("n_events")).collect()[0][0] == ev.count()


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_EVENTS = st.lists(st.tuples(st.integers(0, 3), st.sampled_from([0, 10, 29, 30, 31, 45, 60, 90, 200, 400, 1441])),
                   min_size=1, max_size=40)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(raw=_EVENTS, bucket=st.integers(1, 9))
def test_sessions_match_brute_force(spark, raw, bucket):
    base = dt.datetime(2024, 3, 1)
    rows, t = [], {}
    for i, (cust, step) in enumerate(raw):
        t[cust] = t.get(cust, 0) + step  # cumulative minutes per customer, steps of 0 give ties
        rows.append((i, cust, base + dt.timedelta(minutes=t[cust])))
    df = spark.createDataFrame(rows, "event_id long, customer_id long, timestamp timestamp_ntz")
    got = ids(sessions.build_sessions(df, 30, partitions=bucket))
    exp = {}
    for cust in {r[1] for r in rows}:
        seq, prev = 0, None
        for eid, _, ts in sorted([r for r in rows if r[1] == cust], key=lambda r: (r[2], r[0])):
            if prev is None or ts - prev > dt.timedelta(minutes=30):
                seq += 1
            exp[eid] = f"{cust}-{seq}"
            prev = ts
    assert got == exp


def test_workers_see_customer_and_time_only(spark, toy, monkeypatch):
    """The other columns of a linked event are not sent to Python."""
    plans, write = [], sessions.materialize
    monkeypatch.setattr(sessions, "materialize", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, label))[1])
    wide = toy.withColumn("note", F.concat(F.lit("n"), F.col("event_id").cast("string")))
    got = {r.event_id: (r.note, r.derived_session_id) for r in sessions.build_sessions(wide, 30, partitions=3).collect()}
    assert got[803] == ("n803", "8-2") and got[502] == ("n502", "5-3") and len(got) == 9
    calls = [x for x in plans[0].splitlines() if "ArrowEvalPython" in x]
    assert len(calls) == 1 and "MapInArrow" not in plans[0] and "note" not in calls[0].split("], [")[0]
