"""The as-of match of transactions to purchase events against a plain loop."""

import random
from datetime import datetime, timedelta

import pytest

from kestrel.operators import attribution
from kestrel.session import _MATERIALIZED

EVENTS = "event_id long, timestamp timestamp_ntz, customer_id long, product_id long, event_type string, experiment_group string"
TX = "transaction_id long, timestamp timestamp_ntz, customer_id long, product_id long, refund_flag int, gross_revenue int"
T0 = datetime(2024, 1, 1)


def slow(events, transactions, days):
    out = []
    for t, at, c, p, *_ in transactions:
        near = [(e[1], e[0], e[5]) for e in events if e[4] == "purchase" and c is not None and p is not None and at is not None and e[1] is not None
                and e[2:4] == (c, p) and timedelta(0) <= at - e[1] <= timedelta(days=days)]
        best = max(near) if near else None
        out.append((t, best and best[1], best and best[2]))
    return sorted(out)


def made(seed, n, customers):
    r = random.Random(seed)
    when = lambda: r.choice([None, *[T0 + timedelta(hours=r.randrange(24 * 60))] * 12])
    who = lambda: r.choice([None, *customers * 4])
    ev = [(i, when(), who(), r.choice([None, 1, 2, 3]), r.choice(["purchase", "view"]), r.choice(["Control", "Variant_A", "other"])) for i in range(n)]
    tx = [(i, when(), who(), r.choice([None, 1, 2, 3]), r.choice([0, 0, 1]), r.choice([None, 5, 7])) for i in range(n)]
    return ev, tx


@pytest.mark.parametrize("partitions", [1, 3, 40])
def test_match_equals_a_loop_wherever_partitions_are_cut(spark, partitions):
    ev, tx = made(partitions, 250, [1, 2, 3, 4])
    got = attribution.attribute_transactions(spark.createDataFrame(ev, EVENTS), spark.createDataFrame(tx, TX), 7, partitions)
    assert sorted((r.transaction_id, r.event_id, r.experiment_group) for r in got.collect()) == slow(ev, tx, 7)


def test_hot_customer_is_split_over_tasks(spark):
    """One customer and product hold nearly all rows, one purchase lies far before: it is carried over many partitions."""
    ev = [(0, T0, 1, 1, "purchase", "Control")] + [(i, T0 + timedelta(days=90), 2, 2, "purchase", "Variant_A") for i in range(1, 20)]
    tx = [(i, T0 + timedelta(seconds=i), 1, 1, 0, 1) for i in range(3000)]
    got = attribution.attribute_transactions(spark.createDataFrame(ev, EVENTS), spark.createDataFrame(tx, TX), 30, 16)
    assert got.where("event_id = 0").count() == 3000
    staged = spark.read.parquet([p for p in _MATERIALIZED if "attribution" in p][-1])
    sizes = [r["count"] for r in staged.groupBy("_pid").count().collect()]
    assert len(sizes) > 8 and max(sizes) < 0.3 * sum(sizes)


def test_revenue_by_arm(spark):
    ev = [(1, T0, 1, 1, "purchase", "Control"), (2, T0, 1, 1, "view", "Control"), (3, T0, 2, 1, "purchase", "Variant_A")]
    tx = [(1, T0 + timedelta(days=1), 1, 1, 0, 10), (2, T0 + timedelta(days=40), 1, 1, 0, 99), (3, T0, 2, 1, 0, 15), (4, T0, 2, 1, 1, 7), (5, T0, 2, 1, 0, None)]
    got = attribution.revenue_per_event(spark.createDataFrame(ev, EVENTS), spark.createDataFrame(tx, TX))
    rows = {r.experiment_group: r for r in got.collect()}
    assert rows["Control"].revenue == 10 and rows["Control"].revenue_per_event == 5 and rows["Control"].matched_transactions == 1
    assert rows["Variant_A"].revenue == 15 and rows["Variant_A"].matched_transactions == 3 and rows["Variant_A"].lift_pct == 200
    assert rows["Variant_B"].total_events == 0 and rows["Variant_B"].revenue_per_event is None
    empty = attribution.revenue_per_event(spark.createDataFrame([], EVENTS), spark.createDataFrame([], TX)).collect()
    assert len(empty) == 3 and all(r.revenue == 0 for r in empty)
