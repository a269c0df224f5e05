"""Load pipeline, marts and the driver contract on sf0.001."""

import os
import threading

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as entry
from kestrel import config, session
from kestrel.operators import quality
from kestrel.plans import pipeline, reports, warehouse
from kestrel.plans.oracle import Q as ORACLE
from kestrel.plans.registry import REGISTRY
from kestrel.sources import csv, marts, schemas
from kestrel.sources.tables import DRIVER_TABLES

SF = "/root/testdata/sf0.001"


def test_entry_returns_rows(spark):
    df = entry.entry(spark)
    assert df.count() == 4
    assert df.columns == ["step_idx", "step_name", "customers_reached", "pct_of_customers",
                          "step_over_step_pct", "drop_off_pct"]


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(REGISTRY) and set(REGISTRY) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_load_then_read_back(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh")
    before = len(session._MATERIALIZED)
    paths = pipeline.run(spark, SF, wh)
    assert len(session._MATERIALIZED) == before  # intermediate tables are deleted
    ev = pipeline.read_warehouse(spark, wh, "fct_events")
    audit = {(r.table_name, r.metric): r.value for r in pipeline.load_audit(spark, SF).collect()}
    assert ev.count() == audit[("fct_events", "rows_out")]
    assert set(paths) == {"dim_customers", "dim_products", "dim_campaigns", "fct_transactions", "fct_events"}
    assert ev.filter("device_type IS NULL").count() == 0
    assert ev.filter("traffic_source = 'ORGANIC'").count() == 0
    assert sorted(os.listdir(wh)) == ["data", "manifests"]


def test_csv_load_equals_table_load_and_can_be_repeated(spark, tmp_dir):
    folder, a, b = (os.path.join(tmp_dir, x) for x in ("csv", "a", "b"))
    csv.write_raw_csv(pipeline.raw_tables(spark, SF), folder)
    pipeline.run(spark, SF, a)
    for _ in range(2):
        pipeline.run(spark, folder, b, from_csv=True)
    for t in schemas.LOAD_ORDER:
        assert sorted(map(str, pipeline.read_warehouse(spark, a, t).collect())) == sorted(map(str, pipeline.read_warehouse(spark, b, t).collect()))


def test_hot_customer_is_cut_inside_the_load(spark):
    """The semi join with the customers leaves no partitioning that sessions would reuse."""
    raw = pipeline.raw_tables(spark, SF)
    raw["fct_events"] = raw["fct_events"].withColumn("customer_id", F.when(F.col("event_id") % 2 == 0, F.lit(1)).otherwise(F.col("customer_id")))
    ev = pipeline.clean_tables(spark, raw)["fct_events"]
    linked = spark.read.parquet([p for p in session._MATERIALIZED if "linked-events" in p][-1])
    sizes = [r["count"] for r in linked.groupBy("_pid").count().collect()]
    assert max(sizes) < 0.45 * sum(sizes)  # half of all rows, over more than one task
    assert ev.filter("customer_id = 1").select("derived_session_id").distinct().count() > 1


def test_domain_violation_fails_before_any_write(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh2")
    with pytest.raises(quality.ContractViolation, match="domain"):
        pipeline.run(spark, SF, wh, config.Profile(valid_event_types=("view",)))
    assert not os.path.exists(wh)


def test_failed_refresh_leaves_the_old_warehouse(spark, tmp_dir):
    wh = os.path.join(tmp_dir, "wh_pk")
    pipeline.run(spark, SF, wh)
    old = pipeline.read_warehouse(spark, wh, "dim_products").count()
    tables = pipeline.clean_tables(spark, pipeline.raw_tables(spark, SF))
    broken = tables | {"dim_products": tables["dim_products"].unionByName(tables["dim_products"].limit(1))}
    with pytest.raises(quality.ContractViolation, match="primary key broken on dim_products: 1"):
        pipeline.load_to_warehouse(spark, broken, wh)
    broken = tables | {"fct_events": tables["fct_events"].withColumn(
        "product_id", F.when(F.col("event_id") == 1, F.lit(10 ** 9)).otherwise(F.col("product_id")))}
    with pytest.raises(quality.ContractViolation, match="foreign key broken on fct_events.product_id: 1"):
        pipeline.load_to_warehouse(spark, broken, wh)
    assert warehouse.versions(spark, wh) == [1] and pipeline.read_warehouse(spark, wh, "dim_products").count() == old
    loads = {f.split("load=")[1].split("/")[0] for d, _, fs in os.walk(wh) for f in (d,) if "load=" in d}
    assert len(loads) == 1  # what the failed loads wrote is deleted


def test_marts_roundtrip_and_fallback(spark, tmp_dir):
    wh, out = os.path.join(tmp_dir, "wh"), os.path.join(tmp_dir, "marts")
    pipeline.run(spark, SF, wh)
    built = reports.build_marts(pipeline.read_warehouse_tables(spark, wh))
    marts.write_marts(built, out)
    snap = marts.read_marts(spark, out, live=None, warehouse_dir=None)
    assert set(snap) == set(marts.MART_SCHEMAS)
    assert snap["funnel_overall"].count() == 4
    assert snap["summary_stats"].select("mode").collect()[0][0] == "snapshot"
    live = marts.read_marts(spark, out, live=lambda: built, warehouse_dir=f"file://{wh}")
    assert live["ab_test_totals"].select("mode").distinct().collect()[0][0] == "live"
    never = marts.read_marts(spark, f"file://{out}", live=lambda: 1 / 0, warehouse_dir=f"file://{tmp_dir}/none")
    assert never["ab_test_totals"].select("mode").distinct().collect()[0][0] == "snapshot"
    with pytest.raises(FileNotFoundError):
        marts.read_marts(spark, f"file://{tmp_dir}/nothing")


def test_no_shared_folder_is_an_error_on_a_cluster(monkeypatch):
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)
        getConf = staticmethod(lambda: {})

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def _canon(rows):
    def norm(v):
        if isinstance(v, float):
            return float(f"{v:.9g}")
        if hasattr(v, "is_finite"):
            return float(f"{float(v):.9g}")
        return v
    return sorted((tuple(norm(x) for x in r) for r in rows), key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_matches_oracle_sf0001(spark, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = entry.queries()[name](spark, SF)
    cols = df.columns
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(ocols)
    orows = cur.fetchall()
    order = [ocols.index(c) for c in cols]
    assert _canon([tuple(r) for r in df.collect()]) == _canon([tuple(r[i] for i in order) for r in orows])


STREAMING = {"stream_sessions", "stream_session_numbers", "stream_group_totals"}


@pytest.mark.parametrize("name", sorted(set(REGISTRY) - STREAMING))
def test_plan_has_no_cross_join_or_python(spark, name):
    """Scale guard: no cartesian product / nested-loop join, no Python UDF in any plan (sorted partitions are
    linked and draws are summed in Arrow batches, both before the plan that is seen here or as MapInArrow)."""
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in plan, f"{name}: {bad}"


def test_cli_query_and_funnel(spark, capsys):
    from kestrel.__main__ import run
    assert run(["query", "bounce_rate", "--sf", SF], spark) == 0
    assert run(["funnel", "--sf", SF], spark) == 0
    out = capsys.readouterr().out
    assert "bounce_rate_pct" in out and "step_over_step_pct" in out
    assert out.count("\n") > 20  # every channel and step, not a first part


def test_cli_prints_everything_unless_asked(spark, capsys, tmp_dir):
    from kestrel.__main__ import run
    run(["query", "fill_unknown", "--sf", SF], spark)
    assert capsys.readouterr().out.count("\n") == 1002
    run(["query", "fill_unknown", "--sf", SF, "--rows", "3"], spark)
    assert capsys.readouterr().out.count("\n") == 5


def test_plain_numbers_equal_checked_ones(spark):
    """One parse for plain spellings gives what the full check gives; other spellings still meet the check."""
    texts = ["0", "-7", "+7", " 5 ", "007", "123.0", "1e3", "12.5", "12.50", "-0.1", ".5", "5.", "1.500000", "2E1", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string").coalesce(1)
    for target, fits in (("bigint", lambda t: t is None or "." not in t or t in ("123.0", "5.")), ("int", lambda t: t is None or "." not in t or t in ("123.0", "5.")),
                         ("decimal(10,2)", lambda t: True), ("decimal(6,4)", lambda t: t not in ("1e3", "123.0"))):
        kind = T._parse_datatype_string(target)
        rows = df.where(F.col("v").isNull() | F.col("v").isin([t for t in texts if t and fits(t)]))
        got = rows.select(csv._exact_number(F.col("v"), "v", kind).alias("a"), csv._checked_number(F.col("v"), "v", kind).alias("b"))
        assert got.count() > 8 and all(r.a == r.b for r in got.collect()) and got.schema["a"].dataType == kind
    for bad, target in (("1.9", "int"), ("1.234", "decimal(10,2)"), ("x", "bigint"), ("99999999999", "int"), ("1e-3", "decimal(10,2)"), ("0.0000000000000000001", "decimal(10,2)")):
        with pytest.raises(Exception):
            spark.createDataFrame([(bad,)], "v string").select(csv._exact_number(F.col("v"), "v", T._parse_datatype_string(target))).collect()


def test_number_checks_stay_out_of_the_compiled_loop(spark):
    text = spark.createDataFrame([("1",)], "v string")
    plan = text.select(csv._exact_number(F.col("v"), "v", T.LongType()))._jdf.queryExecution().optimizedPlan().toString()
    assert "try_cast" in plan.lower() and plan.index("transform(") < plan.index("RLIKE")


def test_independent_steps_run_at_once(spark):
    """Both steps must have begun before either ends; a failed step raises after all have ended."""
    both, ended = threading.Barrier(2, timeout=30), []

    def step(fail):
        both.wait()
        if fail:
            raise ValueError("broken")
        ended.append(spark.range(3).count())
        return ended[0]

    with pytest.raises(ValueError, match="broken"):
        session.at_once(spark, {"a": lambda: step(True), "b": lambda: step(False)})
    assert ended == [3] and session.at_once(spark, {}) == {}
    assert session.at_once(spark, {"a": lambda: step(False), "b": lambda: step(False)}) == {"a": 3, "b": 3}
