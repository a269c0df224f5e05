"""The registered corpus queries against their SQL, and the pipeline against its parts."""

import importlib
import sys

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from helpers import shingles
from kestrel.llm.queries import ORACLE, REGISTRY

SF = "/root/testdata/sf0.001"


def norm(rows):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    cur = con.execute(ORACLE[name])
    names = [d[0] for d in cur.description]
    df = REGISTRY[name](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert norm(df.select(*names).collect()) == norm(cur.fetchall())


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in REGISTRY} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in entry.queries() and not {"pipeline"} & set(entry.oracle_sql())


def test_pipeline_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names, before = docs.columns, docs.count()
    items = [shingles(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == names
        rows = docs.collect()
        assert 0 < len(rows) <= before
        before = len(rows)
        if name == "quality_rules":
            assert all(len(r.text.split()) >= 20 for r in rows)
        docs = spark.createDataFrame(rows, docs.schema)
    sets = [shingles(r.text) for r in rows]
    assert not any(100 * len(i & s) >= 75 * len(i) for i in items if i for s in sets)
    assert not any(100 * len(a & b) >= 75 * len(a | b) for k, a in enumerate(sets) for b in sets[:k] if a)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in rows}
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).select("doc_id", "piece", "length", "ids_crc32").collect())) == \
        sorted(map(tuple, packed.select("doc_id", "piece", "length", "ids_crc32").collect()))


def test_pipeline_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_entry_without_the_corpus_part(monkeypatch):
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    importlib.invalidate_caches()
    with pytest.raises(ModuleNotFoundError):
        importlib.import_module("corpus_pipeline")
    assert "pipeline" not in entry.queries() and "funnel_overall" in entry.queries()
