"""Cleaning, flags, contracts and CSV scans, incl. the FIXTURES.md §5 traps."""

import os

import pytest
from pyspark.sql import functions as F

from kestrel.operators import quality
from kestrel.sources import csv as csvsrc


def test_dedupe_keeps_first_by_tiebreak_then_dropna(spark):
    df = spark.createDataFrame([(1, None, "b"), (1, "a", "z"), (2, "x", "y"), (2, "x", "y")],
                               "k long, c1 string, c2 string")
    deduped = {r.k: r for r in quality.dedupe_by_key(df, "k").collect()}
    assert deduped[1].c1 is None  # nulls sort first -> the null copy is "first"
    cleaned = quality.clean_dimension(df, "k").collect()
    assert [r.k for r in cleaned] == [2]  # key 1 vanishes although a complete copy existed


def test_transaction_flags(spark):
    tx = spark.createDataFrame([(1, 5, 1, None), (2, None, 0, "3.00"), (3, 5, None, "2.00"), (4, 5, 1, "-4.00")],
                               "transaction_id long, product_id long, refund_flag int, gross_revenue string") \
        .withColumn("gross_revenue", F.col("gross_revenue").cast("decimal(10,2)"))
    got = {r.transaction_id: (r.has_missing_product_or_revenue, r.revenue_sign_mismatch)
           for r in quality.flag_transactions(tx).collect()}
    assert got == {1: (1, 1), 2: (1, 0), 3: (0, 0), 4: (0, 0)}


def test_null_refund_fails_not_null_contract(spark):
    tx = spark.createDataFrame([(1, None)], "transaction_id long, refund_flag int")
    nn = quality.not_null_violations({"fct_transactions": (tx, ["transaction_id", "refund_flag"])})
    with pytest.raises(quality.ContractViolation, match="refund_flag"):
        quality.raise_on_violations(nn=nn)


def test_domain_contract(spark):
    ev = spark.createDataFrame([(1, "view"), (2, None), (3, "signup"), (4, "purchase")], "event_id long, event_type string")
    bad = {r.value: r.n_rows for r in quality.domain_violations(ev).collect()}
    assert bad == {None: 1, "signup": 1}
    with pytest.raises(quality.ContractViolation, match="2 row"):
        quality.raise_on_violations(domain=quality.domain_violations(ev))


def test_pk_and_fk_contracts(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (2, None), (3, 99)], "id long, product_id long")
    parent = spark.createDataFrame([(10,), (11,)], "product_id long")
    pk = quality.pk_violations({"t": (child, "id")})
    assert pk.collect()[0].duplicate_keys == 1
    fk = quality.fk_violations([("t", "product_id", child, parent, "product_id")])
    assert fk.collect()[0].violations == 1  # NULL allowed, 99 missing
    with pytest.raises(quality.ContractViolation):
        quality.raise_on_violations(pk=pk, fk=fk)


def test_orphans(spark):
    facts = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    valid = spark.createDataFrame([(1,), (3,)], "customer_id long")
    assert sorted(r[0] for r in quality.orphan_filter(facts, valid).collect()) == [1, 3]
    assert [r[0] for r in quality.orphans(facts, valid).collect()] == [2]


def test_normalize_and_fill(spark):
    ev = spark.createDataFrame([("ORGANIC", None), ("paid search", "mobile"), ("Partner", "tablet")],
                               "traffic_source string, device_type string")
    got = ev.select(quality.normalize_case("traffic_source").alias("s"),
                    quality.fill_unknown("device_type").alias("d")).collect()
    assert [tuple(r) for r in got] == [("Organic", "unknown"), ("Paid Search", "mobile"), ("Partner", "tablet")]


def _write(tmp_dir, name, text):
    path = os.path.join(tmp_dir, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_csv_na_token_kept_by_default(spark, tmp_dir):
    path = _write(tmp_dir, "customers.csv",
                  "customer_id,signup_date,country,age,gender,loyalty_tier,acquisition_channel\n"
                  "1,2023-01-05,NA,30,F,Gold,Email\n2,2023-01-06,DE,31,M,Silver,\n")
    rows = csvsrc.read_raw_csv(spark, path, "customers").orderBy("customer_id").collect()
    assert rows[0].country == "NA" and rows[1].acquisition_channel is None
    rows2 = csvsrc.read_raw_csv(spark, path, "customers", csvsrc.PANDAS_NA_TOKENS).orderBy("customer_id").collect()
    assert rows2[0].country is None


def test_csv_float_keys_and_failfast(spark, tmp_dir):
    header = ("transaction_id,timestamp,customer_id,product_id,quantity,discount_applied,gross_revenue,"
              "campaign_id,refund_flag\n")
    ok = _write(tmp_dir, "tx_ok.csv", header + "1,2024-01-01 10:00:00,5,123.0,1,0.1,9.99,0,0\n"
                                               "2,2024-01-01 11:00:00,5,,1,0.0,,0,1\n")
    rows = csvsrc.read_raw_csv(spark, ok, "transactions").orderBy("transaction_id").collect()
    assert rows[0].product_id == 123 and rows[1].product_id is None and rows[1].gross_revenue is None
    bad = _write(tmp_dir, "tx_bad.csv", header + "3,2024-01-01 10:00:00,5,abc,1,0.1,9.99,0,0\n")
    with pytest.raises(Exception):
        csvsrc.read_raw_csv(spark, bad, "transactions").collect()


@pytest.mark.parametrize("field, text, ok", [("customer_id", "5.7", False), ("quantity", "2.5", False), ("quantity", "2.000", True),
                                              ("discount_applied", "0.123456", False), ("discount_applied", "0.12340", True),
                                              ("gross_revenue", "10.129", False), ("gross_revenue", "1e2", True),
                                              ("customer_id", "1.00000000000000000001", False)])
def test_csv_numbers_are_never_cut(spark, tmp_dir, field, text, ok):
    row = {"transaction_id": "1", "timestamp": "2024-01-01 10:00:00", "customer_id": "5", "product_id": "3", "quantity": "1",
           "discount_applied": "0.1", "gross_revenue": "9.99", "campaign_id": "0", "refund_flag": "0"} | {field: text}
    path = _write(tmp_dir, f"{field}.csv", ",".join(row) + "\n" + ",".join(row.values()) + "\n")
    df = csvsrc.read_raw_csv(spark, path, "transactions")
    if ok:
        assert float(df.first()[field]) == float(text)
    else:
        with pytest.raises(Exception, match=field):
            df.collect()


def test_cluster_conf_sizing():
    from kestrel.session import cluster_conf
    conf = cluster_conf(100 * (1 << 40), total_cores=8000)  # 100 TB on 1000 x 8 cores
    assert int(conf["spark.sql.shuffle.partitions"]) == 409600  # 100 TB / 256 MB
    assert int(cluster_conf(1 << 30, total_cores=64)["spark.sql.shuffle.partitions"]) == 192  # 3 waves


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_declared_driver_schemas_match_files(spark, sf):
    from pyspark.sql import types as T

    from kestrel.sources.tables import SCHEMAS
    for name, ddl in SCHEMAS.items():
        inferred = spark.read.parquet(f"/root/testdata/{sf}/{name}.parquet").schema
        declared = T._parse_datatype_string(ddl)
        assert [(f.name, f.dataType) for f in inferred] == [(f.name, f.dataType) for f in declared], name
