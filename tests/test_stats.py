"""Column-expression statistics against Python's math library."""

import math

import pytest
from pyspark.sql import functions as F

from kestrel.functions.labels import format_p
from kestrel.functions.stats import with_chi2_survival, with_erfc_nonneg, with_normal_p, with_two_proportion_z


def test_erfc_over_the_whole_range(spark):
    df = with_erfc_nonneg(spark.range(2600).select((F.col("id") / 100.0).alias("x")), "x", "v")
    for r in df.collect():
        assert r.v == pytest.approx(math.erfc(r.x), rel=1e-12, abs=1e-300)


def test_normal_p(spark):
    zs = [1.96, 12.70096015595637, 0.0, -1.96]
    got = [r.p for r in with_normal_p(spark.createDataFrame([(z,) for z in zs], "z double"), "z", "p").collect()]
    assert got == [pytest.approx(math.erfc(abs(z) / math.sqrt(2)), rel=1e-10) for z in zs]


@pytest.mark.parametrize("dof", [1, 2, 3, 4, 5])
def test_chi2_survival(spark, dof):
    out = with_chi2_survival(spark.createDataFrame([(0.5,), (3.0,), (11.0,)], "x double"), "x", dof, "q")
    for r in out.collect():
        h = r.x / 2
        if dof % 2 == 0:
            exp = math.exp(-h) * sum(h ** i / math.factorial(i) for i in range(dof // 2))
        else:
            exp = math.erfc(math.sqrt(h)) + math.exp(-h) * sum(h ** (i - 0.5) / math.gamma(i + 0.5)
                                                               for i in range(1, (dof - 1) // 2 + 1))
        assert r.q == pytest.approx(exp, rel=1e-10)


def test_two_proportions_without_data(spark):
    rows = [(10, 5, 0, 0), (None, None, 10, 5), (10, 0, 10, 0), (0, 0, 0, 0)]
    out = with_two_proportion_z(spark.createDataFrame(rows, "na long, xa long, nb long, xb long"), "na", "xa", "nb", "xb").collect()
    assert [(r.z_stat, r.p_value) for r in out] == [(None, None), (None, None), (0.0, pytest.approx(1.0)), (None, None)]


def test_format_p_matches_python(spark):
    ps = [0.5, 0.04567, 0.123456, 1.0, 0.99996, 0.00009, 0.0001, 0.3159193114, 0.0123449]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.s for r in df.select(format_p(F.col("p")).alias("s")).collect()]
    exp = ["< 0.0001" if p < 0.0001 else f"{p:.4g}" for p in ps]
    assert got == exp


def test_format_p_at_decimal_ties(spark):
    """Five-digit values ending in 5: half of them lie below the decimal in binary, a few are exact ties."""
    ps = [n * 10 + 5 for n in range(1000, 9999, 7)]
    ps = [x / 10 ** d for x in ps for d in (5, 6, 7, 8)] + [0.03125, 0.00390625, 0.5 ** 12]
    df = spark.createDataFrame([(p,) for p in ps], "p double")
    got = [r.s for r in df.select(format_p(F.col("p")).alias("s")).collect()]
    assert got == ["< 0.0001" if p < 0.0001 else f"{p:.4g}" for p in ps]
