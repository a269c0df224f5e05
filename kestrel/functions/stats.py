"""Statistical functions as pure Column expressions (no Python UDF).

Spark SQL has no ``erf``/``erfc``. We use the form
``erfc(x) = t * exp(-x^2 + P(t))`` with ``t = 1 / (1 + x/2)`` (the shape of the
published Chebyshev fit in Numerical Recipes, "erfcc"), but fit ``P`` at degree
20 by least squares against ``math.erfc`` on ``x`` in ``[0, 26]``; beyond 26 the
value underflows double anyway. Relative error is below 1e-12 everywhere, so the
tails of tiny p-values are resolved instead of rounding ``1 - cdf`` to 0.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ERFC_DEGREE = 20
ERFC_X_MAX = 26.0


@lru_cache(maxsize=None)
def erfc_coefficients(degree: int = ERFC_DEGREE) -> tuple[float, ...]:
    """Monomial coefficients (ascending powers of t) of P(t), fitted by rule."""
    xs = np.linspace(0.0, ERFC_X_MAX, 20001)
    ts = 1.0 / (1.0 + 0.5 * xs)
    gs = np.array([math.log(math.erfc(x) / t) + x * x for x, t in zip(xs, ts)])
    cheb = np.polynomial.chebyshev.Chebyshev.fit(ts, gs, degree, domain=[0, 1])
    poly = cheb.convert(kind=np.polynomial.Polynomial, domain=[0, 1], window=[0, 1])
    return tuple(float(c) for c in poly.coef)


def with_erfc_nonneg(df: DataFrame, x_col: str, out: str) -> DataFrame:
    """``out`` = erfc(x) for x >= 0, staged: ``t`` is its own column, so the
    20-term Horner polynomial refers to a column instead of repeating the
    expression for t (Catalyst does not re-inline a non-trivial column used
    more than once), which keeps generated code small."""
    t_col, acc_col = f"_{out}_t", f"_{out}_acc"
    df = df.withColumn(t_col, F.lit(1.0) / (F.lit(1.0) + F.lit(0.5) * F.col(x_col)))
    acc = F.lit(0.0)
    for a in reversed(erfc_coefficients()):
        acc = acc * F.col(t_col) + F.lit(a)
    df = df.withColumn(acc_col, acc)
    x = F.col(x_col)
    return df.withColumn(out, F.col(t_col) * F.exp(-(x * x) + F.col(acc_col))).drop(t_col, acc_col)


def with_normal_p(df: DataFrame, z_col: str, out: str) -> DataFrame:
    """``out`` = two-sided normal p-value of the column ``z_col`` (staged)."""
    x_col = f"_{out}_x"
    df = df.withColumn(x_col, F.abs(F.col(z_col)) / F.lit(math.sqrt(2.0)))
    return with_erfc_nonneg(df, x_col, out).drop(x_col)


def with_chi2_survival(df: DataFrame, x_col: str, dof: int, out: str) -> DataFrame:
    """``out`` = chi-square upper tail of the column ``x_col`` (staged)."""
    h_col = f"_{out}_h"
    df = df.withColumn(h_col, F.col(x_col) / F.lit(2.0))
    h = F.col(h_col)
    if dof % 2 == 0:
        total = F.lit(0.0)
        for i in range(dof // 2):
            total = total + F.pow(h, F.lit(float(i))) / F.lit(float(math.factorial(i)))
        return df.withColumn(out, F.exp(-h) * total).drop(h_col)
    r_col = f"_{out}_r"
    df = with_erfc_nonneg(df.withColumn(r_col, F.sqrt(h)), r_col, f"_{out}_e")
    total = F.lit(0.0)
    for i in range(1, (dof - 1) // 2 + 1):
        total = total + F.pow(h, F.lit(i - 0.5)) / F.lit(math.gamma(i + 0.5))
    return df.withColumn(out, F.col(f"_{out}_e") + F.exp(-h) * total).drop(h_col, r_col, f"_{out}_e")


def with_two_proportion_z(df: DataFrame, n_a: str, x_a: str, n_b: str, x_b: str) -> DataFrame:
    """Adds rate_a, rate_b, z_stat, p_value (pooled, two-sided), one stage per
    intermediate; z = 0 when the standard error is 0; an arm that is missing or
    has no events gives NULL rate, z and p: no test was run."""
    na, xa, nb, xb = (F.col(c).cast("double") for c in (n_a, x_a, n_b, x_b))
    df = (df.withColumn("rate_a", F.try_divide(xa, na))
            .withColumn("rate_b", F.try_divide(xb, nb))
            .withColumn("_pool", F.try_divide(xa + xb, na + nb)))
    pool = F.col("_pool")
    one = F.lit(1.0)
    df = df.withColumn("_se", F.sqrt(pool * (one - pool) * (F.try_divide(one, na) + F.try_divide(one, nb))))
    df = df.withColumn("z_stat", F.when(F.col("_se") > 0, (F.col("rate_b") - F.col("rate_a")) / F.col("_se"))
                       .when(F.col("_se") == 0, F.lit(0.0)))
    return with_normal_p(df, "z_stat", "p_value").drop("_pool", "_se")
