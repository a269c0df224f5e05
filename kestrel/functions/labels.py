"""Report labels: p-value text, yes/no, comparison names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

P_FLOOR = 1e-4


def _tie_broken(p: Column, decimals: int) -> Column:
    """``p``, or its neighbour of ``decimals`` places where the two roundings differ.

    The JVM rounds the shortest decimal text of a double half-up; the label needs the
    exact binary value rounded half-even. They differ only if that text ends in a 5 right
    after the last kept digit. Then p * 2^66, which is an integer for the p shown here, is
    compared with that decimal in exact DECIMAL arithmetic."""
    scale = 10 ** (decimals + 1)
    digits = F.rint(p * F.lit(float(scale))).cast("bigint")
    tie = (F.pmod(digits, F.lit(10)) == 5) & (digits.cast("double") / F.lit(float(scale)) == p)
    high = F.floor(p * F.lit(2.0 ** 40))
    low = F.floor((p * F.lit(2.0 ** 40) - high.cast("double")) * F.lit(2.0 ** 26))
    exact = (high.cast("decimal(20,0)") * F.lit(2 ** 26) + low.cast("decimal(20,0)")).cast("decimal(27,0)")
    diff = exact * F.lit(scale).cast("decimal(10,0)") - digits.cast("decimal(10,0)") * F.lit(str(2 ** 66)).cast("decimal(20,0)")
    below = F.floor(digits / 10).cast("bigint")
    down = (diff < 0) | ((diff == 0) & (F.pmod(below, F.lit(2)) == 0))
    return F.when(tie & down, below.cast("double") / F.lit(float(10 ** decimals))).otherwise(p)


def format_p(p: Column) -> Column:
    """'< 0.0001' below 1e-4, else 4 significant digits without trailing zeros
    (Python's ``f"{p:.4g}"`` for p in [1e-4, 1], ties included)."""
    exp10 = F.floor(F.log10(p))
    text = None
    for e in range(-4, 1):
        decimals = 3 - e
        branch = F.format_string(f"%.{decimals}f", _tie_broken(p, decimals))
        text = F.when(exp10 == e, branch) if text is None else text.when(exp10 == e, branch)
    text = text.otherwise(F.format_string("%.0f", p))
    stripped = F.regexp_replace(F.regexp_replace(text, r"(\.\d*?)0+$", "$1"), r"\.$", "")
    return F.when(p.isNull(), F.lit(None).cast("string")) \
            .when(p < P_FLOOR, F.lit("< 0.0001")).otherwise(stripped)


def yes_no(flag: Column) -> Column:
    return F.when(flag, F.lit("Yes")).otherwise(F.lit("No"))


def versus(a: Column, b: Column) -> Column:
    return F.concat_ws(" vs ", a, b)
