"""Rounding rules.

Two rules coexist in the analysed application (SURVEY T1): its dataframe path
rounds like numpy (``rint(x * 10^n) / 10^n``, ties to even on the scaled value),
its SQL path uses SQL ``ROUND`` (ties away from zero).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_np(x: Column, ndigits: int = 2) -> Column:
    scale = float(10 ** ndigits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def pct(numer: Column, denom: Column) -> Column:
    """numer / denom * 100 as double; NULL (not an error under ANSI) when denom is 0."""
    return F.try_divide(numer.cast("double"), denom.cast("double")) * F.lit(100.0)
