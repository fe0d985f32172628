"""Half-away-from-zero rounding of ratios of counts, done in integers.

A database rounds exact numerics half away from zero. Doubles cannot (1.005 is
stored below 1.005), so the quotient is rounded as an integer first and only
the final scaling is a floating division, which any engine does alike. Counts
up to about 4e14 fit a bigint after scaling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _rounded_quotient(scale: int, parts: Column, whole: Column) -> Column:
    """``round(scale * parts / whole)`` for counts; NULL when ``whole`` is 0."""
    base = F.nullif(whole.cast("bigint"), F.lit(0).cast("bigint"))
    return F.call_function("div", F.lit(2 * scale) * parts.cast("bigint") + base, F.lit(2) * base)


def percent(parts: Column, whole: Column) -> Column:
    """``100 * parts / whole`` to two decimals, as double."""
    return _rounded_quotient(10000, parts, whole) / F.lit(100.0)


def ratio(parts: Column, whole: Column, digits: int = 2) -> Column:
    """``parts / whole`` to ``digits`` decimals, as double."""
    factor = 10**digits
    return _rounded_quotient(factor, parts, whole) / F.lit(float(factor))
