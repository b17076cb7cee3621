"""Weights as whole numbers of units, so that sums are exact in any order and any partitioning.

A unit is 10 ** -exponent.  Graphs choose the exponent from their own weights (``unit_exponent``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EXPONENT = 8            # units of 1e-8 where weights don't ask for others; finer weights are rounded
DIGITS = 6              # of the least positive weight that a unit keeps at least, where sums leave room
MOST_UNITS = 2.0**62    # that a sum may reach


def weight_units(weight: Column | str, exponent: int = EXPONENT) -> Column:
    """A weight as a whole number of units (null: 0)."""
    w = F.col(weight) if isinstance(weight, str) else weight
    return F.coalesce(F.round(w.cast("double") * F.lit(10.0**exponent)).cast("bigint"), F.lit(0).cast("bigint"))


def from_units(units: Column | str, exponent: int = EXPONENT) -> Column:
    return (F.col(units) if isinstance(units, str) else units) / F.lit(10.0**exponent)


def unit_sum_limit(exponent: int) -> float:
    """What a sum of weights may reach in units of 10 ** -exponent."""
    return MOST_UNITS / 10.0**exponent


def unit_exponent(least: float | None, largest_sum: float | None) -> int:
    """The exponent for weights whose least positive one and largest sum (of those added up) are given.

    ``EXPONENT``, unless the least weight needs finer units or the sums need coarser ones.  An error if
    one unit can't serve both: the least weight would become 0, and its edge could never be drawn.
    """
    if not least or not largest_sum:
        return EXPONENT
    wanted = max(EXPONENT, DIGITS + math.ceil(-math.log10(least)))
    exponent = min(wanted, math.floor(math.log10(unit_sum_limit(0) / largest_sum)))
    if round(least * 10.0**exponent) < 1:
        raise ValueError(f"weights from {least} to sums of {largest_sum} don't fit units of one size")
    return exponent
