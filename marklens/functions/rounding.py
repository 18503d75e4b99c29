"""Rounding half up, fast."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Nearer to a tie than this, the double alone does not tell which way it goes.
_DOUBT = 1e-6
# Beyond this, divided by the unit, a double has too few decimals left for the test.
_LARGE = 1e8


def round_half_up(column: Column, digits: int) -> Column:
    """What ``F.round`` gives on a double, in a quarter of the time.

    ``F.round`` makes a decimal number of every value. That is needed only near a
    tie; elsewhere the nearest whole number of hundredths, divided by 100, is the
    same double.
    """
    unit = 10**digits
    shifted = column * unit + 0.5
    whole = F.floor(shifted)
    is_clear = (F.abs(column) < _LARGE / unit) & (shifted - whole).between(_DOUBT, 1 - _DOUBT)
    return F.when(is_clear, whole / unit).otherwise(F.round(column, digits))
