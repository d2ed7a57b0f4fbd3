"""Rounding and sums that give the same digits whatever the partitioning.

Floating sums depend on the order in which tasks finish. Model values and distances have a fixed number of
digits, so they are summed as integers in that unit and divided once at the end.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SNAP_DIGITS = 8
# Up to here a value in units of the last snapped digit is a bigint; from WHOLE on a double has no decimals to round.
MOST = 9e10
WHOLE = 1e15


def _wide(value: Column, digits: int) -> Column:
    """Rounding of a large value >= 0 as a decimal, which holds all of its digits."""
    exact = F.round(F.least(value, F.lit(WHOLE)).cast("decimal(38,8)"), digits).cast("double")
    return F.when(value >= WHOLE, value).otherwise(exact)


def _snap(value: Column, digits: int) -> Column:
    units = F.floor(value * F.lit(10.0**SNAP_DIGITS) + F.lit(0.5))
    if digits == SNAP_DIGITS:
        return units
    step = 10 ** (SNAP_DIGITS - digits)
    return F.call_function("div", units + F.lit(step // 2), F.lit(step))


def round_pos(value: Column, digits: int) -> Column:
    """Round a value known to be >= 0 half up, after snapping to eight digits like a decimal cast."""
    value = value.cast("double")
    small = _snap(value, digits) / F.lit(float(10**digits))
    return F.when(value > MOST, _wide(value, digits)).otherwise(small)


def round_any(value: Column, digits: int) -> Column:
    """Round half away from zero."""
    value = value.cast("double")
    units = _snap(F.abs(value), digits)
    small = F.when(value < 0, -units).otherwise(units) / F.lit(float(10**digits))
    wide = F.signum(value) * _wide(F.abs(value), digits)
    return F.when(F.abs(value) > MOST, wide).otherwise(small)


def to_units(value: Column, digits: int) -> Column:
    """A value that has at most ``digits`` decimals, as a whole number of its last digit."""
    return F.floor(value * F.lit(float(10**digits)) + F.lit(0.5))


def exact_sum(value: Column, digits: int) -> Column:
    """Order-independent sum of a column with at most ``digits`` decimals (nulls are skipped).

    The sum of the units is a bigint: at six digits it holds totals up to 9 * 10^12.
    """
    return F.sum(to_units(value, digits)) / F.lit(float(10**digits))


def exact_avg(value: Column, digits: int) -> Column:
    """Order-independent mean; null for a group without values."""
    return F.try_divide(exact_sum(value, digits), F.count(value).cast("double"))


def count_where(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` with null for a zero divisor."""
    return F.try_divide(top.cast("double"), F.nullif(bottom, F.lit(0)).cast("double"))
