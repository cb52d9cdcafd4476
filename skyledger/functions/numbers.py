"""Number, date and mask expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def holds(condition: Column) -> Column:
    """Two-valued condition: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def to_number(col: Column, kind: str = "double") -> Column:
    """Bad text -> null. Whole numbers go through double so that ``'12.0'`` reads as 12."""
    number = col.cast("string").try_cast("double")
    number = F.when(~F.isnan(number), number)
    return number if kind == "double" else number.try_cast(kind)


def to_date(col: Column) -> Column:
    return col.cast("string").try_cast("date")


def cap(value: Column, limit: Column, when: Column | None = None) -> Column:
    """``value`` brought down to ``limit``; a null on either side changes nothing."""
    over = value > limit
    return F.when(over if when is None else over & when, limit).otherwise(value)


def within(value: Column, low, high) -> Column:
    """``value``, or null when it lies outside ``[low, high]``."""
    return F.when(value.between(low, high), value)


def ratio(part: Column, whole: Column, digits: int = 4) -> Column:
    """``part / whole`` rounded half to even; 0 when unknown or ``whole`` is not positive."""
    scale = float(10**digits)
    share = F.when(whole > 0, part.cast("double") / whole.cast("double"))
    return F.coalesce(F.rint(share * scale) / scale, F.lit(0.0))
