"""Measures derived from the cleaned segments."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.numbers import ratio


def passenger_load(passengers: Column, seats: Column) -> Column:
    return ratio(passengers, seats)


def freight_load(freight: Column, payload: Column) -> Column:
    return ratio(freight, payload)


def runway_delay(ramp: Column, air: Column) -> Column:
    return F.coalesce(ramp - air, F.lit(0))


def season(month: Column) -> Column:
    out = F.lit(0)
    for number, months in fv.SEASON_MONTHS.items():
        out = F.when(month.isin(*months), number).otherwise(out)
    return out


def season_label(number: Column) -> Column:
    out = F.lit(None).cast("string")
    for key, label in fv.SEASON_LABELS.items():
        out = F.when(number == key, label).otherwise(out)
    return out
