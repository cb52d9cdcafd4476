"""Which version of a member was valid at a point in time, without comparing every version with every point."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.operators.joins import attach
from skyledger.staging import StagingArea


def open_beginning(versions: DataFrame, keys: Sequence[str], since: str) -> DataFrame:
    """Every member's first version counts as valid from the beginning (a missing ``since``)."""
    first = F.min(since).over(Window.partitionBy(*keys))
    return versions.withColumn(since, F.when(F.col(since) > first, F.col(since)))


def as_of(
    points: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str, until: str, value: str,
    unit: str = "year",
) -> DataFrame:
    """(keys, at, value) of every different point: the last version that began by ``at``, if it had not ended.

    Versions and points of a member are put in one order and the last version is
    carried forward. A member with very many points is split by ``unit`` of time:
    what is valid at the start of each unit is found first, from its versions and
    units alone, so that no window holds more than one unit's points of a member.
    Missing keys are a member like any other; of versions that begin on the same
    day the one with the largest ``value`` counts; a point without time has none.
    """
    keys = list(keys)
    points = points.select(*keys, F.col(at).alias("_time")).distinct()
    began = versions.select(
        *keys, F.col(since).alias("_time"), F.struct(F.col(value).alias("value"), F.col(until).alias("until")).alias("_version")
    )
    none = F.lit(None).cast(began.schema["_version"].dataType)
    start = F.trunc("_time", unit)

    def carried(rows: DataFrame, *within: str) -> Column:
        order = Window.partitionBy(*keys, *within).orderBy("_time", "_kind", "_version")
        return F.last("_version", ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))

    units = points.where("_time IS NOT NULL").select(*keys, start.alias("_time")).distinct()
    at_start = units.select("*", F.lit(0).alias("_kind"), none.alias("_version")).unionByName(
        began.withColumn("_kind", F.lit(1))
    )
    at_start = at_start.withColumn("_version", carried(at_start)).where("_kind = 0")
    inside = (
        at_start.unionByName(began.withColumn("_kind", F.lit(1)))
        .unionByName(points.select("*", F.lit(2).alias("_kind"), none.alias("_version")))
        .withColumn("_unit", start)
    )
    found = inside.withColumn("_version", carried(inside, "_unit")).where("_kind = 2")
    ended = F.col("_version.until") < F.col("_time")
    valid = F.col("_time").isNotNull() & ~F.coalesce(ended, F.lit(False))
    return found.select(*keys, F.col("_time").alias(at), F.when(valid, F.col("_version.value")).alias(value))


def attach_as_of(
    df: DataFrame, versions: DataFrame, keys: Sequence[str], at: str, since: str, until: str, value: str,
    area: StagingArea, name: str = "as-of",
) -> DataFrame:
    """``value`` of the version valid at each row's ``at``; rows are joined back by their different points only."""
    found = as_of(df, versions, keys, at, since, until, value)
    return attach(df, found, [*keys, at], area, null_safe=True, name=name)
