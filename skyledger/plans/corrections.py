"""Late corrections of single months: only those months' folders are written."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.operators.keys import dense_key, largest_key
from skyledger.sources.tables import scan_table, stage_overwrite
from skyledger.staging import StagingArea

MONTH = ("Anio", "Mes")


def _turn(rows: DataFrame, order: list[str], area: StagingArea) -> DataFrame:
    """Adds each row's number inside its month, from dense numbers over all months: no month is sorted in one task."""
    numbered = area.table(dense_key(rows, "_at", [*MONTH, *order], area, kind="bigint"), "numbered")
    first = numbered.groupBy(*MONTH).agg(F.min("_at").alias("_first"))
    return numbered.join(F.broadcast(first), list(MONTH)).withColumn("_turn", F.col("_at") - F.col("_first")).drop("_at", "_first")


def correct_months(
    spark: SparkSession, folder: str, table: str, rows: DataFrame, key: str, order: list[str], area: StagingArea
) -> DataFrame:
    """Put ``rows`` (without ``key``) in place of the months that they belong to; returns the table.

    The table lies in a folder per month. Rows of a corrected month take over its
    keys in their order; what is more than before gets keys after the largest, what
    is less leaves keys unused. Other months are neither read, but for their largest
    key, nor written.
    """
    stored = scan_table(spark, folder, table)
    rows = area.table(rows, "corrected")
    months = [tuple(r) for r in rows.select(*MONTH).distinct().collect()]  # a load's months are few
    if not months:
        return stored
    in_month = [(F.col(MONTH[0]) == y) & (F.col(MONTH[1]) == m) for y, m in months]
    old = _turn(stored.where(reduce(Column.__or__, in_month)).select(*MONTH, key), [key], area)
    new = _turn(rows, order, area)
    matched = area.table(new.join(old, [*MONTH, "_turn"], "left").drop("_turn"), "matched")
    added = matched.where(F.col(key).isNull()).drop(key)
    keyed = dense_key(added, key, [*MONTH, *order], area, largest_key(stored, key) + 1, "bigint")
    result = matched.where(F.col(key).isNotNull()).unionByName(keyed).select(stored.columns)
    stage_overwrite(area.table(result, "months"), folder, table, *MONTH, dynamic=True)
    return scan_table(spark, folder, table)
