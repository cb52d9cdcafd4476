"""Per-key evidence tables and filling values from them.

Each ``*_by_key`` function returns one row per key. They aggregate in two
steps: first per (key, value) with counters that fit the hash aggregate and
collapse on the map side, then over those few pairs. No step gathers a key's
rows, so a key that holds a third of the data costs no more than another.
Null keys and null values are no evidence.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.operators.joins import attach
from skyledger.operators.rows import order_key
from skyledger.schemas import ROW_ID
from skyledger.staging import StagingArea

FILL = "_fill"


def _evidence(df: DataFrame, keys: Sequence[str], value: str, where: Column | None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.dropna(subset=[*keys, value])


def first_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    where: Column | None = None,
    order_by: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    """First value in row order; rows of equal order: the smallest value."""
    pairs = (
        _evidence(df, keys, value, where)
        .groupBy(*keys, value)
        .agg(F.min(order_key(order_by)).alias("_seen"))
    )
    return pairs.groupBy(*keys).agg(
        F.min_by(value, F.struct("_seen", value)).alias(FILL)
    )


def last_by_key(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    where: Column | None = None,
    order_by: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    """Last value in row order (a later entry of a lookup replaces an earlier one)."""
    pairs = (
        _evidence(df, keys, value, where)
        .groupBy(*keys, value)
        .agg(F.max(order_key(order_by)).alias("_seen"))
    )
    return pairs.groupBy(*keys).agg(
        F.max_by(value, F.struct("_seen", value)).alias(FILL)
    )


def mode_by_key(
    df: DataFrame, keys: Sequence[str], value: str, where: Column | None = None
) -> DataFrame:
    """Most frequent value; equal counts: the smallest value."""
    pairs = (
        _evidence(df, keys, value, where).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    )
    return pairs.groupBy(*keys).agg(
        F.min_by(value, F.struct(-F.col("_n"), F.col(value))).alias(FILL)
    )


def max_by_key(
    df: DataFrame, keys: Sequence[str], value: str, where: Column | None = None,
    null_keys: bool = False,
) -> DataFrame:
    if where is not None:
        df = df.where(where)
    df = df.dropna(subset=[value] if null_keys else [*keys, value])
    return df.groupBy(*keys).agg(F.max(value).alias(FILL))


def dominant_by_key(df: DataFrame, key: str, value: str, weight: str) -> DataFrame:
    """For keys with several values: the one with most rows, then most weight, then smallest."""
    pairs = (
        _evidence(df, [key], value, None)
        .groupBy(key, value)
        .agg(
            F.count("*").alias("_n"),
            F.coalesce(F.sum(F.col(weight).cast("bigint")), F.lit(0)).alias("_w"),
        )
    )
    rank = F.struct(-F.col("_n"), -F.col("_w"), F.col(value))
    return (
        pairs.groupBy(key)
        .agg(F.min_by(value, rank).alias(FILL), F.count("*").alias("_values"))
        .where("_values > 1")
        .drop("_values")
    )


def fill_missing(
    df: DataFrame, target: str, found: str, default: Column | None = None,
    usable: Column | None = None,
) -> DataFrame:
    """Where ``target`` is null or not ``usable``: column ``found``, else ``default``."""
    kept = F.col(target) if usable is None else F.when(usable, F.col(target))
    choices = [kept, F.col(found)] + ([] if default is None else [default])
    return df.withColumn(target, F.coalesce(*choices)).drop(found)


def fill_wrong(df: DataFrame, target: str, found: str, wrong: Column) -> DataFrame:
    """Where ``wrong`` holds and there is a ``found``, that; else ``target`` as it is."""
    return df.withColumn(target, F.coalesce(F.when(wrong, F.col(found)), F.col(target))).drop(found)


def join_found(
    df: DataFrame, table: DataFrame, keys: Sequence[str], area: StagingArea, **join_options
) -> DataFrame:
    """``df`` with the table's value per key in column ``FILL``."""
    return attach(df, table, keys, area, name="found", **join_options)
