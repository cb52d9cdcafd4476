"""Operators that keep, drop or mark rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.functions.numbers import holds
from skyledger.schemas import ROW_ID


def drop_where(df: DataFrame, condition: Column) -> DataFrame:
    """Drop the rows where ``condition`` is true; rows where it is unknown stay."""
    return df.where(~holds(condition))


def flag_where(df: DataFrame, name: str, condition: Column, yes=1, no=0) -> DataFrame:
    return df.withColumn(name, F.when(condition, yes).otherwise(no))


def copy_column(df: DataFrame, source: str, *targets: str) -> DataFrame:
    return df.withColumns({target: F.col(source) for target in targets})


def order_key(order_by: Sequence[str]) -> Column:
    """One sortable value. A single column keeps the aggregates on the hash path."""
    return F.col(order_by[0]) if len(order_by) == 1 else F.struct(*order_by)


def cut(df: DataFrame) -> DataFrame:
    """The same rows in the same partitions; steps before and after are compiled apart, so that neither method gets too large."""
    return df.coalesce(1 << 20)


def dedupe_rows(df: DataFrame, order_by: Sequence[str] = (ROW_ID,)) -> DataFrame:
    """Keep one of each group of rows that agree in all columns, nulls being equal.

    Ordering columns are not part of a row's identity; the first value is kept.
    Copies collapse on the map side, so a huge group of copies never meets in
    one task.
    """
    order_by = [c for c in order_by if c in df.columns]
    if not order_by:
        return df.distinct()
    identity = [c for c in df.columns if c not in order_by]
    # One struct as the key: far less generated code than a key of many columns.
    kept = (
        df.select(F.struct(*identity).alias("_row"), order_key(order_by).alias("_order"))
        .groupBy("_row")
        .agg(F.min("_order").alias("_order"))
    )
    order = F.col("_order").alias(order_by[0]) if len(order_by) == 1 else F.col("_order.*")
    return kept.select("_row.*", order).select(*df.columns)


def dedupe_first_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = (ROW_ID,)
) -> DataFrame:
    """One row per key (null is a key): the first in order, ties by the remaining columns."""
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    order_by = [c for c in order_by if c in df.columns]
    row = F.struct(*order_by, *rest)
    first = df.groupBy(*keys).agg(F.min(row).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


class Marks:
    """Which conditions a row met on its way through a chain of steps, as bits of one column, to be counted together."""

    column = "_marks"

    def __init__(self):
        self.names: list[str] = []

    def add(self, df: DataFrame, **conditions: Column) -> DataFrame:
        bits = F.col(self.column) if self.names else F.lit(0).cast("bigint")
        for name, condition in conditions.items():
            bits = bits.bitwiseOR(F.when(condition, F.lit(1 << len(self.names))).otherwise(0).cast("bigint"))
            self.names.append(name)
        return df.withColumn(self.column, bits)

    def counts(self) -> list[Column]:
        """Aggregates, one per condition."""
        return [
            F.count_if(F.col(self.column).bitwiseAND(F.lit(1 << i).cast("bigint")) != 0).alias(name)
            for i, name in enumerate(self.names)
        ]
