"""Joining a keyed table onto the fact without moving the fact if that can be helped."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.staging import StagingArea

#: A written table is broadcast if it takes at most this many bytes in memory, as
#: estimated from its rows and the width of its columns.
BROADCAST_BYTES = 64 << 20
#: Bytes that a row takes besides its values, and that a text takes on average.
_ROW_BYTES, _TEXT_BYTES = 32, 32


def row_bytes(table: DataFrame) -> int:
    """An estimate of the memory that a row of a broadcast table takes."""
    wide = (T.StringType, T.BinaryType, T.ArrayType, T.MapType, T.StructType)
    return _ROW_BYTES + sum(8 + _TEXT_BYTES * isinstance(f.dataType, wide) for f in table.schema)


def broadcasts(table: DataFrame, rows: int, limit: int | None = None) -> bool:
    """Whether a table of so many rows is small enough to be sent to all tasks."""
    return rows * row_bytes(table) <= (BROADCAST_BYTES if limit is None else limit)


def _match(keys: Sequence[str], null_safe: bool) -> Column:
    pairs = (
        F.col(k).eqNullSafe(F.col(f"_key_{k}")) if null_safe else F.col(k) == F.col(f"_key_{k}")
        for k in keys
    )
    return reduce(Column.__and__, pairs)


def attach(
    df: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    area: StagingArea,
    *,
    null_safe: bool = False,
    rows: int | None = None,
    broadcast_bytes: int | None = None,
    name: str = "map",
) -> DataFrame:
    """Left join ``table``, which has one row per key, onto ``df``.

    The table is written first and its rows are counted (from file footers).
    Up to ``broadcast_bytes`` it is broadcast and ``df`` stays where it is; above
    that both sides are shuffled by key, where adaptive execution splits the
    partitions of hot keys. Callers that already know a written table's rows pass
    ``rows``.
    """
    if rows is None:
        table = area.table(table, name)
        rows = table.count()
    table = table.withColumnsRenamed({k: f"_key_{k}" for k in keys})
    other = F.broadcast(table) if broadcasts(table, rows, broadcast_bytes) else table.hint("merge")
    return df.join(other, _match(keys, null_safe), "left").drop(*[f"_key_{k}" for k in keys])
