"""Dense, deterministic surrogate keys without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from skyledger.staging import StagingArea

_ROW_BITS = 33  # monotonically_increasing_id(): partition << 33 | row


def dense_key(
    df: DataFrame,
    name: str,
    order_by: Sequence[str],
    area: StagingArea,
    start: int = 1,
    kind: str = "int",
    spread: int | None = None,
) -> DataFrame:
    """Number the rows ``start, start + 1, ...`` in the order of ``order_by``.

    Rows are range-partitioned and sorted, and written with their partition and
    their place in it. What is left is to add, per partition, the rows of the
    partitions before it: a table of as many rows as there are partitions. Pass
    an order that tells rows apart and no partition grows with a hot key. Where the
    first ``spread`` columns tell nearly all rows apart, ranges are made of them
    alone, and the sampling of ranges need not compute the others.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    place = F.monotonically_increasing_id()
    placed = area.table(
        df.repartitionByRange(*order[:spread])
        .sortWithinPartitions(*order)
        .select(
            "*",
            F.shiftrightunsigned(place, _ROW_BITS).cast("int").alias("_part"),
            place.bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_place"),
        ),
        f"placed-{name}",
    )
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        F.col("_part").alias("_offset_part"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    key = (F.col("_before") + F.col("_place") + F.lit(start)).cast(kind)
    return (
        placed.join(F.broadcast(offsets), F.col("_part") == F.col("_offset_part"))
        .select(key.alias(name), *df.columns)
    )


def largest_key(df: DataFrame, name: str) -> int:
    """The largest key in use, 0 for an empty table."""
    return df.agg(F.max(name)).first()[0] or 0
