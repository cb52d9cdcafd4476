"""What the operators of this folder share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.staging import StagingArea

#: The six ASCII characters that separate words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"
#: Rows of whole texts that one Arrow batch should hold at most, in bytes.
BATCH_BYTES = 16 << 20
#: Of the C library, where it has one: gives unused memory back.
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def area(spark: SparkSession) -> StagingArea:
    """A folder for written tables below the one named in ``spark.checkpoint.dir``."""
    return StagingArea(spark)


def whole_text(column: Column | str = "text") -> Column:
    """The text itself; a missing text counts as an empty one."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def doc_order(doc_id: str = "doc_id", *ties: str) -> Column:
    """Something to compare documents by: ``doc_id``, missing ids last, then ``ties``."""
    return F.struct(
        F.col(doc_id).isNull().alias("no_id"),
        F.col(doc_id).alias("id"),
        *[F.col(t).alias(f"tie{i}") for i, t in enumerate(ties)],
    )


def row_place() -> Column:
    """Tells repeated rows apart; write it to a table before it is used twice."""
    return F.monotonically_increasing_id()


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of every text, missing ones as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [b if b is not None else b"" for b in column.cast(pa.binary()).to_pylist()]


def sliced(
    batches: Iterator[pa.RecordBatch], column: str, most: int = BATCH_BYTES
) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes of ``column``.

    Spark keeps Python workers for later tasks, so memory that is free at the end goes back to the system.
    """
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = held = 0
        for i, size in enumerate(sizes):
            held += size
            if held >= most or i == n - 1:
                yield batch.slice(start, i + 1 - start)
                start, held = i + 1, 0
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)
