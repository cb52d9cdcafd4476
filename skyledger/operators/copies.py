"""Copies among wide rows, removed without sending the rows anywhere.

The rows are written once, each with its place, as compressed columns. What is
shuffled is two hashes of a row, 128 bits together, its order and its place. Of each group
the first row's place is kept, as one bit in an array of words per 4 096 places; the
written rows are then read again and those with their bit set are the result. The
words of all rows take about a bit and a seventh a row, so that they can be sent to
all tasks; beyond ``joins.BROADCAST_BYTES`` rows and words are shuffled by place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.operators import joins
from skyledger.operators.rows import cut, order_key
from skyledger.schemas import ROW_ID
from skyledger.staging import StagingArea

_WORD, _WORDS = 6, 6  # a word holds 2^6 places, a chunk 2^6 words
_CHUNK_BYTES = (8 << _WORDS) + 64


def row_hashes(columns: Sequence[str]) -> dict[str, Column]:
    """Two hashes of the columns, 128 bits together; null is a value of its own."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    return {"_h1": F.xxhash64(*values), "_h2": F.xxhash64(F.lit("second"), *values)}


def _one_zero(column: T.StructField) -> Column:
    """As the value of a grouping key: negative zero is zero."""
    floating = isinstance(column.dataType, (T.FloatType, T.DoubleType))
    return F.when(F.col(column.name) == 0, F.lit(0).cast(column.dataType)).otherwise(F.col(column.name)).alias(column.name) if floating else F.col(column.name)


def _firsts(placed: DataFrame, identity: Sequence[str], order: Column) -> DataFrame:
    """_place of the first of all rows that agree in ``identity``; a row without order comes last."""
    hashed = placed.select(order.alias("_order"), "_place", *[h.alias(n) for n, h in row_hashes(identity).items()])
    # Rows of one group and one order agree in everything, so it does not matter whose place it is.
    place = F.coalesce(F.min_by("_place", "_order"), F.min("_place"))
    return hashed.groupBy("_h1", "_h2").agg(place.alias("_place"))


def _words(places: DataFrame) -> DataFrame:
    """(_chunk, _words): which places of a chunk are among ``places``."""
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_place").bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int"))
    words = places.groupBy(F.shiftright("_place", _WORD).alias("_word")).agg(F.bit_or(bit).alias("_bits"))
    number = F.col("_word").bitwiseAND(F.lit((1 << _WORDS) - 1)).cast("int")
    found = words.groupBy(F.shiftright("_word", _WORDS).alias("_chunk")).agg(
        F.map_from_entries(F.collect_list(F.struct(number, "_bits"))).alias("_found")
    )
    every = F.sequence(F.lit(0), F.lit((1 << _WORDS) - 1))
    return found.select("_chunk", F.transform(every, lambda i: F.coalesce(F.element_at("_found", i), F.lit(0).cast("bigint"))).alias("_words"))


def without_copies(df: DataFrame, area: StagingArea, order_by: Sequence[str] = (ROW_ID,), aside: Sequence[str] = ()) -> DataFrame:
    """``dedupe_rows`` for wide rows: the same rows, from a written table.

    Columns ``aside`` are neither compared nor returned.
    """
    return Copies(df, area, order_by, aside).kept()


class Copies:
    """Written rows and, once they are asked for, the places of those that are no copies."""

    def __init__(self, df: DataFrame, area: StagingArea, order_by: Sequence[str] = (ROW_ID,), aside: Sequence[str] = ()):
        self.columns = [c for c in df.columns if c not in aside]
        self.order_by = [c for c in order_by if c in self.columns]
        self.area = area
        # As one struct a wide row takes far less generated code; see ``dedupe_rows``.
        rows = cut(df.select(F.struct(*df.columns).alias("_row"))).select("_row.*", F.monotonically_increasing_id().alias("_place"))
        self.rows = area.table(rows, "placed-rows")

    def kept(self) -> DataFrame:
        identity = [c for c in self.columns if c not in self.order_by]
        order = order_key(self.order_by) if self.order_by else F.lit(0)
        words = self.area.table(_words(_firsts(self.rows, identity, order)), "first-rows")
        small = words.count() * _CHUNK_BYTES <= joins.BROADCAST_BYTES
        place = F.col("_place")
        chunk = F.shiftright(place, _WORD + _WORDS)
        word = F.get("_words", F.shiftright(place, _WORD).bitwiseAND(F.lit((1 << _WORDS) - 1)).cast("int"))
        own = F.call_function("shiftright", word, place.bitwiseAND(F.lit((1 << _WORD) - 1)).cast("int"))
        found = self.rows.join(F.broadcast(words) if small else words.hint("merge"), chunk == F.col("_chunk"))
        return found.where(own.bitwiseAND(F.lit(1).cast("bigint")) == 1).select(*[_one_zero(self.rows.schema[c]) for c in self.columns])
