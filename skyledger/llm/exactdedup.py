"""Exact duplicates, with the frequent ones taken out of the shuffle.

A first pass over the digests keeps Misra-Gries counters in every task. Their
merged counters name at most ``counters`` candidates; an exact count confirms
them, and the confirmed table, whose size is bounded by that parameter, is
broadcast. Rows of frequent digests are decided where they lie; the rest is
grouped and joined by digest in the ordinary way.

Defined results: a missing text equals an empty one. Of equal texts the row with
the smallest doc_id stays, a missing doc_id comes last, and of repeated rows
exactly one stays. An empty table gives an empty result. Other columns of the
input are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import doc_order, row_place, whole_text
from skyledger.staging import StagingArea

#: Misra-Gries counters per task, and the most rows the broadcast table can have.
COUNTERS = 1024
#: One space, or a run of white space that is not already a single space.
_UNEVEN_SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, SHA-256 of the text with every run of white space made one space, and a place."""
    even = F.regexp_replace(whole_text(), _UNEVEN_SPACE, " ")
    return docs.select("doc_id", F.unhex(F.sha2(even.cast("binary"), 256)).alias("digest"), row_place().alias("place"))


def _count_frequent(counters: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, int] = {}
        for batch in batches:
            found = batch.column(0).value_counts()
            for digest, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                held[digest] = held.get(digest, 0) + n
            if len(held) > counters:
                counts = np.fromiter(held.values(), np.int64, len(held))
                cut = int(np.partition(counts, -counters - 1)[-counters - 1])
                held = {d: n - cut for d, n in held.items() if n > cut}
        yield pa.RecordBatch.from_arrays(
            [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], ["digest", "low"]
        )

    return run


def frequent_digests(rows: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests: every one above 2 / (counters + 1) of all rows is among them.

    A counter misses at most 1 / (counters + 1) of the rows its task has seen.
    """
    return (
        rows.select("digest")
        .mapInArrow(_count_frequent(counters), "digest binary, low long")
        .groupBy("digest")
        .agg(F.sum("low").alias("low"))
        .orderBy(F.desc("low"), "digest")
        .limit(counters)
        .select("digest")
    )


def exact_dedup(docs: DataFrame, area: StagingArea, counters: int = COUNTERS) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = area.table(digests(docs), "digests")
    candidates = area.table(frequent_digests(rows, counters).coalesce(1), "candidates")
    group = (F.count("*").alias("group_size"), F.min(doc_order("doc_id", "place")).alias("keep"))
    winners = area.table(
        rows.join(F.broadcast(candidates), "digest")
        .groupBy("digest").agg(*group).where("group_size > 1").coalesce(1),
        "winners",
    )
    hot = rows.join(F.broadcast(winners), "digest")
    rest = rows.join(F.broadcast(winners), "digest", "left_anti")
    decided = rest.join(rest.groupBy("digest").agg(*group), "digest")
    return hot.unionByName(decided).select(
        "doc_id",
        F.col("keep.id").alias("keep_id"),
        "group_size",
        (F.col("place") == F.col("keep.tie0")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
