"""Near duplicates by SimHash, found with anchor points of a covering code.

Two fingerprints of 64 bits that differ in at most 4 bits differ in at most 2
bits in one of their halves. A half is a point of the 32-bit cube, and the
anchors are the words of a code that covers the cube with radius 2: two blocks,
each the perfect Hamming code of length 15 and one free bit. Two halves with
distance 2 have a point between them at distance 1 from both, and that point's
anchor is within 2 of it. So every half that is sent to all anchors within
radius 2 + 1 meets its partners at one of them: 21.4 anchors on average, from a
fixed table of 5 489 error patterns that is joined on the half's syndrome.

At an anchor, fingerprints are compared and only a spanning forest of the links
is emitted, so a dense group yields as many rows as it has members, not pairs.

Defined results: a missing text equals an empty one; texts without words have
fingerprint 0 and link like any other. Rows that share a doc_id count as one
node if their fingerprints agree. If all doc_ids of a component are missing its
id is missing. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from skyledger.llm.common import doc_order, sliced, texts_of
from skyledger.llm.components import components
from skyledger.staging import StagingArea

SHINGLE_WORDS = 4
HASH_SEED = 42
#: Fingerprints link at this many differing bits or fewer; the anchors are laid out for it.
MOST_BITS = 4
_RADIUS = 3
_hash = partial(xxhash.xxh64_intdigest, seed=HASH_SEED)


def fingerprint(text: bytes) -> int:
    """SimHash over shingles of ASCII-lower-cased words, repeats included."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        return _hash(b" ".join(words))
    shingles = zip(*(words[i:] for i in range(SHINGLE_WORDS)))
    n = len(words) - SHINGLE_WORDS + 1
    hashes = np.fromiter(map(_hash, map(b" ".join, shingles)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for start in range(0, n, 1 << 16):
        octets = hashes[start:start + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches, "text"):
        marks = np.fromiter(map(fingerprint, texts_of(batch.column("text"))), np.uint64, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id").cast(pa.int64()), pa.array(marks.view(np.int64))], ["doc_id", "mark"]
        )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and the fingerprint ``mark`` as a signed long, for every row."""
    return docs.select("doc_id", "text").mapInArrow(_fingerprints, "doc_id long, mark long")


def _block_syndrome(word: int) -> int:
    """Of the 15 upper bits of a 16-bit block under the Hamming code; bit 0 is free."""
    syndrome = 0
    for place in range(1, 16):
        if word >> place & 1:
            syndrome ^= place
    return syndrome


def error_patterns() -> list[tuple[int, int]]:
    """(syndrome, pattern) of every 32-bit pattern of weight up to the radius."""
    found = []
    for weight in range(_RADIUS + 1):
        for places in combinations(range(32), weight):
            pattern = sum(1 << p for p in places)
            found.append((_block_syndrome(pattern & 0xFFFF) << 4 | _block_syndrome(pattern >> 16), pattern))
    return found


def _syndrome(half: Column) -> Column:
    """The two blocks' syndromes as one number of 8 bits."""
    total = F.lit(0)
    for block, shift in ((0, 4), (1, 0)):
        for bit in range(4):
            places = sum(1 << p for p in range(1, 16) if p >> bit & 1) << 16 * block
            parity = F.bit_count(half.bitwiseAND(F.lit(places))) % 2
            total = total + F.shiftleft(parity.cast("int"), shift + bit)
    return total


def at_anchors(spark: SparkSession, marks: DataFrame) -> DataFrame:
    """(anchor, mark): every mark once for each anchor near one of its halves."""
    patterns = spark.createDataFrame(error_patterns(), "syndrome int, pattern long")
    lower = F.col("mark").bitwiseAND(F.lit(0xFFFFFFFF))
    upper = F.shiftrightunsigned("mark", 32)
    halves = marks.select(
        "mark", F.explode(F.array(F.struct(F.lit(0).alias("part"), lower.alias("half")),
                                  F.struct(F.lit(1).alias("part"), upper.alias("half")))).alias("h"),
    ).select("mark", "h.part", "h.half", _syndrome(F.col("h.half")).alias("syndrome"))
    return halves.join(F.broadcast(patterns), "syndrome").select(
        (F.shiftleft(F.col("half").bitwiseXOR(F.col("pattern")), 1) + F.col("part")).alias("anchor"), "mark"
    )


def _forest(marks: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Spanning forest of the links among distinct marks: every mark is reached at most once."""
    waiting, found = marks, []
    while len(waiting) > 1:
        frontier, waiting = [waiting[:1]], waiting[1:]
        while frontier and len(waiting):
            for mark in frontier.pop():
                near = np.bitwise_count(waiting ^ mark) <= MOST_BITS
                if near.any():
                    reached, waiting = waiting[near], waiting[~near]
                    found.append((np.full(len(reached), mark), reached))
                    frontier.append(reached)
    return found


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links among the marks of each anchor; rows arrive sorted by anchor."""
    many = 48

    def links(anchor: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
        start = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
        size = np.diff(np.r_[start, len(anchor)])
        found = []
        for at, n in zip(start[size > many], size[size > many]):
            found += _forest(np.unique(mark[at:at + n]))
        small = np.repeat(size <= many, size)
        anchor, mark = anchor[small], mark[small]
        for step in range(1, min(many, size[size <= many].max(initial=0))):
            same = anchor[step:] == anchor[:-step]
            a, b = mark[step:][same], mark[:-step][same]
            near = (np.bitwise_count(a ^ b) <= MOST_BITS) & (a != b)
            found.append((a[near], b[near]))
        a = np.concatenate([f[0] for f in found]) if found else mark[:0]
        b = np.concatenate([f[1] for f in found]) if found else mark[:0]
        pairs = np.unique(np.stack([a, b], 1), axis=0) if len(a) else np.empty((0, 2), np.uint64)
        columns = [pa.array(np.ascontiguousarray(pairs[:, i]).view(np.int64)) for i in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, ["a", "b"])

    anchors, marks = [], []
    for batch in batches:
        anchor = batch.column("anchor").to_numpy(zero_copy_only=False)
        if not len(anchor):
            continue
        mark = batch.column("mark").to_numpy(zero_copy_only=False).view(np.uint64)
        cut = int(np.searchsorted(anchor, anchor[-1]))  # the last anchor may go on in the next batch
        if cut:
            yield links(np.concatenate([*anchors, anchor[:cut]]), np.concatenate([*marks, mark[:cut]]))
            anchors, marks = [], []
        elif anchors and anchors[-1][-1] != anchor[0]:
            yield links(np.concatenate(anchors), np.concatenate(marks))
            anchors, marks = [], []
        anchors.append(anchor[cut:])
        marks.append(mark[cut:])
    if anchors:
        yield links(np.concatenate(anchors), np.concatenate(marks))


def links(spark: SparkSession, marks: DataFrame) -> DataFrame:
    """(a, b): links between distinct ``mark`` values that connect all that are connected."""
    return (
        at_anchors(spark, marks)
        .repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(_links, "a long, b long")
    )


def components_of(rows: DataFrame, area: StagingArea) -> DataFrame:
    """Adds component_id to written rows (doc_id, mark, ...)."""
    nodes = area.table(rows.groupBy("mark").agg(F.min("doc_id").alias("least")), "marks")
    roots = area.table(components(links(area.spark, nodes.select("mark")), area), "roots")
    ids = (
        nodes.join(roots, F.col("mark") == F.col("node"), "left")
        .withColumn("root", F.coalesce("root", "mark"))
        .select("root", "least", F.col("mark").alias("_mark"))
    )
    least = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    named = ids.join(least, "root").select("_mark", "component_id", "root")
    return rows.join(named, F.col("mark") == F.col("_mark")).drop("_mark")


def near_duplicates(docs: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, fingerprint, component_id."""
    rows = area.table(fingerprints(docs), "fingerprints")
    return components_of(rows, area).select(
        "doc_id", F.lower(F.lpad(F.hex("mark"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, area: StagingArea) -> DataFrame:
    """``docs`` with one document of every component: the one with the least doc_id.

    A missing doc_id comes last. Of documents with the same doc_id the one with
    the smaller fingerprint stays, of repeated rows one. Columns are kept as they are.
    """
    rows = area.table(fingerprints(docs), "fingerprints")
    grouped = area.table(components_of(rows, area).select("doc_id", "mark", "root"), "grouped")
    chosen = grouped.groupBy("root").agg(F.min(doc_order("doc_id", "mark")).alias("keep")).select(
        F.col("keep.id").alias("_id"), F.col("keep.tie0").alias("_mark")
    )
    packed = docs.select(F.struct("*").alias("row"))
    marked = packed.mapInArrow(
        _with_mark(docs.columns.index("doc_id"), docs.columns.index("text")),
        T.StructType([*packed.schema.fields, T.StructField("doc_id", T.LongType()), T.StructField("mark", T.LongType())]),
    )
    kept = marked.join(
        area.table(chosen, "chosen"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("mark") == F.col("_mark"))
    )
    return kept.dropDuplicates(["_id", "_mark"]).select("row.*")


def _with_mark(doc_id: int, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(0)
            marks = np.fromiter(map(fingerprint, texts_of(rows.field(text))), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [rows, rows.field(doc_id).cast(pa.int64()), pa.array(marks.view(np.int64))], ["row", "doc_id", "mark"]
            )

    return run
