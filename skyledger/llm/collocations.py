"""Collocations of two and three words, mined by partitions (SON).

Documents are dealt to ``SHARDS`` shards. A phrase that occurs ``SUPPORT`` times
occurs at least ceil(SUPPORT / SHARDS) times in one of them, so every shard is
mined completely at that local support, level by level: a phrase is counted
there only if its first and its last part are locally frequent. The union of
what is locally frequent are the candidates, and one more pass counts all of them
(and single words, which the scores need) exactly over the whole corpus.

Mining goes by 64-bit hashes. Two phrases with one hash are counted together, so
none is missed; the last pass counts the words themselves. What a level has found
reaches the tasks as a bitmap of hash slots of ``MOST_BITS`` bits at most. Slots
that are shared let more through, never less: beyond that size the levels and
the last pass count more phrases, and the results stay the same.

Texts are cut into lots between pieces, so a task's memory follows the longest
piece, not the longest text.

Defined results: a missing or empty text has no words; a missing lang counts as
``und``. Repeated rows count each; doc_id only deals documents to shards, rows
without one to the same. Phrases of equal score and frequency are in the order
of their UTF-8 bytes. An empty table gives an empty result. Other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import sliced, texts_of
from skyledger.staging import StagingArea

SUPPORT, MOST_WORDS, TOP = 10, 3, 2000
SHARDS = 3
#: A candidate goes if a longer one that holds it has this share of its occurrences, in hundredths.
HELD_PERCENT = 50
SCORE_UNIT = 1_000_000
UNKNOWN = "und"
#: A bitmap has at least 32 bits per entry, and these at most and at least.
MOST_BITS, LEAST_BITS = 28, 16
_LOT = 1 << 20
#: Bytes whose candidates are counted together before they leave a task.
_COUNTED_LOT = 3 << 20
_ENTRIES_IN_A_TASK = 1 << 20
_ROWS_AT_ONCE = 1 << 16
#: Bits of a hash that tell shards apart while one is mined.
_SHARD_BITS = 8

_KIND = np.zeros(256, np.uint8)  # 0 part of a word, 1 between words, 2 between pieces
_KIND[[0x20, 0x09]] = 1
_KIND[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93))
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(1, 8)] + [(1 << 64) - 1], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _C
    return h ^ (h >> np.uint64(29))


class Lot:
    """Words of some texts: bytes of all words in lower case with one space after each, and what tells phrases apart."""

    def __init__(self, texts: list[bytes], langs: list[str], shards: list[int]):
        # A line end between texts ends a piece, as it does inside them.
        sizes = np.array([len(t) + 1 for t in texts])
        raw = _LOWER[np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)]
        kind = _KIND[raw]
        inside = kind == 0
        starts = np.flatnonzero(inside & np.r_[True, ~inside[:-1]])
        ends = np.flatnonzero(inside & np.r_[~inside[1:], True]) + 1
        text = np.repeat(np.arange(len(texts)), sizes)[starts]
        piece = np.cumsum(kind == 2)[starts]
        keep = inside.copy()
        keep[ends] = True  # the byte after a word becomes its space
        self.data = np.where(inside, raw, 0x20).astype(np.uint8)[keep]
        size = ends - starts
        self.begin = np.cumsum(size + 1) - size - 1
        self.end = self.begin + size
        self.langs = sorted(set(langs))
        number = {lang: i for i, lang in enumerate(self.langs)}
        self.lang = np.array([number[lang] for lang in langs], np.int64)[text]
        self.shard = np.array(shards, np.int64)[text]
        seeds = np.array([xxhash.xxh64_intdigest(lang) for lang in self.langs], np.uint64)
        self.numbers = np.ndarray(len(self.data) + 1, "<u8", self.data.tobytes() + bytes(8), strides=(1,))
        self.words = self._hashes(seeds[self.lang] if len(text) else np.empty(0, np.uint64))
        #: Whether the word with the same place plus k belongs to the same piece.
        self.on = [np.ones(len(piece), bool), *(np.r_[piece[k:] == piece[:-k], np.zeros(k, bool)][:len(piece)] for k in range(1, MOST_WORDS))]

    def _hashes(self, seed: np.ndarray) -> np.ndarray:
        """A hash of every word, eight bytes at a time."""
        h, size, at, step = seed * _A, self.end - self.begin, np.arange(len(self.begin)), 0
        while len(at):
            left = np.minimum(size[at] - step, 8)
            h[at] = _mixed((h[at] ^ self._eight(self.begin[at] + step, left)) * _B + left.astype(np.uint64))
            step += 8
            at = at[size[at] > step]
        return h

    def _eight(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Up to eight bytes of the text from each place, as one number."""
        return self.numbers[at] & _MASKS[size - 1]

    def same(self, at: np.ndarray, other: np.ndarray, n: int) -> np.ndarray:
        """Whether phrases of ``n`` words from these places are equal, byte by byte and in their language."""
        begin, begin_other = self.begin[at], self.begin[other]
        size = self.end[at + n - 1] - begin
        equal = (size == self.end[other + n - 1] - begin_other) & (self.lang[at] == self.lang[other])
        open_, step = np.flatnonzero(equal & (at != other)), 0
        while len(open_):
            left = np.minimum(size[open_] - step, 8)
            good = self._eight(begin[open_] + step, left) == self._eight(begin_other[open_] + step, left)
            equal[open_[~good]] = False
            step += 8
            open_ = open_[good & (size[open_] > step)]
        return equal

    def phrases(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all phrases of ``n`` words."""
        at = np.flatnonzero(self.on[n - 1])
        h = self.words[at]
        for k in range(1, n):
            h = _mixed(h * _A + self.words[at + k] * _B + np.uint64(k))
        return at, h

    def spelled(self, at: np.ndarray, n: int) -> list[str]:
        data = self.data.tobytes()
        return [data[a:b].decode() for a, b in zip(self.begin[at].tolist(), self.end[at + n - 1].tolist())]


class Slots:
    """A bitmap over two slots of each hash: what was put in is always found."""

    def __init__(self, found: DataFrame, h: str):
        entries = max(1, found.count())
        self.bits = bits = min(MOST_BITS, max(LEAST_BITS, (32 * entries - 1).bit_length()))
        upper, lower = F.shiftrightunsigned(h, 64 - bits), F.shiftrightunsigned(h, _SHARD_BITS).bitwiseAND(F.lit((1 << bits) - 1))
        words = found.select(F.explode(F.array(upper, lower)).alias("slot")).groupBy(F.shiftright("slot", 6).cast("int").alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("set")
        ).toArrow()  # 2^(MOST_BITS - 6) rows at most
        filled = np.zeros(1 << bits - 6, np.uint64)
        filled[words.column("word").to_numpy()] = words.column("set").to_numpy().view(np.uint64)
        self.value = found.sparkSession.sparkContext.broadcast(filled)

    def holds(self, h: np.ndarray) -> np.ndarray:
        held = self._set(h >> np.uint64(64 - self.bits))
        held[held] = self._set((h[held] >> np.uint64(_SHARD_BITS)) & np.uint64((1 << self.bits) - 1))
        return held

    def _set(self, slot: np.ndarray) -> np.ndarray:
        return (self.value.value[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def _in_shard(h: np.ndarray, shard: np.ndarray) -> np.ndarray:
    """The number of a shard over the upper bits of a hash."""
    return (h >> np.uint64(_SHARD_BITS)) | (shard.astype(np.uint64) << np.uint64(64 - _SHARD_BITS))


def _parts(text: bytes) -> Iterator[bytes]:
    """A long text in parts that end between pieces."""
    start = 0
    while len(text) - start > _LOT:
        ends = _KIND[np.frombuffer(text, np.uint8, _LOT, start)] == 2
        stop = start + int(np.flatnonzero(ends)[-1]) if ends.any() else start
        if stop == start:  # one piece goes on: up to its end
            stop = len(text)
            for at in range(start + 1, len(text), _LOT):
                ends = np.flatnonzero(_KIND[np.frombuffer(text, np.uint8, min(_LOT, len(text) - at), at)] == 2)
                if len(ends):
                    stop = at + int(ends[0])
                    break
        yield text[start:stop]
        start = stop
    yield text[start:]


def _lots(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Lot]:
    held, size = [], 0
    for batch in sliced(batches, "text", _LOT):
        columns = texts_of(batch.column("text")), batch.column("lang").to_pylist(), batch.column("shard").to_pylist()
        for text, lang, shard in zip(*columns):
            for part in _parts(text):
                held.append((part, lang, shard))
                size += len(part)
                if size >= most:
                    yield Lot(*map(list, zip(*held)))
                    held, size = [], 0
    if held:
        yield Lot(*map(list, zip(*held)))


def _mined(n: int, shorter: Slots | None):
    """Counts of a task's phrases of ``n`` words whose parts of n - 1 words are frequent in the shard."""

    def counted(held: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
        h, times = (np.concatenate([x[i] for x in held]) for i in (0, 1))
        h, where = np.unique(h, return_inverse=True)
        return [(h, np.bincount(where, weights=times, minlength=len(h)).astype(np.int64))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, waiting = [], 0
        for lot in _lots(batches, _LOT):
            at, h = lot.phrases(n)
            if shorter is not None:
                places, parts = lot.phrases(n - 1)
                frequent = np.zeros(len(lot.words), bool)
                frequent[places] = shorter.holds(_in_shard(parts, lot.shard[places]))
                both = frequent[at] & frequent[at + 1]
                at, h = at[both], h[both]
            h, times = np.unique(_in_shard(h, lot.shard[at]), return_counts=True)
            held.append((h, times))
            waiting += len(h)
            if waiting > _ENTRIES_IN_A_TASK:
                held = counted(held)
                waiting = len(held[0][0])
                if waiting > _ENTRIES_IN_A_TASK // 2:
                    yield from rows(*held[0])
                    held, waiting = [], 0
        if held:
            yield from rows(*counted(held)[0])

    def rows(h: np.ndarray, times: np.ndarray) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(h), _ROWS_AT_ONCE):
            part = slice(at, at + _ROWS_AT_ONCE)
            yield pa.RecordBatch.from_arrays([pa.array(h[part].view(np.int64)), pa.array(times[part])], ["h", "times"])

    return run


def locally_frequent(texts: DataFrame, area: StagingArea, least: int) -> list[DataFrame]:
    """For 1, 2, ... words: shards and hashes of what occurs ``least`` times in a shard."""
    found, shorter = [], None
    for n in range(1, MOST_WORDS + 1):
        local = (
            texts.mapInArrow(_mined(n, shorter), "h long, times long")
            .groupBy("h").agg(F.sum("times").alias("times")).where(F.col("times") >= least)
            .select("h")
        )
        found.append(area.table(local, f"local-{n}"))
        if n < MOST_WORDS:
            shorter = Slots(found[-1], "h")
    return found


def _exactly(candidates: Slots):
    """(lang, phrase, n, times) of a task's candidates, and each lang's number of words as n = 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lot in _lots(batches, _COUNTED_LOT):
            words = np.bincount(lot.lang, minlength=len(lot.langs))
            yield rows(lot.langs, [""] * len(words), 0, words.tolist())
            for n in range(1, MOST_WORDS + 1):
                at, h = lot.phrases(n)
                known = candidates.holds(h)
                at, h = at[known], h[known]
                if not len(at):
                    continue
                by = np.argsort(h, kind="stable")
                at, h = at[by], h[by]
                first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]])
                leader = at[np.repeat(first, np.diff(np.r_[first, len(h)]))]
                same = lot.same(at, leader, n)
                times = np.add.reduceat(same, first)
                odd = ~same  # another phrase with the same hash: a row of its own
                places = np.r_[at[first], at[odd]]
                yield rows([lot.langs[i] for i in lot.lang[places].tolist()], lot.spelled(places, n), n, [*times.tolist(), *[1] * int(odd.sum())])

    def rows(langs: list[str], phrases: list[str], n: int, times: list[int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(langs, pa.string()), pa.array(phrases, pa.string()), pa.array([n] * len(langs), pa.int32()), pa.array(times, pa.int64())],
            ["lang", "phrase", "n", "times"],
        )

    return run


def _cuts(n: int) -> Column:
    """Every way to cut the phrase in two, with both parts."""
    words = F.split("phrase", " ")
    part = lambda a, b: F.array_join(F.slice(words, a, b), " ")
    return F.array(*[F.struct(F.lit(k).alias("k"), part(1, k).alias("first"), part(k + 1, n - k).alias("rest")) for k in range(1, n)])


def phrase_counts(docs: DataFrame, area: StagingArea, shards: int = SHARDS, support: int = SUPPORT) -> DataFrame:
    """lang, n, phrase, a: exact counts of all phrases of up to ``MOST_WORDS`` words with this support, and each lang's words as n = 0."""
    texts = docs.select(
        "text", F.coalesce("lang", F.lit(UNKNOWN)).alias("lang"), F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard")
    )
    local = locally_frequent(texts, area, -(-support // shards))
    anywhere = reduce(DataFrame.unionByName, local).select(F.shiftleft("h", _SHARD_BITS).alias("h")).distinct()
    candidates = Slots(area.table(anywhere, "candidates"), "h")
    counts = (
        texts.mapInArrow(_exactly(candidates), "lang string, phrase string, n int, times long")
        .groupBy("lang", "n", "phrase").agg(F.sum("times").alias("a"))
    )
    return area.table(counts.where((F.col("n") == 0) | (F.col("a") >= support)), "counts")


def scored(counts: DataFrame) -> DataFrame:
    """lang, phrase, a, l, r, score of every phrase in ``counts``: the cut with the lowest score, of equal ones the first."""
    known = lambda side: counts.where("n > 0").select(
        F.col("lang").alias(f"{side}_lang"), F.col("phrase").alias(side), F.col("a").alias(f"{side}_times")
    )
    cuts = reduce(DataFrame.unionByName, [
        counts.where(F.col("n") == n).select("lang", "phrase", "a", F.explode(_cuts(n)).alias("cut")) for n in range(2, MOST_WORDS + 1)
    ])
    score = F.expr(
        f"(CAST({SCORE_UNIT} AS DECIMAL(20, 0)) * CAST(a AS DECIMAL(20, 0)) * CAST(a AS DECIMAL(20, 0)))"
        " div (CAST(first_times AS DECIMAL(20, 0)) * CAST(rest_times AS DECIMAL(20, 0)))"
    )
    lowest = F.min(F.struct(score.alias("score"), F.col("cut.k").alias("k"), F.col("first_times").alias("l"), F.col("rest_times").alias("r")))
    return (
        cuts.join(known("first"), (F.col("lang") == F.col("first_lang")) & (F.col("cut.first") == F.col("first")))
        .join(known("rest"), (F.col("lang") == F.col("rest_lang")) & (F.col("cut.rest") == F.col("rest")))
        .groupBy("lang", "phrase", "a").agg(lowest.alias("m"))
        .select("lang", "phrase", "a", "m.l", "m.r", "m.score")
    )


def not_held(counts: DataFrame, percent: int = HELD_PERCENT) -> DataFrame:
    """lang, phrase of the phrases that are no mere part of a longer one.

    It is enough to look at phrases of one word more: what lies in a still longer
    one lies in one of these that is at least as frequent.
    """
    parts = [
        counts.where(F.col("n") == n).select(
            "lang", "a", F.explode(F.array(*[F.array_join(F.slice(F.split("phrase", " "), k, n - 1), " ") for k in (1, 2)])).alias("phrase")
        )
        for n in range(3, MOST_WORDS + 1)
    ]
    longer = reduce(DataFrame.unionByName, parts).groupBy("lang", "phrase").agg(F.max("a").alias("longest"))
    return counts.where("n > 1").join(longer, ["lang", "phrase"], "left").where(
        F.col("longest").isNull() | (100 * F.col("longest") < percent * F.col("a"))
    ).select("lang", "phrase")


def collocations(
    docs: DataFrame, area: StagingArea, shards: int = SHARDS, support: int = SUPPORT, top: int = TOP
) -> DataFrame:
    """Each lang's first ``top`` collocations: lang, rank, phrase, a, l, r, n, score."""
    counts = phrase_counts(docs, area, shards, support)
    found = area.table(scored(counts).join(not_held(counts), ["lang", "phrase"], "left_semi"), "scored")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    # First in parts, so that no lang is sorted in one task.
    parts = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(256))).orderBy(*order)
    first = found.withColumn("rank", F.row_number().over(parts)).where(F.col("rank") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    words = counts.where("n = 0").select("lang", F.col("a").alias("n"))
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
