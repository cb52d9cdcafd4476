"""Alignment of two tokenizers' tokens over the same text.

Every text is encoded whole by both: tokens A of a byte-level vocabulary, tokens
B of a piece vocabulary. An anchor is a byte offset at which tokens of both end
and after which both go on with a token that starts with a space. Anchors cut a
text into windows, and a window is nothing but its ids of A and of B: its groups
and links are worked out once and remembered under these ids. Inside a window,
groups end where tokens of both end, and tokens are linked where their bytes
overlap.

Neither tokenizer joins a character to a space or line end that follows it (of
B's pieces this is looked up), so a text is encoded in segments that begin with
one, and a task remembers the segments it has met with their windows, up to a
fixed number. That the tokens spell the text is checked for every segment.

How many documents hold a pair linked is counted by a grouped sum over each
document's different pairs. The counts come back to the documents by a join; the
``FREQUENT`` pairs that most documents hold are broadcast for it, so that no pair
is a hot key, and the other rows are shuffled.

The vocabulary files are given, never trained; their content travels with the
job, and a worker makes the tokenizers once.

Defined results: a missing or empty text has no tokens, and so has a text whose
tokens do not spell space + text. Every row is a document of its own, repeated
rows and rows without doc_id too. An empty table gives an empty result. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame, Window, functions as F

from skyledger.llm.common import row_place, sliced, texts_of
from skyledger.staging import StagingArea

BYTE_FILE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_FILE = "/opt/tokenizers/piece_bpe_32k.model"
#: Pairs whose counts are broadcast.
FREQUENT = 1 << 15
#: Segments that a task remembers, and those that are encoded at a time.
_REMEMBERED, _TOGETHER = 1 << 17, 1 << 11
#: Bytes of texts encoded at a time.
_LOT = 1 << 19
#: Bits of an id of B inside a pair.
_B_BITS = 20
_MARKER = "▁"
#: What keeps a text from being cut before every space and line end, and where it is cut then.
_ODD, _OTHER_SPACE, _CUT = ("  ", " \n", "\n ", "\n\n"), re.compile(r"[^\S \n]"), re.compile(r"(?<=\S)(?= +[^ ])")
_STARTS = (" ", "\n")
# How byte-level vocabularies split a text before merging, as file entry and as pattern.
_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_BEYOND_LATIN = "\u0250"
#: The tokenizers that a worker has made, kept for its next task.
_MADE: dict[int, Tokenizers] = {}


def _byte_letters() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as letters from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


def _by_rank(file: dict) -> tiktoken.Encoding | None:
    """The vocabulary of the file for an encoder that merges by rank, if its merges are in the order of their ids.

    It gives the same ids several times faster. It is used for Latin letters only,
    whose classes are the same in every edition of Unicode.
    """
    vocabulary, merges = file["model"]["vocab"], [m.split(" ") if isinstance(m, str) else m for m in file["model"]["merges"]]
    first, split = len(vocabulary) - len(merges), file["pre_tokenizer"]
    in_order = all(vocabulary.get(a + b) == first + i for i, (a, b) in enumerate(merges))
    if not in_order or file["normalizer"] or split != _BYTE_LEVEL:
        return None
    letters = _byte_letters()
    ranks = {bytes(letters[c] for c in token): i for token, i in vocabulary.items()}
    return tiktoken.Encoding("latin", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={})


class Tokenizers:
    """Both tokenizers, made from the content of their files, and the bytes of their tokens."""

    def __init__(self, byte_json: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a = tokenizers.Tokenizer.from_str(byte_json)
        self.a.encode_special_tokens = True
        self.a_latin = _by_rank(json.loads(byte_json))
        letters, vocabulary = _byte_letters(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_MARKER, " ").encode() for i, p in enumerate(pieces)
        ]
        self.a_size, self.b_size = (np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes))
        self.a_text, self.b_text = (np.array([f"{i}," for i in range(len(t))], object) for t in (self.a_bytes, self.b_bytes))
        self.a_spaced, self.b_spaced = (np.array([x[:1] == b" " for x in t]) for t in (self.a_bytes, self.b_bytes))
        self.by_segment = not any(re.search(f"[^{_MARKER}]{_MARKER}", p) for p in pieces)
        # A line end is spelled by itself, so that it can be cut off what comes before.
        first = self.b.encode("\na")[:1]
        self.by_line = not any("\n" in p for p in pieces) and first == [self.b.piece_to_id(_MARKER)]

    def segments(self, text: str) -> list[str]:
        """Of space + text, cut before spaces and line ends that follow another character; a leading space is left out."""
        if not self.by_segment:
            return [" " + text]
        if not self.by_line or any(odd in text for odd in _ODD) or text[0] in " \n" or text[-1] in " \n" or _OTHER_SPACE.search(text):
            return _CUT.split(" " + text)
        return text.replace("\n", " \n").split(" ")

    def encode(self, segments: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids of A and of B of all segments one after another, how many each segment has, and whether both spell it."""
        a, b, whole = [], [], [s if s[:1] in _STARTS else " " + s for s in segments]
        for at in range(0, len(whole), _TOGETHER):
            texts = whole[at:at + _TOGETHER]
            a += self._encode_a(texts)
            # B puts a space before what it encodes.
            own = self.b.encode([t[1:] if t[0] == " " else t for t in texts], num_threads=1)
            b += [ids[1:] if t[0] == "\n" else ids for t, ids in zip(texts, own)]
        n_a, n_b = (np.fromiter(map(len, x), np.int64, len(x)) for x in (a, b))
        a, b = (np.fromiter(chain.from_iterable(x), np.int32) for x in (a, b))
        return a, b, n_a, n_b, self._spelled([t.encode() for t in whole], a, b, n_a, n_b)

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        latin = [self.a_latin is not None and (t.isascii() or max(t) < _BEYOND_LATIN) for t in texts]
        others = self.a.encode_batch_fast([t for t, own in zip(texts, latin) if not own], add_special_tokens=False)
        others = iter(others)
        return [self.a_latin.encode_ordinary(t) if own else next(others).ids for t, own in zip(texts, latin)]

    def _spelled(self, texts: list[bytes], a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
        whole, size = b"".join(texts), np.fromiter(map(len, texts), np.int64, len(texts))
        good = np.ones(len(texts), bool)
        for ids, n, tokens, sizes in ((a, n_a, self.a_bytes, self.a_size), (b, n_b, self.b_bytes, self.b_size)):
            of = np.repeat(np.arange(len(texts)), n)
            same = np.bincount(of, sizes[ids], len(texts)) == size
            found = list(map(tokens.__getitem__, ids.tolist()))
            if not same.all() or b"".join(found) != whole:
                ends = np.cumsum(n).tolist()
                same = np.array([b"".join(found[i:j]) == t for i, j, t in zip([0, *ends], ends, texts)])
            good &= same
        return good


def _gathered(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all entries of these ranges, one range after another."""
    ends = np.cumsum(size)
    return np.repeat(begin - (ends - size), size) + np.arange(int(size.sum()))


class Ragged:
    """Arrays of different lengths, one after another."""

    def __init__(self):
        self.value, self.begin, self.size = (np.empty(0, np.int64) for _ in range(3))

    def add(self, value: np.ndarray, size: np.ndarray) -> None:
        self.begin = np.r_[self.begin, len(self.value) + np.cumsum(size) - size]
        self.value, self.size = np.r_[self.value, value], np.r_[self.size, size]

    def take(self, at: np.ndarray) -> np.ndarray:
        return self.value[_gathered(self.begin[at], self.size[at])]


class Aligner:
    """Segments and windows that were met: windows by their ids, with the text of their groups and their links."""

    def __init__(self, both: Tokenizers):
        self.both = both
        self._forget()

    def _forget(self) -> None:
        self.segment: dict[str, int] = {}
        self.segment_windows, self.segment_tokens = Ragged(), np.empty((0, 3), np.int64)  # tokens of A, of B, spelled
        self.window: dict[tuple[bytes, bytes], int] = {}
        self.groups: list[str] = []
        self.n_groups, self.pairs = np.empty(0, np.int64), Ragged()

    def _align(self, a: np.ndarray, b: np.ndarray, n_a: np.ndarray) -> None:
        """Add windows, given all their ids one after another and the number of those of A."""
        a_end, b_end = np.cumsum(self.both.a_size[a]), np.cumsum(self.both.b_size[b])
        window_end = a_end[np.cumsum(n_a) - 1]
        # Between one end of any token and the next there is one token of A and one of B: a link.
        ends = np.union1d(a_end, b_end)
        pairs = (a[np.searchsorted(a_end, ends)].astype(np.int64) << _B_BITS) | b[np.searchsorted(b_end, ends)]
        self.pairs.add(pairs, np.diff(np.searchsorted(ends, window_end, "right"), prepend=0))
        shared, i, j = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
        last = np.searchsorted(shared, window_end, "right")
        self.n_groups = np.r_[self.n_groups, np.diff(last, prepend=0)]
        # One list of "id," in the order of groups, with "|" after each group's A and ";" or a line end after its B.
        n = np.arange(len(shared))
        group_a, group_b = (np.repeat(n, np.diff(k, prepend=-1)) for k in (i, j))
        parts = np.empty(len(a) + len(b) + 2 * len(n), object)
        ends_a, ends_b = i + 1, j + 1  # tokens up to each group's end
        before_b = np.r_[0, ends_b[:-1]]
        parts[np.arange(len(a)) + before_b[group_a] + 2 * group_a] = self.both.a_text[a]
        parts[ends_a + before_b + 2 * n] = "|"
        parts[np.arange(len(b)) + ends_a[group_b] + 2 * group_b + 1] = self.both.b_text[b]
        closing = np.full(len(n), ";", object)
        closing[last - 1] = "\n"
        parts[ends_a + ends_b + 2 * n + 1] = closing
        text = "".join(parts.tolist()).replace(",|", "|").replace(",;", ";").replace(",\n", "\n")
        self.groups += text.split("\n")[:-1]

    def _windows(self, a: np.ndarray, b: np.ndarray, segment_end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the windows of these ids, which spell the same bytes, and where in the bytes they end.

        The end of a segment is one: what follows it in a text begins with white space.
        """
        both = self.both
        a_end, b_end = np.cumsum(both.a_size[a]), np.cumsum(both.b_size[b])
        shared, i, j = np.intersect1d(a_end, b_end, assume_unique=True, return_indices=True)
        spaced = np.r_[both.a_spaced[a[i[:-1] + 1]] & both.b_spaced[b[j[:-1] + 1]], True]
        spaced[np.searchsorted(shared, segment_end)] = True
        anchors = np.flatnonzero(spaced)
        i, j = np.r_[0, i[anchors] + 1], np.r_[0, j[anchors] + 1]
        a_bytes, b_bytes, p, r = a.tobytes(), b.tobytes(), (4 * i).tolist(), (4 * j).tolist()
        keys = [(a_bytes[p0:p1], b_bytes[r0:r1]) for p0, p1, r0, r1 in zip(p, p[1:], r, r[1:])]
        new = {key: k for k, key in enumerate(keys) if key not in self.window}
        if new:
            first = np.fromiter(new.values(), np.int64, len(new))
            size_a, size_b = np.diff(i)[first], np.diff(j)[first]
            self.window.update(zip(new, range(len(self.groups), len(self.groups) + len(new))))
            self._align(a[_gathered(i[first], size_a)], b[_gathered(j[first], size_b)], size_a)
        return np.fromiter(map(self.window.__getitem__, keys), np.int64, len(keys)), shared[anchors]

    def _learn(self, segments: list[str]) -> None:
        a, b, n_a, n_b, good = self.both.encode(segments)
        a, b = a[np.repeat(good, n_a)], b[np.repeat(good, n_b)]
        count = np.zeros(len(segments), np.int64)
        numbers = np.empty(0, np.int64)
        if len(a):
            segment_end = np.cumsum(self.both.a_size[a])[np.cumsum(n_a[good]) - 1]
            numbers, ends = self._windows(a, b, segment_end)
            count[good] = np.diff(np.searchsorted(ends, segment_end, "right"), prepend=0)
        self.segment.update(zip(segments, range(len(self.segment), len(self.segment) + len(segments))))
        self.segment_windows.add(numbers, count)
        self.segment_tokens = np.concatenate([self.segment_tokens, np.stack([n_a, n_b, good], 1)])

    def align(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of every text: tokens of A, of B, groups, links; the groups' digest; and (text, pair, times) of its different pairs."""
        if len(self.segment) > _REMEMBERED:
            self._forget()
        split = [self.both.segments(t) if t else [] for t in texts]
        new = [s for s in dict.fromkeys(chain.from_iterable(split)) if s not in self.segment]
        if new:
            self._learn(new)
        n = len(texts)
        of = np.repeat(np.arange(n), [len(s) for s in split])
        at = np.fromiter(map(self.segment.__getitem__, chain.from_iterable(split)), np.int64, len(of))
        spelled = np.bincount(of, self.segment_tokens[at, 2] == 0, n) == 0
        at, of = at[spelled[of]], of[spelled[of]]
        tokens = [np.bincount(of, self.segment_tokens[at, k], n) for k in (0, 1)]
        windows, of = self.segment_windows.take(at), np.repeat(of, self.segment_windows.size[at])
        size = self.pairs.size[windows]
        totals = np.stack([*tokens, np.bincount(of, self.n_groups[windows], n), np.bincount(of, size, n)], 1).astype(np.int64)
        texts_of_windows, ends = list(map(self.groups.__getitem__, windows.tolist())), np.searchsorted(of, np.arange(n + 1)).tolist()
        digests = [
            hashlib.sha256(";".join(texts_of_windows[p:q]).encode()).hexdigest() if p < q else "" for p, q in zip(ends, ends[1:])
        ]
        kinds, kind = np.unique(self.pairs.take(windows), return_inverse=True)
        held, times = np.unique(np.repeat(of, size) * max(1, len(kinds)) + kind, return_counts=True)
        return totals, digests, held // max(1, len(kinds)), kinds[held % max(1, len(kinds))], times


_SCHEMA = (
    "place long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "pairs array<long>, times array<int>"
)


def _aligned(byte_json: str, piece_model: bytes):
    names = [c.split()[0] for c in _SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = hash((byte_json, piece_model))
        if files not in _MADE:
            _MADE.clear()
            _MADE[files] = Tokenizers(byte_json, piece_model)
        aligner = Aligner(_MADE[files])
        for batch in sliced(batches, "text", _LOT):
            totals, digests, of, pairs, times = aligner.align([t.decode() for t in texts_of(batch.column("text"))])
            offsets = pa.array(np.searchsorted(of, np.arange(batch.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([
                batch.column("place"), batch.column("doc_id").cast(pa.int64()), *map(pa.array, totals.T),
                pa.array(digests, pa.string()), pa.ListArray.from_arrays(offsets, pa.array(pairs)),
                pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
            ], names)

    return run


def aligned(docs: DataFrame, byte_file: str = BYTE_FILE, piece_file: str = PIECE_FILE) -> DataFrame:
    """One row per document: place, doc_id, n_a, n_b, n_groups, n_links, groups_sha256, pairs, times.

    A pair is the id in A, shifted, and the id in B; ``times`` says how often the document links it.
    """
    with open(byte_file, encoding="utf-8") as f:
        byte_json = f.read()
    with open(piece_file, "rb") as f:
        piece_model = f.read()
    rows = docs.select(row_place().alias("place"), "doc_id", "text")
    return rows.mapInArrow(_aligned(byte_json, piece_model), _SCHEMA)


def pair_counts(rows: DataFrame) -> DataFrame:
    """pair, documents, best: how many documents link a pair, and whether no pair of its id in A has more."""
    counts = rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("documents"))
    of_a = Window.partitionBy(F.shiftright("pair", _B_BITS))
    return counts.withColumn("best", F.col("documents") == F.max("documents").over(of_a))


def alignment(docs: DataFrame, area: StagingArea, frequent: int = FREQUENT) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = area.table(aligned(docs), "aligned")
    counts = area.table(pair_counts(rows), "pairs")
    hot = area.table(
        counts.orderBy(F.desc("documents"), "pair").limit(frequent)
        .select(F.col("pair").alias("_pair"), F.col("documents").alias("_documents"), F.col("best").alias("_best")),
        "frequent",
    )
    held = rows.select("place", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("place", "p.pairs", "p.times")
    held = held.join(F.broadcast(hot), F.col("pairs") == F.col("_pair"), "left")
    sums = [
        F.sum(F.when(F.col("best"), F.col("times").cast("long")).otherwise(0)).alias("n_best"),
        F.sum(F.col("documents") * F.col("times")).alias("count_sum"),
    ]
    here = held.where("_pair IS NOT NULL").select("place", "times", F.col("_documents").alias("documents"), F.col("_best").alias("best"))
    rare = held.where("_pair IS NULL").select("place", "times", "pairs").join(counts, F.col("pairs") == F.col("pair"))
    total = (
        here.groupBy("place").agg(*sums)
        .unionByName(rare.groupBy("place").agg(*sums))
        .groupBy("place").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
        .withColumnRenamed("place", "_place")
    )
    none = F.lit(0).cast("long")
    return rows.drop("pairs", "times").join(total, F.col("place") == F.col("_place"), "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
