"""Encoding texts into vocabulary pieces and back.

The best segmentation of a text is the one whose pieces have the highest sum of
log scores (Viterbi). Pieces are looked up in a double-array trie over bytes; a
character that is no piece costs the least score less 10 and becomes one piece
per byte. A text is encoded with a space put before it, and pieces write a space
as the marker U+2581. Decoding turns markers into spaces, byte pieces into bytes
and takes the first space away, so every text comes back as it was; a marker
character in the text itself is spelled in bytes.

No piece goes on past a space that follows another character, nor over a line
end, so a text falls into segments that are encoded by themselves. A task keeps
the segments it has met, up to a fixed number, and encodes new ones together.

The vocabulary file is given, never trained. Where it ranks its pieces instead
of scoring them, the log score of rank r is -log(r + 1).

Defined results: a missing or empty text has no pieces and decodes to an empty
one. Repeated rows give equal rows; doc_id is only carried along. An empty table
gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame, types as T

from skyledger.llm.common import sliced

MARKER = "▁"
MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
UNKNOWN_PENALTY = 10.0
#: Segments a task remembers.
_REMEMBERED = 1 << 17
#: Bytes of new segments encoded at a time.
_TOGETHER = 1 << 17
#: Bytes of texts encoded at a time.
_LOT = 2 << 20
_SEGMENT = re.compile(rb" *[^ \n]+|\n| +")
_ALIGNED = re.compile(f"{MARKER}*[^{MARKER}\n ]*")


class Trie:
    """Double-array trie: the child of node s by byte c is base[s] + c, if check there is s."""

    def __init__(self, words: dict[bytes, int]):
        children: list[dict[int, int]] = [{}]
        ends: list[int] = [-1]
        for word, value in words.items():
            at = 0
            for c in word:
                if c not in children[at]:
                    children[at][c] = len(children)
                    children.append({})
                    ends.append(-1)
                at = children[at][c]
            ends[at] = value
        room = 2 * len(children) + 1024
        base, check, value = np.zeros(room, np.int32), np.full(room, -1, np.int32), np.full(room, -1, np.int32)
        taken = bytearray(room)
        taken[0], value[0], free, wide, waiting = 1, ends[0], 257, 257, [(0, 0)]
        while waiting:
            node, slot = waiting.pop()
            own = sorted(children[node])
            if not own:
                continue
            while taken[free]:
                free += 1
            begun = at = max(free, wide) if len(own) > 1 else free
            while any(taken[at - own[0] + c] for c in own):
                at += 1
                if at + 256 >= len(taken):
                    taken.extend(bytes(room))
                    base = np.r_[base, np.zeros(room, np.int32)]
                    check, value = np.r_[check, np.full(room, -1, np.int32)], np.r_[value, np.full(room, -1, np.int32)]
            if at - begun > 64:  # too full for nodes with several children; single ones still fill it
                wide = at
            base[slot] = at - own[0]
            for c in own:
                child = at - own[0] + c
                taken[child], check[child], value[child] = 1, slot, ends[children[node][c]]
                waiting.append((children[node][c], child))
        size = int(np.flatnonzero(np.frombuffer(bytes(taken), np.uint8))[-1]) + 257
        pad = max(0, size - len(base))
        self.base = np.r_[base, np.zeros(pad, np.int32)][:size]
        self.check = np.r_[check, np.full(pad, -1, np.int32)][:size]
        self.value = np.r_[value, np.full(pad, -1, np.int32)][:size]

    def matches(self, data: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, length, value) of every word at every place, none beyond ``end`` of the place."""
        at = np.arange(len(data))
        state, found, size = np.zeros(len(data), np.int64), [], 0
        while len(at):
            inside = at + size < end[at]
            at, state = at[inside], state[inside]
            step = self.base[state] + data[at + size]
            good = self.check[step] == state
            at, state, size = at[good], step[good], size + 1
            ends = self.value[state] >= 0
            found.append((at[ends], np.full(int(ends.sum()), size), self.value[state[ends]]))
        return tuple(np.concatenate([f[i] for f in found]) if found else np.empty(0, np.int64) for i in range(3))


class Vocabulary:
    """Pieces with log scores, ready to encode and decode."""

    def __init__(self, pieces: list[str], scores: list[float], bytes_from: int):
        """``bytes_from`` is the id of the piece for byte 0; a piece of score None is never used."""
        self.bytes_from = bytes_from
        usable = {p.replace(MARKER, " ").encode(): i for i, p in enumerate(pieces) if scores[i] is not None}
        self.trie = Trie(usable)
        self.scores = np.array([0.0 if s is None else s for s in scores])
        self.unknown = min((s for s in scores if s is not None), default=0.0) - UNKNOWN_PENALTY
        spelled = [p.replace(MARKER, " ").encode() if s is not None else b"" for p, s in zip(pieces, scores)]
        spelled[bytes_from:bytes_from + 256] = [bytes([b]) for b in range(256)]
        self.size = np.array([len(s) for s in spelled])
        self.begin = np.cumsum(self.size) - self.size
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.by_segment = all(_ALIGNED.fullmatch(p) for p, s in zip(pieces, scores) if s is not None)

    @classmethod
    def from_file(cls, path: str = MODEL_FILE) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.vocab_size()
        plain = [not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)) for i in range(n)]
        given = [model.get_score(i) for i in range(n)]
        ranked = all(s == int(s) for s, p in zip(given, plain) if p)
        scores = [(-float(np.log(1.0 - s)) if ranked else s) if p else None for s, p in zip(given, plain)]
        return cls([model.id_to_piece(i) for i in range(n)], scores, model.piece_to_id("<0x00>"))

    def segments(self, text: bytes) -> list[bytes]:
        if not text:
            return []
        return _SEGMENT.findall(b" " + text) if self.by_segment else [b" " + text]

    def best(self, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all segments' best pieces one after another, and how many each has."""
        data = np.frombuffer(b"".join(segments), np.uint8).astype(np.int64)
        sizes = np.array([len(s) for s in segments])
        stop = np.cumsum(sizes)
        begin = stop - sizes
        opens = (data & 0xC0) != 0x80
        opens[begin] = True
        width = np.ones(len(data), np.int64)  # bytes of the character that starts here
        starts = np.flatnonzero(opens)
        width[starts] = np.diff(np.r_[starts, len(data)])
        end_of = np.repeat(stop, sizes)
        at, size, piece = self.trie.matches(data, end_of)
        single = np.zeros(len(data), bool)
        single[at[size == width[at]]] = True
        alone = starts[~single[starts]]
        at, size = np.r_[at, alone], np.r_[size, width[alone]]
        score = np.r_[self.scores[piece], np.full(len(alone), self.unknown)]
        piece = np.r_[piece, np.full(len(alone), -1)]
        # All segments step by step: the edges that leave the same offset of their segments at once.
        offset = at - np.repeat(begin, sizes)[at]
        by = np.argsort(offset, kind="stable")
        at, size, piece, score, offset = at[by], size[by], piece[by], score[by], offset[by]
        cuts = np.searchsorted(offset, np.arange(int(sizes.max()) + 1))
        # Place p + segment number: each segment has one place more than bytes.
        number = np.repeat(np.arange(len(segments)), sizes)
        best = np.full(len(data) + len(segments), -np.inf)
        best[begin + np.arange(len(segments))] = 0.0
        came, by_piece = np.zeros(len(best), np.int64), np.full(len(best), -1)
        source = at + number[at]
        target = source + size
        for a, b in zip(cuts[:-1], cuts[1:]):
            value = best[source[a:b]] + score[a:b]
            to = target[a:b]
            better = value > best[to]
            to = to[better]
            best[to], came[to], by_piece[to] = value[better], source[a:b][better], piece[a:b][better]
        place, seg, steps = stop + np.arange(len(segments)), np.arange(len(segments)), []
        first = begin + seg
        while len(seg):
            back = came[place]
            steps.append((seg, back, place, by_piece[place]))
            more = back > first[seg]
            place, seg = back[more], seg[more]
        seg, source, target, piece = (np.concatenate([s[i] for s in steps]) for i in range(4))
        by = np.lexsort((source, seg))
        seg, source, target, piece = seg[by], source[by] - seg[by], target[by] - seg[by], piece[by]
        count = np.where(piece < 0, target - source, 1)
        ids = np.repeat(piece, count)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(count) - count, count)
        spelled = ids < 0
        ids[spelled] = self.bytes_from + data[(np.repeat(source, count) + within)[spelled]]
        return ids.astype(np.int32), np.bincount(seg, weights=count, minlength=len(segments)).astype(np.int64)

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The texts of ``counts`` ids each."""
        size = self.size[ids]
        whole = self.spelled[
            np.repeat(self.begin[ids] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        ].tobytes()
        stop = np.r_[0, np.cumsum(size)][np.cumsum(counts)]
        start = np.r_[0, stop[:-1]][:len(stop)]
        return [whole[a + 1:b] for a, b in zip(start.tolist(), stop.tolist())]


class Encoder:
    """Encodes batches of texts and remembers segments."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.ids, self.begin, self.count = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        split = [self.vocabulary.segments(t) for t in texts]
        if len(self.number) > _REMEMBERED:
            self._forget()
        new = list(dict.fromkeys(s for segments in split for s in segments if s not in self.number))
        sizes = np.cumsum([len(s) for s in new])
        lots = np.searchsorted(sizes, np.arange(0, sizes[-1] if new else 0, _TOGETHER)).tolist()
        for lot in (new[a:b] for a, b in zip(lots, [*lots[1:], len(new)])):
            if not lot:
                continue
            ids, count = self.vocabulary.best(lot)
            begin = np.cumsum(count) - count + len(self.ids)
            self.number.update(zip(lot, range(len(self.number), len(self.number) + len(lot))))
            self.ids, self.begin, self.count = np.r_[self.ids, ids], np.r_[self.begin, begin], np.r_[self.count, count]
        per_text = np.array([len(s) for s in split], np.int64)
        at = np.fromiter((self.number[s] for segments in split for s in segments), np.int64, int(per_text.sum()))
        count = self.count[at]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(self.begin[at] - (ends - count), count) + np.arange(int(count.sum()))]
        totals = np.r_[0, ends][np.cumsum(per_text)]
        return ids, np.diff(np.r_[0, totals])


def encode(docs: DataFrame, vocabulary: Vocabulary, decode: bool = True) -> DataFrame:
    """doc_id, ids, n_pieces and, if asked for, what they decode to, for every row of ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in sliced(batches, "text", _LOT):
            texts = [b or b"" for b in batch.column("text").cast(pa.binary()).to_pylist()]
            ids, counts = encoder.encode(texts)
            offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
            columns = [batch.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(ids)), pa.array(counts)]
            if decode:
                columns.append(pa.array(vocabulary.decode(ids, counts), pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([
        T.StructField("doc_id", T.LongType()), T.StructField("ids", T.ArrayType(T.IntegerType())),
        T.StructField("n_pieces", T.LongType()), *([T.StructField("decoded", T.StringType())] if decode else []),
    ])
    names = schema.fieldNames()
    return docs.select("doc_id", "text").mapInArrow(run, schema)
