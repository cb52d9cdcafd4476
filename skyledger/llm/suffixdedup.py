"""Removal of every byte that a 100-byte string covers which also starts earlier.

The strings are the suffixes of all documents, read only through their first 100
bytes. They are sorted by digits, most significant first, and after every pass
only groups that still have company go on; groups that are equal in all digits
are exactly the repeated strings.

1. The first digit is the content-defined one of minimizer counting: of the
   32-byte grams inside a string, the one with the least hash. Consecutive
   strings share it, so they travel as one run without their bytes: gram hash,
   hash of the run's bytes, document, start. About one row per 35 bytes.
2. Runs with equal bytes: all but the first are repeated as a whole. A task
   already reduces equal runs among its own documents before the shuffle, so a
   run that is everywhere reaches its group once per batch.
3. Grams that occur in different runs: only the first run of each kind is left,
   its bytes are fetched, and its strings are sorted by 8-byte digits.
4. A gram with more than ``HOT_RUNS`` kinds of runs, as at the edges of a passage
   that is everywhere, is split before that shuffle: every string of its runs
   goes by a 128-bit hash of its bytes, so that equal strings still meet. Equal
   strings of one batch are reduced to the first, as equal runs are.

Sorted groups stream through the tasks. Step 2 and 4 hold a batch; step 3 holds a
block of strings and one gram, which has ``HOT_RUNS`` runs at most, besides
repeated rows.

Defined results: a missing text is empty; texts under 100 bytes keep everything.
Order is by doc_id (missing ids last), then by a hash of the text, then by
start. Repeated rows are one document to each other and get the same result. An
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, functions as F

from skyledger.llm.common import sliced, texts_of, whole_text
from skyledger.staging import StagingArea

LENGTH = 100
GRAM = 32
#: Bytes hashed at a time; positions inside fit the lower 24 bits of a key.
_PIECE = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)
#: Strings sorted at a time.
_BLOCK = 1 << 21
#: A gram with more kinds of runs is split by whole strings.
HOT_RUNS = 1024
#: Hot grams (one number each) that are broadcast; more are joined by shuffling.
HOT_GRAMS = 500_000
#: Hot runs whose strings are expanded at a time.
_HOT_ROWS = 1 << 13

_RUN = "sig long, content long, doc_id long, text_hash long, at long"
_ORDER = ["no_id", "doc_id", "text_hash", "at"]


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """64-bit hashes of all grams, by doubling the hashed length."""
    values = np.random.default_rng(100).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
    h, size, base = values[data], 1, np.uint64(0x9E3779B97F4A7C15)
    while size < GRAM:
        h = h[:-size] * base + h[size:]
        base, size = base * base, size * 2
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return np.minimum(h[:len(h) - (width - size)], h[width - size:]) if width > size else h


def _runs_of(data: np.ndarray, valid: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, start, strings) of the runs among the valid string starts of ``data``."""
    hashes = _gram_hashes(data)
    keys = (hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64)
    place = (_least(keys, LENGTH - GRAM + 1) & _PLACE).astype(np.int64)
    place = np.where(valid, place, -1)
    start = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    strings = np.diff(np.r_[start, len(place)])
    real = place[start] >= 0
    start, strings = start[real], strings[real]
    return hashes[place[start]], start, strings


def _pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """(text number, offset, bytes) in lots of about ``_PIECE`` bytes; long texts in overlapping parts."""
    lot, held = [], 0
    for i, text in enumerate(texts):
        for offset in range(0, max(len(text) - LENGTH + 1, 0), _PIECE):
            part = text[offset:offset + _PIECE + LENGTH - 1]
            lot.append((i, offset, part))
            held += len(part)
            if held >= _PIECE:
                yield lot
                lot, held = [], 0
    if lot:
        yield lot


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of every document; those that repeat one of the same batch have no content hash."""
    for batch in sliced(batches, "text"):
        ids, text_hash = batch.column("doc_id").cast(pa.int64()), batch.column("text_hash").to_numpy()
        no_id = np.asarray(ids.is_null())
        plain = ids.fill_null(0).to_numpy(zero_copy_only=False)
        order = np.lexsort((text_hash, plain, no_id))
        same = (no_id[order][1:] == no_id[order][:-1]) & (plain[order][1:] == plain[order][:-1])
        order = order[~np.r_[False, same & (text_hash[order][1:] == text_hash[order][:-1])]]  # repeated rows
        texts = texts_of(batch.column("text").take(pa.array(order)))
        found = [[np.empty(0, np.uint64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int64)]]
        for lot in _pieces(texts):
            whole = b"".join(part for _, _, part in lot)
            data = np.frombuffer(whole, np.uint8)
            begin = np.cumsum([0, *(len(part) for _, _, part in lot)])
            valid = np.zeros(len(data) - LENGTH + 1, bool)
            for a, b in zip(begin[:-1], begin[1:]):
                valid[a:b - LENGTH + 1] = True
            sig, start, strings = _runs_of(data, valid)
            which = np.searchsorted(begin, start, "right") - 1
            number = np.array([i for i, _, _ in lot])
            offset = np.array([o for _, o, _ in lot]) - begin[:-1]
            view = memoryview(whole)
            ends = start + strings + (LENGTH - 1)
            content = [xxhash.xxh3_64_intdigest(view[a:b]) for a, b in zip(start.tolist(), ends.tolist())]
            found[0].append(sig)
            found[1].append(np.array(content, np.uint64))
            found[2].append(number[which])
            found[3].append((start + offset[which]) << 8 | strings)
        sig, content, number, at = map(np.concatenate, found)
        if not len(sig):
            continue
        mixed = sig * np.uint64(0x9E3779B97F4A7C15) ^ content
        by = np.argsort(mixed, kind="stable")  # stable: the first of equal runs comes first
        again = np.zeros(len(sig), bool)
        again[by[1:]] = (sig[by[1:]] == sig[by[:-1]]) & (content[by[1:]] == content[by[:-1]])
        sig = np.where(again, mixed + at.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93), sig)  # spread: decided already
        rows = order[number]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(sig.view(np.int64)), pa.array(content.view(np.int64), mask=again),
                ids.take(pa.array(rows)), pa.array(text_hash[rows]), pa.array(at),
            ],
            ["sig", "content", "doc_id", "text_hash", "at"],
        )


_DECIDED = "repeated boolean, sig long, doc_id long, text_hash long, at long"


def _decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeated runs, and the first of each kind where a gram has runs of several kinds.

    Rows arrive sorted by gram, content and order. Of the gram that a batch ends
    in, at most one run has to be kept for the next batch.
    """
    names = ["repeated", "sig", "doc_id", "text_hash", "at"]
    last_sig = last_content = held = None
    last_first = (None, None, None)
    kinds = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        sig = batch.column("sig").to_numpy()
        done = np.asarray(batch.column("content").is_null())
        content = batch.column("content").fill_null(0).to_numpy()
        rest = batch.select(["sig", "doc_id", "text_hash", "at"])
        if done.any():
            part = rest.filter(pa.array(done))
            yield pa.RecordBatch.from_arrays([pa.array(np.ones(part.num_rows, bool)), *part.columns], names)
            rest, sig, content = rest.filter(pa.array(~done)), sig[~done], content[~done]
            if not len(sig):
                continue
        new_sig = np.r_[sig[0] != last_sig, sig[1:] != sig[:-1]]
        new = new_sig | np.r_[content[0] != last_content, content[1:] != content[:-1]]
        first_of = np.maximum.accumulate(np.where(new, np.arange(len(new)), -1))
        own = [rest.column(c) for c in ("doc_id", "text_hash", "at")]
        copy = np.ones(len(new), bool)  # of the first run of its kind: a repeated row
        for column, value in zip(own, last_first):
            x, missing = column.fill_null(0).to_numpy(), np.asarray(column.is_null())
            before = np.where(first_of < 0, 0 if value is None else value, x[first_of])
            copy &= (x == before) & (missing == np.where(first_of < 0, value is None, missing[first_of]))
        last_first = last_first if first_of[-1] < 0 else tuple(c[int(first_of[-1])].as_py() for c in own)
        group = np.cumsum(new_sig) - new_sig[0]  # 0 may continue the last batch's gram
        n = np.bincount(group, weights=new).astype(np.int64)
        if not new_sig[0]:
            n[0] += kinds
        ends_open = group[-1]
        several = (n >= 2)[group] & new
        out = []
        if held is not None and not new_sig[0] and n[0] >= 2:
            out.append(held)
        if new_sig[0] or n[0] >= 2 or ends_open != 0:
            held = None
        repeated = rest.filter(pa.array(~new & ~copy))
        first = rest.filter(pa.array(several))
        for flag, part in ((True, repeated), (False, first), *((False, h) for h in out)):
            if part.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.full(part.num_rows, flag)), *part.columns], names)
        if n[ends_open] == 1 and new[group == ends_open].any():
            held = rest.slice(int(np.flatnonzero(new & (group == ends_open))[0]), 1)
        last_sig, last_content, kinds = sig[-1], content[-1], int(min(n[ends_open], 2))


_WANTED = "hot boolean, sig long, content long, doc_id long, text_hash long, at long, data binary"


def _strings(runs: pa.Table) -> pa.RecordBatch:
    """The strings of hot runs as runs of one, named by their hash; those that repeat one of the table have no content."""
    at = runs["at"].to_numpy()
    strings = at & 255
    row = np.repeat(np.arange(len(at)), strings)
    step = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
    views = [memoryview(d) for d in runs["data"].to_pylist()]
    digest = b"".join(xxhash.xxh3_128_digest(views[r][s:s + LENGTH]) for r, s in zip(row.tolist(), step.tolist()))
    sig, content = np.frombuffer(digest, ">u8").astype(np.uint64).reshape(-1, 2).T
    at = ((at >> 8)[row] + step) << 8 | 1
    doc_id, text_hash = runs["doc_id"].combine_chunks(), runs["text_hash"].to_numpy()[row]
    no_id, plain = np.asarray(doc_id.is_null())[row], doc_id.fill_null(0).to_numpy()[row]
    by = np.lexsort((at, text_hash, plain, no_id, content, sig))
    kind = np.stack([sig[by], content[by]])
    new = np.r_[True, (kind[:, 1:] != kind[:, :-1]).any(axis=0)][:len(by)]
    first = np.empty(len(by), np.int64)
    first[by] = by[np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))]
    place = np.stack([no_id, plain, text_hash, at])
    again = (place != place[:, first]).any(axis=0)  # a repeated row of the first is left to ``_decide``
    spread = sig ^ (np.arange(len(sig), dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    sig = np.where(again, spread, sig)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.ones(len(row), bool)), pa.array(sig.view(np.int64)), pa.array(np.ascontiguousarray(content).view(np.int64), mask=again),
         doc_id.take(pa.array(row)), pa.array(text_hash), pa.array(at), pa.nulls(len(row), pa.binary())],
        ["hot", "sig", "content", "doc_id", "text_hash", "at", "data"],
    )


def _bytes_of_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per wanted run with its bytes, or per string of a hot one."""
    for batch in sliced(batches, "text"):
        wanted = batch.column("wanted")
        counts = wanted.value_lengths().to_numpy(zero_copy_only=False)
        flat = wanted.flatten()
        at = flat.field("at").to_numpy()
        start, size = at >> 8, (at & 255) + LENGTH - 1
        row = np.repeat(np.arange(batch.num_rows), counts)
        texts = texts_of(batch.column("text"))
        data = [texts[r][s:s + n] for r, s, n in zip(row.tolist(), start.tolist(), size.tolist())]
        take = pa.array(row)
        runs = pa.Table.from_arrays(
            [flat.field("hot"), flat.field("sig"), pa.nulls(len(row), pa.int64()), batch.column("doc_id").take(take),
             batch.column("text_hash").take(take), flat.field("at"), pa.array(data, pa.binary())],
            ["hot", "sig", "content", "doc_id", "text_hash", "at", "data"],
        )
        yield from runs.filter(pc.invert(runs["hot"])).to_batches()
        hot = runs.filter(runs["hot"])
        for i in range(0, hot.num_rows, _HOT_ROWS):
            yield _strings(hot.slice(i, _HOT_ROWS))


def repeated_strings(data: np.ndarray, group: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Of the strings of one length at ``start`` in ``data``, which repeat an earlier one of their group.

    Digits of 8 bytes from the most significant on; strings that are alone in
    their group after a digit are dropped before the next.
    """
    words = data.astype(np.uint64)
    for shift in (1, 2, 4):
        words = words[:-shift] << np.uint64(8 * shift) | words[shift:]
    alive = np.arange(len(start))
    for digit in [*range(0, LENGTH - 8, 8), LENGTH - 8]:
        value = words[start[alive] + digit]
        by = np.lexsort((value, group[alive]))  # stable: order inside a group stays
        g, v = group[alive][by], value[by]
        new = np.r_[True, (g[1:] != g[:-1]) | (v[1:] != v[:-1])]
        number = np.cumsum(new) - 1
        company = np.bincount(number)[number] > 1
        alive, number = alive[by][company], number[company]
        if not len(alive):
            return alive
        back = np.argsort(alive, kind="stable")
        alive = alive[back]
        group = group.copy()
        group[alive] = number[back]
    by = np.argsort(group[alive], kind="stable")
    g = group[alive][by]
    return np.sort(alive[by][np.r_[False, g[1:] == g[:-1]]])


def _sort_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans covered by repeated strings among runs sorted by gram and order."""

    def spans(table: pa.Table) -> pa.RecordBatch:
        own = [table[c] for c in ("sig", "doc_id", "text_hash", "at")]
        own = np.stack([c.fill_null(0).to_numpy() for c in own] + [np.asarray(own[1].is_null())])
        table = table.filter(pa.array(np.r_[True, (own[:, 1:] != own[:, :-1]).any(axis=0)]))  # repeated rows
        at = table["at"].to_numpy()
        strings = at & 255
        pieces = table["data"].to_pylist()
        data = np.frombuffer(b"".join(pieces), np.uint8)
        begin = np.r_[0, np.cumsum([len(p) for p in pieces])[:-1]]
        row = np.repeat(np.arange(len(at)), strings)
        step = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
        _, group = np.unique(table["sig"].to_numpy(), return_inverse=True)
        found = repeated_strings(data, group[row], begin[row] + step)
        r, s = row[found], step[found]
        new = np.r_[True, (r[1:] != r[:-1]) | (s[1:] != s[:-1] + 1)][:len(r)]
        first = np.flatnonzero(new)
        size = np.diff(np.r_[first, len(r)])
        take = pa.array(r[first])
        start = (at[r[first]] >> 8) + s[first]
        return pa.RecordBatch.from_arrays(
            [table["doc_id"].combine_chunks().take(take), table["text_hash"].combine_chunks().take(take),
             pa.array(start), pa.array(size + LENGTH - 1)],
            ["doc_id", "text_hash", "start", "size"],
        )

    held: list[pa.RecordBatch] = []
    strings = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        strings += int((batch.column("at").to_numpy() & 255).sum())
        if strings >= _BLOCK:
            table = pa.Table.from_batches(held)
            sig = table["sig"].to_numpy()
            cut = int(np.searchsorted(sig, sig[-1]))
            if cut:
                yield spans(table.slice(0, cut))
                held = table.slice(cut).combine_chunks().to_batches()
                strings = int((table["at"].to_numpy()[cut:] & 255).sum())
    if held:
        yield spans(pa.Table.from_batches(held))


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of runs whose strings are all repeated."""
    for batch in _decide(batches):
        batch = batch.filter(batch.column("repeated"))
        at = batch.column("at").to_numpy()
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), pa.array(at >> 8), pa.array((at & 255) + LENGTH - 1)],
            ["doc_id", "text_hash", "start", "size"],
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans covered by repeated strings; rows of hot grams come after the others."""

    def parts() -> Iterator[tuple[bool, pa.RecordBatch]]:
        for batch in batches:
            hot = batch.column("hot")
            for flag, part in ((False, batch.filter(pc.invert(hot))), (True, batch.filter(hot))):
                if part.num_rows:
                    yield flag, part

    for flag, own in groupby(parts(), lambda p: p[0]):
        yield from (_repeated if flag else _sort_runs)(part for _, part in own)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document without its spans."""
    for batch in sliced(batches, "text"):
        spans = batch.column("spans").to_pylist()
        out = []
        for text, own in zip(texts_of(batch.column("text")), spans):
            kept, done, removed, n_spans = [], 0, 0, 0
            end = -1
            for start, size in sorted((s["start"], s["size"]) for s in own or ()):
                if start > end:
                    kept.append(text[done:start])
                    n_spans += 1
                    removed += size
                    end = done = start + size
                elif start + size > end:
                    removed += start + size - end
                    end = done = start + size
            kept.append(text[done:])
            out.append((len(text), removed, n_spans, b"".join(kept)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([o[i] for o in out], pa.int64()) for i in range(3)),
             pa.array([o[3] for o in out], pa.binary()),
             pa.array([hashlib.sha256(o[3]).hexdigest() for o in out])],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256"],
        )


def _to_compare(texts: DataFrame, decided: DataFrame, area: StagingArea) -> DataFrame:
    """Runs of grams that have several kinds, with their bytes; of hot grams, their strings."""
    several = decided.where("not repeated")
    hot = several.groupBy("sig").count().where(F.col("count") > HOT_RUNS).select(F.col("sig").alias("hot_sig"))
    hot = area.table(hot, "hot")
    wanted = (
        several.join(F.broadcast(hot) if hot.count() <= HOT_GRAMS else hot, F.col("sig") == F.col("hot_sig"), "left")
        .withColumn("hot", F.col("hot_sig").isNotNull())
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_set(F.struct("sig", "at", "hot")).alias("wanted"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "wanted")
    )
    return (
        texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")))
        .select("doc_id", "text_hash", "text", "wanted")
        .mapInArrow(_bytes_of_runs, _WANTED)
    )


def removed_spans(texts: DataFrame, area: StagingArea) -> DataFrame:
    """doc_id, text_hash, start, size of spans to remove; they may overlap."""
    no_id = F.col("doc_id").isNull()
    runs = texts.where(F.octet_length("text") >= LENGTH).mapInArrow(_runs, _RUN)
    decided = area.table(
        runs.repartition("sig")
        .withColumn("no_id", no_id)
        .sortWithinPartitions("sig", "content", *_ORDER)
        .drop("no_id")
        .mapInArrow(_decide, _DECIDED),
        "runs",
    )
    whole = decided.where("repeated").select(
        "doc_id", "text_hash", F.shiftright("at", 8).alias("start"),
        (F.col("at").bitwiseAND(F.lit(255)) + (LENGTH - 1)).alias("size"),
    )
    parts = (
        _to_compare(texts, decided, area)
        .repartition("sig")
        .withColumn("no_id", no_id)
        .sortWithinPartitions("hot", "sig", "content", *_ORDER)
        .drop("no_id")
        .mapInArrow(_compare, "doc_id long, text_hash long, start long, size long")
    )
    return whole.unionByName(parts)


def suffix_dedup(docs: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), whole_text().alias("text"))
    spans = (
        removed_spans(texts, area)
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("start", "size")).alias("spans"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans")
    )
    return (
        texts.join(spans, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, kept_sha256 string"
        )
    )
