"""Collocations, benchmark passages and token alignment against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest
import sentencepiece
import tokenizers
from pyspark.sql import functions as F

from skyledger.llm import alignment, collocations, decontaminate

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside, as columns of the input.
CLASHING = ["words", "least", "window", "wid", "pair", "place", "shard", "h", "phrase", "a", "documents"]
SCHEMA = "doc_id long, text string, lang string, " + ", ".join(f"{c} string" for c in CLASHING)


def _docs(spark, texts, parts=3):
    rows = [(i if i % 7 else None if i == 7 else i, t, lang, *["x"] * len(CLASHING)) for i, (t, lang) in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def _got(df):
    return Counter(map(tuple, df.collect()))


def _lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# -- collocations ---------------------------------------------------------------------


def _phrase_texts():
    rnd = random.Random(3)
    vocabulary = ["the", "new", "York", "É", "été", "a" * 7, "b" * 8, "c" * 9, "d" * 25, "x", "日本"]
    sentence = lambda: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(0, 9)))
    texts = [(rnd.choice([". ", "!\n", ";", "\x0b", ":\t"]).join(sentence() for _ in range(rnd.randint(1, 6))), rnd.choice(["en", "fr", None]))
             for _ in range(120)]
    return texts + [
        (None, "en"), ("", None), (" ", "en"), ("..", "en"), ("the  new\tyork " * 30, "en"), ("x x x x x x", "und"), ("same", ""),
        *[("THE new york. the new york", "fr")] * 12, (" ".join(["long"] * 3000), "de"),
    ]


def _collocations(rows, support, top):
    counts, words = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            words[lang] += len(w)
            for n in (1, 2, 3):
                counts[lang].update(tuple(w[i:i + n]) for i in range(len(w) - n + 1))
    out = Counter()
    for lang, of in counts.items():
        found = []
        for phrase, a in of.items():
            if len(phrase) == 1 or a < support:
                continue
            if any(len(o) > len(phrase) and 100 * b >= 50 * a and any(o[i:i + len(phrase)] == phrase for i in range(len(o)))
                   for o, b in of.items() if b >= support):
                continue
            score, _, l, r = min((1_000_000 * a * a // (of[phrase[:k]] * of[phrase[k:]]), k, of[phrase[:k]], of[phrase[k:]])
                                 for k in range(1, len(phrase)))
            found.append((-score, -a, " ".join(phrase).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            out[lang, rank, phrase.decode(), -a, l, r, words[lang], -score] += 1
    return out


@pytest.mark.parametrize("shards,support,top", [(3, 10, 2000), (1, 10, 5), (5, 12, 2000), (20, 10, 2000), (3, 2, 40)])
def test_collocations(spark, area, shards, support, top):
    texts = _phrase_texts()
    got = _got(collocations.collocations(_docs(spark, texts), area, shards, support, top))
    assert got and got == _collocations(texts, support, top)


def test_collocations_cut_long_texts_and_full_bitmaps(spark, area, monkeypatch):
    """Small lots and a bitmap without a free slot change nothing."""
    texts = _phrase_texts()
    for name, value in {"_LOT": 64, "_COUNTED_LOT": 64, "MOST_BITS": 7, "LEAST_BITS": 7, "_ENTRIES_IN_A_TASK": 8}.items():
        monkeypatch.setattr(collocations, name, value)
    assert b"".join(collocations._parts(b"ab, c" * 100 + b"x" * 500 + b".y")) == b"ab, c" * 100 + b"x" * 500 + b".y"
    langs, shards = [lang or "und" for _, lang in texts], [i % 3 for i in range(len(texts))]
    columns = [pa.array([t for t, _ in texts], pa.string()), pa.array(langs), pa.array(shards)]
    batch = pa.RecordBatch.from_arrays(columns, ["text", "lang", "shard"])
    slots = collocations.Slots(spark.range(2000).select(F.xxhash64("id").alias("h")), "h")
    rows = Counter()
    for found in collocations._exactly(slots)([batch]):
        for row in found.to_pylist():
            rows[row["lang"], row["phrase"], row["n"]] += row["times"]
    every = Counter()
    for text, lang in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", _lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for n in (1, 2, 3):
                every.update((lang or "und", " ".join(w[i:i + n]), n) for i in range(len(w) - n + 1))
    assert {k: v for k, v in rows.items() if k[2]} == dict(every)


def test_collocations_of_nothing(spark, area):
    assert collocations.collocations(_docs(spark, [("", None)]).limit(0), area).count() == 0
    assert collocations.collocations(_docs(spark, [(None, None), ("once only", "en")]), area).count() == 0


# -- benchmark passages ------------------------------------------------------------------


def _items():
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdé1") for _ in range(rnd.randint(1, 3)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(10, 40)))) for i in range(25)]
    shared = " ".join(word() for _ in range(14))
    items += [(30, shared + " one"), (31, "two " + shared), (31, shared + " again"), (None, shared), (40, "Only Three WORDS"),
              (41, "single"), (42, None), (43, " ..."), (44, "a a a a a a a a a a a a"), (45, "nine words are one less than ten of them")]
    return items


def _leaking(items):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdé1") for _ in range(rnd.randint(1, 3)))
    texts = []
    for n in range(80):
        parts = []
        for _ in range(rnd.randint(1, 4)):
            parts.append(" ".join(word() for _ in range(rnd.randint(0, 30))))
            w = re.findall(r"\S+", items[rnd.randrange(len(items))][1] or "")
            size = rnd.choice([3, 9, 10, 11, 12, 40])
            at = rnd.randint(0, max(0, len(w) - size))
            parts.append(rnd.choice([" ", ", ", "\n-"]).join(w[at:at + size]).upper() if rnd.random() < 0.3 else " ".join(w[at:at + size]))
        texts.append(" ".join(parts))
    return texts + [None, "", "--", "a " * 3000, "only, three words. only three", "Single", texts[0], "nine words are one less than ten of", "É é " * 20]


def _contamination(texts, items):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", _lower(t))
    windows = defaultdict(set)
    for item, text in items:
        w = split(text)
        size = min(len(w), 10)
        for i in range(len(w) - size + 1):
            if size:
                windows[tuple(w[i:i + size])].add("" if item is None else str(item))
    out = []
    for text in texts:
        w, hit, found = split(text), set(), set()
        for size in {len(k) for k in windows}:
            for i in range(len(w) - size + 1):
                if tuple(w[i:i + size]) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[tuple(w[i:i + size])]
        out.append((len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


@pytest.mark.parametrize("broadcast", [500_000, 0])
def test_contamination(spark, area, monkeypatch, broadcast):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", broadcast)
    items, texts = _items(), _leaking(_items())
    ids = [None if i % 9 == 0 else i // 2 for i in range(len(texts))]
    docs = spark.createDataFrame([(i, t, "en", *["x"] * len(CLASHING)) for i, t in zip(ids, texts)], SCHEMA).repartition(3)
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    want = Counter((i, *r) for i, r in zip(ids, _contamination(texts, items)))
    got = _got(decontaminate.contamination(docs, benchmark, area))
    assert got == want and sum(r[-1] for r in got.elements()) > 40
    assert _got(decontaminate.contamination(docs, benchmark.limit(0), area)) == Counter(
        (i, *r) for i, r in zip(ids, _contamination(texts, [])))
    assert decontaminate.contamination(docs.limit(0), benchmark, area).count() == 0


def test_windows_keep_their_least_gram_rightmost_on_ties(spark):
    words = [f"{'ab'[i % 2]}" for i in range(13)]  # two kinds of grams, each many times
    texts = spark.createDataFrame([(1, words)], "doc_id long, words array<string>")
    kept = [r["at"] for r in decontaminate.kept_grams(texts).orderBy("at").collect()]
    assert kept in ([5, 7, 9], [6, 8])


def test_no_python_in_the_search_for_passages(spark, area):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    plan = decontaminate.contamination(docs, items, area)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


# -- alignment -----------------------------------------------------------------------------


def _alignment(texts):
    a_side = tokenizers.Tokenizer.from_file(alignment.BYTE_FILE)
    a_side.encode_special_tokens = True
    b_side = sentencepiece.SentencePieceProcessor(model_file=alignment.PIECE_FILE)
    letters = alignment._byte_letters()
    rows, documents = [], Counter()
    for text in texts:
        text = text or ""
        a = a_side.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_side.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in a_side.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:-1], 16)]) if re.fullmatch("<0x..>", p) else p.replace("▁", " ").encode() for p in map(b_side.id_to_piece, b)]
        if not text or b"".join(a_bytes) != (" " + text).encode() or b"".join(b_bytes) != (" " + text).encode():
            rows.append(None)
            continue
        spans = lambda parts: [(sum(map(len, parts[:i])), sum(map(len, parts[:i + 1]))) for i in range(len(parts))]
        a_spans, b_spans = spans(a_bytes), spans(b_bytes)
        links = [(x, y) for x, (s, e) in zip(a, a_spans) for y, (p, q) in zip(b, b_spans) if max(s, p) < min(e, q)]
        cuts, groups = sorted({e for _, e in a_spans} & {e for _, e in b_spans}), []
        for low, high in zip([0, *cuts], cuts):
            groups.append(",".join(str(x) for x, (s, e) in zip(a, a_spans) if low <= s and e <= high) + "|" +
                          ",".join(str(y) for y, (s, e) in zip(b, b_spans) if low <= s and e <= high))
        rows.append((len(a), len(b), groups, links))
        documents.update(set(links))
    highest = Counter()
    for (x, _), n in documents.items():
        highest[x] = max(highest[x], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else (
        r[0], r[1], len(r[2]), len(r[3]), sum(documents[p] == highest[p[0]] for p in r[3]), sum(documents[p] for p in r[3]),
        hashlib.sha256(";".join(r[2]).encode()).hexdigest()) for r in rows]


@pytest.mark.parametrize("frequent", [alignment.FREQUENT, 20, 1])
def test_alignment(spark, area, frequent):
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1200").orderBy("doc_id").limit(25).collect()]
    texts += [
        None, "", " ", "  two  spaces ", "<|endoftext|> and </s> <unk>", "▁ marker", "é ß 😀 日本語 ñandú", "x" * 700, "\x00\x01 odd", "tab\tand\r\nend",
        "Unbelievable internationalization", "don't can't we'll", "123456 78", texts[0], texts[0], "﻿mark", "é combining",
    ]
    docs = _docs(spark, [(t, "en") for t in texts])
    ids = [i if i % 7 else None if i == 7 else i for i in range(len(texts))]
    got = _got(alignment.alignment(docs, area, frequent))
    assert got == Counter((i, *r) for i, r in zip(ids, _alignment(texts)))


def test_both_encoders_of_a_give_the_same_ids(spark):
    """Every segment of the documents, and random ones of Latin letters, signs and spaces."""
    with open(alignment.BYTE_FILE, encoding="utf-8") as a, open(alignment.PIECE_FILE, "rb") as b:
        both = alignment.Tokenizers(a.read(), b.read())
    texts = [r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]
    segments = {s if s[:1] == "\n" else " " + s for t in texts for s in (t or "x").replace("\n", " \n").split(" ")}
    rnd = random.Random(6)
    letters = [chr(c) for c in range(32, 0x250) if chr(c).isprintable()] + ["\n", "\t", " ", " "] * 20
    segments |= {" " + "".join(rnd.choice("etaoinshrdlu" * 60 + "".join(letters)) for _ in range(rnd.randint(1, 15))) for _ in range(20000)}
    segments |= {rnd.choice(" \n") + rnd.choice("aeEtT.-_=0") * rnd.randint(1, 40) for _ in range(300)}
    segments = sorted(s for s in segments if max(s) < alignment._BEYOND_LATIN)
    found = both.a.encode_batch_fast(segments, add_special_tokens=False)
    assert [e.ids for e in found] == [both.a_latin.encode_ordinary(s) for s in segments] == both._encode_a(segments)


def test_alignment_of_nothing(spark, area):
    assert alignment.alignment(_docs(spark, [("x", "en")]).limit(0), area).count() == 0
    assert _got(alignment.alignment(_docs(spark, [(None, "en")]), area)) == Counter([(0, 0, 0, 0, 0, 0, 0, "")])
