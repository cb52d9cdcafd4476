"""The corpus operators against brute force, on hand-made rows with every awkward case."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import (
    exactdedup, language, linewindows, mixing, pieces, preference, queries, simhash, suffixdedup, toxicity, winnowing,
)

SF = "/root/testdata/sf0.001"
#: Names that the operators use inside, as columns of the input.
CLASHING = ["row", "score", "mark", "bucket", "place", "copies", "starts", "lines", "h", "guest", "digest", "root"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHING)


def _texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 7)))
    line = lambda n=12: " ".join(word() for _ in range(n))
    shared = "\n".join(line() for _ in range(5))
    base = "\n".join(line() for _ in range(9))
    long = "\n".join(line(30) for _ in range(120))
    return [
        base, base, base.replace(" ", "  "), base[:-3] + "zzz", base + " one more", shared, line() + "\n" + shared,
        shared + "\n" + line() + "\n" + shared, None, "", " ", "\n\n\n\n", "a", "three short words", "Three  short\twords",
        "x" * 400, "ab" * 300, "é ß 😀 日本語 ▁ é" * 30, long, long[500:3000], "same\nsame\nsame\nsame\nsame", None, "",
        "you idiot, you id-iot. nothing else", "\x00 odd \x01 signs \t tab",
    ]


def _rows():
    rows = []
    for i, text in enumerate(_texts()):
        source = [None, "b", "a", "", "é"][i % 5]
        rows.append((100 - i * 3, text, "en", source, len(text or ""), *["c"] * len(CLASHING)))
    rows += [rows[0], rows[7], rows[7]]  # repeated rows
    rows += [(None, _texts()[0], None, None, None, *[None] * len(CLASHING)), (None, None, None, "b", None, *[None] * len(CLASHING))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _order(row):
    return (row[0] is None, row[0] or 0)


def _got(df):
    return Counter(tuple(tuple(v) if isinstance(v, list) else v for v in r) for r in df.collect())


def test_exact_dedup(docs, empty, area):
    digest = lambda t: hashlib.sha256(re.sub(r"[\x20\x09-\x0D]+", " ", t or "").encode()).hexdigest()
    groups = defaultdict(list)
    for row in _rows():
        groups[digest(row[1])].append(row[0])
    expected = Counter()
    for d, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        for n, i in enumerate(ids):
            expected[(i, ids[0], len(ids), n == 0, d)] += 1
    for counters in (1024, 2):  # with and without room for all frequent digests
        assert _got(exactdedup.exact_dedup(docs, area, counters)) == expected
    assert exactdedup.exact_dedup(empty, area).count() == 0


def test_frequent_digests_keeps_heavy_ones(spark, area):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).cast("binary").alias("digest")
    ).repartition(5)
    assert bytearray(b"hot") in [r[0] for r in exactdedup.frequent_digests(rows, 8).collect()]


def test_line_windows(docs, empty, area):
    seen, expected = {}, {}
    for key in sorted({(_order(r), r[1]) for r in _rows()}, key=lambda k: k[0]):
        lines = (key[1] or "").split("\n")
        gone = set()
        for at in range(len(lines) - 2):
            if tuple(lines[at:at + 3]) in seen:
                gone |= {at, at + 1, at + 2}
            seen.setdefault(tuple(lines[at:at + 3]), key)
        text = key[1] if not gone else "\n".join(x for i, x in enumerate(lines) if i not in gone)
        spans = sum(i - 1 not in gone for i in gone)
        expected[key] = (text, len(lines), len(gone), spans)
    want = Counter((r[0], *expected[(_order(r), r[1])]) for r in _rows())
    got = linewindows.line_dedup(docs, area).select("row.doc_id", "text", "n_lines", "n_removed", "n_spans")
    assert _got(got) == want
    kept = linewindows.without_repeated_lines(docs, area)
    assert kept.columns == docs.columns and kept.count() == len(_rows())
    assert linewindows.without_repeated_lines(empty, area).count() == 0


def _suffix_brute(rows):
    seen, result = set(), {}
    for key in sorted({(_order(r), (r[1] or "").encode()) for r in rows}):
        data, covered = key[1], bytearray(len(key[1]))
        for at in range(len(data) - 99):
            if data[at:at + 100] in seen:
                covered[at:at + 100] = b"\1" * 100
            seen.add(data[at:at + 100])
        kept = bytes(b for b, c in zip(data, covered) if not c)
        spans = (b"\0" + bytes(covered)).count(b"\0\1")
        result[key] = (len(data), sum(covered), spans, hashlib.sha256(kept).hexdigest())
    return result


def test_suffix_dedup(docs, empty, area):
    expected = _suffix_brute(_rows())
    want = Counter((r[0], *expected[(_order(r), (r[1] or "").encode())]) for r in _rows())
    assert _got(suffixdedup.suffix_dedup(docs, area).drop("kept")) == want
    assert suffixdedup.suffix_dedup(empty, area).count() == 0


def test_suffix_dedup_in_small_pieces(docs, area, monkeypatch):
    """Long texts cut into parts, and groups that go on over several batches."""
    monkeypatch.setattr(suffixdedup, "_PIECE", 700)
    for _ in range(2):
        texts = [r[1] or "" for r in _rows()]
        lots = list(suffixdedup._pieces([t.encode() for t in texts]))
        starts = {(i, o + k) for lot in lots for i, o, part in lot for k in range(len(part) - 99)}
        assert starts == {(i, k) for i, t in enumerate(texts) for k in range(len(t.encode()) - 99)}
    rows = [(i // 3, i % 2 == 0, i) for i in range(60)]
    batches = [rows[i:i + 7] for i in range(0, 60, 7)]
    import pyarrow as pa

    def batch(part):
        return pa.RecordBatch.from_arrays(
            [pa.array([r[0] // 2 for r in part]), pa.array([r[0] for r in part]), pa.array([r[2] for r in part]),
             pa.array([0] * len(part)), pa.array([r[2] << 8 | 1 for r in part])],
            ["sig", "content", "doc_id", "text_hash", "at"],
        )

    whole = [tuple(x.values()) for b in suffixdedup._decide(iter([batch(rows)])) for x in b.to_pylist()]
    parts = [tuple(x.values()) for b in suffixdedup._decide(map(batch, batches)) for x in b.to_pylist()]
    assert Counter(whole) == Counter(parts) and len(whole) == 60


def test_repeated_strings_needs_all_digits():
    data = np.frombuffer(b"a" * 99 + b"b" + b"a" * 99 + b"c" + b"a" * 99 + b"b", np.uint8)
    found = suffixdedup.repeated_strings(data, np.zeros(3, np.int64), np.array([0, 100, 200]))
    assert found.tolist() == [2]


def _simhash(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in words]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [simhash._hash(s) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, empty, area):
    marks = [(r[0], _simhash(r[1])) for r in _rows()]
    parent = list(range(len(marks)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(marks)):
        for j in range(i):
            if (marks[i][1] ^ marks[j][1]).bit_count() <= 4:
                parent[find(i)] = find(j)
    ids = defaultdict(list)
    for i, (doc, _) in enumerate(marks):
        ids[find(i)].append(doc)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in ids.items()}
    want = Counter((d, format(m, "016x"), least[find(i)]) for i, (d, m) in enumerate(marks))
    assert _got(simhash.near_duplicates(docs, area)) == want
    kept = simhash.one_of_each_group(docs, area)
    assert kept.columns == docs.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(least.values())
    assert simhash.near_duplicates(empty, area).count() == 0 == simhash.one_of_each_group(empty, area).count()


def test_anchors_meet_all_close_pairs(spark):
    rnd = random.Random(3)
    marks = []
    for _ in range(300):
        a = rnd.getrandbits(64)
        marks.append((a, a ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4)))))
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = spark.createDataFrame([(signed(m),) for pair in marks for m in pair], "mark long")
    at = defaultdict(set)
    for anchor, mark in simhash.at_anchors(spark, rows).collect():
        at[mark].add(anchor)
    assert all(at[signed(a)] & at[signed(b)] for a, b in marks)


def test_forest_links_dense_groups():
    marks = np.unique(np.array([1 << a | 1 << b for a in range(40) for b in range(40)], np.uint64))
    links = [(int(x), int(y)) for a, b in simhash._forest(marks) for x, y in zip(a, b)]
    assert len(links) == len(marks) - 1 and all((a ^ b).bit_count() <= 4 for a, b in links)


def test_mixing(docs, empty, area):
    rows = [(r[0], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")), r[3]) for r in _rows()]
    size = Counter()
    for _, n, source in rows:
        size[source] += n
    order = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    target, open_ = {}, set(order)
    while True:
        left = sum(size.values()) - sum(3 * size[s] for s in order if s not in open_)
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * size[s]}
        if not over:
            break
        open_ -= over
    target = {s: share.get(s, 3.0 * size[s]) for s in order}
    got = mixing.mix_sources(docs, area).collect()
    assert Counter((r["doc_id"], r["size"]) for r in got) == Counter((d, n) for d, n, _ in rows)
    taken = Counter()
    for r in mixing.mix_plan(docs, area).collect():
        assert r["source_size"] == size[r["source"]] and abs(r["target"] - target[r["source"]]) < 1e-6 and r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
    for s in order:  # whole copies first, then the nearest sum of documents
        copies = min(int(target[s] // size[s]), 3) if size[s] else 0
        sums = {0}
        for _, n, source in rows if copies < 3 else ():
            sums |= {a + n for a in sums} if source == s else set()
        assert abs(taken[s] - target[s]) <= min(abs(copies * size[s] + a - target[s]) for a in sums) + 1
    assert _got(mixing.mix_sources(docs.repartition(5), area)) == Counter(map(tuple, got))
    mix = mixing.mixed(docs, area)
    assert mix.columns == docs.columns
    assert sum(len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in mix.collect()) == sum(taken.values())
    assert mixing.mix_sources(empty, area).count() == 0 == mixing.mixed(empty, area).count()


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 6), min_size=1, max_size=6), st.integers(0, 200), st.sampled_from([4, 40, 1 << 16]))
def test_fit_budget_is_nearest(lengths, budget, exact):
    size = np.array(sorted(lengths))
    count = np.array([lengths[s] for s in size])
    taken = mixing.fit_budget(size, count, budget, exact)
    assert (taken >= 0).all() and (taken <= count).all()
    sums = {0}
    for s, n in lengths.items():
        sums = {a + s * k for a in sums for k in range(n + 1)}
    # The proportional share comes first, so the nearest sum is among those that contain it.
    share = np.maximum(count * budget // (size * count).sum() - 1, 0) if budget < (size * count).sum() else count
    rest = {int((share * size).sum())}
    for s, n in zip(size.tolist(), (count - share).tolist()):
        rest = {a + s * k for a in rest for k in range(n + 1)}
    off = abs(int((taken * size).sum()) - budget)
    assert off >= min(abs(a - budget) for a in sums)
    if exact == 1 << 16:
        assert off == min(abs(a - budget) for a in rest)


def _winnow(text, hashes):
    grams = [text[i:i + winnowing.GRAM] for i in range(len(text) - winnowing.GRAM + 1)] or ([text] if text else [])
    keys = [(hashes[g], -i) for i, g in enumerate(grams)]
    chosen = {min(keys[i:i + winnowing.WINDOW]) for i in range(max(1, len(keys) - winnowing.WINDOW + 1)) if keys}
    return sorted((-i, h & 0xFFFFFFFF) for h, i in chosen)


def test_winnowing(docs, empty, area, spark):
    rows = [r for r in _rows()][:-2]
    order = sorted(set((r[0], r[1] or "") for r in rows), key=lambda r: -r[0])
    nulls = [r for r in _rows() if r[0] is None]
    got = defaultdict(list)
    for r in winnowing.document_fingerprints(docs, area).collect():
        got[r["doc_id"]].append(r)
    assert sum(map(len, got.values())) == len(_rows()) and len(got[None]) == len(nulls)
    edited, following = {}, {}
    for (i, text), (_, after) in zip(order, order[1:]):
        n = len(text) // 3
        edited[i], following[i] = text[:len(text) - n] + after[:n], after
    grams = {t[i:i + 12] for t in [*edited.values(), *following.values(), *(t for _, t in order)] for i in range(max(1, len(t) - 11))}
    table = spark.createDataFrame([(g,) for g in grams], "g string").select("g", F.hash("g")).collect()
    hashes = {g: h for g, h in table}
    likeness = lambda a, b: (len(a & b) / len(a | b)) if a | b else 1.0
    for i, text in order[:-1]:
        if len(got[i]) > 1:  # repeated rows follow one another
            continue
        own, other, after = (_winnow(t, hashes) for t in (text, edited[i], following[i]))
        values = [{h for _, h in w} for w in (own, other, after)]
        row = got[i][0]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited[i].encode()).hexdigest()
        assert row["fingerprint"] == " ".join(format(p << 32 | h, "X") for p, h in own)
        assert row["edited_fingerprint"] == " ".join(format(p << 32 | h, "X") for p, h in other)
        assert row["near_edited"] == pytest.approx(likeness(values[0], values[1]))
        assert row["near_next"] == pytest.approx(likeness(values[0], values[2]))
    assert winnowing.document_fingerprints(empty, area).count() == 0


def test_pieces_round_trip_and_best_score(docs, empty):
    vocabulary = pieces.Vocabulary.from_file()
    rows = pieces.encode(docs, vocabulary).collect()
    assert Counter((r["doc_id"], r["decoded"]) for r in rows) == Counter((r[0], r[1] or "") for r in _rows())
    assert pieces.encode(empty, vocabulary).count() == 0
    model = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL_FILE)
    known = {model.id_to_piece(i).replace(pieces.MARKER, " "): vocabulary.scores[i] for i in range(259, model.vocab_size())}
    for text in [r[1][:400] for r in _rows() if r[1]]:
        whole = " " + text
        best = [0.0] + [-np.inf] * len(whole)
        for i in range(len(whole)):
            for j in range(i + 1, min(len(whole), i + 20) + 1):
                if whole[i:j] in known:
                    best[j] = max(best[j], best[i] + known[whole[i:j]])
            if whole[i] not in known:
                best[i + 1] = max(best[i + 1], best[i] + vocabulary.unknown)
        ids, _ = pieces.Encoder(vocabulary).encode([text.encode()])
        spelled = (ids >= vocabulary.bytes_from) & (ids < vocabulary.bytes_from + 256)
        starts = sum((int(i) - vocabulary.bytes_from) & 0xC0 != 0x80 for i in ids[spelled])
        assert vocabulary.scores[ids[~spelled]].sum() + starts * vocabulary.unknown == pytest.approx(best[-1])


def test_pieces_agree_with_the_library(docs):
    from sentencepiece import sentencepiece_model_pb2

    vocabulary = pieces.Vocabulary.from_file()
    proto = sentencepiece_model_pb2.ModelProto()
    with open(pieces.MODEL_FILE, "rb") as file:
        proto.ParseFromString(file.read())
    proto.trainer_spec.model_type = 1
    for i, piece in enumerate(proto.pieces):
        if piece.type == 1:
            piece.score = float(vocabulary.scores[i])
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    texts = ["the house of the rising sun", "Antidisestablishment  and\nmore", "naïve 😀 words", "x = y + 1"]
    for text in texts:
        assert pieces.Encoder(vocabulary).encode([text.encode()])[0].tolist() == library.encode(text)


def test_toxicity(docs, empty, area, spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(2, 6)))
    rows, labels = [], []
    for i in range(400):
        words, toxic = [word() for _ in range(60)], i % 5 == 0
        if toxic:
            for _ in range(3):
                words[rnd.randrange(60)] = rnd.choice(["grubwick", "grubwock", "vexhump"])
        rows.append((i, " ".join(words[:30]) + ". " + " ".join(words[30:]), "en", "s", 0, *["c"] * len(CLASHING)))
        labels.append((i, 1, int(toxic)))
    both = docs.unionByName(spark.createDataFrame([(1000 + r[0], *r[1:]) for r in rows], SCHEMA))
    known = spark.createDataFrame(
        [(1000 + i, q, t) for i, q, t in labels] + [(None, 1, 1), (1000, 1, 1), (5, 1, None), (99999, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
    got = toxicity.toxicity(both, known, area).collect()
    assert len(got) == len(_rows()) + 400 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    held = [(labels[i][2], score[1000 + i]) for i in range(400) if zlib.crc32(str(1000 + i).encode()) % 4 == 2]
    assert min(s for y, s in held if y) > max(s for y, s in held if not y)
    model = toxicity.fit(both, known, area)
    plain, gapped, other = model.margins(["grubwick", "grub-wick", "saloner"])
    assert plain > 0.5 and gapped > 0.5 and other < 0.3
    assert toxicity.toxicity(empty, known, area).count() == 0
    nothing = toxicity.toxicity(docs, known.limit(0), area).collect()
    assert {r["score"] for r in nothing} == {0.0}
    kept = toxicity.score(docs, model).select("row.*")
    assert kept.columns == docs.columns and kept.count() == len(_rows())


def test_language(spark, area):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html", F.lit("x").alias("host"), F.lit(1).alias("p"))
    odd = spark.createDataFrame(
        [(None, None, None, "x", 1), (7, "nonsense", "", "x", 1), (7, "nonsense", "", "x", 1), (8, "http://a.b.de", "<html lang=de>" + "ü" * 50000, "x", 1)],
        "page_id long, url string, html string, host string, p int",
    )
    got = language.page_languages(pages.unionByName(odd), docs, area).collect()
    assert len(got) == pages.count() + 4 and all(0 <= r["probability"] <= 1.0000001 for r in got)
    declared = [r for r in got if r["declared"]]
    assert sum(r["lang"] == r["declared"] for r in declared) > 0.95 * len(declared)
    assert next(r for r in got if r["host"] == "a.b.de")["suffix"] == "de"
    assert language.page_languages(pages.limit(0), docs, area).count() == 0
    assert {r["lang"] for r in language.page_languages(pages, docs.limit(0), area).collect()} == {None}


def test_preferences(spark):
    turns = lambda *t: [{"role": r, "text": x} for r, x in t]
    a = turns(("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "fine"))
    b = turns(("user", "hi"), ("assistant", "yes"), ("user", "more"), ("assistant", "bad"), ("user", "why"))
    pairs = spark.createDataFrame(
        [(1, a, b), (2, a, a), (3, a, None), (4, None, None), (5, a, a[:2])],
        "pair_id long, chosen array<struct<role:string,text:string>>, rejected array<struct<role:string,text:string>>",
    )
    got = {r["pair_id"]: r for r in preference.format_preferences(pairs).collect()}
    prompt = "<|user|>\nhi<|end|>\n<|assistant|>\nyes<|end|>\n<|user|>\nmore<|end|>\n"
    assert got[1]["n_prompt_turns"] == 3 and got[1]["prompt"] == prompt
    assert got[1]["chosen"] == "<|assistant|>\nfine<|end|>\n"
    span = got[1]["rejected_mask"][0]
    assert got[1]["rejected"][span["start"]:span["stop"]] == "bad<|end|>\n" and len(got[1]["rejected_mask"]) == 1
    assert got[2]["chosen"] == got[2]["rejected"] == "" and got[2]["n_prompt_turns"] == 4
    assert got[3]["prompt"] == "" and got[3]["rejected"] == "" and len(got[3]["chosen_mask"]) == 2
    assert got[4]["n_prompt_turns"] == 0 and got[5]["n_prompt_turns"] == 2 and got[5]["rejected"] == ""
    table = spark.createDataFrame(
        [(2, 0, "user", "q", "x"), (2, 1, "assistant", None, "x"), (2, 1, "assistant", None, "x"), (3, 0, None, "q", "x"),
         (None, None, None, None, None), (8, 0, "assistant", "only", "x")],
        "conv_id long, turn long, role string, text string, answer string",
    )
    rows = {r["pair_id"]: r for r in preference.format_preferences(preference.answers_of_neighbours(table)).collect()}
    assert set(rows) == {2, 3, None, 8} and rows[2]["chosen"] == "<|assistant|>\n<|end|>\n"
    assert rows[3]["prompt"] == "<|unknown|>\nq<|end|>\n" and rows[8]["rejected"] == ""
    assert preference.format_preferences(preference.answers_of_neighbours(table.limit(0))).count() == 0


def test_pipeline_stages(docs, empty, spark, area):
    """Every stage keeps the columns of documents and works on what the one before kept."""
    for source in (docs, empty):
        current = source
        for name, stage in corpus_pipeline.STAGES[:-1]:
            result = area.table(stage(spark, current, SF), name)
            assert result.columns == docs.columns
            if name in ("toxicity", "near_duplicates"):
                assert result.count() <= current.count()
            current = result
        encoded = area.table(corpus_pipeline.STAGES[-1][1](spark, current, SF), "encoded")
        left = Counter((r["doc_id"], r["text"] or "") for r in current.collect())
        assert Counter((r["doc_id"], r["decoded"]) for r in encoded.collect()) == left


def test_pipeline_run_equals_its_stages(spark, area):
    current = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        current = area.table(stage(spark, current, SF), name)
    assert _got(corpus_pipeline.run(spark, SF)) == _got(current)


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracle(spark, name):
    from tools.compare import compare, connect

    assert compare(spark, connect(SF), SF, name)[2] == []
