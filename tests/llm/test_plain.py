"""Kernel, evidence and text model against plain loops."""

import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest

from skyledger.llm import language, queries, suffixdedup, toxicity


def _plain_kernel(a, b):
    def parts(word):
        found = defaultdict(float)
        for i in range(len(word)):
            for middle, last in toxicity._SPANS:
                if i + last < len(word):
                    found[word[i], word[i + middle], word[i + last]] += toxicity._DECAY ** (last - 2)
        return found

    x, y = parts(a), parts(b)
    norm = math.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    like = (sum(v * y[k] for k, v in x.items()) / norm) ** 2 if norm else 0.0
    return like if like >= toxicity._FAINT else 0.0


def test_kernel_equals_plain_subsequences():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdeé日") for _ in range(rnd.randint(1, 14)))
    landmarks = list(dict.fromkeys(word() for _ in range(40)))
    words = [word() for _ in range(150)] + [w[:2] + "x" + w[2:] for w in landmarks] + ["", "a", "ab", "abc", "aaaaaaaa"] + landmarks
    got = toxicity.WordKernel(landmarks)(words)
    want = np.array([[_plain_kernel(w, m) for m in landmarks] for w in words])
    # A likeness at the very threshold may fall on either side of it.
    sure = np.abs(want - toxicity._FAINT) > 1e-9
    assert np.allclose(got[sure], want[sure], atol=1e-9) and (want > 0).sum() > 100


def _normal(log):
    top = max(log)
    e = [math.exp(x - top) for x in log]
    return [x / sum(e) for x in e]


def _plain_fusion(rows, langs):
    n, se, sh = len(langs), language._SMOOTH_EVIDENCE, language._SMOOTH_HOST

    def sums(ps, key):
        found = defaultdict(lambda: [0.0] * n)
        for r, p in zip(rows, ps):
            found[key(r)] = [a + b for a, b in zip(found[key(r)], p)]
        return found

    p = [_normal(r[5]) for r in rows]
    total = sums(p, lambda r: 0)[0]
    own = []
    tables = [sums(p, lambda r, c=c: r[c]) for c in (1, 2)]
    for r in rows:
        log = list(r[5])
        for c, table in zip((1, 2), tables):
            if r[c] != "":
                log = [x + math.log((s + (se if r[c] == lang else 0) + se / n) / (t + 2 * se))
                       for x, s, t, lang in zip(log, table[r[c]], total, langs)]
        own.append(log)
    p = [_normal(x) for x in own]
    total = sums(p, lambda r: 0)[0]
    base = [(x + 1) / (sum(total) + n) for x in total]
    hosts, domains = sums(p, lambda r: r[3]), sums(p, lambda r: r[4])

    def smoothed(s, mine, above):
        rest = [max(a - b, 0.0) for a, b in zip(s, mine)]
        return [(x + sh * a) / (sum(rest) + sh) for x, a in zip(rest, above)]

    out = []
    for r, log, mine in zip(rows, own, p):
        prior = smoothed(hosts[r[3]], mine, smoothed(domains[r[4]], mine, base))
        out.append((r[0], _normal([x + math.log(q) for x, q in zip(log, prior)])))
    return out


@pytest.mark.parametrize("frequent", [language.MOST_KEYS, 1, 0])
def test_evidence_is_fused_as_plain_bayes_would(spark, area, monkeypatch, frequent):
    """A hundred pages, a third of them of one host; joined where they lie, by shuffling, and both."""
    monkeypatch.setattr(language, "MOST_KEYS", frequent)
    rnd, langs = random.Random(2), ["de", "en", "fr"]
    rows = []
    for i in range(100):
        host = "big.org" if i % 3 == 0 else rnd.choice(["", "a.x.org", "b.x.org", "c.de"])
        domain = ".".join(host.split(".")[-2:])
        text = [0.0, 0.0, 0.0] if i % 10 == 0 else [-rnd.random() * 9 for _ in langs]
        rows.append((i % 60, rnd.choice(["", "de", "en", "xx"]), rnd.choice(["", "de", "fr"]), host, domain, text))
    table = spark.createDataFrame(rows, "page_id long, declared string, suffix string, host string, domain string, text_log array<double>")
    fused = language.fuse(table.repartition(3), langs, area).select("page_id", "p").collect()
    key = lambda page, p: (page, *[round(x, 9) for x in p])
    assert Counter(key(r["page_id"], r["p"]) for r in fused) == Counter(key(*r) for r in _plain_fusion(rows, langs))


def test_text_model_equals_plain_counts(spark):
    rnd = random.Random(5)
    word = lambda letters: "".join(rnd.choice(letters) for _ in range(rnd.randint(1, 6)))
    docs = [(i, lang, " ".join(word(letters) for _ in range(30))) for i, (lang, letters) in enumerate(
        [("l1", "abcdé"), ("l2", "cdefg"), ("l3", "xyzab")] * 20)]
    docs += [(None, "l1", None), (99, None, "unlabelled"), (98, "l4", "")]
    langs, model = language.fit_text(spark.createDataFrame(docs, "doc_id long, lang string, text string"))
    assert langs == ["l1", "l2", "l3", "l4"]
    counts = {lang: Counter() for lang in langs}
    for _, lang, text in docs:
        if lang:
            counts[lang].update(language._slots((text or "").encode()).tolist())
    for text in ("abc dé", "xyz xyz", "", "Ünrelated"):
        slots = language._slots(text.encode())
        want = [sum(math.log((counts[lang][s] + 0.5) / (sum(counts[lang].values()) + 0.5 * language._SLOTS)) for s in slots.tolist())
                for lang in langs]
        assert np.allclose(model.log_likelihood(slots), want)


def test_equal_posteriors_go_to_the_first_language(spark, area):
    docs = spark.createDataFrame([(1, "b", "same text"), (2, "a", "same text")], "doc_id long, lang string, text string")
    pages = spark.createDataFrame([(1, None, "<p>same text</p>"), (2, None, None)], "page_id long, url string, html string")
    got = language.page_languages(pages, docs, area).collect()
    assert [(r["lang"], round(r["probability"], 9)) for r in got] == [("a", 0.5), ("a", 0.5)]


def test_hot_grams_beyond_the_broadcast_are_shuffled(spark, area, monkeypatch):
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = text(150)
    docs = spark.createDataFrame([(i, text(60) + passage + text(60)) for i in range(60)], "doc_id long, text string").repartition(3)
    monkeypatch.setattr(suffixdedup, "HOT_RUNS", 20)
    rows = lambda: sorted(map(tuple, suffixdedup.suffix_dedup(docs, area).drop("kept").collect()))
    want = rows()
    monkeypatch.setattr(suffixdedup, "HOT_GRAMS", 0)
    assert rows() == want and sum(r[2] for r in want) >= 59 * 150


def test_sql_of_preferences_knows_turns_without_conversation(spark, area):
    turns = [(None, 1, "assistant", "é"), (None, 1, "assistant", "é"), (None, 2, None, None), (None, None, "user", "q")]
    turns += [(2, 0, "user", "q"), (2, 1, "assistant", "a"), (3, 0, "user", "q"), (3, 1, "assistant", "b"), (8, 0, "user", "x")]
    path = area.path("tables")
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{path}/conversations.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{path.removeprefix('file:')}/conversations.parquet/*.parquet'")
    got = queries.op1_preferences(spark, path)
    names = sorted(got.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op1_preferences']})").fetchall()
    assert Counter(map(tuple, got.select(names).collect())) == Counter(want) and len(want) == 7
