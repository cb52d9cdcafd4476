"""What the second review found missing."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from skyledger.llm import components, language, preference, simhash, suffixdedup, toxicity
from tests.llm.test_corpus import _got, _order, _simhash, _suffix_brute


def test_near_copies_of_the_pipeline_equal_brute_force(spark):
    """One document of every group of fingerprints that differ in at most four bits stays; others with its columns do not."""
    rnd = random.Random(11)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(5))
    texts = []
    for i in range(100):
        words = [word() for _ in range(rnd.choice([30, 120, 400]))]
        texts.append(" ".join(words))
        copy = list(words)
        for at in rnd.sample(range(len(words)), rnd.choice([0, 1, 2, 4])):
            copy[at] = word()
        texts.append(" ".join(copy))
    core = [word() for _ in range(200)]
    for i in range(60):
        copy = list(core)
        copy[rnd.randrange(200)] = word()
        texts.append(" ".join(copy))
    marks = [_simhash(t) for t in texts]
    root = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= simhash.MOST_BITS:
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    kept = corpus_pipeline.without_near_copies(spark, docs, "")
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(root))
    assert 100 < len(set(root)) < len(texts)


@pytest.mark.parametrize("most", [10_000, 1, 0])
def test_components_with_hot_centres(spark, area, monkeypatch, most):
    monkeypatch.setattr(components, "CENTRE_EDGES", 5)
    monkeypatch.setattr(components, "MOST_CENTRES", most)
    edges = [(50, i) for i in range(51, 120)] + [(i, i + 1) for i in range(200, 240)] + [(7, 7), (300, 301), (301, 300)]
    edges += [(130, i) for i in range(131, 150)] + [(149, 119)]
    table = spark.createDataFrame(edges, "a long, b long").repartition(3)
    got = {r["node"]: r["root"] for r in components.components(table, area).collect()}
    want = {n: 50 for n in [*range(50, 120), *range(130, 150)]} | {n: 200 for n in range(200, 241)} | {300: 300, 301: 300}
    assert got == want
    assert components.components(table.limit(0), area).count() == 0


def test_hot_grams_are_split_before_the_shuffle(spark, area, monkeypatch):
    """A passage in every document, in other company each time: no task gets all runs of one of its grams."""
    monkeypatch.setattr(suffixdedup, "HOT_RUNS", 20)
    rnd = random.Random(2)
    text = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    passage = text(150)
    rows = [(i if i % 7 else None, text(60) + passage + text(60)) for i in range(120)]
    rows += [(500, passage + "x" * 300), rows[0], rows[3], rows[3]]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    sent, whole = [], suffixdedup._to_compare

    def noted(*args):
        sent.append(area.table(whole(*args), "sent"))
        return sent[0]

    monkeypatch.setattr(suffixdedup, "_to_compare", noted)
    expected = _suffix_brute(rows)
    want = Counter((r[0], *expected[(_order(r), r[1].encode())]) for r in rows)
    assert _got(suffixdedup.suffix_dedup(docs, area).drop("kept")) == want
    cold = Counter(r["sig"] for r in sent[0].where("not hot").collect())
    assert max(cold.values()) <= 22 and sent[0].where("hot").count()  # 20 kinds and two repeated rows


def test_every_label_is_a_language(spark, area):
    """More labels than 64, one of which has nearly all documents."""
    rnd = random.Random(4)
    lexicon = {f"l{i:02}": ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(12)] for i in range(70)}
    text = lambda lang: " ".join(rnd.choice(lexicon[lang]) for _ in range(30))
    docs = [(lang, text(lang)) for lang in lexicon for _ in range(2)] + [("l00", text("l00")) for _ in range(3000)]
    docs = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, lang string, text string")
    pages = spark.createDataFrame(
        [(i, f"http://h{i}.org/", f"<p>{text(lang)}</p>") for i, lang in enumerate(lexicon)], "page_id long, url string, html string"
    )
    got = {r["page_id"]: r for r in language.page_languages(pages, docs, area, rows=100).collect()}
    assert [got[i]["text_lang"] for i in range(70)] == list(lexicon)
    assert [got[i]["lang"] for i in range(70)] == list(lexicon)


def test_turns_without_conversation_are_not_gathered(spark):
    turns = [(None, i, "assistant" if i % 2 else None, f"t{i}") for i in range(40)] + [(None, 1, "assistant", "t1")]
    turns += [(4, 0, "user", "q"), (4, 1, "assistant", "a"), (5, 0, "assistant", "b")]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = preference.format_preferences(preference.answers_of_neighbours(table)).collect()
    lone = Counter(r["prompt"] + r["chosen"] for r in rows if r["pair_id"] is None)
    assert lone == Counter(f"<|{r or 'unknown'}|>\n{t}<|end|>\n" for c, _, r, t in turns if c is None)
    assert all(r["rejected"] == "" for r in rows if r["pair_id"] is None)
    assert sorted(r["pair_id"] for r in rows if r["pair_id"] is not None) == [4, 5]
    assert next(r["rejected"] for r in rows if r["pair_id"] == 4) == "<|assistant|>\nb<|end|>\n"


def test_a_repeated_id_is_one_document_of_the_sample(spark, area):
    docs = spark.range(3000).select(F.lit(1).cast("long").alias("doc_id"), F.concat(F.lit("text "), "id").alias("text"))
    docs = docs.unionByName(spark.range(2, 60).select(F.col("id").alias("doc_id"), F.lit("another text").alias("text")))
    labels = spark.range(1, 60).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    labels = labels.unionByName(labels)
    sample = toxicity.fit_sample(docs, labels, area, rows=10).collect()
    assert Counter(r["toxic"] for r in sample) == {0: 10, 1: 10}
    every = toxicity.fit_sample(docs, labels, area, rows=100).collect()
    assert sum(r["text"].startswith("text ") for r in every) == 1 and len(every) < 60
