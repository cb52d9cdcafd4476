"""Language of web pages from several kinds of evidence.

A page's language is the one with the highest posterior over

* the text: byte trigrams, learned from documents with a language label,
* the language that the markup declares,
* the address suffix: country code of the host or a two-letter path head,
* the host: how its other pages turned out, smoothed towards its domain, and
  the domain towards all pages.

The last three are counted over all pages by grouped aggregation, first with the
text's posterior, then with the posterior so far; a page's own count is taken
out of its host's and domain's, but not out of those of its declaration and
suffix, which are smoothed by what they say themselves. A text's confidence
stops growing at ``_ENOUGH`` trigrams. Counts are sums of probabilities per host,
domain, declaration and suffix, pre-aggregated before the shuffle.

The text model is fitted on all labelled documents of a language, or about
``FIT_ROWS`` of them chosen by a hash of their id (of their text if that is
missing). Every label is a language. Sums are grouped as long rows of key and
language; a page's evidence has one place per language.

Defined results: a page without html has no text evidence, one without address
the empty host. Without labelled documents there is no language (null) and the
probability is 0. Equal posteriors go to the first language in code point order.
Repeated rows are separate pages. An empty table gives an empty result.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import sliced, texts_of
from skyledger.staging import StagingArea

#: Documents per language that the text model is fitted on.
FIT_ROWS = 5_000
#: Languages counted at a time in one task.
_HELD = 64
_SLOTS = 1 << 15
#: Trigrams beyond this many add nothing to the confidence.
_ENOUGH = 120
#: Weight of the level above when a host or domain is smoothed, and of a flat likelihood.
_SMOOTH_HOST, _SMOOTH_EVIDENCE = 3.0, 2.0
#: Hosts and domains whose sums are broadcast.
MOST_KEYS = 256
_HIDDEN = re.compile(r"(?is)<(script|style|nav)\b.*?</\1\s*>|<!--.*?-->")
_TAG = re.compile(r"(?s)<[^>]*>")


def visible_text(page: str) -> str:
    return html.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", page)))


def _slots(text: bytes) -> np.ndarray:
    """Slots of the text's letter trigrams."""
    data = np.frombuffer(b" " + text + b" ", np.uint8).astype(np.uint32)
    letter = ((data | 32) >= 97) & ((data | 32) <= 122) | (data >= 128)
    data = np.where(letter, np.where(data < 128, data | 32, data), 32)
    code = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    return ((code[data[1:-1] != 32] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[str, np.ndarray] = {}

    def counted() -> Iterator[pa.RecordBatch]:
        for lang, counts in held.items():
            slot = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(slot), pa.string()), pa.array(slot), pa.array(counts[slot])], ["lang", "slot", "n"]
            )
        held.clear()

    for batch in sliced(batches, "text"):
        for lang, text in zip(batch.column("lang").to_pylist(), texts_of(batch.column("text"))):
            if lang not in held and len(held) == _HELD:
                yield from counted()
            held.setdefault(lang, np.zeros(_SLOTS, np.int64))
            held[lang] += np.bincount(_slots(text), minlength=_SLOTS)
    yield from counted()


class TextModel:
    """Log probabilities of slots under each language; only slots that a language has are kept."""

    def __init__(self, n_langs: int, lang: np.ndarray, slot: np.ndarray, n: np.ndarray):
        total = np.bincount(lang, n, n_langs) + 0.5 * _SLOTS
        self.unseen = np.log(0.5 / total)
        by = np.argsort(slot, kind="stable")
        self.lang, self.gain = lang[by].astype(np.int32), np.log((n[by] + 0.5) / 0.5)
        self.begin = np.searchsorted(slot[by], np.arange(_SLOTS + 1))

    def log_likelihood(self, slots: np.ndarray) -> np.ndarray:
        slot, times = np.unique(slots, return_counts=True)
        size = self.begin[slot + 1] - self.begin[slot]
        at = np.arange(size.sum()) + np.repeat(self.begin[slot] - np.cumsum(size) + size, size)
        return len(slots) * self.unseen + np.bincount(self.lang[at], self.gain[at] * np.repeat(times, size), len(self.unseen))


def fit_text(docs: DataFrame, rows: int = FIT_ROWS) -> tuple[list[str], TextModel]:
    """Languages in order and the model of their texts, from about ``rows`` documents of each."""
    labelled = docs.where(F.col("lang").isNotNull())
    found = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(found)
    number = {lang: i for i, lang in enumerate(langs)}
    limits = docs.sparkSession.createDataFrame(
        [(lang, int(min(1.0, rows / n) * (1 << 30))) for lang, n in found.items()], "lang string, most long"
    )
    place = F.pmod(F.xxhash64("doc_id", F.when(F.col("doc_id").isNull(), F.col("text"))), F.lit(1 << 30))
    sample = labelled.join(F.broadcast(limits), "lang").where(place < F.col("most"))
    grouped = sample.select("lang", "text").mapInArrow(_count, "lang string, slot long, n long")
    table = grouped.groupBy("lang", "slot").agg(F.sum("n").alias("n")).toPandas()
    lang = np.array([number[x] for x in table["lang"]], np.int64)
    return langs, TextModel(len(langs), lang, table["slot"].to_numpy(np.int64), table["n"].to_numpy(np.int64))


def _text_evidence(model: TextModel):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "html"):
            out = []
            for page in batch.column("html").to_pylist():
                slots = _slots(visible_text(page or "").encode())
                value = model.log_likelihood(slots) * min(1.0, _ENOUGH / max(1, len(slots)))
                out.append((value - value.max()).tolist() if len(value) else [])
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("page_id", "declared", "suffix", "host", "domain")),
                 pa.array(out, pa.list_(pa.float64()))],
                ["page_id", "declared", "suffix", "host", "domain", "text_log"],
            )

    return run


def addressed(pages: DataFrame) -> DataFrame:
    """page_id, html, and what address and markup say."""
    address = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(address, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    ending = F.regexp_extract(host, r"\.([a-z]{2})$", 1)
    path_head = F.lower(F.regexp_extract(address, r"^[^:]+://[^/?#]*/([a-zA-Z]{2})(?:[/?#-]|$)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce("html", F.lit("")), r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1))
    return pages.select(
        "page_id", "html", declared.alias("declared"),
        F.when(ending != "", ending).otherwise(path_head).alias("suffix"), host.alias("host"),
        F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1).alias("domain"),
    )


def _normal(log: Column) -> Column:
    """Probabilities from log values."""
    top = F.get(F.transform(F.array(F.array_max(log)), lambda m: F.transform(log, lambda x: F.exp(x - m))), F.lit(0))
    return F.get(
        F.transform(F.array(top), lambda e: F.transform(
            e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b))),
        F.lit(0),
    )


def _long_sums(rows: DataFrame, *by: str) -> DataFrame:
    """Per key and place of a language, the sum of its probability."""
    return rows.select(*by, F.posexplode("p").alias("i", "x")).groupBy(*by, "i").agg(F.sum("x").alias("x"))


def _sums(rows: DataFrame, by: str) -> DataFrame:
    """Per key, the sums of all languages in order."""
    return _long_sums(rows, by).groupBy(by).agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("sums")).select(
        by, F.col("sums.x").alias("sums")
    )


def _with_sums(rows: DataFrame, by: str, area: StagingArea) -> DataFrame:
    """Adds ``<by>_sums``; the ``MOST_KEYS`` keys with most rows are joined where the rows lie, the others by shuffling."""
    sums = area.table(_sums(rows, by).select(F.col(by).alias(f"_{by}"), F.col("sums").alias(f"{by}_sums")), f"{by}-sums")
    most = rows.groupBy(F.col(by).alias(f"_{by}")).count().orderBy(F.desc("count"), f"_{by}").limit(MOST_KEYS)
    frequent = F.broadcast(area.table(sums.join(most.drop("count"), f"_{by}"), f"frequent-{by}"))
    same = F.col(by) == F.col(f"_{by}")
    rest = rows.join(frequent, same, "left_anti").join(sums, same)
    return rows.join(frequent, same).unionByName(rest).drop(f"_{by}")


def _total(rows: DataFrame, n: int) -> list[float]:
    """The sum of every language's probability over all rows."""
    found = {r["i"]: r["x"] for r in _long_sums(rows).collect()}
    return [found.get(i, 0.0) for i in range(n)]


def _likelihood(rows: DataFrame, column: str, langs: list[str], everything: list[float]) -> DataFrame:
    """``column`` and the log likelihood of its value under each language; what it says by itself weighs in."""
    own = F.transform(F.lit(langs), lambda lang: F.when(F.col(column) == lang, _SMOOTH_EVIDENCE).otherwise(0.0))
    flat = _SMOOTH_EVIDENCE / len(langs)
    totals = F.lit([float(x) + 2 * _SMOOTH_EVIDENCE for x in everything])
    sums = _sums(rows, column)
    log = F.transform(
        F.arrays_zip(sums["sums"].alias("s"), own.alias("o"), totals.alias("t")),
        lambda z: F.log((z["s"] + z["o"] + flat) / z["t"]),
    )
    # A missing declaration or suffix says nothing.
    return sums.where(F.col(column) != "").select(F.col(column).alias(f"_{column}"), log.alias(f"{column}_log"))


def fuse(rows: DataFrame, langs: list[str], area: StagingArea) -> DataFrame:
    """Adds the posterior ``p`` (in the order of ``langs``) to rows with text_log, declared, suffix, host, domain."""
    n = len(langs)
    zero = F.array_repeat(F.lit(0.0), n)
    rows = area.table(rows.withColumn("p", _normal(F.col("text_log"))), "text-posterior")
    everything = _total(rows, n)

    def add(*columns: str) -> Column:
        total = F.col("text_log")
        for c in columns:
            total = F.zip_with(total, F.coalesce(F.col(c), zero), lambda a, b: a + b)
        return total

    for column in ("declared", "suffix"):
        table = _likelihood(rows, column, langs, everything)
        rows = rows.join(table, F.col(column) == F.col(f"_{column}"), "left").drop(f"_{column}")
    rows = area.table(
        rows.withColumn("own_log", add("declared_log", "suffix_log")).withColumn("p", _normal(F.col("own_log")))
        .select("page_id", "declared", "suffix", "host", "domain", "text_log", "own_log", "p"),
        "own-posterior",
    )
    everything = _total(rows, n)
    total = sum(everything) + n
    base = F.lit([(x + 1.0) / total for x in everything])
    joined = _with_sums(_with_sums(rows, "host", area), "domain", area)

    def smoothed(sums: Column, above: Column) -> Column:
        """Counts without the page's own, smoothed towards ``above``."""
        rest = F.zip_with(sums, F.col("p"), lambda s, p: F.greatest(s - p, F.lit(0.0)))
        size = F.aggregate(rest, F.lit(_SMOOTH_HOST), lambda a, b: a + b)
        return F.zip_with(rest, above, lambda r, a: (r + _SMOOTH_HOST * a) / size)

    by_domain = joined.withColumn("domain_p", smoothed(F.col("domain_sums"), base))
    by_host = by_domain.withColumn("prior", smoothed(F.col("host_sums"), F.col("domain_p")))
    return by_host.withColumn("p", _normal(F.zip_with("own_log", "prior", lambda o, q: o + F.log(q))))


def page_languages(pages: DataFrame, docs: DataFrame, area: StagingArea, rows: int = FIT_ROWS) -> DataFrame:
    """One row per page: page_id, lang, probability, text_lang, declared, suffix, host."""
    langs, model = fit_text(docs, rows)
    read = addressed(pages).mapInArrow(
        _text_evidence(model),
        "page_id long, declared string, suffix string, host string, domain string, text_log array<double>",
    )
    if not langs:
        none = F.lit(None).cast("string")
        return read.select("page_id", none.alias("lang"), F.lit(0.0).alias("probability"), none.alias("text_lang"),
                           "declared", "suffix", "host")
    names = F.lit(langs)
    best = lambda c: F.get(names, F.array_position(c, F.array_max(c)).cast("int") - 1)
    return fuse(read, langs, area).select(
        "page_id", best(F.col("p")).alias("lang"), F.array_max("p").alias("probability"),
        best(F.col("text_log")).alias("text_lang"), "declared", "suffix", "host",
    )
