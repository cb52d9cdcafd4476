"""Benchmark passages in documents, found by winnowing.

Words are what is left between ASCII characters other than letters and digits,
ASCII letters in lower case. Of every ten consecutive words the least hash of
its four-word grams is kept, the rightmost on ties, so that two texts that share
ten consecutive words keep the same gram of them. Kept grams of documents and
of benchmark items are joined by hash, and every meeting is extended to all the
windows of ten words around it, which are then compared as words. Windows of an
item are compared once for all items that hold them. An item of fewer words is
one window and one gram; documents keep all grams of such a length where the
benchmark has one. Only DataFrame functions are used.

Grams and windows of the benchmark are broadcast up to ``BROADCAST_ROWS`` rows
(at most about 100 bytes each); larger ones are joined by shuffling.

Defined results: a missing or empty text has no words and no hits. Rows with the
same item_id are one item; a missing item_id counts as an empty one. Repeated
documents give equal rows; a missing doc_id is a value like any other. An empty
benchmark leaves every document clean; an empty document table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import whole_text
from skyledger.staging import StagingArea

#: Words of a shared span that is found for certain, and of a gram.
SPAN_WORDS, GRAM_WORDS = 10, 4
#: Rows of a benchmark table that is broadcast at most.
BROADCAST_ROWS = 500_000

_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: ASCII characters that are no part of a word; characters beyond ASCII are.
_BETWEEN = "".join(chr(c) for c in range(128) if not chr(c).isalnum())
_PLACE = (1 << 31) - 1


def words(text: Column | str = "text") -> Column:
    """Everything between words becomes a space, on which the text is split: far cheaper than a pattern."""
    even = F.translate(whole_text(text), _LETTERS + _BETWEEN, _LETTERS.lower() + " " * len(_BETWEEN))
    return F.array_remove(F.split(even, " ", -1), "")


def _gram(at: Column, size: int, *seed: Column) -> Column:
    """Hash of ``size`` words of the column ``words`` from place ``at``."""
    return F.xxhash64(*seed, *[F.get("words", at + k) for k in range(size)])


def _starts(column: str, short_by: int) -> Column:
    """The array without its last ``short_by`` entries."""
    return F.slice(column, 1, F.greatest(F.size(column) - short_by, F.lit(0)))


def _least_with(step: int) -> Column:
    """Every entry of the column ``least``, or the one ``step`` places on if that is less."""
    return F.transform(_starts("least", step), lambda x, i: F.least(x, F.get("least", i + step)))


def kept_grams(texts: DataFrame, span: int = SPAN_WORDS, gram: int = GRAM_WORDS) -> DataFrame:
    """Other columns of ``texts`` with span, at and h: one row for every gram that a window of ``span`` words keeps.

    A window's grams are compared by the upper half of their hash, over the place
    counted down, so that the least is the rightmost of equal ones. The minimum
    of a window comes from the minima of two windows that cover it.
    """
    names = [c for c in texts.columns if c != "words"]
    key = lambda _, i: _gram(i, gram).bitwiseAND(F.lit(-1 << 32)).bitwiseOR(F.lit(_PLACE) - i)
    least = texts.where(F.size("words") >= span).withColumn("least", F.transform(_starts("words", gram - 1), key))
    wide, window = 1, span - gram + 1
    while wide < window:
        step = min(wide, window - wide)
        least, wide = least.withColumn("least", _least_with(step)), wide + step
    place = lambda k: (F.lit(_PLACE) - k.bitwiseAND(F.lit(_PLACE))).cast("int")
    kept = F.transform(
        F.array_distinct("least"), lambda k: F.struct(place(k).alias("at"), _gram(place(k), gram, F.lit(span)).alias("h"))
    )
    return least.select(*names, F.explode(kept).alias("g")).select(*names, F.lit(span).alias("span"), "g.at", "g.h")


def all_grams(texts: DataFrame, size: int) -> DataFrame:
    """The same columns for every gram of ``size`` words: windows of one gram."""
    names = [c for c in texts.columns if c != "words"]
    grams = F.transform(_starts("words", size - 1), lambda _, i: _gram(i, size, F.lit(size)))
    return (
        texts.where(F.size("words") >= size)
        .select(*names, F.posexplode(grams).alias("at", "h"))
        .select(*names, F.lit(size).alias("span"), "at", "h")
    )


def _grams(texts: DataFrame, short: list[int]) -> DataFrame:
    found = kept_grams(texts)
    for size in short:
        found = found.unionByName(all_grams(texts, size))
    return found


def _small(table: DataFrame) -> DataFrame:
    """Marked for broadcasting if it has few rows."""
    return F.broadcast(table) if table.count() <= BROADCAST_ROWS else table


def _windows_at(span: Column, at: Column) -> Column:
    """First words of all windows that can have kept the gram at ``at``."""
    back = F.when(span == SPAN_WORDS, SPAN_WORDS - GRAM_WORDS).otherwise(0)
    return F.sequence(F.greatest(at - back, F.lit(0)), at)


class Benchmark:
    """What documents are compared with: windows, the items that hold them, and the grams that are kept of them."""

    def __init__(self, items: DataFrame, area: StagingArea):
        texts = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), words().alias("words"))
        texts = area.table(texts.where(F.size("words") > 0), "items")
        span = F.least(F.size("words"), F.lit(SPAN_WORDS))
        starts = F.transform(
            F.sequence(F.lit(0), F.size("words") - span), lambda i: F.array_join(F.slice("words", i + 1, span), " ")
        )
        held = area.table(texts.select("item", F.explode(starts).alias("window")).distinct(), "held")
        self.windows = area.table(
            held.select("window").distinct().withColumn("wid", F.monotonically_increasing_id()), "windows"
        )
        self.items = area.table(held.join(self.windows, "window").select("wid", "item"), "window-items")
        lengths = texts.select(F.size("words").alias("n")).where(F.col("n") < SPAN_WORDS).distinct()
        self.short = sorted(r["n"] for r in lengths.collect())  # at most SPAN_WORDS - 1 numbers
        own = kept_grams(texts)
        for size in self.short:
            own = own.unionByName(all_grams(texts.where(F.size("words") == size), size))
        self.grams = area.table(own.select("h").distinct(), "grams")


def hits(docs: DataFrame, benchmark: Benchmark, area: StagingArea) -> DataFrame:
    """doc_id, text_hash, start, span, wid: every window of the benchmark in every document."""
    key = ["doc_id", "text_hash"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words().alias("words"))
    met = (
        _grams(texts, benchmark.short)
        .join(_small(benchmark.grams), "h")
        .groupBy(*key)
        .agg(F.collect_set(F.struct("span", "at")).alias("met"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "met")
    )
    met = area.table(met, "met")
    of_doc = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    again = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).join(met, of_doc).select(
        *key, "met", words().alias("words")
    )
    around = F.flatten(F.transform("met", lambda m: F.transform(
        _windows_at(m.span, m["at"]), lambda s: F.struct(s.alias("start"), m.span.alias("span")))))
    inside = F.filter(F.array_distinct(around), lambda w: w.start + w.span <= F.size("words"))
    windows = F.transform(inside, lambda w: F.struct(
        w.start.alias("start"), w.span.alias("span"),
        F.array_join(F.slice("words", w.start + 1, w.span), " ").alias("window")))
    return (
        again.select(*key, F.explode(windows).alias("w"))
        .select(*key, "w.start", "w.span", "w.window")
        .join(_small(benchmark.windows), "window")
        .select(*key, "start", "span", "wid")
    )


def _covered(spans: Column) -> Column:
    """Words that sorted spans (start, span) cover."""
    none = F.struct(F.lit(0).alias("end"), F.lit(0).cast("long").alias("n"))
    return F.aggregate(spans, none, lambda a, s: F.struct(
        F.greatest(a.end, s.start + s.span).alias("end"),
        (a.n + F.greatest(s.start + s.span - F.greatest(a.end, s.start), F.lit(0))).cast("long").alias("n"),
    ), lambda a: a.n)


def contamination(docs: DataFrame, items: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated.

    Documents that hold the same windows hold the same items, so the items are
    listed once for every set of windows that occurs.
    """
    benchmark = Benchmark(items, area)
    per_doc = hits(docs, benchmark, area).groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_set(F.struct("start", "span"))).alias("spans"),
        F.sort_array(F.collect_set("wid")).alias("wids"),
    )
    found = area.table(per_doc.select("doc_id", "text_hash", _covered(F.col("spans")).alias("n_hit"), "wids"), "found")
    sets = area.table(found.select("wids").distinct().withColumn("set", F.monotonically_increasing_id()), "sets")
    listed = (
        sets.select("set", F.explode("wids").alias("wid"))
        .join(benchmark.items, "wid")
        .groupBy("set")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
        .select("set", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    )
    listed = area.table(sets.join(listed, "set").drop("set"), "listed")
    found = found.join(listed, "wids").select(
        F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "n_hit", "n_items", "items_sha256"
    )
    counted = docs.select(
        "doc_id", F.xxhash64("text").alias("text_hash"),
        F.size(words()).cast("long").alias("n_words"),
    )
    of_doc = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash"))
    none = F.lit(0).cast("long")
    return counted.join(found, of_doc, "left").select(
        "doc_id", "n_words",
        F.coalesce("n_hit", none).alias("n_hit"),
        F.coalesce("n_items", none).alias("n_items"),
        F.coalesce("items_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("items_sha256"),
        (F.coalesce("n_hit", none) > 0).alias("contaminated"),
    )
