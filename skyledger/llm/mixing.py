"""Mixing sources to target weights by fitting each source's budget of words.

Documents are counted by exact length. A source's budget is spent in whole
copies of the source first; what remains is a bounded subset-sum problem over
lengths: a proportional share of every length, then the longest that still fit,
then an exact knapsack over the last words. Which documents of a length are
taken follows a seeded hash: whole hash buckets, and in the bucket where the
count is reached, the first ones in hash order. So no (source, length) is ever
sorted in one task.

Defined results: a missing text has length 0; documents of length 0 take no
words and are in the mix as often as their whole source is. A missing source is
a source of its own, ordered last. Rows that share a doc_id are separate
documents. An empty table, or one without words, gives targets of 0. Reruns take
the same documents.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import row_place, whole_text, word_count
from skyledger.operators.keys import dense_key
from skyledger.staging import StagingArea

SEED = 20240115
#: Weights of the sources in order, repeating.
WEIGHTS = (1, 2, 3)
#: A source gives at most this many times its words.
MOST_COPIES = 3
#: Words left to the exact knapsack.
EXACT_WORDS = 1 << 16
_BUCKETS = 256


def source_targets(
    sizes: DataFrame, area: StagingArea, weights: tuple[int, ...] = WEIGHTS, share: float = 1.0,
    most: int = MOST_COPIES,
) -> DataFrame:
    """source, source_size, target from (source, source_size).

    A target is the source's weighted share of ``share`` of all words, at most
    ``most`` times its own; what a capped source leaves is shared anew. Each
    round is a small aggregate, and ends when no further source is capped.
    """
    ranked = area.table(
        dense_key(sizes.withColumn("no_source", F.col("source").isNull()), "rank", ["no_source", "source"], area),
        "ranked-sources",
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    sources = ranked.select("source", "source_size", weight.cast("double").alias("weight"))
    cap = F.col("source_size") * F.lit(float(most))
    budget = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    unit, capped = 0.0, -1
    while True:
        above = cap <= F.lit(unit) * F.col("weight")
        n, held, free = sources.agg(
            F.count(F.when(above, 1)), F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight")))
        ).first()
        if n == capped or not free:
            break
        unit, capped = (budget - (held or 0.0)) / free, n
    target = cap if not free else F.least(cap, F.lit(unit) * F.col("weight"))
    return sources.select("source", "source_size", target.alias("target"))


def fit_budget(lengths: np.ndarray, counts: np.ndarray, budget: int, exact: int = EXACT_WORDS) -> np.ndarray:
    """How many of each length to take so that their words come nearest to ``budget``.

    At most ``counts`` of a length; one budget, its lengths distinct and positive.
    """
    lengths, counts = lengths.astype(object), counts.astype(object)  # exact for any size
    total = sum(lengths * counts)
    if budget >= total or not total:
        return counts.astype(np.int64)
    taken = np.maximum(counts * budget // total - 1, 0)  # one of each is left to fit with
    left = budget - sum(lengths * taken)
    for i in np.argsort(-lengths.astype(np.int64), kind="stable"):
        if left <= exact:
            break
        more = min(counts[i] - taken[i], left // lengths[i])
        taken[i] += more
        left -= more * lengths[i]
    if left <= 0:
        return taken.astype(np.int64)
    # Bit s of ``reach`` says that the items so far can add up to s.
    goal, reach, steps = int(left), 1, []
    mask = (1 << (2 * goal + 1)) - 1
    for i in np.argsort(lengths.astype(np.int64), kind="stable"):
        spare, part = int(min(counts[i] - taken[i], 2 * goal // lengths[i])), 1
        while spare > 0 and not reach >> goal & 1:
            part = min(part, spare)
            steps.append((i, part, reach))
            reach |= (reach << part * int(lengths[i])) & mask
            spare, part = spare - part, part * 2
        if reach >> goal & 1:
            break
    for off in range(goal + 1):
        if reach >> (goal - off) & 1:
            at = goal - off
            break
        if reach >> (goal + off) & 1:
            at = goal + off
            break
    for i, part, before in reversed(steps):
        if not before >> at & 1:
            at -= part * int(lengths[i])
            taken[i] += part
    return taken.astype(np.int64)


def _fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
    """Rows (source, source_size, target, size, n) of one source: adds copies and quota."""
    size, target = int(pdf["source_size"].iloc[0]), float(pdf["target"].iloc[0])
    copies = min(int(target // size) if size else 0, MOST_COPIES)
    rest = int(round(target - copies * size)) if copies < MOST_COPIES else 0
    words = pdf["size"].to_numpy() > 0
    quota = np.zeros(len(pdf), np.int64)
    if words.any() and rest > 0:
        quota[words] = fit_budget(pdf["size"].to_numpy()[words], pdf["n"].to_numpy()[words], rest)
    return pdf.assign(copies=copies, quota=quota)[["source", "source_size", "target", "size", "copies", "quota"]]


def _seeded(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col("doc_id"), F.col("text"))


def _bucket(h: Column) -> Column:
    return F.pmod(h, F.lit(_BUCKETS)).cast("int")


def mix_plan(docs: DataFrame, area: StagingArea, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, source, h, place, size, source_size, target, copies.

    ``h`` is the seeded hash of the document, ``place`` tells repeated rows apart,
    ``copies`` says how often the mix has the document.
    """
    rows = area.table(
        docs.select(
            "doc_id",
            "source",
            word_count(whole_text()).alias("size"),
            _seeded(seed).alias("h"),
            row_place().alias("place"),
        ),
        "sizes",
    ).withColumn("bucket", _bucket(F.shiftrightunsigned("h", 8)))
    counted = area.table(rows.groupBy("source", "size", "bucket").agg(F.count("*").alias("n")), "counts")
    lengths = counted.groupBy("source", "size").agg(F.sum("n").alias("n"))
    targets = area.table(
        source_targets(
            area.table(lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), "totals"),
            area,
        ),
        "targets",
    )
    same_source = lambda a, b: a["source"].eqNullSafe(b["source"])
    fitted = (
        lengths.join(targets, same_source(lengths, targets)).drop(targets["source"])
        .groupBy("source")
        .applyInPandas(
            _fit_source, "source string, source_size long, target double, size long, copies int, quota long"
        )
    )
    fitted = area.table(fitted, "fitted").withColumnsRenamed({"source": "_source", "size": "_size"})
    before = Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    quotas = (
        counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(fitted, F.col("source").eqNullSafe(F.col("_source")) & (F.col("size") == F.col("_size")))
        .select(
            F.col("source").alias("_source"), F.col("size").alias("_size"), F.col("bucket").alias("_bucket"),
            "source_size", "target", "copies", (F.col("quota") - F.col("before")).alias("left"),
        )
    )
    turn = F.row_number().over(Window.partitionBy("source", "size", "bucket").orderBy("h", "doc_id", "place"))
    return (
        rows.withColumn("turn", turn)
        .join(
            quotas,
            F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("size") == F.col("_size"))
            & (F.col("bucket") == F.col("_bucket")),
        )
        .select(
            "doc_id", "source", "h", "place", "size", "source_size", "target",
            (F.col("copies") + (F.col("turn") <= F.col("left")).cast("int")).alias("copies"),
        )
    )


def mix_sources(docs: DataFrame, area: StagingArea, seed: int = SEED) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken."""
    return mix_plan(docs, area, seed).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


def mixed(docs: DataFrame, area: StagingArea, seed: int = SEED) -> DataFrame:
    """``docs`` as the mix has them: rows repeated, or left out, as often as planned."""
    among = lambda order: F.row_number().over(
        Window.partitionBy("doc_id", "source", "h").orderBy(order)
    )
    plan = mix_plan(docs, area, seed).withColumn("among", among("place")).where("copies > 0").select(
        F.col("doc_id").alias("_id"), F.col("source").alias("_source"), F.col("h").alias("_h"),
        F.col("among").alias("_among"), "copies",
    )
    rows = docs.select(F.struct("*").alias("row"), "doc_id", "source", _seeded(seed).alias("h")).withColumn(
        "among", among(F.lit(1))
    )
    return (
        rows.join(
            plan,
            F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
            & (F.col("h") == F.col("_h")) & (F.col("among") == F.col("_among")),
        )
        .select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies"))).alias("copy"))
        .select("row.*")
    )
