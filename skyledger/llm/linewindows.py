"""Repeated lines, found as overlapping windows of three lines.

Every three consecutive lines of a document are hashed to 128 bits. The first
occurrence of every window that occurs more than once is found by a grouped
minimum; all other occurrences are later ones, and the lines they cover, merged
into spans, are removed. Windows are judged on the input, not on what is left.
Only DataFrame functions are used.

Defined results: documents of fewer than three lines have no window and stay as
they are. A missing text stays missing and counts as one empty line. Order is by
doc_id (missing ids last), then by a hash of the text, then by line; repeated
rows are one document to each other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.llm.common import whole_text
from skyledger.staging import StagingArea

WINDOW_LINES = 3


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def windows(docs: DataFrame, lines: int = WINDOW_LINES) -> DataFrame:
    """doc_id, text_hash, at, h1, h2: one row per window, ``at`` its first line from 0."""
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), _lines(whole_text()).alias("lines")).where(
        F.size("lines") >= lines
    )

    def hashes(i: Column) -> Column:
        window = [F.get("lines", i + k) for k in range(lines)]
        return F.struct(F.xxhash64(*window).alias("h1"), F.xxhash64(F.lit(lines), *reversed(window)).alias("h2"))

    starts = F.sequence(F.lit(0), F.size("lines") - lines)
    return texts.select("doc_id", "text_hash", F.posexplode(F.transform(starts, hashes)).alias("at", "w")).select(
        "doc_id", "text_hash", "at", "w.h1", "w.h2"
    )


def _occurrence() -> Column:
    return F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "at")


def later_windows(found: DataFrame) -> DataFrame:
    """Of ``windows``, the occurrences that are not the first of their window."""
    repeated = (
        found.groupBy("h1", "h2")
        .agg(F.min(_occurrence()).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("h1").alias("_h1"), F.col("h2").alias("_h2"), "first")
    )
    return found.join(repeated, (F.col("h1") == F.col("_h1")) & (F.col("h2") == F.col("_h2"))).where(
        _occurrence() > F.col("first")
    )


def _merged(starts: Column, n: Column, lines: int) -> dict[str, Column]:
    """Spans that sorted window starts cover, as gaps between them: linear in the document."""
    m = F.size(starts)
    begin = lambda i: F.when(i == 0, F.lit(0)).otherwise(F.get(starts, i - 1) + lines)
    end = lambda i: F.when(i == m, n).otherwise(F.get(starts, i))
    kept = F.transform(
        F.sequence(F.lit(0), m), lambda i: F.slice("lines", begin(i) + 1, F.greatest(end(i) - begin(i), F.lit(0)))
    )
    opened = F.transform(starts, lambda s, i: ((i == 0) | (F.get(starts, i - 1) + lines < s)).cast("int"))
    return {"kept": F.flatten(kept), "spans": F.aggregate(opened, F.lit(0), lambda a, b: a + b)}


def line_dedup(docs: DataFrame, area: StagingArea, lines: int = WINDOW_LINES) -> DataFrame:
    """One row per row of ``docs``: row (all its columns), text (what is left), n_lines, n_removed, n_spans."""
    found = area.table(windows(docs, lines), "windows")
    covered = (
        later_windows(found)
        .groupBy("doc_id", "text_hash")
        .agg(F.sort_array(F.collect_set("at")).alias("starts"))
        .select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "starts")
    )
    rows = docs.select(F.struct("*").alias("row")).select("row", F.xxhash64("row.text").alias("_text_hash"))
    joined = rows.join(
        covered, F.col("row.doc_id").eqNullSafe(F.col("_id")) & (F.col("_text_hash") == F.col("_hash")), "left"
    ).select("row", "starts", _lines(whole_text("row.text")).alias("lines"))
    merged = _merged(F.col("starts"), F.size("lines"), lines)
    changed = F.col("starts").isNotNull()
    return (
        joined.select(
            "row",
            F.size("lines").cast("long").alias("n_lines"),
            F.when(changed, merged["kept"]).alias("kept"),
            F.when(changed, merged["spans"]).otherwise(F.lit(0)).cast("long").alias("n_spans"),
        )
        .select(
            "row",
            F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(F.array_join("kept", "\n")).alias("text"),
            "n_lines",
            F.when(F.col("kept").isNull(), F.lit(0)).otherwise(F.col("n_lines") - F.size("kept")).cast("long").alias("n_removed"),
            "n_spans",
        )
    )


def without_repeated_lines(docs: DataFrame, area: StagingArea) -> DataFrame:
    """``docs`` with what is left of each text; ``n_chars`` follows the text where it is given."""
    result = line_dedup(docs, area)
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        unchanged = F.col("n_removed") == 0
        new["n_chars"] = F.when(unchanged, F.col("row.n_chars")).otherwise(F.length("text"))
    return result.select(*[new[c].alias(c) if c in new else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
