"""Registered queries of the corpus operators, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger.llm import (
    alignment, collocations, decontaminate, exactdedup, language, linewindows, mixing, pieces, preference, simhash, suffixdedup,
    toxicity, winnowing,
)
from skyledger.llm.common import area, table


def op1_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = preference.answers_of_neighbours(table(spark, sf_dir, "conversations"))
    return preference.format_preferences(pairs).withColumns({
        c: preference.mask_string(F.col(c)) for c in ("chosen_mask", "rejected_mask")
    })


def op2_line_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linewindows.line_dedup(table(spark, sf_dir, "documents"), area(spark)).select(
        F.col("row.doc_id").alias("doc_id"), "text", "n_lines", "n_removed", "n_spans"
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return toxicity.toxicity(docs, labels, area(spark))


def op4_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.document_fingerprints(table(spark, sf_dir, "documents"), area(spark))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, docs = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    return language.page_languages(pages, docs, area(spark))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.suffix_dedup(table(spark, sf_dir, "documents"), area(spark)).drop("kept")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), area(spark))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), area(spark))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_dedup(table(spark, sf_dir, "documents"), area(spark))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(table(spark, sf_dir, "documents"), pieces.Vocabulary.from_file())


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), area(spark))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), area(spark))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"), area(spark))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_preferences, op2_line_windows, op3_toxicity, op4_winnowing, op5_language, op6_suffix_dedup, op7_mixing,
        op8_simhash, op9_exact_dedup, op10_pieces, op11_collocations, op12_decontaminate, op13_alignment,
    )
}

ORACLES: dict[str, str] = {
    "op1_preferences": """
WITH turns AS (
  SELECT DISTINCT conv_id, turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS text FROM conversations
  WHERE conv_id IS NOT NULL
), lone AS (
  SELECT '<|' || coalesce(role, 'unknown') || '|>' || chr(10) AS header, coalesce(text, '') || '<|end|>' || chr(10) AS body,
    coalesce(role, '') = 'assistant' AS learned FROM conversations WHERE conv_id IS NULL
), own AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS k FROM turns
), last AS (
  SELECT conv_id, max(k) FILTER (WHERE role = 'assistant') AS last FROM own GROUP BY conv_id
), sides AS (
  SELECT conv_id, 'chosen' AS side, k, role, text FROM own
  UNION ALL
  SELECT o.conv_id, 'rejected', o.k, o.role, o.text FROM own o JOIN last l USING (conv_id)
  WHERE l.last IS NULL OR o.k < l.last
  UNION ALL
  SELECT l.conv_id, 'rejected', l.last, o.role, o.text
  FROM last l JOIN last p ON p.conv_id = xor(l.conv_id, 1) JOIN own o ON o.conv_id = p.conv_id AND o.k = p.last
  WHERE l.last IS NOT NULL
), compared AS (
  SELECT conv_id, k, count(*) = 2 AND min(role) = max(role) AND min(text) = max(text) AS same FROM sides GROUP BY conv_id, k
), prefix AS (
  SELECT conv_id, coalesce(min(k) FILTER (WHERE NOT same) - 1, max(k)) AS n FROM compared GROUP BY conv_id
), parts AS (
  SELECT s.conv_id, s.side, s.k, s.role, p.n, s.k <= p.n AS shared,
    '<|' || s.role || '|>' || chr(10) AS header, s.text || '<|end|>' || chr(10) AS body
  FROM sides s JOIN prefix p USING (conv_id)
), placed AS (
  SELECT *, sum(length(header) + length(body)) OVER (PARTITION BY conv_id, side, shared ORDER BY k) AS stop FROM parts
)
SELECT conv_id AS pair_id, n AS n_prompt_turns,
  coalesce(string_agg(header || body, '' ORDER BY k) FILTER (WHERE shared AND side = 'chosen'), '') AS prompt,
  coalesce(string_agg(header || body, '' ORDER BY k) FILTER (WHERE NOT shared AND side = 'chosen'), '') AS chosen,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY k)
    FILTER (WHERE NOT shared AND side = 'chosen' AND role = 'assistant'), '') AS chosen_mask,
  coalesce(string_agg(header || body, '' ORDER BY k) FILTER (WHERE NOT shared AND side = 'rejected'), '') AS rejected,
  coalesce(string_agg((stop - length(body)) || '-' || stop, ',' ORDER BY k)
    FILTER (WHERE NOT shared AND side = 'rejected' AND role = 'assistant'), '') AS rejected_mask
FROM placed GROUP BY conv_id, n
UNION ALL
SELECT NULL, CASE WHEN learned THEN 0 ELSE 1 END, CASE WHEN learned THEN '' ELSE header || body END,
  CASE WHEN learned THEN header || body ELSE '' END,
  CASE WHEN learned THEN length(header) || '-' || length(header || body) ELSE '' END, '', '' FROM lone
""",
    "op2_line_windows": """
WITH texts AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
  SELECT doc_id, len(lines) AS n, unnest(range(0, len(lines))) AS pos, unnest(lines) AS line FROM texts
), windows AS (
  SELECT doc_id, unnest(range(0, len(lines) - 2)) AS pos, lines FROM texts WHERE len(lines) > 2
), placed AS (
  SELECT doc_id, pos, row_number() OVER (
    PARTITION BY lines[pos + 1] || chr(10) || lines[pos + 2] || chr(10) || lines[pos + 3] ORDER BY doc_id, pos) AS turn
  FROM windows
), covered AS (
  SELECT DISTINCT doc_id, pos + k AS pos FROM placed, (VALUES (0), (1), (2)) AS v(k) WHERE turn > 1
), marked AS (
  SELECT l.doc_id, l.n, l.pos, l.line, c.pos IS NOT NULL AS gone,
    coalesce(lag(c.pos IS NOT NULL) OVER (PARTITION BY l.doc_id ORDER BY l.pos), false) AS gone_before
  FROM line l LEFT JOIN covered c ON c.doc_id = l.doc_id AND c.pos = l.pos
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text,
  any_value(n) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  count(*) FILTER (WHERE gone AND NOT gone_before) AS n_spans
FROM marked GROUP BY doc_id
""",
    "op6_suffix_dedup": """
WITH texts AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents
), blocks AS (
  SELECT doc_id, first, least(128, n - first) AS many, substr(h, CAST(2 * first + 1 AS BIGINT), 454) AS block FROM (
    SELECT doc_id, h, len(h) // 2 - 99 AS n, unnest(range(0, len(h) // 2 - 99, 128)) AS first FROM texts WHERE len(h) >= 200)
), strings AS (
  SELECT doc_id, first + unnest(range(0, many)) AS pos,
    unnest([substr(block, CAST(2 * i + 1 AS BIGINT), 200) FOR i IN range(0, many)]) AS string FROM blocks
), later AS (
  SELECT doc_id, pos FROM (SELECT doc_id, pos, row_number() OVER (PARTITION BY string ORDER BY doc_id, pos) AS turn FROM strings)
  WHERE turn > 1
), gaps AS (
  SELECT doc_id, pos, coalesce(pos > lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) + 100, true) AS opens FROM later
), spans AS (
  SELECT doc_id, min(pos) AS low, max(pos) + 100 AS high FROM (
    SELECT doc_id, pos, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY pos) AS span FROM gaps) GROUP BY doc_id, span
), kept AS (
  SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS after FROM spans
), cut AS (
  SELECT k.doc_id, count(*) AS n_spans, sum(high - low) AS n_removed, max(high) AS last,
    string_agg(substr(h, CAST(2 * after + 1 AS BIGINT), CAST(2 * (low - after) AS BIGINT)), '' ORDER BY low) AS kept
  FROM kept k JOIN texts USING (doc_id) GROUP BY k.doc_id
)
SELECT doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(kept || substr(h, CAST(2 * last + 1 AS BIGINT)), h))) AS kept_sha256
FROM texts LEFT JOIN cut USING (doc_id)
""",
    "op9_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS digest FROM documents
)
SELECT doc_id, min(doc_id) OVER (PARTITION BY digest) AS keep_id, count(*) OVER (PARTITION BY digest) AS group_size,
  doc_id = min(doc_id) OVER (PARTITION BY digest) AS kept, digest AS text_sha256
FROM texts
""",
    "op11_collocations": r"""
WITH texts AS (
  SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents
), pieces AS (
  SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), worded AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), phrases AS (
  SELECT lang, size, unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS phrase
  FROM worded, (VALUES (1), (2), (3)) AS v(size) WHERE len(w) >= size
), counts AS (
  SELECT lang, size, phrase, count(*) AS f FROM phrases GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counts WHERE size > 1 AND f >= 10
), cuts AS (
  SELECT lang, size, phrase, a, k, array_to_string(w[1 : k], ' ') AS head, array_to_string(w[k + 1 : size], ' ') AS tail
  FROM candidates, (VALUES (1), (2)) AS v(k) WHERE k < size
), scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, h.f AS l, t.f AS r, (1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f))::BIGINT AS score,
    row_number() OVER (PARTITION BY c.lang, c.phrase ORDER BY 1000000::HUGEINT * c.a * c.a // (h.f::HUGEINT * t.f), k) AS turn
  FROM cuts c JOIN counts h ON h.lang = c.lang AND h.phrase = c.head JOIN counts t ON t.lang = c.lang AND t.phrase = c.tail
), held AS (
  SELECT lang, phrase, max(a) AS longest FROM (
    SELECT lang, a, array_to_string(w[1 : 2], ' ') AS phrase FROM candidates WHERE size = 3
    UNION ALL SELECT lang, a, array_to_string(w[2 : 3], ' ') FROM candidates WHERE size = 3) GROUP BY ALL
), ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM scored s LEFT JOIN held x ON x.lang = s.lang AND x.phrase = s.phrase
  WHERE turn = 1 AND (x.longest IS NULL OR 100 * x.longest < 50 * a)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op12_decontaminate": r"""
WITH texts AS (
  SELECT row_number() OVER () AS place, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS size,
    unnest([array_to_string(w[i : i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS win
  FROM items WHERE len(w) > 0
), own AS (
  SELECT place, size, unnest(range(1, len(w) - size + 2)) AS start,
    unnest([array_to_string(w[i : i + size - 1], ' ') FOR i IN range(1, len(w) - size + 2)]) AS win
  FROM texts, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size
), hits AS (
  SELECT o.place, o.size, o.start, w.item FROM own o JOIN windows w ON w.win = o.win AND w.size = o.size
), covered AS (
  SELECT place, count(*) AS n_hit FROM (SELECT DISTINCT place, unnest(range(start, start + size)) AS word FROM hits) GROUP BY place
), named AS (
  SELECT place, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT place, item FROM hits) GROUP BY place
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN covered USING (place) LEFT JOIN named USING (place)
""",
}
