"""Document fingerprints by winnowing.

Every run of ``GRAM`` code points is hashed; of every ``WINDOW`` consecutive
hashes the least is chosen, of equal ones the rightmost. Two texts that share
``GRAM + WINDOW - 1`` code points therefore share a chosen hash. Chosen hashes
keep their positions. Texts are worked on in blocks that overlap by what a
window needs, so the work is linear in the text; inside a block the walk goes
from one chosen hash to the next. Only DataFrame functions are used.

Each document is also compared with its edited text and with the next document
in descending order. Documents are put into buckets of neighbouring ids, one
shuffle of the texts; the first document of a bucket is sent to the bucket
before it as well, so that no order over the whole table is needed.

Defined results: a missing text is empty and has an empty fingerprint; texts
shorter than a gram are one gram, those with less than a window one window. Two
empty fingerprints are alike (1), an empty and another one are not (0). Missing
doc_ids come last, equal ids are ordered by a hash of the text. A document that
is alone is its own next one. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from skyledger.llm.common import whole_text
from skyledger.staging import StagingArea

GRAM = 12
WINDOW = 40
#: Windows that start in one block.
_BLOCK = 300
_BLOCK_CHARS = _BLOCK + WINDOW + GRAM - 2
#: A place inside a block fits these bits of a key.
_PLACE = 2047
#: Documents per bucket of neighbours, and the most buckets; their limits are kept on the driver.
BUCKET_ROWS = 256
MOST_BUCKETS = 4096


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def blocks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{_BLOCK_CHARS}}})).{{1,{_BLOCK}}}"), F.lit(1))


def _keys(block: Column) -> Column:
    """Per gram its hash, then its place counted from the right: the least key is the rightmost least hash."""
    grams = F.when(
        F.length(block) >= GRAM, F.regexp_extract_all(block, F.lit(f"(?s)(?=(.{{{GRAM}}}))."), F.lit(1))
    ).otherwise(F.array(block))
    return F.transform(grams, lambda g, i: F.shiftleft(F.hash(g).cast("long"), 11) + (F.lit(_PLACE) - i))


def _place(key: Column) -> Column:
    return F.lit(_PLACE) - key.bitwiseAND(F.lit(_PLACE)).cast("int")


def _chosen(keys: Column) -> Column:
    """Keys chosen by the windows over ``keys``, from left to right.

    After a chosen key comes the first smaller one that enters the window while
    it is inside; if there is none, the least of the window that has lost it.
    """

    def step(state: Column, _: Column) -> Column:
        last = F.element_at(state["out"], -1)

        def following(ahead: Column) -> Column:
            return _let(F.array_min(ahead), lambda least: F.when(
                least < last, F.get(F.filter(ahead, lambda k: k < last), F.lit(0))
            ).when(F.size(ahead) == WINDOW, least))

        return F.when(state["done"], state).otherwise(_let(
            _let(F.slice(keys, _place(last) + 2, WINDOW), following),
            lambda n: F.when(n.isNull(), F.struct(state["out"].alias("out"), F.lit(True).alias("done"))).otherwise(
                F.struct(F.array_append(state["out"], n).alias("out"), F.lit(False).alias("done"))
            ),
        ))

    def walk(state: Column, steps: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), steps), state, step)

    # About 2 in WINDOW + 1 are chosen; texts that need more steps than twice that go on.
    first = F.struct(F.array(F.array_min(F.slice(keys, 1, WINDOW))).alias("out"), F.lit(False).alias("done"))
    usual = walk(first, (F.size(keys) * 4 / WINDOW).cast("int") + 8)
    return _let(usual, lambda s: F.when(s["done"], s["out"]).otherwise(walk(s, F.size(keys))["out"]))


def block_marks(block: Column, i: Column) -> Column:
    """(position in the text << 32 | hash) of what the windows that start in block ``i`` choose."""

    def marks(keys: Column) -> Column:
        enough = (i == 0) | (F.size(keys) >= WINDOW)
        return F.when(
            enough,
            F.transform(
                _chosen(keys),
                lambda k: F.shiftleft((i * _BLOCK + _place(k)).cast("long"), 32).bitwiseOR(
                    F.shiftright(k, 11).bitwiseAND(F.lit(0xFFFFFFFF))
                ),
            ),
        ).otherwise(F.array().cast("array<long>"))

    short = (i > 0) & (F.length(block) < GRAM + WINDOW - 1)
    return F.when(short, F.array().cast("array<long>")).otherwise(_let(_keys(block), marks))


def _joined(per_block: Column) -> Column:
    return F.array_distinct(F.flatten(per_block))


def _hashes(marks: Column) -> Column:
    return F.array_distinct(F.transform(marks, lambda m: m.bitwiseAND(F.lit(0xFFFFFFFF))))


def fingerprint_string(marks: Column) -> Column:
    """Position and hash of every mark in hexadecimal, separated by spaces."""
    return F.array_join(F.transform(marks, lambda m: F.hex(m)), " ")


def likeness(a: Column, b: Column) -> Column:
    """Shared share of two sets of hashes."""
    common = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b)
    return F.when(every == 0, F.lit(1.0)).otherwise(
        _let(common, lambda n: n / (every - n)).cast("double")
    )


def _with_next(texts: DataFrame, area: StagingArea) -> DataFrame:
    """``texts`` in buckets of neighbours; rows with guest are repeated from the bucket after."""
    n, ids = texts.agg(F.count("*"), F.count("doc_id")).first()
    many = max(1, min(MOST_BUCKETS, n // BUCKET_ROWS))
    shares = [k / many for k in range(1, many)]
    bounds = []
    if ids and shares:
        bounds = sorted(set(texts.agg(F.percentile_approx("doc_id", shares, 20 * many)).first()[0]))
    bucket = F.lit(0)
    if bounds:
        limits = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<long>")
        found = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))

        def halve(s: Column, _: Column) -> Column:
            middle = F.shiftright(s["low"] + s["high"], 1)
            below = F.get(limits, middle) < F.col("doc_id")
            return F.when(s["low"] >= s["high"], s).otherwise(
                F.struct(
                    F.when(below, middle + 1).otherwise(s["low"]).alias("low"),
                    F.when(below, s["high"]).otherwise(middle).alias("high"),
                )
            )

        steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length() + 1))
        bucket = F.aggregate(steps, found, halve, lambda s: s["low"])
    placed = texts.withColumn("bucket", F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(bucket))
    tops = (
        placed.groupBy("bucket")
        .agg(F.max(F.struct("doc_id", F.col("text_hash").alias("text_hash"))).alias("top"))
        .select("bucket", "top.*").orderBy("bucket").collect()
    )
    spark = area.spark
    guests = spark.createDataFrame(
        [(t["bucket"], t["doc_id"], t["text_hash"], tops[(i + 1) % len(tops)]["bucket"]) for i, t in enumerate(tops)],
        "_bucket int, _id long, _hash long, target int",
    )
    return (
        placed.join(
            F.broadcast(guests),
            (F.col("bucket") == F.col("_bucket")) & F.col("doc_id").eqNullSafe(F.col("_id"))
            & (F.col("text_hash") == F.col("_hash")),
            "left",
        )
        .withColumn(
            "seat",
            F.explode(
                F.when(F.col("target").isNull(), F.array(F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest"))))
                .otherwise(F.array(
                    F.struct(F.col("bucket").alias("b"), F.lit(False).alias("guest")),
                    F.struct(F.col("target").alias("b"), F.lit(True).alias("guest")),
                ))
            ),
        )
        .select("doc_id", "text", "text_hash", F.col("seat.b").alias("bucket"), F.col("seat.guest").alias("guest"))
    )


def fingerprints(docs: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, n_chars, marks (array), and the same of its edited text and likenesses."""
    texts = docs.select("doc_id", whole_text().alias("text"), F.xxhash64("text").alias("text_hash"))
    seated = _with_next(texts, area).repartition("bucket")
    marked = seated.withColumn("per_block", F.transform(blocks(F.col("text")), block_marks)).withColumn(
        "marks", _joined(F.col("per_block"))
    ).withColumn("hashes", _hashes(F.col("marks")))
    order = Window.partitionBy("bucket").orderBy(
        "guest", F.col("doc_id").isNull(), F.desc("doc_id"), F.desc("text_hash")
    )
    pairs = marked.select(
        "doc_id", "text", "guest", "per_block", "marks", "hashes",
        F.lead("text").over(order).alias("next_text"), F.lead("hashes").over(order).alias("next_hashes"),
    ).where("not guest")
    n = F.length("text")
    edited = pairs.withColumn("n_chars", n.cast("long")).withColumn("kept", n - F.floor(n / 3).cast("int")).withColumn(
        "edited", F.concat(F.substring("text", F.lit(1), F.col("kept")), F.substring("next_text", F.lit(1), n - F.col("kept")))
    )

    def again(block: Column, i: Column) -> Column:
        same = i * _BLOCK + _BLOCK_CHARS <= F.col("kept")
        return F.when(same, F.get("per_block", i)).otherwise(block_marks(block, i))

    return (
        edited.withColumn("edited_marks", _joined(F.transform(blocks(F.col("edited")), again)))
        .withColumn("edited_hashes", _hashes(F.col("edited_marks")))
        .select(
            "doc_id", "n_chars", "marks", "edited", "edited_marks",
            likeness(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
            likeness(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
        )
    )


def document_fingerprints(docs: DataFrame, area: StagingArea) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, both fingerprints, near_edited, near_next."""
    return fingerprints(docs, area).select(
        "doc_id", "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_string(F.col("marks")).alias("fingerprint"),
        fingerprint_string(F.col("edited_marks")).alias("edited_fingerprint"),
        "near_edited", "near_next",
    )
