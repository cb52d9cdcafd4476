"""Change detection against a table of stored row hashes that is not moved for it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Buckets of a stored hash table; a feed is dealt into as many.
BUCKETS = 16


def _key(columns: Sequence[str]) -> Column:
    """The natural key as one text without nulls, so that a missing value is a key like any other."""
    parts = [F.when(F.col(c).isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), F.replace(F.col(c).cast("string"), F.lit("|"), F.lit("||")))) for c in columns]
    return F.concat_ws("|,", *parts)


def _hashed(df: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    row = F.struct(*[F.struct(F.col(a).isNull(), F.col(a)) for a in attributes])
    return df.select(_key(key).alias("_clave"), *key, F.xxhash64(row).alias("_h1"), F.xxhash64(F.lit("second"), row).alias("_h2"))


def store_hashes(dim: DataFrame, key: Sequence[str], attributes: Sequence[str], table: str, path: str) -> None:
    """Write key and row hash of every member as catalog table ``table`` at ``path``, bucketed and sorted by key."""
    _hashed(dim, key, attributes).write.bucketBy(BUCKETS, "_clave").sortBy("_clave").option("path", path).saveAsTable(table)


def changes_by_hash(
    spark: SparkSession, table: str, new: DataFrame, key: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Every key with its state, ``new``, ``changed``, ``unchanged`` or ``absent``; ``new`` has one row per key.

    Only the feed is shuffled: the stored hashes lie in the buckets it is dealt into.
    """
    old = spark.table(table).withColumn("_in_old", F.lit(True)).alias("old")
    feed = _hashed(new, key, attributes).withColumn("_in_new", F.lit(True)).alias("new")
    same = (F.col("old._h1") == F.col("new._h1")) & (F.col("old._h2") == F.col("new._h2"))
    state = (
        F.when(F.col("old._in_old").isNull(), "new").when(F.col("new._in_new").isNull(), "absent")
        .when(same, "unchanged").otherwise("changed")
    )
    names = [F.when(F.col("new._in_new"), F.col(f"new.{k}")).otherwise(F.col(f"old.{k}")).alias(k) for k in key]
    return old.hint("merge").join(feed, F.col("old._clave") == F.col("new._clave"), "full").select(*names, state.alias("state"))
