"""Generic operators: ties, nulls, hot keys, both ways of joining, dense keys."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.operators import impute as im, joins, rows as ro
from skyledger.operators.evidence import Evidence, gather
from skyledger.operators.keys import dense_key
from skyledger.operators.rows import Marks

c = F.col


def found(df):
    return {r[0]: r[1] for r in df.collect()}


def test_dedupe_treats_nulls_as_equal_and_keeps_the_first(spark):
    df = spark.createDataFrame([(3, "a", None), (1, "a", None), (2, "b", 1.5)], "row_id long, x string, y double")
    assert sorted(map(tuple, ro.dedupe_rows(df).collect())) == [(1, "a", None), (2, "b", 1.5)]
    assert ro.dedupe_rows(df.drop("row_id")).count() == 2
    two = df.withColumn("file", F.lit(0))
    assert sorted(r.row_id for r in ro.dedupe_rows(two, ("file", "row_id")).collect()) == [1, 2]


def test_drop_where_keeps_unknown(spark):
    df = spark.createDataFrame([(-1.0,), (None,), (2.0,)], "x double")
    assert [r.x for r in ro.drop_where(df, c("x") < 0).collect()] == [None, 2.0]


def test_dedupe_first_by_key_counts_null_as_a_key(spark):
    df = spark.createDataFrame([(2, None, "b"), (1, None, "a"), (3, "k", "c")], "row_id long, k string, v string")
    assert found(ro.dedupe_first_by_key(df, ["k"]).select("k", "v")) == {None: "a", "k": "c"}


def test_first_last_mode_ties(spark):
    data = [(1, "k", 9), (1, "k", 7), (2, "k", 5), (0, "k", None), (3, None, 1), (5, "z", 2)]
    df = spark.createDataFrame(data, "row_id long, k string, v int")
    assert found(im.first_by_key(df, ["k"], "v")) == {"k": 7, "z": 2}
    assert found(im.last_by_key(df, ["k"], "v")) == {"k": 5, "z": 2}
    assert found(im.mode_by_key(df, ["k"], "v")) == {"k": 5, "z": 2}
    assert found(im.max_by_key(df, ["k"], "v", c("v") < 8)) == {"k": 7, "z": 2}


def test_dominant_breaks_ties_by_weight_then_smallest(spark):
    data = [("a", 2, 5), ("a", 1, 5), ("b", 3, 1), ("b", 4, 9), ("c", 8, 1), ("d", 5, None), ("d", 6, None)]
    df = spark.createDataFrame(data, "k string, v int, w int")
    assert found(im.dominant_by_key(df, "k", "v", "w")) == {"a": 1, "b": 4, "d": 5}


def _hot(spark, rows=6000):
    """A third of the rows share one key, and some keys are null."""
    return spark.range(rows).select(
        c("id").alias("row_id"),
        F.when(c("id") % 3 == 0, 0).when(c("id") % 50 == 1, F.lit(None)).otherwise(c("id") % 97).alias("k"),
        (c("id") % 11).cast("int").alias("v"),
    )


def test_one_pass_evidence_equals_single_evidence(spark):
    df = _hot(spark).withColumn("t", F.concat(F.lit("t"), c("v").cast("string")))
    specs = [
        Evidence("first", ("k",), "v", "first", c("v") > 3),
        Evidence("mode", ("k",), "t", "mode"),
        Evidence("dominant", ("k",), "v", "dominant"),
    ]
    got = gather(df, specs, "v").collect()
    pick = lambda name: {int(r.key1): r[name] for r in got if r["name"] == name}
    assert {k: int(v) for k, v in pick("first").items()} == found(im.first_by_key(df, ["k"], "v", c("v") > 3))
    assert pick("mode") == found(im.mode_by_key(df, ["k"], "t"))
    several = {int(r.key1): int(r.dominant) for r in got if r["name"] == "dominant" and r["values"] > 1}
    assert several == found(im.dominant_by_key(df, "k", "v", "v"))


@pytest.mark.parametrize("null_safe", [False, True])
def test_attach_gives_the_same_rows_both_ways(spark, area, null_safe):
    df = _hot(spark)
    table = df.groupBy("k").agg(F.max("v").alias("top"))
    small = joins.attach(df, table, ["k"], area, null_safe=null_safe)
    large = joins.attach(df, table, ["k"], area, null_safe=null_safe, broadcast_bytes=0)
    assert "Broadcast" in small._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in large._jdf.queryExecution().sparkPlan().toString()
    assert sorted(map(str, small.collect())) == sorted(map(str, large.collect()))
    assert large.count() == df.count()
    tops = {r.k: r.top for r in small.collect()}
    assert (tops[None] is not None) == null_safe


def test_large_join_splits_a_hot_key(spark, area):
    """A key with a third of the rows does not stay in one partition."""
    df = _hot(spark)
    df = df.unionByName(df).unionByName(df).withColumn("wide", F.concat(*[F.sha2(F.uuid(), 512) for _ in range(3)]))
    table = df.groupBy("k").agg(F.max("v").alias("top"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "32",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = joins.attach(df.repartition(16), table, ["k"], area, broadcast_bytes=0)
        sizes = [r[1] for r in area.table(joined.withColumn("p", F.spark_partition_id()), "joined").groupBy("p").count().collect()]
        assert max(sizes) < df.count() / 3 / 2
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_dense_key_is_dense_ordered_and_repeatable(spark, area):
    ids = list(range(5000))
    random.Random(7).shuffle(ids)
    # One value of the leading column holds most rows.
    df = spark.createDataFrame([(0 if i % 3 else i % 5, i) for i in ids], "g int, i int").repartition(6)
    keyed = dense_key(df, "key", ["g", "i"], area, start=10)
    rows = sorted(keyed.collect(), key=lambda r: r.key)
    assert [r.key for r in rows] == list(range(10, 5010))
    assert [(r.g, r.i) for r in rows] == sorted((r.g, r.i) for r in rows)
    again = dense_key(df.repartition(3), "key", ["g", "i"], area, start=10)
    assert sorted(map(str, again.collect())) == sorted(map(str, keyed.collect()))
    assert dense_key(df.limit(0), "key", ["g", "i"], area).count() == 0


def test_mode_ties_of_digit_like_texts(spark):
    """Texts are compared as texts, numbers as numbers, in one pass as in single passes."""
    df = spark.createDataFrame([(1, "k", "9", 9), (2, "k", "10", 10)], "row_id long, k string, t string, n long")
    specs = [Evidence("t", ("k",), "t", "mode"), Evidence("n", ("k",), "n", "mode")]
    got = {r["name"]: r["mode"] for r in gather(df, specs, "n").collect()}
    assert got == {"t": "10", "n": "9"}
    assert found(im.mode_by_key(df, ["k"], "t")) == {"k": "10"}


def test_marks_are_counted_together(spark):
    marks = Marks()
    df = spark.createDataFrame([(i, None if i % 5 == 0 else i) for i in range(30)], "i int, v int")
    df = marks.add(df, **{"a__even": F.col("i") % 2 == 0, "a__null": F.col("v").isNull()})
    df = marks.add(df.where("i < 20"), b__big=F.col("v") > 10)
    assert df.agg(*marks.counts()).first().asDict() == {"a__even": 10, "a__null": 4, "b__big": 8}
