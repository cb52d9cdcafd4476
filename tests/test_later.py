"""Corrections of months, change detection by hash, orphans by bitmap, mergeable profiles."""

import os
import random
import uuid

from pyspark.sql import functions as F

from skyledger.operators import bitmaps, changes
from skyledger.plans import corrections, history as h, profiles
from skyledger.sources import tables


def test_corrections_write_only_their_months(spark, area):
    folder = area.path("monthly")
    rows = spark.range(400).select(
        (F.col("id") % 2 + 2000).cast("int").alias("Anio"), (F.col("id") % 3 + 1).cast("int").alias("Mes"), F.col("id").alias("row_id"),
        (F.col("id") + 1).alias("VueloKey"), F.lit("old").alias("v"))
    tables.stage_overwrite(rows, folder, "Vuelo", "Anio", "Mes")
    place = f"{folder}/Vuelo".removeprefix("file:")
    files = lambda: {f"{d}/{f}" for d, _, names in os.walk(place) for f in names if f.endswith(".parquet")}
    before = files()
    late = rows.where("Anio = 2000 AND Mes = 1 AND row_id % 4 = 0").drop("VueloKey").withColumn("v", F.lit("new"))
    more = spark.range(1000, 1100).select(F.lit(2001).alias("Anio"), F.lit(2).alias("Mes"), F.col("id").alias("row_id"), F.lit("more").alias("v"))
    unseen = spark.range(2).select(F.lit(2002).alias("Anio"), F.lit(9).alias("Mes"), F.col("id").alias("row_id"), F.lit("first").alias("v"))
    after = corrections.correct_months(
        spark, folder, "Vuelo", late.unionByName(more).unionByName(unseen), "VueloKey", ["row_id"], area)
    gone, come = before - files(), files() - before
    assert {f.split("/")[-3:-1][0] + f.split("/")[-2] for f in gone} == {"Anio=2000Mes=1", "Anio=2001Mes=2"}
    assert {f.split("/")[-3:-1][0] + f.split("/")[-2] for f in come} == {"Anio=2000Mes=1", "Anio=2001Mes=2", "Anio=2002Mes=9"}
    got = after.collect()
    assert len({r.VueloKey for r in got}) == len(got)
    old = {(r.Anio, r.Mes): sorted(x.VueloKey for x in rows.where(f"Anio = {r.Anio} AND Mes = {r.Mes}").collect()) for r in rows.select("Anio", "Mes").distinct().collect()}
    for month in ((2000, 1), (2001, 2), (2000, 2)):
        new = [r.VueloKey for r in sorted((r for r in got if (r.Anio, r.Mes) == month), key=lambda r: r.row_id)]
        assert new[:len(old[month])] == old[month][:len(new)]
        assert all(k > 400 for k in new[len(old[month]):])
    assert {r.v for r in got if (r.Anio, r.Mes) == (2000, 1)} == {"new"}
    again = corrections.correct_months(spark, folder, "Vuelo", late.limit(0), "VueloKey", ["row_id"], area)
    assert again.count() == len(got)


def test_changes_by_hash_leave_the_stored_side_where_it_is(spark, area):
    rnd = random.Random(1)
    value = lambda: rnd.choice([None, "", "x", "y|", "|,+"])
    names = [(a, b) for a in (None, "", "-", "a", "+a", "a|", "|,+b") for b in (None, "b", "|", 3)]
    names = [(a, None if b is None else str(b)) for a, b in names]
    old = [(*n, value(), value()) for n in names if rnd.random() < 0.7]
    new = [(*n, value(), value()) for n in names if rnd.random() < 0.7]
    schema = "k1 string, k2 string, v1 string, v2 string"
    old_df, new_df = spark.createDataFrame(old, schema), spark.createDataFrame(new, schema)
    table, key, attributes = f"hashes_{uuid.uuid4().hex}", ["k1", "k2"], ["v1", "v2"]
    changes.store_hashes(old_df, key, attributes, table, area.path("hashes"))
    found = changes.changes_by_hash(spark, table, new_df, key, attributes)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "SelectedBucketsCount" in plan
    assert sorted(map(tuple, found.collect()), key=str) == sorted(
        map(tuple, h.change_detect(old_df, new_df, key, attributes).collect()), key=str)
    spark.sql(f"DROP TABLE {table}")


def test_orphans_by_bitmap(spark):
    keys = [1, 2, 32768, 32769, 70000, 10**9]
    dims = {"A": spark.createDataFrame([(k,) for k in keys if k != 2], "AKey int"), "B": spark.createDataFrame([(k,) for k in (*keys, -1)], "BKey int")}
    fact = spark.createDataFrame([(k, k, j) for k in (*keys, 65536, 10**9 + 1, -1, 0, None) for j in (k, 2)], "a long, b long, c long")
    got = {tuple(r) for r in bitmaps.orphan_keys(fact, dims, {"a": "A", "b": "B", "c": "A"}).collect()}
    want = {(column, k) for column, known in (("a", {*keys} - {2}), ("b", {*keys, -1}), ("c", {*keys} - {2}))
            for k in (*keys, 65536, 10**9 + 1, -1, 0) if k not in known}
    assert got == want
    assert bitmaps.orphan_keys(fact.limit(0), dims, {"a": "A"}).count() == 0


def test_profiles_merge(spark):
    rows = spark.range(30000).select(
        F.col("id"), (F.col("id") % 7000).cast("string").alias("text"), F.when(F.col("id") % 3 > 0, F.col("id") * 0.5).alias("half"))
    whole = {r.columna: r for r in profiles.estimates(profiles.profile(rows, ["id", "text", "half"]), (0.25, 0.5)).collect()}
    stored = None
    for k in range(4):
        stored = profiles.kept(stored, profiles.profile(rows.where(f"id % 4 = {k}"), ["id", "text", "half"]))
    merged = {r.columna: r for r in profiles.estimates(stored, (0.25, 0.5)).collect()}
    for name, distinct in (("id", 30000), ("text", 7000), ("half", 20000)):
        assert (merged[name].filas, merged[name].nulos) == (30000, 10000 if name == "half" else 0)
        assert abs(merged[name].distintos - distinct) <= 3 * profiles.DISTINCT_ERROR * distinct
        assert merged[name].distintos == whole[name].distintos
    assert merged["text"].q50 is None
    for name, top in (("id", 30000), ("half", 15000)):
        assert abs(merged[name].q50 - top / 2) <= 2 * profiles.RANK_ERROR * top and abs(merged[name].q25 - top / 4) <= 2 * profiles.RANK_ERROR * top
