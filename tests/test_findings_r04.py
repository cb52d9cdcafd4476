"""Findings of round 4: what a run leaves on disk, and that the removal of copies stays the same."""

import os

import pytest
from pyspark.sql import functions as F, types as T

from skyledger.operators import joins
from skyledger.operators.copies import Copies, without_copies
from skyledger.operators.rows import dedupe_rows
from skyledger.plans.clean import clean, run_rules
from skyledger.schemas import CARRIER_HISTORY, FACT_RAW, LOOKUP, ROW_ID
from skyledger.session import SHUFFLE_FILES, tune

NAN = float("nan")
ROWS = [(5, "a", None, 0.0), (4, "a", None, -0.0), (3, "b", None, 1.0), (2, None, "b", 1.0), (2, None, "b", 1.0), (None, "b", "x", NAN),
        (6, "b", "x", NAN), (None, "z", "z", None), (None, "z", "z", None), (7, "", None, 1.0), (7, None, "", 1.0)]


def _sorted(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("order", [("row_id",), ("other", "row_id"), ()])
def test_copies_go_as_they_do_when_rows_are_compared(spark, area, monkeypatch, limit, order):
    monkeypatch.setattr(joins, "BROADCAST_BYTES", limit)
    odd = spark.createDataFrame(ROWS * 40, "row_id long, k string, v string, f double")
    many = spark.range(20000).select(F.col("id").alias("row_id"), (F.col("id") % 15001).cast("string").alias("k"), F.lit("v").alias("v"), F.lit(1.0).alias("f"))
    df = odd.repartition(3).unionByName(many).withColumn("other", F.col("row_id") % 2)
    assert _sorted(without_copies(df, area, order)) == _sorted(dedupe_rows(df, order))


def test_columns_aside_are_kept_with_the_written_rows_only(spark, area):
    copies = Copies(spark.createDataFrame([(1, "a", 7), (2, "a", 8)], "row_id long, k string, mark int"), area, aside=("mark",))
    assert [tuple(r) for r in copies.kept().collect()] == [(1, "a")]
    assert sorted(r.mark for r in copies.rows.collect()) == [7, 8]


def _inputs(spark):
    schema = T.StructType([T.StructField(ROW_ID, T.LongType()), *FACT_RAW.fields])
    given = {"UniqueCarrier": "AC", "AirlineID": 20001, "Origin": "A", "Dest": "B", "Distance": 10.0, "Freight": 1.0}
    raw = spark.createDataFrame(
        [tuple((given | {ROW_ID: n, "Seats": n % 3}).get(c) for c in schema.fieldNames()) for n in range(9)], schema)
    airports = spark.createDataFrame([], T.StructType([T.StructField(ROW_ID, T.LongType()), *LOOKUP.fields]))
    return raw, airports, spark.createDataFrame([], CARRIER_HISTORY)


def test_no_row_is_shuffled_to_remove_copies(spark, area):
    run = run_rules(*_inputs(spark), area)
    assert "_row" not in run.final._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.row_id, r.Seats) for r in run.final.collect()) == [(0, 0), (1, 1), (2, 2)]


def test_cleaning_leaves_on_disk_what_its_result_reads(spark, area):
    rows = clean(*_inputs(spark), area)
    assert sorted(n.split("-", 1)[1] for n in os.listdir(area.root.removeprefix("file:"))) == ["first-rows", "placed-rows"]
    assert rows.count() == 3


def test_shuffle_files_go_with_the_action(spark):
    assert tune(spark).conf.get(SHUFFLE_FILES[0]) == "true"
