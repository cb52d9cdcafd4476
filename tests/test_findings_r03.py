"""Findings of round 3: work that must be done once, and results that stay the same."""

from pyspark.sql import types as T

from skyledger.catalog import inputs
from skyledger.operators import joins
from skyledger.plans import rules as r
from skyledger.plans.clean import run_rules
from skyledger.schemas import CARRIER_HISTORY, FACT_RAW, LOOKUP, ROW_ID

NAMES = [(1, " acme airls. inc."), (2, "Acme Air Lines"), (3, None), (4, "Acme Air Lines"), (5, ""), (6, "Beta Intl.")]


def _named(spark, area, repeat=1):
    df = spark.createDataFrame(NAMES * repeat, "row_id long, UniqueCarrierName string")
    names = area.table(r.spelled_names(df), "names")
    return df, r.use_spelled_names(df, names, names.count(), area)


def test_every_spelling_is_normalized_once(spark, area, monkeypatch):
    df, found = _named(spark, area, 3)
    expected = sorted(map(tuple, r.r02_names(df).collect()), key=str)
    assert found.columns == df.columns
    assert sorted(map(tuple, found.collect()), key=str) == expected
    assert "regexp_replace" not in found._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    _, by_row = _named(spark, area, 3)
    assert sorted(map(tuple, by_row.collect()), key=str) == expected
    assert "Join" not in by_row._jdf.queryExecution().executedPlan().toString()


def test_rules_leave_no_name_to_normalize_per_row(spark, area):
    schema = T.StructType([T.StructField(ROW_ID, T.LongType()), *FACT_RAW.fields])
    given = {"UniqueCarrier": "AC", "AirlineID": 20001, "Origin": "A", "Dest": "B", "Distance": 10.0, "Freight": 1.0}
    raw = spark.createDataFrame(
        [tuple((given | {ROW_ID: n, "UniqueCarrierName": name}).get(c) for c in schema.fieldNames()) for n, name in NAMES], schema)
    airports = spark.createDataFrame([], T.StructType([T.StructField(ROW_ID, T.LongType()), *LOOKUP.fields]))
    run = run_rules(raw, airports, spark.createDataFrame([], CARRIER_HISTORY), area)
    assert "INTERNATIONAL" not in run.repaired._jdf.queryExecution().optimizedPlan().toString()
    names = sorted({x.UniqueCarrierName for x in run.repaired.collect()}, key=str)
    assert names == ["", "ACME AIR LINES", "BETA INTERNATIONAL", None]


def test_files_grow_in_number_and_not_in_size(spark, monkeypatch):
    monkeypatch.setattr(inputs, "_PIECE_ROWS", 10)
    assert [inputs.pieces(spark.range(n), 5) for n in (0, 50, 51, 1000)] == [5, 5, 6, 100]
