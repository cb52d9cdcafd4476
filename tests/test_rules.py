"""Rules on small frames: nulls, ties, order of effects, repetition."""

from pyspark.sql import functions as F

from skyledger.plans import lookups as lk, rules as r, variants as v
from skyledger.sources import tables

c = F.col


def rows(df, *columns):
    return sorted((tuple(x) for x in df.select(*columns).collect()), key=str)


def test_r07_fills_its_own_row_and_drops_the_hopeless(spark, area):
    data = [(1, "A", "B", 100.0), (2, "A", "B", None), (3, "A", "B", -5.0), (4, "A", "B", 120.0),
            (5, "C", "D", 0.0), (6, None, "B", None), (7, None, "B", 50.0)]
    df = spark.createDataFrame(data, "row_id long, Origin string, Dest string, Distance double")
    assert rows(r.r07_distance(df, area), "row_id", "Distance") == [
        (1, 100.0), (2, 120.0), (3, 120.0), (4, 120.0), (7, 50.0)]
    assert (6, 50.0) in rows(v.v07_distance_nullsafe(df, area), "row_id", "Distance")


def test_r03_infers_first_id_in_row_order(spark, area):
    data = [(1, "AA", 0, "x"), (2, "AA", 9, "x"), (3, "AA", 5, "x"), (4, "ZZ", None, "y"), (5, None, 0, "z")]
    df = spark.createDataFrame(data, "row_id long, UniqueCarrier string, AirlineID int, UniqueCarrierName string")
    assert rows(r.r03_airline_id(df, area), "row_id", "AirlineID", "UniqueCarrier", "UniqueCarrierName") == [
        (1, 9, "AA", "x"), (2, 9, "AA", "x"), (3, 5, "AA", "x"), (4, 0, "UNK", "DESCONOCIDO"),
        (5, 0, "UNK", "DESCONOCIDO")]
    assert rows(v.v03_sentinel_only(df), "row_id", "AirlineID", "UniqueCarrier")[3] == (4, None, "ZZ")


def test_r08_range_then_coherence(spark):
    data = [(1, 50, 60), (2, 0, 60), (3, 70, 60), (4, 50, 9001), (5, None, 60), (6, 9000, 9000)]
    df = spark.createDataFrame(data, "row_id long, AirTime int, RampTime int")
    expected = [(1, 50, 60), (2, None, 60), (3, None, None), (4, 50, None), (5, None, 60), (6, 9000, 9000)]
    assert rows(r.r08_times(df), "row_id", "AirTime", "RampTime") == expected
    assert rows(r.r08_times(r.r08_times(df)), "row_id", "AirTime", "RampTime") == expected


def test_r09_null_id_is_other_than_the_dominant(spark, area):
    data = [(1, "A", 1, 5), (2, "A", 1, 5), (3, "A", 2, 90), (4, "A", None, 1), (5, "B", None, 1), (6, "B", 7, 1)]
    df = spark.createDataFrame(data, "row_id long, UniqueCarrier string, AirlineID int, Passengers int")
    assert rows(r.r09_dominant_id(df, area), "row_id", "AirlineID", "AirlineID_original", "is_merged_carrier") == [
        (1, 1, 1, False), (2, 1, 1, False), (3, 1, 2, True), (4, 1, None, True), (5, None, None, False),
        (6, 7, 7, False)]


def test_r16_matches_id_and_code_before_the_period(spark, area):
    history = spark.createDataFrame(
        [("19991", "US", "2015-04-08"), ("19386", "US", None), ("1", "XX", "  "), ("2", "YY", "2023-01-01"),
         ("0", "EA", "1991-01-18"), ("x", "ZZ", "1991-01-18")],
        "AirlineID string, UniqueCarrier string, EndDate string")
    df = spark.createDataFrame([(1, 19991, "US"), (2, 19386, "US"), (3, None, "EA"), (4, 2, "YY"), (5, 0, "ZZ")],
                               "row_id long, AirlineID int, UniqueCarrier string")
    assert rows(r.r16_inactive(df, history, area), "row_id", "AirlineID", "IsActive") == [
        (1, 19991, 0), (2, 19386, 1), (3, None, 0), (4, 2, 1), (5, 0, 1)]


def test_r18_region(spark, area):
    data = [(1, "A", "NULL"), (2, "A", "D"), (3, "A", "C"), (4, "B", " "), (5, "B", None)]
    df = spark.createDataFrame(data, "row_id long, UniqueCarrier string, CarrierRegion string")
    assert [x[1] for x in rows(r.r18_region(df, area), "row_id", "CarrierRegion")] == [
        "D", "D", "C", "Desconocido", "Desconocido"]


def test_city_lookup_wins_over_mode_and_last_entry_wins(spark, area):
    airports = spark.createDataFrame(
        [(1, "N1", "City 1x, ST: Main"), (2, "N1", "City 1y, ST: Other"), (3, "N2", None), (4, None, "Unknown")],
        "row_id long, Code string, Description string")
    data = [(1, "N1", None, "N2", None), (2, "N1", "Old", "N2", "Two"), (3, "N3", None, "N1", None),
            (4, "N2", "Z", "N2", "One"), (5, "N2", "Y", "N2", "Two")]
    df = spark.createDataFrame(data, "row_id long, Origin string, OriginCityName string, Dest string, DestCityName string")
    assert rows(r.r04_city(df, airports, area), "row_id", "OriginCityName", "DestCityName") == [
        (1, "City 1y, ST", "Two"), (2, "Old", "Two"), (3, None, "City 1y, ST"), (4, "Z", "One"), (5, "Y", "Two")]


def test_r11_keeps_what_it_cannot_replace(spark, area):
    data = [(1, 2000, 10, 10), (2, 2000, 10, 1001), (3, 2001, 10, 10), (4, 2000, 10, None), (5, 2000, 10, 1002)]
    df = spark.createDataFrame(data, "row_id long, Year int, OriginAirportID int, OriginAirportSeqID int").withColumns(
        {"DestAirportID": F.lit(1), "DestAirportSeqID": F.lit(100)})
    assert [x[1] for x in rows(r.r11_airport_seq(df, area), "row_id", "OriginAirportSeqID")] == [1001, 1001, 10, None, 1002]


def test_v11_uses_the_period_and_v13_drops_equal_and_null(spark, area):
    codes = spark.createDataFrame(
        [(1, "1013503", "Atlanta (2005-)"), (2, "1013401", "Atlanta (PRE-2005)"), (3, "10135", "short"), (4, "9999999", None)],
        "row_id long, Code string, Description string")
    data = [(1, 2004, 10135, 10135), (2, 2005, 10135, 10135), (3, 2004, 10134, 10134), (4, None, 10135, 10135),
            (5, 2005, 10135, 1013500)]
    df = spark.createDataFrame(data, "row_id long, Year int, OriginAirportID int, OriginAirportSeqID int").withColumns(
        {"DestAirportID": F.lit(1), "DestAirportSeqID": F.lit(100)})
    assert rows(v.v11_seq_period_lookup(df, codes, area), "row_id", "OriginAirportSeqID") == [
        (1, None), (2, "1013503"), (3, "1013401"), (4, "10135"), (5, "1013500")]
    freight = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (None, 2.0), (-1.0, 2.0), (1.0, None)], "Freight double, Payload double")
    assert v.v13_freight_filter(freight).count() == 1


def test_caps_and_flags_twice_equal_once(spark):
    data = [(1, 5, 7, 0, 4, 9.0, 3.0), (2, 5, None, 6, 8, None, 3.0)]
    df = spark.createDataFrame(data, "row_id long, DepScheduled int, DepPerformed int, Seats int, Passengers int, Freight double, Payload double")
    for rule in (r.r05_cap_departures, r.r06_cap_passengers, r.r13_cap_freight, r.r14_seat_flag, r.r15_negative_freight):
        assert rows(rule(df), "*") == rows(rule(rule(df)), "*")


HISTORY = [
    ("19386", "AA", "1990-01-01", None), ("19690", "DL", "1990-01-01", None), ("19386", "DL", "2020-01-01", None),
    ("19991", "US", "1990-01-01", "2015-04-08"), ("19386", "US", "2015-04-09", None),
    ("20271", "KS", "2010-01-01", "2005-12-31"), ("21171", "CP", "2007-06-01", "2099-12-31"),
    ("99999", "G4", "2019-01-01", None), ("0", "EA", "1990-01-01", "1991-01-18"), ("19386", "AA(1)", "1990-01-01", "2001-12-31"),
]


def test_carrier_history_cases(spark, area):
    df = spark.createDataFrame(
        [(i, a, u, "n", s, e) for i, (a, u, s, e) in enumerate(HISTORY)],
        "row_id long, AirlineID string, UniqueCarrier string, CarrierName string, StartDate string, EndDate string")
    out = lk.carrier_history(df, 2026, area)
    kept = [(x.AirlineID, x.UniqueCarrier) for x in out.orderBy("row_id").collect()]
    assert kept == [(19386, "AA"), (19690, "DL"), (19991, "US"), (19386, "US"), (20271, "KS"), (0, "EA")]
    swapped = out.where("UniqueCarrier = 'KS'").selectExpr("string(StartDate)", "string(EndDate)").first()
    assert tuple(swapped) == ("2005-12-31", "2010-01-01")
    assert tables.closed_history(df).count() == 5


def test_unique_carriers_cases(spark):
    data = [(1, "AA", "American Airlines Inc."), (2, "OO", ""), (3, "OO", "SkyWest"), (4, " AA", "x"), (5, "aa", "y"),
            (6, "AA(1)", "z"), (7, "  ", "w"), (8, None, "w"), (9, "US ", None), (10, "us", " ")]
    df = spark.createDataFrame(data, "row_id long, Code string, Description string")
    assert rows(lk.unique_carriers(df), "Code", "Description", "IsActive") == [
        ("AA", "American Airlines Inc.", True), ("OO", "SkyWest", True), ("US", None, False)]
