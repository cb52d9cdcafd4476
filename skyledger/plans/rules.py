"""The eighteen quality rules.

Every rule is ``DataFrame -> DataFrame``. Rules that need evidence from other
rows also take the staging area in which that evidence is written.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.functions import text
from skyledger.functions.numbers import cap, holds, to_date, to_number, within
from skyledger.operators.impute import (
    FILL,
    dominant_by_key,
    fill_missing,
    fill_wrong,
    first_by_key,
    join_found,
    last_by_key,
    max_by_key,
    mode_by_key,
)
from skyledger.operators.joins import attach, broadcasts
from skyledger.operators.rows import copy_column, dedupe_rows, drop_where, flag_where
from skyledger.schemas import ROW_ID
from skyledger.sources.tables import closed_history, described
from skyledger.staging import StagingArea

ROW_ORDER = (ROW_ID,)
REQUIRED_TEXTS = ("CarrierName", "Class", "OriginCityName", "DestCityName", "AircraftType")
ENDS = ("Origin", "Dest")


# -- conditions shared by the rules and the audit ----------------------------


def valid_distance() -> Column:
    return holds(F.col("Distance") > 0)


def seq_is_airport(end: str) -> Column:
    return F.col(f"{end}AirportSeqID") == F.col(f"{end}AirportID")


def market_is_airport(end: str) -> Column:
    return F.col(f"{end}CityMarketID") == F.col(f"{end}AirportID")


def passengers_without_seats() -> Column:
    return (F.col("Seats") == 0) & (F.col("Passengers") > 0)


# -- R10: copies --------------------------------------------------------------


def r10_dedupe(df: DataFrame, order_by: Sequence[str] = ROW_ORDER) -> DataFrame:
    return dedupe_rows(df, order_by)


# -- R07: distance from the route ---------------------------------------------


def route_distances(df: DataFrame, null_keys: bool = False) -> DataFrame:
    return max_by_key(df, ENDS, "Distance", valid_distance(), null_keys)


def use_route_distance(df: DataFrame, routes: DataFrame, area: StagingArea, **options) -> DataFrame:
    joined = join_found(df, routes, ENDS, area, **options)
    filled = fill_missing(joined, "Distance", FILL, usable=F.col("Distance") > 0)
    return filled.where(F.col("Distance") > 0)


def r07_distance(df: DataFrame, area: StagingArea, null_safe: bool = False) -> DataFrame:
    """Missing or non-positive distance: the route's longest; no such distance: drop the row."""
    return use_route_distance(df, route_distances(df, null_safe), area, null_safe=null_safe)


# -- R15, R01, R17, R02: row by row -------------------------------------------


def r15_negative_freight(df: DataFrame) -> DataFrame:
    return drop_where(df, F.col("Freight") < 0)


def r01_suffix(df: DataFrame, trimmed: bool = True) -> DataFrame:
    return df.withColumns(
        {c: text.strip_code_suffix(F.col(c), trimmed) for c in ("UniqueCarrier", "Carrier")}
    )


def r17_unify_carrier(df: DataFrame) -> DataFrame:
    return copy_column(df, "UniqueCarrier", "UniqCarrierEntity", "Carrier", "CarrierName")


def r02_names(df: DataFrame) -> DataFrame:
    return df.withColumn("UniqueCarrierName", text.normalize_name(F.col("UniqueCarrierName")))


def spelled_names(df: DataFrame) -> DataFrame:
    """The different spellings of names (``_spelled``) and the name of each, so that a spelling is normalized once."""
    spelled = df.select("UniqueCarrierName").distinct()
    return r02_names(spelled.withColumn("_spelled", F.col("UniqueCarrierName")))


def use_spelled_names(df: DataFrame, names: DataFrame, rows: int, area: StagingArea) -> DataFrame:
    """R02 by a written table of ``rows`` spellings; with too many to broadcast every row is normalized where it is."""
    if not broadcasts(names, rows):
        return r02_names(df)
    named = names.select(F.col("_spelled").alias("UniqueCarrierName"), F.col("UniqueCarrierName").alias(FILL))
    found = join_found(df, named.dropna(), ["UniqueCarrierName"], area, rows=rows)
    return found.withColumn("UniqueCarrierName", F.col(FILL)).drop(FILL)


# -- R03: missing airline id ---------------------------------------------------


def known_airline_ids(df: DataFrame, order_by: Sequence[str] = ROW_ORDER) -> DataFrame:
    return first_by_key(df, ["UniqueCarrier"], "AirlineID", F.col("AirlineID") > 0, order_by)


def use_airline_ids(df: DataFrame, ids: DataFrame, area: StagingArea, **options) -> DataFrame:
    joined = join_found(df, ids, ["UniqueCarrier"], area, **options)
    filled = fill_missing(joined, "AirlineID", FILL, F.lit(0), usable=F.col("AirlineID") != 0)
    return mark_unknown_carrier(filled)


def mark_unknown_carrier(df: DataFrame) -> DataFrame:
    """AirlineID 0 -> sentinel code and name."""
    unknown = F.col("AirlineID") == 0
    return df.withColumns(
        {
            "UniqueCarrier": F.when(unknown, fv.UNKNOWN_CARRIER_CODE).otherwise(
                F.col("UniqueCarrier")
            ),
            "UniqueCarrierName": F.when(unknown, fv.UNKNOWN_CARRIER_NAME).otherwise(
                F.col("UniqueCarrierName")
            ),
        }
    )


def r03_airline_id(
    df: DataFrame, area: StagingArea, order_by: Sequence[str] = ROW_ORDER
) -> DataFrame:
    return use_airline_ids(df, known_airline_ids(df, order_by), area)


# -- R04: required texts ---------------------------------------------------------


def blanks_to_null(df: DataFrame, columns: Sequence[str] = REQUIRED_TEXTS) -> DataFrame:
    return df.withColumns({c: text.blank_to_null(F.col(c)) for c in columns})


def r04_carrier_name(df: DataFrame) -> DataFrame:
    return df.withColumn("CarrierName", F.coalesce("CarrierName", "Carrier"))


def r04_class_mode(df: DataFrame, area: StagingArea) -> DataFrame:
    modes = mode_by_key(df, ["UniqueCarrier"], "Class")
    return fill_missing(join_found(df, modes, ["UniqueCarrier"], area), "Class", FILL)


def airport_cities(airports: DataFrame, order_by: Sequence[str] = ROW_ORDER) -> DataFrame:
    """City per airport code; a later entry of the same code replaces an earlier one."""
    cities = described(airports).withColumn("City", text.city_of(F.col("Description")))
    return last_by_key(cities, ["Code"], "City", order_by=order_by)


def r04_city_lookup(df: DataFrame, airports: DataFrame, area: StagingArea) -> DataFrame:
    cities = area.table(airport_cities(airports), "airport-cities")
    rows = cities.count()
    for end in ENDS:
        named = cities.withColumnRenamed("Code", end)
        df = fill_missing(join_found(df, named, [end], area, rows=rows), f"{end}CityName", FILL)
    return df


def r04_city_mode(df: DataFrame, area: StagingArea) -> DataFrame:
    for end in ENDS:
        modes = mode_by_key(df, [end], f"{end}CityName")
        df = fill_missing(join_found(df, modes, [end], area), f"{end}CityName", FILL)
    return df


class CityTables:
    """Cities per airport and end: the lookup's where it has one, else the data's.

    Both ends are written as one table, which is counted once.
    """

    def __init__(self, lookup: DataFrame, modes: dict[str, DataFrame], area: StagingArea):
        ranked = None
        for end, seen in modes.items():
            for source, table in enumerate(
                (lookup.select(F.col("Code").alias("_code"), FILL),
                 seen.select(F.col(end).alias("_code"), FILL))
            ):
                part = table.dropna().select(
                    F.lit(end).alias("_end"), "_code", FILL, F.lit(source).alias("_source")
                )
                ranked = part if ranked is None else ranked.unionByName(part)
        best = ranked.groupBy("_end", "_code").agg(F.min_by(FILL, "_source").alias(FILL))
        self.written = area.table(best, "cities")
        self.rows = self.written.count()
        self.area = area

    def fill(self, df: DataFrame, end: str) -> DataFrame:
        cities = self.written.where(F.col("_end") == end).select(F.col("_code").alias(end), FILL)
        joined = join_found(df, cities, [end], self.area, rows=self.rows)
        return fill_missing(joined, f"{end}CityName", FILL)


def r04_city(df: DataFrame, airports: DataFrame, area: StagingArea) -> DataFrame:
    """Missing city: the airport lookup's, else the airport's most frequent city in the data."""
    modes = {end: mode_by_key(df, [end], f"{end}CityName") for end in ENDS}
    cities = CityTables(airport_cities(airports), modes, area)
    return cities.fill(cities.fill(df, "Origin"), "Dest")


def r04_required(
    df: DataFrame, airports: DataFrame, area: StagingArea, blanks: bool = True
) -> DataFrame:
    """Carrier name, class and cities; the aircraft type cannot be inferred and stays null."""
    df = r04_carrier_name(blanks_to_null(df) if blanks else df)
    return r04_city(r04_class_mode(df, area), airports, area)


# -- R05, R06, R08: physical limits -----------------------------------------------


def r05_cap_departures(df: DataFrame) -> DataFrame:
    return df.withColumn("DepPerformed", cap(F.col("DepPerformed"), F.col("DepScheduled")))


def r06_cap_passengers(df: DataFrame) -> DataFrame:
    seats = F.col("Seats")
    return df.withColumn("Passengers", cap(F.col("Passengers"), seats, seats > 0))


def r08_times(df: DataFrame) -> DataFrame:
    """Impossible minutes -> null; then air time above ramp time -> both null."""
    air, ramp = F.col("AirTime"), F.col("RampTime")
    df = df.withColumns(
        {c: within(F.col(c), fv.MINUTES_MIN, fv.MINUTES_MAX) for c in ("AirTime", "RampTime")}
    )
    df = df.withColumn("_coherent", ~holds(air > ramp))
    coherent = F.col("_coherent")
    return df.withColumns(
        {"AirTime": F.when(coherent, air), "RampTime": F.when(coherent, ramp)}
    ).drop("_coherent")


# -- R09: one id per carrier code ----------------------------------------------------


def dominant_ids(df: DataFrame) -> DataFrame:
    return dominant_by_key(df, "UniqueCarrier", "AirlineID", "Passengers")


def assign_dominant_id(df: DataFrame, found: str) -> DataFrame:
    other = F.col(found).isNotNull() & ~F.col("AirlineID").eqNullSafe(F.col(found))
    return df.withColumns(
        {
            "is_merged_carrier": other,
            "AirlineID_original": F.col("AirlineID"),
            "AirlineID": F.coalesce(found, "AirlineID"),
        }
    ).drop(found)


def r09_dominant_id(df: DataFrame, area: StagingArea) -> DataFrame:
    joined = attach(df, dominant_ids(df), ["UniqueCarrier"], area, name="dominant-id")
    return assign_dominant_id(joined, FILL)


# -- R11, R12: airport versions and markets ---------------------------------------------


def r11_airport_seq(
    df: DataFrame, area: StagingArea, order_by: Sequence[str] = ROW_ORDER
) -> DataFrame:
    """A version id that only repeats the airport id: the first sound one of airport and year."""
    for end in ENDS:
        keys, target = [f"{end}AirportID", "Year"], f"{end}AirportSeqID"
        sound = first_by_key(df, keys, target, ~holds(seq_is_airport(end)), order_by)
        df = fill_wrong(join_found(df, sound, keys, area), target, FILL, seq_is_airport(end))
    return df


def r12_city_market(
    df: DataFrame, area: StagingArea, order_by: Sequence[str] = ROW_ORDER
) -> DataFrame:
    """A market id that only repeats the airport id: the first sound one of the airport."""
    for end in ENDS:
        keys, target = [f"{end}AirportID"], f"{end}CityMarketID"
        sound = first_by_key(df, keys, target, ~holds(market_is_airport(end)), order_by)
        df = fill_wrong(join_found(df, sound, keys, area), target, FILL, market_is_airport(end))
    return df


# -- R13, R14: freight and seats -----------------------------------------------------------


def r13_cap_freight(df: DataFrame) -> DataFrame:
    return df.withColumn("Freight", cap(F.col("Freight"), F.col("Payload")))


def r14_seat_flag(df: DataFrame) -> DataFrame:
    return flag_where(df, "Flag_Review_Seats", passengers_without_seats())


# -- R16: carriers that had ended -------------------------------------------------------------


def ended_carriers(history: DataFrame, before: str = fv.INACTIVE_BEFORE) -> DataFrame:
    """(AirlineID, UniqueCarrier) pairs with an end date before the period, from raw history."""
    ended = to_date(F.col("EndDate")) < F.lit(before).cast("date")
    return (
        closed_history(history)
        .where(ended)
        .select(to_number(F.col("AirlineID"), "int").alias("AirlineID"), "UniqueCarrier")
        .dropna()
        .distinct()
        .withColumn("_ended", F.lit(True))
    )


def use_ended_carriers(df: DataFrame, ended: DataFrame, area: StagingArea) -> DataFrame:
    joined = attach(df, ended, ["AirlineID", "UniqueCarrier"], area, name="ended-carriers")
    return flag_where(joined, "IsActive", F.col("_ended"), 0, 1).drop("_ended")


def r16_inactive(df: DataFrame, history: DataFrame, area: StagingArea) -> DataFrame:
    """IsActive 0 for ended carriers; a missing id counts as 0."""
    raw_id = F.col("AirlineID")
    looked_up = df.withColumns({"_raw": raw_id, "AirlineID": F.coalesce(raw_id, F.lit(0))})
    marked = use_ended_carriers(looked_up, ended_carriers(history), area)
    return marked.withColumn("AirlineID", F.col("_raw")).drop("_raw")


# -- R18: carrier region -------------------------------------------------------------------------


def region_tokens_to_null(df: DataFrame) -> DataFrame:
    region = text.tokens_to_null(F.col("CarrierRegion"), fv.REGION_NULL_TOKENS)
    return df.withColumn("CarrierRegion", region)


def r18_region(
    df: DataFrame, area: StagingArea, order_by: Sequence[str] = ROW_ORDER
) -> DataFrame:
    df = region_tokens_to_null(df)
    regions = first_by_key(df, ["UniqueCarrier"], "CarrierRegion", order_by=order_by)
    joined = join_found(df, regions, ["UniqueCarrier"], area)
    return fill_missing(joined, "CarrierRegion", FILL, F.lit(fv.UNKNOWN_REGION))
