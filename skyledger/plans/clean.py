"""All rules in their order.

The order decides the results: copies and unusable rows go first, codes are
unified before names and ids are repaired, ids are merged before activity is
looked up, and copies that the repairs created go last.

Passes over the data: the rows are written before and after each removal of copies,
which shuffles hashes of rows and not the rows, and there are four narrow aggregations (route distances, spellings of names, airline ids,
everything else) whose results are written and joined back by size.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.functions import text
from skyledger.functions.numbers import holds, within
from skyledger.operators.copies import Copies, without_copies
from skyledger.operators.evidence import Evidence, EvidenceTables, Memory, pairs_of, picked
from skyledger.operators.impute import FILL, fill_missing, fill_wrong
from skyledger.operators.rows import Marks, cut
from skyledger.plans import rules as r
from skyledger.plans.derive import add_measures
from skyledger.staging import StagingArea

def _specs() -> list[Evidence]:
    specs = [
        Evidence("class", ("UniqueCarrier",), "Class", "mode"),
        Evidence("dominant_id", ("UniqueCarrier",), "AirlineID", "dominant"),
        Evidence("region", ("UniqueCarrier",), "CarrierRegion", "first"),
    ]
    for end in r.ENDS:
        airport = f"{end}AirportID"
        specs += [
            Evidence(f"{end}_city", (end,), f"{end}CityName", "mode"),
            Evidence(f"{end}_seq", (airport, "Year"), f"{end}AirportSeqID", "first",
                     ~holds(r.seq_is_airport(end))),
            Evidence(f"{end}_market", (airport,), f"{end}CityMarketID", "first",
                     ~holds(r.market_is_airport(end))),
        ]
    return specs


def known_routes(df: DataFrame, order_by: Sequence[str], memory: Memory) -> DataFrame:
    """``route_distances`` over this load and all before."""
    spec = Evidence("route", r.ENDS, "Distance", "first", r.valid_distance())
    pairs = memory.with_own(pairs_of(df, [spec], "Passengers", order_by), [spec.name])
    return pairs.groupBy(F.col("key1").alias(r.ENDS[0]), F.col("key2").alias(r.ENDS[1])).agg(
        F.max(F.col("value").cast("double")).alias(FILL)
    )


def known_ids(df: DataFrame, order_by: Sequence[str], memory: Memory) -> DataFrame:
    """``known_airline_ids`` over this load and all before."""
    spec = Evidence("airline_id", ("UniqueCarrier",), "AirlineID", "first", F.col("AirlineID") > 0)
    pairs = memory.with_own(pairs_of(df, [spec], "Passengers", order_by), [spec.name])
    return picked(pairs, [spec.name]).select(F.col("key1").alias("UniqueCarrier"), F.col("first").cast("int").alias(FILL))


def local_conditions() -> dict[str, Column]:
    """What the rules from R04 on meet in a row once its blanks are null."""
    c = F.col
    air, ramp = (within(c(n), fv.MINUTES_MIN, fv.MINUTES_MAX) for n in ("AirTime", "RampTime"))
    return {
        "R04__carrier_name": c("CarrierName").isNull() | (F.trim("CarrierName") == ""),
        "R04__class": c("Class").isNull(),
        "R04__origin_city": c("OriginCityName").isNull(),
        "R04__dest_city": c("DestCityName").isNull(),
        "R04__aircraft_type_kept_null": c("AircraftType").isNull(),
        "R05__capped": c("DepPerformed") > c("DepScheduled"),
        "R06__capped": (c("Seats") > 0) & (c("Passengers") > c("Seats")),
        "R08__air_time": ~c("AirTime").between(fv.MINUTES_MIN, fv.MINUTES_MAX),
        "R08__ramp_time": ~c("RampTime").between(fv.MINUTES_MIN, fv.MINUTES_MAX),
        "R08__incoherent": air > ramp,
        "R11__origin_affected": r.seq_is_airport("Origin"),
        "R11__dest_affected": r.seq_is_airport("Dest"),
        "R12__origin_affected": r.market_is_airport("Origin"),
        "R12__dest_affected": r.market_is_airport("Dest"),
        "R13__capped": c("Freight") > c("Payload"),
        "R18__missing": text.tokens_to_null(c("CarrierRegion"), fv.REGION_NULL_TOKENS).isNull(),
    }


@dataclass
class CleanRun:
    """A run's stages, kept so that the audit can count without repeating them."""

    raw: DataFrame
    deduped: DataFrame
    routes: DataFrame
    flown: DataFrame
    coded: DataFrame
    identified: DataFrame
    prepared: DataFrame
    repaired: DataFrame
    final: DataFrame


def run_rules(
    raw: DataFrame,
    airports: DataFrame,
    history: DataFrame,
    area: StagingArea,
    order_by: Sequence[str] = r.ROW_ORDER,
    memory: Memory | None = None,
    marks: Marks | None = None,
    last: StagingArea | None = None,
) -> CleanRun:
    """Run the rules; with ``memory`` on what earlier loads know as well.

    ``marks`` notes on the rows of ``repaired`` what the rules met, for the audit.
    What ``final`` reads is written to ``last``, if that is given, and all else to ``area``.
    """
    mark = marks.add if marks else lambda df, **_: df
    with StagingArea(area.spark) as before:
        deduped = area.table(without_copies(raw, before, order_by), "deduped")

    routes = area.table(known_routes(deduped, order_by, memory) if memory else r.route_distances(deduped), "routes")
    flown = r.use_route_distance(deduped, routes, area, rows=routes.count())

    kept = mark(r.r15_negative_freight(flown), R01__suffixes=F.col("UniqueCarrier").rlike(fv.CODE_SUFFIX))
    coded = r.r17_unify_carrier(r.r01_suffix(kept))
    names = area.table(r.spelled_names(deduped), "names")
    named = mark(r.use_spelled_names(coded, names, names.count(), area), R17__unified=F.lit(True), R03__missing=F.coalesce("AirlineID", F.lit(0)) == 0)
    ids = known_ids(named, order_by, memory) if memory else r.known_airline_ids(named, order_by)
    ids = area.table(ids, "airline-ids")
    identified = r.use_airline_ids(named, ids, area, rows=ids.count())

    # Everything up to the next evidence changes a row from its own columns only.
    # R04 has no carrier name to fill: R17 made it equal to the code it is filled from.
    prepared = r.blanks_to_null(identified, r.REQUIRED_TEXTS[1:])
    if marks:
        prepared = mark(prepared, R03__unknown=F.col("AirlineID") == 0, **local_conditions())
    prepared = r.r08_times(r.r06_cap_passengers(r.r05_cap_departures(prepared)))
    prepared = r.region_tokens_to_null(prepared)

    known = EvidenceTables(prepared, _specs(), "Passengers", area, order_by, memory)
    df = known.join(prepared, "UniqueCarrier")
    df = fill_missing(df, "Class", "_class")
    df = r.assign_dominant_id(df, "_dominant_id")
    cities = r.CityTables(
        r.airport_cities(airports),
        {end: known.table((end,)).withColumnRenamed(f"_{end}_city", FILL) for end in r.ENDS},
        area,
    )
    df = cities.fill(df, "Origin")
    df = fill_missing(df, "CarrierRegion", "_region", F.lit(fv.UNKNOWN_REGION))
    df = cut(cities.fill(df, "Dest"))
    df = r.use_ended_carriers(df, r.ended_carriers(history), area)  # ids are never null here
    df = r.r14_seat_flag(r.r13_cap_freight(df))
    for end in r.ENDS:
        target = f"{end}AirportSeqID"
        df = known.join(df, f"{end}AirportID", "Year")
        df = fill_wrong(df, target, f"_{end}_seq", r.seq_is_airport(end))
    for end in r.ENDS:
        target = f"{end}CityMarketID"
        df = known.join(df, f"{end}AirportID")
        df = fill_wrong(df, target, f"_{end}_market", r.market_is_airport(end))
    copies = Copies(df, last or area, order_by, aside=(Marks.column,))
    repaired, final = copies.rows.drop("_place"), copies.kept()
    return CleanRun(
        raw, deduped, routes, flown, coded, identified, prepared, repaired, final
    )


def clean(
    raw: DataFrame,
    airports: DataFrame,
    history: DataFrame,
    area: StagingArea,
    order_by: Sequence[str] = r.ROW_ORDER,
    memory: Memory | None = None,
) -> DataFrame:
    """Raw segments -> cleaned segments with audit columns and measures."""
    with StagingArea(area.spark) as before:
        return add_measures(run_rules(raw, airports, history, before, order_by, memory, last=area).final)
