"""One callable per operator: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from skyledger.catalog import inputs
from skyledger.functions import measures as m, text
from skyledger.functions.numbers import to_number
from skyledger.operators.keys import dense_key as number
from skyledger.operators import bitmaps, changes
from skyledger.operators.asof import attach_as_of
from skyledger.plans import audit, corrections, etl, history as h, lookups as lk, profiles, rules as r, star, variants as v
from skyledger.plans.clean import clean, run_rules
from skyledger.plans.derive import add_measures
from skyledger.schemas import FACT_COLUMNS, FACT_RAW
from skyledger.session import tune
from skyledger.sources import files, tables
from skyledger.sources.warehouse import Warehouse
from skyledger.staging import CODEC, StagingArea
from skyledger.streaming import increments

LOAD_DATE = "2024-01-15"
NEXT_LOAD_DATE = "2024-02-15"
CURRENT_YEAR = 2026
SPLIT_YEAR = 1998


class Source:
    """The inputs of one query run."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = tune(spark), sf_dir
        self.area = StagingArea(spark)

    @property
    def segments(self) -> DataFrame:
        return inputs.segments(self.spark, self.sf_dir)

    def lookup(self, name: str) -> DataFrame:
        return inputs.lookup(self.spark, self.sf_dir, name)

    def given(self, name: str) -> DataFrame:
        return inputs.given(self.spark, self.sf_dir, name)

    def clean(self, raw: DataFrame | None = None) -> DataFrame:
        raw = self.segments if raw is None else raw
        return clean(raw, self.lookup("airports"), self.lookup("history"), self.area)

    def cleaned(self) -> DataFrame:
        """The cleaned segments as a written table; what they were made from is deleted."""
        with StagingArea(self.spark) as before:
            return self.area.table(clean(self.segments, self.lookup("airports"), self.lookup("history"), before), "clean")

    @property
    def run(self):
        return run_rules(
            self.segments, self.lookup("airports"), self.lookup("history"), self.area
        )

    @property
    def history(self) -> DataFrame:
        return lk.prepared_history(self.lookup("history"), CURRENT_YEAR)

    @property
    def star(self) -> dict[str, DataFrame]:
        return star.build_star(self.cleaned(), LOAD_DATE, self.area, written=True)

    @property
    def dims(self) -> dict[str, DataFrame]:
        return self._dims(self.cleaned())

    def _dims(self, cleaned: DataFrame) -> dict[str, DataFrame]:
        return {
            "Tiempo": star.dim_tiempo(cleaned, self.area),
            "Transportista": star.dim_transportista(cleaned, LOAD_DATE, self.area),
            "Aeropuerto": star.dim_aeropuerto(cleaned, LOAD_DATE, self.area),
        }


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[Source], DataFrame]):
    QUERIES[function.__name__] = lambda spark, sf_dir: function(Source(spark, sf_dir))
    return function


# -- flagship -------------------------------------------------------------------------


@query
def load_factor_by_carrier_season(s: Source) -> DataFrame:
    """Mean load factors per carrier and season on the cleaned segments."""
    share = F.avg(F.col("OcupPasajeros").cast("decimal(5,4)")).cast("decimal(9,8)")
    return (
        s.clean()
        .groupBy("UniqueCarrier", m.season_label(F.col("Estacion")).alias("season"))
        .agg(
            F.count("*").alias("segments"),
            F.sum(F.col("Passengers").cast("bigint")).cast("bigint").alias("passengers"),
            share.alias("mean_passenger_load"),
        )
    )


# -- scans, staging, sinks ----------------------------------------------------------------


def _write_csv(df: DataFrame, path: str) -> str:
    df.write.csv(path, header=True, escape='"', ignoreLeadingWhiteSpace=False,
                 ignoreTrailingWhiteSpace=False)
    return path


def _fact_files(s: Source, area: StagingArea) -> str:
    """The raw segments as files of three shapes in row order, and a file of lines that do not fit their header."""
    root, rows = area.path("fact-csv"), s.segments.withColumn("Extra", F.lit("e"))
    shapes = [FACT_COLUMNS, list(reversed(FACT_COLUMNS)), ["Extra", *[c for c in FACT_COLUMNS if c != "Mail"]]]
    for k, columns in enumerate(shapes):
        part = rows.where(f"row_id % {len(shapes)} = {k}").repartitionByRange(4, "row_id").sortWithinPartitions("row_id", "Payload", "Passengers")
        _write_csv(part.select(columns), f"{root}/{k}")
    number_ = F.col("row_id").cast("string")
    broken = rows.where("row_id % 50 = 7").select("row_id", F.when(F.col("row_id") % 3 == 0, F.concat(F.lit("short"), number_))
                                                 .otherwise(F.concat(F.lit("1999,C1,"), number_)).alias("value"))
    header = s.spark.createDataFrame([(-1, "Year,UniqueCarrier")], "row_id long, value string")
    broken.unionByName(header).coalesce(1).sortWithinPartitions("row_id").select("value").write.text(f"{root}/broken")
    return root


@query
def scan_fact_csv(s: Source) -> DataFrame:
    """Files with their columns in any order, numbered in the order of the read; broken lines are not among the rows."""
    with StagingArea(s.spark) as before:  # the scan parses the files once and writes what it finds
        root = _fact_files(s, before)
        rows = files.scan_fact_csv(s.spark, [f"{root}/{k}" for k in ("0", "1", "2", "broken")], s.area)
    return number(rows, "orden", ["row_id"], s.area, kind="bigint").drop("row_id")


@query
def scan_refused_lines(s: Source) -> DataFrame:
    """The lines that do not have the columns of their header, as they are kept."""
    root = _fact_files(s, s.area)
    scan = files.scan_csv(s.spark, [f"{root}/{k}" for k in ("0", "1", "2", "broken")], FACT_RAW, s.area)
    lines = files.refused_lines(scan.refused, "stg_t100")
    return lines.select("tabla", F.get_json_object("fila", "$.linea").alias("linea"), F.array_join("motivos", ",").alias("motivos"))


_LOOKUP_FILES = {"airports": "l_strport.csv", "history": "l_carrier_history.csv", "unique_carriers": "l_unique_carriers.csv",
                 "markets": "l_city_market_id.csv", "seq_ids": "l_strport_seq_id.csv"}


@query
def scan_lookup_csv(s: Source) -> DataFrame:
    folder = s.area.path("lookups")
    for name, file in _LOOKUP_FILES.items():
        _write_csv(s.lookup(name).drop("row_id"), f"{folder}/{file}")
    found = files.scan_lookups(s.spark, folder, area=s.area)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [
        df.drop("row_id").select(F.lit(name).alias("tabla"), "*") for name, df in found.items()
    ])


@query
def stage_overwrite(s: Source) -> DataFrame:
    folder = s.area.path("staging")
    tables.stage_overwrite(s.segments, folder, "stg_t100")
    return tables.stage_overwrite(s.segments, folder, "stg_t100").select(
        "row_id", "Year", "Month", "UniqueCarrier", "Origin", "Dest", "Seats", "Freight"
    )


@query
def scan_table(s: Source) -> DataFrame:
    folder = s.area.path("staging")
    tables.stage_overwrite(s.lookup("history"), folder, "stg_carrier_history")
    return tables.scan_table(s.spark, folder, "stg_carrier_history")


@query
def scan_projected_filtered(s: Source) -> DataFrame:
    return tables.described(s.lookup("airports")).select("Code", "Description")


@query
def scan_history_filtered(s: Source) -> DataFrame:
    return tables.closed_history(s.lookup("history"))


@query
def staging_row_counts(s: Source) -> DataFrame:
    return tables.staging_row_counts(
        {
            "stg_t100": s.segments,
            "stg_airports": s.lookup("airports"),
            "stg_unique_carriers": s.lookup("unique_carriers"),
            "stg_carrier_history": s.lookup("history"),
            "stg_city_market_ids": s.lookup("markets"),
            "stg_airport_seq_ids": s.lookup("seq_ids"),
        }
    )


@query
def sink_transformed_audit(s: Source) -> DataFrame:
    return tables.stage_overwrite(s.clean(), s.area.path("staging"), "stg_t100_transformed")


@query
def sink_dim(s: Source) -> DataFrame:
    dims, folder = s.dims, s.area.path("dw")
    return tables.stage_overwrite(dims["Transportista"], folder, "Transportista")


@query
def sink_fact(s: Source) -> DataFrame:
    folder = s.area.path("dw")
    star.load_dw(s.cleaned(), folder, LOAD_DATE, s.area, written=True)
    return Warehouse(s.spark, folder).read("Vuelo").groupBy("Anio").agg(
        F.count("*").alias("filas"), F.sum("Pasajeros").alias("pasajeros")
    )


@query
def full_reload(s: Source) -> DataFrame:
    """Loading twice into one place leaves the tables as after one load."""
    folder = s.area.path("dw")
    cleaned = s.cleaned()
    star.load_dw(cleaned, folder, LOAD_DATE, s.area, written=True)
    star.load_dw(cleaned, folder, LOAD_DATE, s.area, written=True)
    return _totals(s, folder)


def _totals(s: Source, folder: str) -> DataFrame:
    """Rows and largest key of every table of a star, as a reader finds it now."""
    house = Warehouse(s.spark, folder)
    return reduce(DataFrame.unionByName, [
        house.read(name).agg(F.count("*").alias("filas"), F.max(f"{name}Key").cast("bigint").alias("max_key"))
        .select(F.lit(name).alias("tabla"), "filas", "max_key")
        for name in star.STAR
    ])


@query
def x_atomic_reload(s: Source) -> DataFrame:
    """A star before a reload, after one that ends before its last step, and after one that is complete."""
    folder = s.area.path("dw")
    cleaned = s.cleaned()
    star.load_dw(cleaned.where(f"Year < {SPLIT_YEAR}"), folder, LOAD_DATE, s.area, written=True)
    seen = [("before", _totals(s, folder))]
    star.write_star(Warehouse(s.spark, folder).begin(), cleaned, NEXT_LOAD_DATE, s.area, written=True)
    seen.append(("broken", _totals(s, folder)))
    star.load_dw(cleaned, folder, LOAD_DATE, s.area, written=True)
    seen.append(("after", _totals(s, folder)))
    return reduce(DataFrame.unionByName, [df.select(F.lit(name).alias("momento"), "*") for name, df in seen])


# -- projections, filters, coercions ------------------------------------------------------


@query
def coerce_numeric(s: Source) -> DataFrame:
    return s.lookup("history").select("row_id", to_number(F.col("AirlineID"), "int").alias("AirlineID"))


@query
def coerce_date(s: Source) -> DataFrame:
    return lk.parse_dates(s.lookup("history")).select("row_id", "StartDate", "EndDate")


@query
def blank_to_null(s: Source) -> DataFrame:
    return r.blanks_to_null(s.segments).select("row_id", *r.REQUIRED_TEXTS)


@query
def null_tokens(s: Source) -> DataFrame:
    return r.region_tokens_to_null(s.segments).select("row_id", "CarrierRegion")


@query
def project_rename(s: Source) -> DataFrame:
    measured = add_measures(s.segments)
    return measured.select("row_id", *[F.col(c).alias(n) for n, c in star.FACT_NAMES.items()])


@query
def filter_length_prefix(s: Source) -> DataFrame:
    return v.filter_length_prefix(s.lookup("seq_ids"))


@query
def filter_contains_ci(s: Source) -> DataFrame:
    return v.filter_contains_ci(s.lookup("seq_ids"))


@query
def filter_range_ids(s: Source) -> DataFrame:
    return lk.drop_bad_ids(s.lookup("history")).select("row_id", "AirlineID", "UniqueCarrier")


# -- the eighteen rules ------------------------------------------------------------------------


@query
def r10_dedupe(s: Source) -> DataFrame:
    return r.r10_dedupe(s.segments)


@query
def r07_distance(s: Source) -> DataFrame:
    return r.r07_distance(s.segments, s.area).select("row_id", "Origin", "Dest", "Distance")


@query
def r15_negative_freight(s: Source) -> DataFrame:
    return r.r15_negative_freight(s.segments).select("row_id", "Freight")


@query
def r01_suffix(s: Source) -> DataFrame:
    return r.r01_suffix(s.segments).select("row_id", "UniqueCarrier", "Carrier")


@query
def r17_unify_carrier(s: Source) -> DataFrame:
    return r.r17_unify_carrier(s.segments).select(
        "row_id", "UniqueCarrier", "UniqCarrierEntity", "Carrier", "CarrierName"
    )


@query
def r02_names(s: Source) -> DataFrame:
    return r.r02_names(s.segments).select("row_id", "UniqueCarrierName")


@query
def r03_airline_id(s: Source) -> DataFrame:
    return r.r03_airline_id(r.r01_suffix(s.segments), s.area).select(
        "row_id", "AirlineID", "UniqueCarrier", "UniqueCarrierName"
    )


@query
def r04_required(s: Source) -> DataFrame:
    return r.r04_required(s.segments, s.lookup("airports"), s.area).select(
        "row_id", *r.REQUIRED_TEXTS
    )


@query
def r04_carrier_name(s: Source) -> DataFrame:
    return r.r04_carrier_name(r.blanks_to_null(s.segments)).select("row_id", "CarrierName")


@query
def r04_class_mode(s: Source) -> DataFrame:
    return r.r04_class_mode(r.blanks_to_null(s.segments), s.area).select(
        "row_id", "UniqueCarrier", "Class"
    )


@query
def r04_city_lookup(s: Source) -> DataFrame:
    return r.r04_city_lookup(r.blanks_to_null(s.segments), s.lookup("airports"), s.area).select(
        "row_id", "Origin", "OriginCityName", "Dest", "DestCityName"
    )


@query
def r04_city_mode(s: Source) -> DataFrame:
    return r.r04_city_mode(r.blanks_to_null(s.segments), s.area).select(
        "row_id", "Origin", "OriginCityName", "Dest", "DestCityName"
    )


@query
def r05_cap_departures(s: Source) -> DataFrame:
    return r.r05_cap_departures(s.segments).select("row_id", "DepScheduled", "DepPerformed")


@query
def r06_cap_passengers(s: Source) -> DataFrame:
    return r.r06_cap_passengers(s.segments).select("row_id", "Seats", "Passengers")


@query
def r08_times(s: Source) -> DataFrame:
    return r.r08_times(s.segments).select("row_id", "AirTime", "RampTime")


@query
def r09_dominant_id(s: Source) -> DataFrame:
    identified = r.r03_airline_id(r.r01_suffix(s.segments), s.area)
    return r.r09_dominant_id(identified, s.area).select(
        "row_id", "UniqueCarrier", "AirlineID", "AirlineID_original", "is_merged_carrier"
    )


@query
def r11_airport_seq(s: Source) -> DataFrame:
    return r.r11_airport_seq(s.segments, s.area).select(
        "row_id", "Year", "OriginAirportID", "OriginAirportSeqID", "DestAirportID", "DestAirportSeqID"
    )


@query
def r12_city_market(s: Source) -> DataFrame:
    return r.r12_city_market(s.segments, s.area).select(
        "row_id", "OriginAirportID", "OriginCityMarketID", "DestAirportID", "DestCityMarketID"
    )


@query
def r13_cap_freight(s: Source) -> DataFrame:
    return r.r13_cap_freight(s.segments).select("row_id", "Freight", "Payload")


@query
def r14_seat_flag(s: Source) -> DataFrame:
    return r.r14_seat_flag(s.segments).select("row_id", "Seats", "Passengers", "Flag_Review_Seats")


@query
def r16_inactive(s: Source) -> DataFrame:
    return r.r16_inactive(r.r01_suffix(s.segments), s.lookup("history"), s.area).select(
        "row_id", "AirlineID", "UniqueCarrier", "IsActive"
    )


@query
def r18_region(s: Source) -> DataFrame:
    return r.r18_region(r.r01_suffix(s.segments), s.area).select(
        "row_id", "UniqueCarrier", "CarrierRegion"
    )


@query
def r10_dedupe_final(s: Source) -> DataFrame:
    return s.run.final


@query
def clean_all_rules(s: Source) -> DataFrame:
    return s.clean()


# -- variants --------------------------------------------------------------------------------


@query
def v01_suffix_nostrip(s: Source) -> DataFrame:
    return v.v01_suffix_nostrip(s.segments).select("row_id", "UniqueCarrier", "Carrier")


@query
def v02_names(s: Source) -> DataFrame:
    """Distinct spellings and the name each becomes."""
    names = s.segments.select(F.col("UniqueCarrierName").alias("spelling")).distinct()
    return names.withColumn("name", text.normalize_name(F.col("spelling")))


@query
def v03_sentinel_only(s: Source) -> DataFrame:
    return v.v03_sentinel_only(s.segments).select(
        "row_id", "AirlineID", "UniqueCarrier", "UniqueCarrierName"
    )


@query
def v04_impute(s: Source) -> DataFrame:
    return v.v04_impute(s.segments, s.lookup("airports"), s.area).select(
        "row_id", *r.REQUIRED_TEXTS
    )


@query
def v04_rule_summary(s: Source) -> DataFrame:
    raw = s.segments
    return v.v04_rule_summary(raw, v.v_chain_1_4(raw, s.lookup("airports"), s.area))


@query
def v_chain_1_4(s: Source) -> DataFrame:
    return v.v_chain_1_4(s.segments, s.lookup("airports"), s.area)


@query
def v05_cap(s: Source) -> DataFrame:
    return r.r05_cap_departures(s.segments).select("row_id", "DepPerformed")


@query
def v06_cap(s: Source) -> DataFrame:
    return r.r06_cap_passengers(s.segments).select("row_id", "Passengers")


def _some_codes_missing(df: DataFrame) -> DataFrame:
    """Blank out some airport codes, so that null keys meet."""
    return df.withColumns(
        {
            "Origin": F.when(F.col("OriginAirportID") % 4 != 0, F.col("Origin")),
            "Dest": F.when(F.col("DestAirportID") % 6 != 0, F.col("Dest")),
        }
    )


@query
def v07_distance_nullsafe(s: Source) -> DataFrame:
    return v.v07_distance_nullsafe(_some_codes_missing(s.segments), s.area).select(
        "row_id", "Origin", "Dest", "Distance"
    )


@query
def v_chain_5_7(s: Source) -> DataFrame:
    return v.v_chain_5_7(s.segments, s.area).select(
        "row_id", "DepPerformed", "Passengers", "Distance"
    )


@query
def v13_freight_filter(s: Source) -> DataFrame:
    return v.v13_freight_filter(s.segments).select("row_id", "Freight", "Payload")


@query
def v12_market_lookup(s: Source) -> DataFrame:
    return v.v12_market_lookup(s.segments, s.lookup("markets"), s.area).select(
        "row_id", "OriginCityMarketID", "OriginCityName", "DestCityMarketID", "DestCityName"
    )


def _both_periods(df: DataFrame) -> DataFrame:
    """Years moved on, so that they lie on both sides of the period limit."""
    return df.withColumn("Year", F.col("Year") + 6)


@query
def v11_seq_period_lookup(s: Source) -> DataFrame:
    moved = _both_periods(s.segments)
    return v.v11_seq_period_lookup(moved, s.lookup("seq_ids"), s.area).select(
        "row_id", "Year", "OriginAirportSeqID", "DestAirportSeqID"
    )


@query
def v_chain_11_13(s: Source) -> DataFrame:
    moved = _both_periods(s.segments)
    return v.v_chain_11_13(moved, s.lookup("markets"), s.lookup("seq_ids"), s.area)


@query
def v11_audit_extract(s: Source) -> DataFrame:
    return v.v11_audit_extract(_both_periods(s.segments), s.lookup("seq_ids"), s.area)


# -- lookups ------------------------------------------------------------------------------------


@query
def lk_unique_carriers(s: Source) -> DataFrame:
    return lk.unique_carriers(s.lookup("unique_carriers"))


@query
def lk_history_suffix(s: Source) -> DataFrame:
    return lk.drop_suffixed(s.lookup("history"))


@query
def lk_history_swap_dates(s: Source) -> DataFrame:
    return lk.swap_dates(lk.parse_dates(s.lookup("history"))).select("row_id", "StartDate", "EndDate")


@query
def lk_history_future(s: Source) -> DataFrame:
    return lk.drop_future(lk.parse_dates(s.lookup("history")), CURRENT_YEAR).select("row_id", "EndDate")


@query
def lk_history_bad_ids(s: Source) -> DataFrame:
    return s.history


@query
def lk_history_primary_id(s: Source) -> DataFrame:
    return lk.primary_ids(s.history)


@query
def lk_history_sole_owner(s: Source) -> DataFrame:
    return lk.sole_owners(lk.primary_ids(s.history))


@query
def lk_history_closed(s: Source) -> DataFrame:
    return lk.closed_carriers(s.history, lk.primary_ids(s.history))


@query
def lk_history_cross_assign(s: Source) -> DataFrame:
    return lk.foreign_claims(s.history, lk.primary_ids(s.history))


@query
def lk_carrier_history(s: Source) -> DataFrame:
    return lk.carrier_history(s.lookup("history"), CURRENT_YEAR, s.area)


@query
def lk_group_compact(s: Source) -> DataFrame:
    """Segments per group code and each type the code stands for."""
    used = s.segments.groupBy(F.col("CarrierGroupNew").alias("Code")).agg(F.count("*").alias("segments"))
    return used.join(lk.carrier_groups(s.spark), "Code")


@query
def lk_all(s: Source) -> DataFrame:
    cleaned = lk.clean_lookups(
        s.lookup("unique_carriers"), s.lookup("history"), CURRENT_YEAR, s.area
    )
    out = None
    for name, df in cleaned.items():
        row = df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
        out = row if out is None else out.unionByName(row)
    return out


# -- measures ----------------------------------------------------------------------------------------


@query
def m_passenger_load(s: Source) -> DataFrame:
    load = m.passenger_load(F.col("Passengers"), F.col("Seats"))
    return s.segments.select("row_id", load.alias("OcupPasajeros"))


@query
def m_freight_load(s: Source) -> DataFrame:
    load = m.freight_load(F.col("Freight"), F.col("Payload"))
    return s.segments.select("row_id", load.alias("OcupCarga"))


@query
def m_runway_delay(s: Source) -> DataFrame:
    return r.r08_times(s.segments).select(
        "row_id", m.runway_delay(F.col("RampTime"), F.col("AirTime")).alias("DemoraPista")
    )


@query
def m_season(s: Source) -> DataFrame:
    return s.segments.select("row_id", "Month", m.season(F.col("Month")).alias("Estacion"))


@query
def m_season_label(s: Source) -> DataFrame:
    return s.segments.select(
        "row_id", "Month", m.season_label(m.season(F.col("Month"))).alias("Estacion")
    )


# -- star ----------------------------------------------------------------------------------------------


@query
def dim_tiempo(s: Source) -> DataFrame:
    return star.dim_tiempo(s.clean(), s.area)


@query
def dim_aeropuerto(s: Source) -> DataFrame:
    return star.dim_aeropuerto(s.clean(), LOAD_DATE, s.area)


@query
def dim_transportista(s: Source) -> DataFrame:
    return star.dim_transportista(s.clean(), LOAD_DATE, s.area)


@query
def dense_key(s: Source) -> DataFrame:
    """The fact's key alone, on raw segments: numbered by year, month and row order."""
    rows = s.segments.select("Year", "Month", "row_id", "Seats", "Passengers", "Freight")
    return number(
        rows, "VueloKey", ["Year", "Month", "row_id", "Seats", "Passengers", "Freight"], s.area,
        kind="bigint",
    )


@query
def resolve_keys(s: Source) -> DataFrame:
    cleaned = s.cleaned()
    return star.resolve_keys(cleaned, s._dims(cleaned), s.area).select(
        "row_id", "Year", "Month", "UniqueCarrierName", "Origin", "Dest", *star.FACT_KEYS
    )


@query
def fact_vuelo(s: Source) -> DataFrame:
    return s.star["Vuelo"]


@query
def load_dw(s: Source) -> DataFrame:
    written = star.load_dw(s.cleaned(), s.area.path("dw"), LOAD_DATE, s.area, written=True)
    return written["Vuelo"]


@query
def dw_contract(s: Source) -> DataFrame:
    accepted, _ = star.dw_contract("Vuelo", s.star["Vuelo"])
    return accepted


# -- audit ------------------------------------------------------------------------------------------------


@query
def audit_rule_counts(s: Source) -> DataFrame:
    return audit.rule_counts(s.segments, s.lookup("airports"), s.lookup("history"), s.area)


@query
def audit_run_counts(s: Source) -> DataFrame:
    run = s.run
    return audit.run_counts(run.raw, run.final)


@query
def audit_lookup_counts(s: Source) -> DataFrame:
    return audit.lookup_counts(
        s.lookup("unique_carriers"), s.lookup("history"), CURRENT_YEAR, s.area
    )


@query
def profile_defects(s: Source) -> DataFrame:
    return audit.profile_defects(s.segments, s.lookup("history"), s.area)


# -- discard rules --------------------------------------------------------------------------------------------


@query
def s_drop_dep_excess(s: Source) -> DataFrame:
    return v.s_drop_dep_excess(s.segments).select("row_id", "DepScheduled", "DepPerformed")


@query
def s_drop_pax_excess(s: Source) -> DataFrame:
    return v.s_drop_pax_excess(s.segments).select("row_id", "Seats", "Passengers", "Flag_Review_Seats")


@query
def s_drop_distance(s: Source) -> DataFrame:
    return v.s_drop_distance(s.segments).select("row_id", "Distance")


@query
def s_drop_airtime(s: Source) -> DataFrame:
    return v.s_drop_airtime(s.segments).select("row_id", "AirTime")


@query
def s_drop_freight(s: Source) -> DataFrame:
    return v.s_drop_freight(s.segments).select("row_id", "Freight", "Payload")


@query
def s_dedupe_business_key(s: Source) -> DataFrame:
    return v.s_dedupe_business_key(s.segments).select("row_id", *v.BUSINESS_KEY)


@query
def s_exclude_unknown_id(s: Source) -> DataFrame:
    return v.s_exclude_unknown_id(s.segments).select("row_id", "AirlineID")


# -- later loads --------------------------------------------------------------------------------------------------

ATTRIBUTES = ("CarrierGrupo", "Region")
BUSINESS_KEY = v.BUSINESS_KEY


def _carrier_name() -> Column:
    """The customer's name; one customer has none."""
    return F.when(F.col("c_custkey") != 1, F.col("c_name")).alias("CarrierNombre")


def _old_carriers(s: Source) -> DataFrame:
    """A carrier dimension of an earlier load, one member per customer it knew, the one without name too."""
    members = s.given("customer").where("c_custkey % 10 <> 0").select(
        _carrier_name(), F.col("c_mktsegment").alias("CarrierGrupo"),
        F.concat(F.lit("R"), (F.col("c_nationkey") % 4).cast("string")).alias("Region"),
    )
    return number(members, "TransportistaKey", ["CarrierNombre"], s.area).withColumns(
        star.since(LOAD_DATE)
    )


def _new_carriers(s: Source) -> DataFrame:
    """The members a later load brings: some new, some changed, some gone, some named twice."""
    key = F.col("c_custkey")
    rows = s.given("customer").where("c_custkey % 9 <> 0")
    members = rows.select(
        _carrier_name(),
        F.when(key % 13 == 0, F.lit(None)).when((key % 7 == 0) | (key == 1), F.lit("Merged"))
        .otherwise(F.col("c_mktsegment")).alias("CarrierGrupo"),
        F.concat(F.lit("R"), ((F.col("c_nationkey") + F.when(key % 11 == 0, 1).otherwise(0)) % 4)
                 .cast("string")).alias("Region"),
        key,
    )
    again = members.where("c_custkey % 17 = 0").withColumn("Region", F.lit("R9"))
    return members.unionByName(again).drop("c_custkey")


@query
def x_unknown_member(s: Source) -> DataFrame:
    """Facts against dimensions of an earlier load; what these do not know is member -1."""
    measured = s.area.table(add_measures(r.r02_names(s.segments)), "measured")
    dims = s._dims(measured.where(f"Year < {SPLIT_YEAR}"))
    dims = {n: h.with_unknown_member(d, f"{n}Key", LOAD_DATE) for n, d in dims.items()}
    return h.unknown_keys(star.resolve_keys(measured, dims, s.area)).select("row_id", *star.FACT_KEYS)


@query
def x_referential_check(s: Source) -> DataFrame:
    tables = s.star
    early = tables | {"Tiempo": tables["Tiempo"].where(f"Anio < {SPLIT_YEAR}")}
    return star.orphans(tables["Vuelo"], early)


@query
def x_orphan_keys(s: Source) -> DataFrame:
    """The orphans of the check above, from bitmaps of keys."""
    tables = s.star
    early = tables | {"Tiempo": tables["Tiempo"].where(f"Anio < {SPLIT_YEAR}")}
    return bitmaps.orphan_keys(tables["Vuelo"], early, star.ROLES)


@query
def x_reject_log(s: Source) -> DataFrame:
    return h.reject_log(s.star["Vuelo"]).select("VueloKey", "TiempoKey", "reason")


@query
def x_change_detect(s: Source) -> DataFrame:
    return h.change_detect(_old_carriers(s), _new_carriers(s), ["CarrierNombre"], ATTRIBUTES)


@query
def x_hash_changes(s: Source) -> DataFrame:
    """The same states from stored row hashes in buckets."""
    table, key = f"huellas_{uuid.uuid4().hex}", ["CarrierNombre"]
    changes.store_hashes(_old_carriers(s), key, ATTRIBUTES, table, s.area.path("hashes"))
    feed = h.one_per_key(_new_carriers(s), key, ATTRIBUTES)
    return changes.changes_by_hash(s.spark, table, feed, key, ATTRIBUTES)


@query
def x_upsert(s: Source) -> DataFrame:
    old = _old_carriers(s).select("CarrierNombre", *ATTRIBUTES)
    return h.upsert(old, _new_carriers(s), ["CarrierNombre"])


@query
def x_scd1(s: Source) -> DataFrame:
    current = _old_carriers(s).select("TransportistaKey", "CarrierNombre", *ATTRIBUTES)
    return h.scd1(current, _new_carriers(s), ["CarrierNombre"], ATTRIBUTES, "TransportistaKey", s.area)


@query
def x_scd2(s: Source) -> DataFrame:
    return h.scd2(
        _old_carriers(s), _new_carriers(s), ["CarrierNombre"], ATTRIBUTES, "TransportistaKey",
        NEXT_LOAD_DATE, s.area,
    )


@query
def x_scd3(s: Source) -> DataFrame:
    current = _old_carriers(s).select("TransportistaKey", "CarrierNombre", *ATTRIBUTES)
    return h.scd3(current, _new_carriers(s), ["CarrierNombre"], "CarrierGrupo")


@query
def x_asof_keys(s: Source) -> DataFrame:
    """Orders as facts of customers that change: the version valid on each one's day, -1 where there was none."""
    versions = s.area.table(h.scd2(
        _old_carriers(s), _new_carriers(s), ["CarrierNombre"], ATTRIBUTES, "TransportistaKey",
        NEXT_LOAD_DATE, s.area,
    ), "versions")
    day = F.date_add(F.lit(LOAD_DATE).cast("date"), (F.col("o_orderkey") % 60 - 10).cast("int"))
    names = s.given("customer").select(F.col("c_custkey").alias("o_custkey"), _carrier_name())
    facts = s.given("orders").join(names, "o_custkey").select("o_orderkey", "CarrierNombre", day.alias("dia"))
    found = attach_as_of(
        facts, versions, ["CarrierNombre"], "dia", "Fecha_Inicio", "Fecha_Fin", "TransportistaKey", s.area
    )
    return found.select("o_orderkey", "dia", F.coalesce("TransportistaKey", F.lit(h.UNKNOWN_KEY)).alias("TransportistaKey"))


def _cleaner(s: Source) -> Callable[..., DataFrame]:
    return lambda raw, area, known=None: clean(raw, s.lookup("airports"), s.lookup("history"), area, memory=known)


def _first_load(s: Source, raw: DataFrame) -> tuple[str, DataFrame]:
    """A warehouse with one load, and the load's log."""
    folder, cleaner = s.area.path("dw"), _cleaner(s)
    write = lambda rows, area, known: area.table(cleaner(rows, area, known), "clean")
    return folder, etl.first_load(raw, folder, LOAD_DATE, s.area, write, "1")


def _facts(s: Source, folder: str) -> DataFrame:
    return Warehouse(s.spark, folder).read("Vuelo").drop("Anio")


@query
def x_incremental_load(s: Source) -> DataFrame:
    """The facts after a first load and one increment, with the load that brought them."""
    raw = s.segments
    folder, _ = _first_load(s, raw.where(f"Year < {SPLIT_YEAR}"))
    increments.load_batch(raw.where(f"Year >= {SPLIT_YEAR}"), "2", folder, NEXT_LOAD_DATE, _cleaner(s))
    return _facts(s, folder)


@query
def x_known_copies(s: Source) -> DataFrame:
    """The same, though the increment brings all rows of the first load once more."""
    folder, _ = _first_load(s, s.segments.where(f"Year < {SPLIT_YEAR}"))
    increments.load_batch(s.segments, "2", folder, NEXT_LOAD_DATE, _cleaner(s), copies=True)
    return _facts(s, folder)


@query
def x_evidence_load(s: Source) -> DataFrame:
    """The facts after two loads, the second filling its gaps from what both know, as one load of everything would."""
    middle = s.given("lineitem").agg(F.max("l_orderkey")).first()[0] * 4
    folder, _ = _first_load(s, s.segments.where(f"row_id < {middle}"))
    increments.load_batch(s.segments.where(f"row_id >= {middle}"), "2", folder, NEXT_LOAD_DATE, _cleaner(s), evidence=True)
    return _facts(s, folder)


@query
def x_stream_load(s: Source) -> DataFrame:
    """The facts after a first load and a stream of files that is started three times, each time without its progress."""
    raw, inbox = s.segments, s.area.path("inbox")
    folder, _ = _first_load(s, raw.where(f"Year < {SPLIT_YEAR}"))
    raw.where(f"Year >= {SPLIT_YEAR}").write.parquet(inbox)
    for _ in range(3):
        increments.start(s.spark, inbox, folder, s.area.path("progress"), NEXT_LOAD_DATE, _cleaner(s)).awaitTermination()
    return _facts(s, folder).withColumn("lote", F.when(F.col("lote") == "1", "1").otherwise("2"))


@query
def x_stream_distinct(s: Source) -> DataFrame:
    """The raw segments without copies, from a stream of files that holds many copies, a few files at a time."""
    inbox, folder, progress = (s.area.path(n) for n in ("inbox", "distinct", "progress"))
    rows = s.segments
    source = s.given("lineitem")
    files = inputs.pieces(source, 5)
    # Tasks end a file at so many rows, so that there are that many files without moving a row; copies come in other files.
    most = max(1, source.count() // files)
    rows.unionByName(rows.where("row_id % 3 = 0")).write.option("maxRecordsPerFile", most).parquet(inbox, compression=CODEC)
    found = len(s.spark.read.schema(rows.schema).parquet(inbox).inputFiles())
    batch = max(1, found * min(2 * files // 5, 32) // files)
    for _ in range(2):
        increments.distinct_segments(s.spark, inbox, folder, progress, files_per_batch=batch).awaitTermination()
    return s.spark.read.schema(rows.schema).parquet(folder).drop("row_id")


def _monthly(df: DataFrame) -> DataFrame:
    return df.select(F.col("Year").alias("Anio"), F.col("Month").alias("Mes"), "row_id", "Seats", "Passengers", "Payload")


@query
def x_correct_months(s: Source) -> DataFrame:
    """Facts foldered by month after corrections of two months: rows are missing, changed and added."""
    folder, rows, order = s.area.path("monthly"), _monthly(s.segments), ["row_id", "Payload", "Passengers"]
    keyed = number(rows, "VueloKey", ["Anio", "Mes", *order], s.area, kind="bigint")
    tables.stage_overwrite(keyed, folder, "Vuelo", *corrections.MONTH)
    late = rows.where("(Anio = 1995 AND Mes = 3 AND row_id % 5 <> 0) OR (Anio = 1996 AND Mes = 7)").withColumn("Seats", F.col("Seats") + 1)
    again = rows.where("Anio = 1996 AND Mes = 7 AND row_id % 3 = 0").withColumn("row_id", F.col("row_id") + 1_000_000_000)
    return corrections.correct_months(s.spark, folder, "Vuelo", late.unionByName(again), "VueloKey", order, s.area)


@query
def x_merged_profile(s: Source) -> DataFrame:
    """Profiles of two loads, merged: exact counts, and whether the estimates are within their stated errors."""
    raw, columns = s.segments, ["UniqueCarrier", "OriginAirportSeqID", "AirlineID", "Passengers", "Payload", "CarrierRegion"]
    parts = [profiles.profile(raw.where(f"Year {side} {SPLIT_YEAR}"), columns) for side in ("<", ">=")]
    found = s.area.table(profiles.estimates(profiles.kept(*parts)), "estimates")
    exact = raw.agg(*[F.count_distinct(c).alias(c) for c in columns])
    exact = exact.select(F.stack(F.lit(len(columns)), *[x for c in columns for x in (F.lit(c), F.col(c))]).alias("columna", "exactos"))
    return found.join(exact, "columna").select(
        "columna", "filas", "nulos",
        (F.abs(F.col("distintos") - F.col("exactos")) <= 3 * profiles.DISTINCT_ERROR * F.col("exactos") + 1).alias("distintos_en_margen"),
    )


@query
def x_load_metadata(s: Source) -> DataFrame:
    return _first_load(s, s.segments)[1]
