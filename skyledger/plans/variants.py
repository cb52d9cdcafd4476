"""Rule variants with other semantics, and the alternative "discard" rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.functions import text
from skyledger.functions.numbers import holds
from skyledger.operators.impute import FILL, last_by_key
from skyledger.operators.joins import attach
from skyledger.operators.rows import dedupe_first_by_key, drop_where
from skyledger.plans import rules as r
from skyledger.staging import StagingArea

BUSINESS_KEY = ("Year", "Month", "UniqueCarrier", "Origin", "Dest", "Class", "AircraftType")


# -- rules 1 to 4 ---------------------------------------------------------------


def v01_suffix_nostrip(df: DataFrame) -> DataFrame:
    return r.r01_suffix(df, trimmed=False)


def v03_sentinel_only(df: DataFrame) -> DataFrame:
    """AirlineID 0 -> sentinels; nothing is inferred and null stays."""
    return r.mark_unknown_carrier(df)


def v04_impute(df: DataFrame, airports: DataFrame, area: StagingArea) -> DataFrame:
    """Nulls only; blank texts count as values."""
    return r.r04_required(df, airports, area, blanks=False)


def v_chain_1_4(df: DataFrame, airports: DataFrame, area: StagingArea) -> DataFrame:
    return v04_impute(v03_sentinel_only(r.r02_names(v01_suffix_nostrip(df))), airports, area)


def v04_rule_summary(raw: DataFrame, result: DataFrame) -> DataFrame:
    """(regla, descripcion, filas_afectadas) of the chain, one pass over each side."""
    missing = F.lit(False)
    for column in fv.REQUIRED_COLUMNS:
        missing = missing | F.col(column).isNull()
    before = raw.select(F.col("UniqueCarrier").rlike(fv.CODE_SUFFIX).alias("suffix")).agg(
        F.count_if("suffix").alias("R01")
    )
    after = result.agg(
        F.count("*").alias("R02"),
        F.count_if(F.col("AirlineID") == 0).alias("R03"),
        F.count_if(missing).alias("R04"),
    )

    def rows(df: DataFrame) -> DataFrame:
        cells = [x for rule in df.columns for x in (F.lit(rule), F.lit(fv.RULE_TEXTS[rule]), F.col(rule))]
        return df.select(
            F.stack(F.lit(len(df.columns)), *cells).alias("regla", "descripcion", "filas_afectadas")
        )

    return rows(before).unionByName(rows(after))


# -- rules 5 to 7 ------------------------------------------------------------------


def v07_distance_nullsafe(df: DataFrame, area: StagingArea) -> DataFrame:
    """As rule 7, but a missing airport code matches a missing airport code."""
    absent = [c for c in r.ENDS if c not in df.columns]
    if absent:
        raise KeyError(f"route columns missing: {absent}")
    return r.r07_distance(df, area, null_safe=True)


def v_chain_5_7(df: DataFrame, area: StagingArea) -> DataFrame:
    return v07_distance_nullsafe(r.r06_cap_passengers(r.r05_cap_departures(df)), area)


# -- rules 11 to 13 -----------------------------------------------------------------


def v13_freight_filter(df: DataFrame) -> DataFrame:
    """Keep freight in [0, payload); unknown freight or payload goes."""
    return df.where((F.col("Freight") < F.col("Payload")) & (F.col("Freight") >= 0))


def market_names(markets: DataFrame) -> DataFrame:
    """Description per market code, the last entry of a code; blank entries count."""
    named = markets.dropna(subset=["Code"]).withColumn(
        "Description", F.coalesce("Description", F.lit(""))
    )
    last = last_by_key(named, ["Code"], "Description")
    return last.select("Code", F.when(F.col(FILL) != "", F.col(FILL)).alias(FILL))


def v12_market_lookup(df: DataFrame, markets: DataFrame, area: StagingArea) -> DataFrame:
    """A market id that repeats the airport id: city from the market lookup, id -> null."""
    names = area.table(market_names(markets), "market-names")
    rows = names.count()
    for end in r.ENDS:
        market, city = f"{end}CityMarketID", f"{end}CityName"
        wrong = holds(r.market_is_airport(end))
        df = df.withColumns({"_wrong": wrong, market: F.col(market).cast("string")})
        df = attach(df, names.withColumnRenamed("Code", market), [market], area, rows=rows)
        df = df.withColumns(
            {
                city: F.when(F.col("_wrong"), F.col(FILL)).otherwise(F.col(city)),
                market: F.when(~F.col("_wrong"), F.col(market)),
            }
        ).drop("_wrong", FILL)
    return df


def seq_codes(seq_ids: DataFrame) -> DataFrame:
    """Airport version code per airport and period, the last entry of each."""
    code = F.trim("Code")
    old = holds(F.lower("Description").contains(fv.OLD_PERIOD_TEXT))
    usable = seq_ids.select(
        "row_id", code.alias("SeqCode"), F.substring(code, 1, fv.AIRPORT_ID_LENGTH).alias("_base"),
        old.alias("_old"),
    ).where(F.length("SeqCode") == fv.SEQ_CODE_LENGTH)
    return last_by_key(usable, ["_base", "_old"], "SeqCode")


def v11_seq_period_lookup(df: DataFrame, seq_ids: DataFrame, area: StagingArea) -> DataFrame:
    """A version id that repeats the airport id: the lookup's code for the airport and period.

    No such code: null. No year: unchanged. Ids become text.
    """
    codes = area.table(seq_codes(seq_ids), "seq-codes")
    rows = codes.count()
    for end in r.ENDS:
        target = f"{end}AirportSeqID"
        wrong = holds(r.seq_is_airport(end)) & F.col("Year").isNotNull()
        df = df.withColumns(
            {
                "_wrong": wrong,
                "_base": F.col(f"{end}AirportID").cast("string"),
                "_old": F.col("Year") < fv.OLD_PERIOD_BEFORE_YEAR,
            }
        )
        df = attach(df, codes, ["_base", "_old"], area, rows=rows)
        code = F.when(F.col("_wrong"), F.col(FILL)).otherwise(F.col(target).cast("string"))
        df = df.withColumn(target, code).drop("_wrong", "_base", "_old", FILL)
    return df


def v_chain_11_13(
    df: DataFrame, markets: DataFrame, seq_ids: DataFrame, area: StagingArea
) -> DataFrame:
    df = v12_market_lookup(v13_freight_filter(df), markets, area)
    return v11_seq_period_lookup(df, seq_ids, area)


def v11_audit_extract(raw: DataFrame, seq_ids: DataFrame, area: StagingArea) -> DataFrame:
    """The rows rule 11's variant looked at: year, airports, and the ids after it."""
    touched = holds(r.seq_is_airport("Origin")) | holds(r.seq_is_airport("Dest"))
    fixed = v11_seq_period_lookup(raw.where(touched), seq_ids, area)
    keep = [c for c in ("row_id", "Year") if c in fixed.columns]
    return fixed.select(
        *keep, "OriginAirportID", "OriginAirportSeqID", "DestAirportID", "DestAirportSeqID"
    )


# -- discard instead of repair ---------------------------------------------------------


def _above(value: str, limit: str) -> Column:
    return F.col(value) > F.col(limit)


def s_drop_dep_excess(df: DataFrame) -> DataFrame:
    return drop_where(df, _above("DepPerformed", "DepScheduled"))


def s_drop_pax_excess(df: DataFrame) -> DataFrame:
    """More passengers than seats goes, unless seats are 0: those rows are marked."""
    return r.r14_seat_flag(drop_where(df, (F.col("Seats") != 0) & _above("Passengers", "Seats")))


def s_drop_distance(df: DataFrame) -> DataFrame:
    return drop_where(df, F.col("Distance") <= 0)


def s_drop_airtime(df: DataFrame) -> DataFrame:
    air = F.col("AirTime")
    return drop_where(df, (air <= 0) | (air > fv.STRICT_AIR_MINUTES_MAX))


def s_drop_freight(df: DataFrame) -> DataFrame:
    return drop_where(df, _above("Freight", "Payload") | (F.col("Freight") < 0))


def s_dedupe_business_key(df: DataFrame) -> DataFrame:
    return dedupe_first_by_key(df, BUSINESS_KEY, r.ROW_ORDER)


def s_exclude_unknown_id(df: DataFrame) -> DataFrame:
    return drop_where(df, F.col("AirlineID") == 0)


def filter_length_prefix(seq_ids: DataFrame) -> DataFrame:
    """Full-length version codes and the airport id they start with."""
    code = text.strip(F.col("Code"))
    return seq_ids.where(F.length(code) == fv.SEQ_CODE_LENGTH).select(
        "row_id", code.alias("Code"), F.substring(code, 1, fv.AIRPORT_ID_LENGTH).alias("BaseAirportID")
    )


def filter_contains_ci(seq_ids: DataFrame) -> DataFrame:
    """Whether a description names the old period, in any case; no description: it does not."""
    return seq_ids.select(
        "row_id", "Code", holds(F.lower("Description").contains(fv.OLD_PERIOD_TEXT)).alias("is_pre")
    )
