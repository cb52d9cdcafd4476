"""Counts of what the rules met and changed, as tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.numbers import holds, to_number
from skyledger.operators.joins import attach
from skyledger.operators.rows import Marks
from skyledger.plans import lookups as lk, rules as r
from skyledger.plans.clean import run_rules
from skyledger.staging import StagingArea


def tall(one_row: DataFrame) -> DataFrame:
    cells = []
    for name in one_row.columns:
        rule, metric = name.split("__")
        cells += [F.lit(rule), F.lit(metric), F.col(name).cast("bigint")]
    return one_row.select(
        F.stack(F.lit(len(one_row.columns)), *cells).alias("rule", "metric", "value")
    )


def _removed(rule: str, before: DataFrame, after: DataFrame) -> DataFrame:
    sizes = before.select(F.lit(1).alias("n")).unionAll(after.select(F.lit(-1).alias("n")))
    return tall(sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias(f"{rule}__removed")))


def _all(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def rule_counts(raw: DataFrame, airports: DataFrame, history: DataFrame, area: StagingArea) -> DataFrame:
    """Affected rows per rule of one run.

    The rules note on every row what they met (``Marks``), and all of it is counted
    in one pass over the repaired rows. The counts come from results of tasks, not
    from accumulators, which count a recomputed stage twice when an executor is lost.
    """
    c, marks = F.col, Marks()
    run = run_rules(raw, airports, history, area, marks=marks)
    bad, found = ~r.valid_distance(), run.routes.select(*r.ENDS, F.lit(True).alias("_known"))
    distances = attach(run.deduped, found, r.ENDS, area, rows=run.routes.count()).agg(
        F.count_if(bad).alias("R07__invalid"),
        F.count_if(bad & c("_known")).alias("R07__imputed"),
        F.count_if((c("Freight") < 0) & (~bad | c("_known"))).alias("R15__removed"),
    )
    # Names are compared as they are spelled, so that each is normalized once.
    spelled = run.coded.select("UniqueCarrierName").distinct()
    names = r.r02_names(spelled.withColumn("_spelled", c("UniqueCarrierName"))).agg(
        F.count("_spelled").alias("R02__names_before"), F.count_distinct("UniqueCarrierName").alias("R02__names_after")
    )
    repaired = run.repaired.agg(
        *marks.counts(),
        F.count_if(c("is_merged_carrier")).alias("R09__merged"),
        F.count_if(r.seq_is_airport("Origin")).alias("R11__origin_left"),
        F.count_if(r.seq_is_airport("Dest")).alias("R11__dest_left"),
        F.count_if(r.market_is_airport("Origin")).alias("R12__origin_left"),
        F.count_if(r.market_is_airport("Dest")).alias("R12__dest_left"),
        F.count_if(c("Flag_Review_Seats") == 1).alias("R14__flagged"),
        F.count_if(c("IsActive") == 0).alias("R16__inactive"),
        F.count_if(c("CarrierRegion") == fv.UNKNOWN_REGION).alias("R18__unknown"),
        F.count("*").alias("_repaired"),
    )
    repaired = area.table(repaired, "counts")
    at_end = tall(
        repaired.select(c("_repaired").alias("n")).unionAll(run.final.agg((-F.count("*")).alias("n")))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("R10__removed_at_end"))
    )
    return _all(_removed("R10", run.raw, run.deduped), tall(distances), tall(names), tall(repaired.drop("_repaired")), at_end)


def run_counts(raw: DataFrame, final: DataFrame) -> DataFrame:
    """(registros, filas): rows in and rows ready for the load."""

    def size(name: str, df: DataFrame) -> DataFrame:
        return df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("registros"), "filas")

    return size("iniciales", raw).unionByName(size("finales", final))


def _listed(df: DataFrame, rule: str, metric: str, which: Column | None = None, codes: str | None = None) -> DataFrame:
    """How many rows, and the different codes among them in order if asked for: (rule, metric, value, codes)."""
    rows = df if which is None else df.where(holds(which))
    names = F.array_join(F.sort_array(F.collect_set(F.col(codes))), ",") if codes else F.lit(None).cast("string")
    return rows.agg(F.count("*").alias("value"), names.alias("codes")).select(
        F.lit(rule).alias("rule"), F.lit(metric).alias("metric"), "value", "codes"
    )


def lookup_counts(
    carriers: DataFrame, history: DataFrame, current_year: int, area: StagingArea
) -> DataFrame:
    """What cleaning the carrier lookups removed and kept, step by step, with the codes and ids that were met."""
    coded = lk.normalized_carriers(carriers)
    suffixed = F.col("Code").contains("(")
    unique = lk.unique_carriers(carriers)
    unsuffixed = lk.drop_suffixed(history)
    dated = lk.parse_dates(unsuffixed)
    swapped = lk.swap_dates(dated)
    current = lk.drop_future(swapped, current_year)
    typed = current.withColumn("AirlineID", to_number(F.col("AirlineID"), "int"))
    outside = ~F.col("AirlineID").between(fv.AIRLINE_ID_MIN, fv.AIRLINE_ID_MAX) & (F.col("AirlineID") != 0)
    valid = area.table(lk.drop_bad_ids(current), "valid")
    final = area.table(lk.drop_foreign_claims(valid, area), "final")
    claims = valid.join(final.select("row_id"), "row_id", "left_anti")
    kept = coded.where(~suffixed)
    duplicates = tall(
        kept.select(F.lit(1).alias("n")).unionAll(unique.select(F.lit(-1).alias("n")))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("carriers__duplicates"))
    ).withColumn("codes", F.lit(None).cast("string"))
    carrier = "UniqueCarrier"
    return _all(
        _listed(carriers, "carriers", "original"),
        _listed(coded, "carriers", "coded"),
        _listed(coded, "carriers", "suffixed", suffixed, "Code"),
        duplicates,
        _listed(unique, "carriers", "final"),
        _listed(unique, "carriers", "inactive", ~F.col("IsActive"), "Code"),
        _listed(history, "history", "original"),
        _listed(history, "history", "suffixed", F.col(carrier).contains("("), carrier),
        _listed(dated, "history", "inverted", F.col("StartDate") > F.col("EndDate"), carrier),
        _listed(swapped, "history", "future", F.year("EndDate") > current_year, carrier),
        _listed(current, "history", "before_id_check"),
        _listed(typed, "history", "bad_ids", outside, "AirlineID"),
        _listed(valid, "history", "before_owner_check"),
        _listed(claims, "history", "foreign_claims", codes=carrier),
        _listed(final, "history", "final"),
    )


def profile_defects(raw: DataFrame, history: DataFrame, area: StagingArea) -> DataFrame:
    """Rows per catalogued defect in the raw data: (defect, rows)."""
    c = F.col

    def blank(name: str) -> Column:
        return c(name).isNull() | (F.trim(name) == "")

    marked = r.r16_inactive(raw, history, area)
    one_pass = marked.agg(
        F.count_if(c("UniqueCarrier").rlike(fv.CODE_SUFFIX)).alias("01_code_suffix"),
        F.count_if(c("AirlineID") == 0).alias("03_airline_id_zero"),
        F.count_if(
            blank("CarrierName") | blank("AircraftType") | blank("Class")
            | blank("OriginCityName") | blank("DestCityName")
        ).alias("04_required_blank"),
        F.count_if(c("DepPerformed") > c("DepScheduled")).alias("05_departures"),
        F.count_if((c("Seats") > 0) & (c("Passengers") > c("Seats"))).alias("06_passengers"),
        F.count_if(c("Distance") <= 0).alias("07_distance"),
        F.count_if(
            ~c("AirTime").between(fv.MINUTES_MIN, fv.MINUTES_MAX)
            | ~c("RampTime").between(fv.MINUTES_MIN, fv.MINUTES_MAX)
        ).alias("08_times"),
        F.count_if(r.seq_is_airport("Origin")).alias("11_origin_seq"),
        F.count_if(r.market_is_airport("Origin")).alias("12_origin_market"),
        F.count_if(c("Freight") > c("Payload")).alias("13_freight"),
        F.count_if(r.passengers_without_seats()).alias("14_seats_zero"),
        F.count_if(c("Freight") < 0).alias("15_negative_freight"),
        F.count_if(c("IsActive") == 0).alias("16_inactive"),
    )
    cells = [x for name in one_pass.columns for x in (F.lit(name), F.col(name))]
    simple = one_pass.select(
        F.stack(F.lit(len(one_pass.columns)), *cells).alias("defect", "rows")
    )

    # The remaining classes compare rows with each other.
    names = raw.select("UniqueCarrierName").distinct()
    variants = (
        r.r02_names(names.withColumn("raw_name", c("UniqueCarrierName")))
        .groupBy("UniqueCarrierName").agg(F.count("raw_name").alias("spellings"))
        .where("spellings > 1").agg(F.coalesce(F.sum("spellings"), F.lit(0)).alias("rows"))
        .select(F.lit("02_name_spellings").alias("defect"), "rows")
    )
    reused = (
        raw.where("AirlineID > 0").groupBy("UniqueCarrier", "AirlineID").agg(F.count("*").alias("n"))
        .groupBy("UniqueCarrier").agg((F.sum("n") - F.max("n")).alias("n"))
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"))
        .select(F.lit("09_reused_code").alias("defect"), "rows")
    )
    copies = (
        raw.select(F.lit(1).alias("n"))
        .unionAll(r.r10_dedupe(raw).select(F.lit(-1).alias("n")))
        .agg(F.sum("n").alias("rows")).select(F.lit("10_copies").alias("defect"), "rows")
    )
    return _all(simple, variants, reused, copies)
