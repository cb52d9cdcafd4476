"""Cleaning the carrier lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.numbers import holds, to_date, to_number
from skyledger.functions.text import strip
from skyledger.operators.impute import FILL, first_by_key
from skyledger.operators.rows import drop_where
from skyledger.staging import StagingArea


def normalized_carriers(lookup: DataFrame) -> DataFrame:
    """Codes stripped and in upper case; blank codes go; blank descriptions become null."""
    code, text = F.upper(strip(F.col("Code"))), strip(F.col("Description"))
    return lookup.select(
        "row_id", code.alias("Code"), F.when(text != "", text).alias("Description")
    ).where("Code IS NOT NULL AND Code <> ''")


def unique_carriers(lookup: DataFrame) -> DataFrame:
    """One row per code without suffix, its first non-blank description, and IsActive."""
    described = F.col("Description").isNotNull()
    return (
        drop_where(normalized_carriers(lookup), F.col("Code").contains("("))
        .groupBy("Code", "Description")
        .agg(F.min("row_id").alias("_seen"))
        .groupBy("Code")
        .agg(
            F.min_by("Description", F.when(described, F.struct("_seen", "Description"))).alias(
                "Description"
            )
        )
        .withColumn("IsActive", ~F.col("Code").isin(*fv.INACTIVE_CARRIERS))
    )


# -- carrier history: six steps ---------------------------------------------------


def drop_suffixed(history: DataFrame) -> DataFrame:
    return drop_where(history, F.col("UniqueCarrier").contains("("))


def parse_dates(history: DataFrame) -> DataFrame:
    return history.withColumns({c: to_date(F.col(c)) for c in ("StartDate", "EndDate")})


def swap_dates(history: DataFrame) -> DataFrame:
    start, end = F.col("StartDate"), F.col("EndDate")
    inverted = holds(start > end)
    return history.withColumns(
        {
            "StartDate": F.when(inverted, end).otherwise(start),
            "EndDate": F.when(inverted, start).otherwise(end),
        }
    )


def drop_future(history: DataFrame, current_year: int) -> DataFrame:
    return drop_where(history, F.year("EndDate") > current_year)


def drop_bad_ids(history: DataFrame) -> DataFrame:
    """Ids outside the assigned range go; 0 and null stay."""
    typed = history.withColumn("AirlineID", to_number(F.col("AirlineID"), "int"))
    inside = F.col("AirlineID").between(fv.AIRLINE_ID_MIN, fv.AIRLINE_ID_MAX)
    return drop_where(typed, ~inside & (F.col("AirlineID") != 0))


def primary_ids(history: DataFrame) -> DataFrame:
    """Id of each carrier's earliest entry (no start date comes last)."""
    dated = history.where("AirlineID <> 0").withColumn(
        "_start", F.coalesce("StartDate", F.lit("9999-12-31").cast("date"))
    )
    first = first_by_key(dated, ["UniqueCarrier"], "AirlineID", order_by=("_start", "row_id"))
    return first.withColumnRenamed(FILL, "PrimaryID")


def sole_owners(primary: DataFrame) -> DataFrame:
    """Ids that are primary for exactly one carrier."""
    return (
        primary.groupBy(F.col("PrimaryID").alias("AirlineID"))
        .agg(F.count("*").alias("_n"), F.min("UniqueCarrier").alias("Owner"))
        .where("_n = 1")
        .drop("_n")
    )


def closed_carriers(history: DataFrame, primary: DataFrame) -> DataFrame:
    """Carriers with an end date on their own primary id."""
    own = primary.withColumnRenamed("PrimaryID", "AirlineID")
    return (
        history.where(F.col("EndDate").isNotNull())
        .select("UniqueCarrier", "AirlineID")
        .distinct()
        .join(own, ["UniqueCarrier", "AirlineID"], "left_semi")
        .select("UniqueCarrier")
        .distinct()
    )


def foreign_claims(history: DataFrame, primary: DataFrame) -> DataFrame:
    """(carrier, id) pairs whose id belongs to another carrier while this one never closed.

    Works on distinct pairs; an id owned by one carrier may be claimed by any
    number of entries.
    """
    pairs = history.where("AirlineID <> 0").select("UniqueCarrier", "AirlineID").distinct()
    claimed = pairs.join(sole_owners(primary), "AirlineID").where("Owner <> UniqueCarrier")
    return claimed.join(closed_carriers(history, primary), "UniqueCarrier", "left_anti").select(
        "UniqueCarrier", "AirlineID"
    )


def drop_foreign_claims(history: DataFrame, area: StagingArea) -> DataFrame:
    written = area.table(history, "history")
    primary = area.table(primary_ids(written), "primary-ids")
    claims = foreign_claims(written, primary)
    return written.join(claims, ["UniqueCarrier", "AirlineID"], "left_anti").select(history.columns)


def prepared_history(history: DataFrame, current_year: int) -> DataFrame:
    """The steps that look at one entry at a time."""
    dated = swap_dates(parse_dates(drop_suffixed(history)))
    return drop_bad_ids(drop_future(dated, current_year))


def carrier_history(history: DataFrame, current_year: int, area: StagingArea) -> DataFrame:
    return drop_foreign_claims(prepared_history(history, current_year), area)


def carrier_groups(spark: SparkSession) -> DataFrame:
    """Group codes and the types they stand for; a code may have two types."""
    return spark.createDataFrame(list(fv.CARRIER_GROUPS), "Code string, Type string, Description string")


def clean_lookups(
    carriers: DataFrame, history: DataFrame, current_year: int, area: StagingArea
) -> dict[str, DataFrame]:
    return {
        "unique_carriers": unique_carriers(carriers),
        "carrier_history": carrier_history(history, current_year, area),
        "carrier_group_compact": carrier_groups(carriers.sparkSession),
    }
