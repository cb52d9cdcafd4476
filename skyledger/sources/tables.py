"""Staged and warehouse tables: Parquet folders, one per table name."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from skyledger import fixed_values as fv
from skyledger.functions.text import strip
from skyledger.schemas import FACT_RAW
from skyledger.sources.files import lookup_schema, null_tokens, present_lookups, refused_lines, scan_csv, typed_fact
from skyledger.staging import StagingArea


def stage_overwrite(df: DataFrame, folder: str, table: str, *partition_by: str, dynamic: bool = False) -> DataFrame:
    """Replace a table's content, so that loading twice equals loading once; ``dynamic``: that of the partitions in ``df`` only."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(f"{folder}/{table}")
    return scan_table(df.sparkSession, folder, table, df)


def scan_table(
    spark: SparkSession, folder: str, table: str, like: DataFrame | None = None
) -> DataFrame:
    reader = spark.read if like is None else spark.read.schema(like.schema)
    scan = reader.parquet(f"{folder}/{table}")
    return scan if like is None else scan.select(*like.columns)


REFUSED = "stg_rechazos"


def extract(
    spark: SparkSession, source: str, staging: str, area: StagingArea, multi_line: bool = False
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Files -> staging tables (the lookups that are there, then the fact), and the lines that could not be read."""
    tables, refused = {}, []
    for name, path in (present_lookups(spark, source) | {fv.FACT_TABLE: f"{source}/{fv.FACT_FILE}"}).items():
        schema = FACT_RAW if name == fv.FACT_TABLE else lookup_schema(path)
        scan = scan_csv(spark, path, schema, area, multi_line)
        rows = typed_fact(scan) if name == fv.FACT_TABLE else null_tokens(scan.rows)
        tables[name] = stage_overwrite(rows, staging, name)
        refused.append(refused_lines(scan.refused, name))
    return tables, stage_overwrite(reduce(DataFrame.unionByName, refused), staging, REFUSED)


def staging_row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per staging table, and their TOTAL."""
    counts = reduce(
        DataFrame.unionByName,
        (
            df.agg(F.count("*").alias("filas")).select(F.lit(name).alias("tabla"), "filas")
            for name, df in tables.items()
            if name.startswith("stg_")
        ),
    )
    return counts.rollup("tabla").agg(F.sum("filas").alias("filas")).select(
        F.coalesce("tabla", F.lit("TOTAL")).alias("tabla"), "filas"
    )


def described(lookup: DataFrame) -> DataFrame:
    """Projection and filter at the scan: codes that have a description."""
    return lookup.select(*[c for c in lookup.columns if c in ("Code", "Description", "row_id")]).where(
        "Code IS NOT NULL AND Description IS NOT NULL"
    )


def closed_history(history: DataFrame) -> DataFrame:
    """Carrier-history entries whose end date is filled in."""
    return history.select("AirlineID", "UniqueCarrier", "EndDate").where(
        F.col("EndDate").isNotNull() & (strip(F.col("EndDate")) != "")
    )
