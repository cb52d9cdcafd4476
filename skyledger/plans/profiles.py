"""Profiles of loads that can be merged: counts, different values and quantiles without reading earlier rows again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, functions as F

#: Log of the size of a sketch of different values, and its error at one standard deviation.
DISTINCT_BITS = 12
DISTINCT_ERROR = 1.04 / 2 ** (DISTINCT_BITS / 2)
#: Size of a quantile sketch, and by how much a rank can be off.
QUANTILE_SIZE = 200
RANK_ERROR = 0.0165


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(columna, filas, nulos, distintos, cuantiles) of a load, in one pass; numbers alone have quantiles."""
    kinds = dict(df.dtypes)
    aggregates = [F.count("*").alias("filas")]
    for c in columns:
        aggregates += [F.count(c).alias(f"{c}__n"), F.hll_sketch_agg(F.col(c).cast("string"), DISTINCT_BITS).alias(f"{c}__d")]
        if kinds[c] != "string":
            aggregates.append(F.kll_sketch_agg_double(F.col(c).cast("double"), QUANTILE_SIZE).alias(f"{c}__q"))
    row = df.agg(*aggregates)
    nothing = F.lit(None).cast("binary")
    cells = [x for c in columns for x in (
        F.lit(c), F.col("filas") - F.col(f"{c}__n"), F.col(f"{c}__d"), F.col(f"{c}__q") if kinds[c] != "string" else nothing)]
    return row.select("filas", F.stack(F.lit(len(columns)), *cells).alias("columna", "nulos", "distintos", "cuantiles")).select(
        "columna", "filas", "nulos", "distintos", "cuantiles")


def merged(profiles: DataFrame) -> DataFrame:
    """One profile per column of all loads' profiles."""
    sketches = F.filter(F.collect_list("cuantiles"), lambda s: s.isNotNull())
    return profiles.groupBy("columna").agg(
        F.sum("filas").alias("filas"), F.sum("nulos").alias("nulos"), F.hll_union_agg("distintos").alias("distintos"), sketches.alias("_all"),
    ).select("columna", "filas", "nulos", "distintos", F.when(F.size("_all") > 0, F.aggregate(
        F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0))), F.get("_all", F.lit(0)), F.kll_sketch_merge_double)).alias("cuantiles"))


def estimates(profiles: DataFrame, ranks: Sequence[float] = (0.5,)) -> DataFrame:
    """(columna, filas, nulos, distintos, and q<rank in hundredths> for numbers)."""
    return profiles.select("columna", "filas", "nulos", F.hll_sketch_estimate("distintos").alias("distintos"), *[
        F.kll_sketch_get_quantile_double("cuantiles", F.lit(float(q))).alias(f"q{round(100 * q)}") for q in ranks
    ])


def kept(stored: DataFrame | None, own: DataFrame) -> DataFrame:
    """A load's profile added to those of the loads before."""
    return own if stored is None else merged(reduce(DataFrame.unionByName, [stored, own]))
