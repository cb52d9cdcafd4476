"""Several evidence tables from one pass.

Filling nine columns from per-key evidence would read the data nine times.
Here every row is stacked into one entry per evidence table and the entries are
counted together: one scan, one shuffle of map-side combined counters.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from skyledger.functions.numbers import holds
from skyledger.operators.joins import attach
from skyledger.operators.rows import order_key
from skyledger.schemas import ROW_ID
from skyledger.staging import StagingArea


@dataclass(frozen=True)
class Evidence:
    """What is known about ``value`` per key, and which of a key's values counts.

    ``pick``: ``first`` in row order, ``mode`` (most rows), or ``dominant`` (most
    rows, then most weight; only for keys with several values). Ties go to the
    smallest value.
    """

    name: str
    keys: tuple[str, ...]
    value: str
    pick: str
    where: Column | None = None

    def entry(self) -> list[Column]:
        keys = [F.col(k) for k in self.keys]
        usable = keys[0].isNotNull()
        for key in keys[1:]:
            usable = usable & key.isNotNull()
        if self.where is not None:
            usable = usable & holds(self.where)
        second = keys[1].cast("string") if len(keys) > 1 else F.lit(None).cast("string")
        return [
            F.lit(self.name),
            keys[0].cast("string"),
            second,
            F.when(usable, F.col(self.value).cast("string")),
        ]


def pairs_of(
    df: DataFrame,
    specs: Sequence[Evidence],
    weight: str,
    order_by: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    """One row per (evidence, key, value): its rows, the first of them in row order, and their weight."""
    entries = [column for spec in specs for column in spec.entry()]
    return (
        df.select(
            F.stack(F.lit(len(specs)), *entries).alias("name", "key1", "key2", "value"),
            order_key(order_by).alias("_order"),
            F.col(weight).cast("bigint").alias("_weight"),
        )
        .where("value IS NOT NULL")
        .groupBy("name", "key1", "key2", "value")
        .agg(
            F.count("*").alias("_n"),
            F.min("_order").alias("_seen"),
            F.coalesce(F.sum("_weight"), F.lit(0)).alias("_w"),
        )
    )


def numeric(df: DataFrame, specs: Sequence[Evidence]) -> list[str]:
    """The names of the evidence tables whose values are numbers."""
    return [s.name for s in specs if not isinstance(df.schema[s.value].dataType, T.StringType)]


def picked(pairs: DataFrame, numbers: Sequence[str]) -> DataFrame:
    """One row per (evidence, key) with the value each way of picking would choose."""
    smallest = (F.when(F.col("name").isin(*numbers), F.col("value").try_cast("bigint")), F.col("value"))
    return pairs.groupBy("name", "key1", "key2").agg(
        F.min_by("value", F.struct("_seen", *smallest)).alias("first"),
        F.min_by("value", F.struct(-F.col("_n"), *smallest)).alias("mode"),
        F.min_by("value", F.struct(-F.col("_n"), -F.col("_w"), *smallest)).alias("dominant"),
        F.count("*").alias("values"),
    )


def gather(
    df: DataFrame,
    specs: Sequence[Evidence],
    weight: str,
    order_by: Sequence[str] = (ROW_ID,),
) -> DataFrame:
    return picked(pairs_of(df, specs, weight, order_by), numeric(df, specs))


class Memory:
    """Counters per (evidence, key, value) that outlive a load.

    The counters of loads add up, so a load only writes its own, for the keys its
    rows have; what all loads know is their sum. Rows of earlier loads come before
    those of later ones.
    """

    def __init__(self, load: int, stored: DataFrame | None, area: StagingArea):
        """``stored``: what earlier loads have written, none if this is the first."""
        self.load, self.stored, self.area = load, stored, area
        self._own: list[DataFrame] = []

    def with_own(self, pairs: DataFrame, names: Sequence[str]) -> DataFrame:
        """This load's counters of some evidence tables, kept for ``own``, and those of the loads before, added up."""
        own = self.area.table(pairs.withColumn("_load", F.lit(self.load).cast("bigint")), "own-evidence")
        self._own.append(own)
        known = own if self.stored is None else self.stored.where(F.col("name").isin(*names)).unionByName(own)
        return added_up(known)

    def own(self) -> DataFrame:
        """What this load has to store."""
        return reduce(DataFrame.unionByName, self._own)


def added_up(stored: DataFrame) -> DataFrame:
    """One row per (evidence, key, value) for all loads; ``_seen`` is the first load and the first row in it."""
    return stored.groupBy("name", "key1", "key2", "value").agg(
        F.sum("_n").alias("_n"), F.min(F.struct("_load", "_seen")).alias("_seen"), F.sum("_w").alias("_w")
    )


class EvidenceTables:
    """Written evidence, ready to be joined back with known sizes."""

    def __init__(
        self,
        df: DataFrame,
        specs: Sequence[Evidence],
        weight: str,
        area: StagingArea,
        order_by: Sequence[str] = (ROW_ID,),
        memory: Memory | None = None,
    ):
        self.area = area
        self.specs = {spec.name: spec for spec in specs}
        self.types = dict(df.dtypes)
        pairs = pairs_of(df, specs, weight, order_by)
        if memory:
            pairs = memory.with_own(pairs, list(self.specs))
        self.written = area.table(picked(pairs, numeric(df, specs)), "evidence")
        # One row per evidence table, so at most len(specs) rows.
        self.rows = {
            r["name"]: r["count"] for r in self.written.groupBy("name").count().collect()
        }

    def table(self, keys: tuple[str, ...]) -> DataFrame:
        """One row per key, one column ``_<evidence>`` per evidence table with these keys."""
        specs = [spec for spec in self.specs.values() if spec.keys == keys]
        named = F.col("name")
        picks = []
        for spec in specs:
            counts = named == spec.name
            if spec.pick == "dominant":
                counts = counts & (F.col("values") > 1)
            value = F.max(F.when(counts, F.col(spec.pick)))
            picks.append(value.cast(self.types[spec.value]).alias(f"_{spec.name}"))
        return (
            self.written.where(named.isin(*[spec.name for spec in specs]))
            .groupBy(*[
                F.col(column).cast(self.types[key]).alias(key)
                for column, key in zip(("key1", "key2"), keys)
            ])
            .agg(*picks)
        )

    def size(self, keys: tuple[str, ...]) -> int:
        """Most keys that ``table`` can have."""
        return sum(self.rows.get(s.name, 0) for s in self.specs.values() if s.keys == keys)

    def join(self, df: DataFrame, *keys: str) -> DataFrame:
        return attach(df, self.table(keys), keys, self.area, rows=self.size(keys))
