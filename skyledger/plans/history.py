"""Loads after the first one: change detection, upsert, changing dimensions, increments."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from skyledger.operators.joins import attach
from skyledger.operators.keys import dense_key, largest_key
from skyledger.plans import star
from skyledger.staging import StagingArea

UNKNOWN_KEY = -1
UNKNOWN_TEXT = "Unknown"


def _differs(attributes: Sequence[str]) -> Column:
    out = F.lit(False)
    for a in attributes:
        out = out | ~F.col(f"new.{a}").eqNullSafe(F.col(f"old.{a}"))
    return out


def one_per_key(feed: DataFrame, key: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """The last row of every key by ``order_by``, then by the remaining columns (missing values first).

    Feeds may name a key several times; everything below works on one row per key.
    """
    rest = [c for c in feed.columns if c not in key]
    order = [c for c in order_by if c in rest] + [c for c in rest if c not in order_by]
    if not order:
        return feed.distinct()
    last = F.max(F.struct(*order)).alias("_last")
    return feed.groupBy(*key).agg(last).select(
        *[F.col(c) if c in key else F.col(f"_last.{c}").alias(c) for c in feed.columns]
    )


def _paired(
    old: DataFrame, new: DataFrame, key: Sequence[str], how: str
) -> DataFrame:
    """Rows of both sides side by side; null matches null. Keys are unique on each side, so no key is hot."""
    condition = reduce(Column.__and__, [F.col(f"old.{k}").eqNullSafe(F.col(f"new.{k}")) for k in key])
    return old.withColumn("_in_old", F.lit(True)).alias("old").join(
        new.withColumn("_in_new", F.lit(True)).alias("new"), condition, how
    )


def _without(rows: DataFrame, others: DataFrame, key: Sequence[str]) -> DataFrame:
    """The rows whose key is not among the others'; null matches null."""
    known = others.select(*[F.col(k).alias(f"_known_{k}") for k in key])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_known_{k}")) for k in key])
    return rows.join(known, same, "left_anti")


def change_detect(
    old: DataFrame, new: DataFrame, key: Sequence[str], attributes: Sequence[str]
) -> DataFrame:
    """Every key with its state: ``new``, ``changed``, ``unchanged`` or ``absent``."""
    new = one_per_key(new, key, attributes)
    state = (
        F.when(F.col("old._in_old").isNull(), "new")
        .when(F.col("new._in_new").isNull(), "absent")
        .when(_differs(attributes), "changed")
        .otherwise("unchanged")
    )
    names = [F.coalesce(f"new.{k}", f"old.{k}").alias(k) for k in key]
    return _paired(old, new, key, "full").select(*names, state.alias("state"))


def upsert(old: DataFrame, new: DataFrame, key: Sequence[str]) -> DataFrame:
    """New rows replace old rows of the same key; other old rows stay."""
    new = one_per_key(new, key)
    return _without(old, new, key).unionByName(new)


def scd1(
    current: DataFrame, new: DataFrame, natural: Sequence[str], attributes: Sequence[str],
    surrogate: str, area: StagingArea,
) -> DataFrame:
    """Overwrite attributes in place; unseen members get the next keys."""
    new = one_per_key(new.select(*natural, *attributes), natural)
    joined = _paired(current, new, natural, "left")
    updated = joined.select(
        *[
            F.when(F.col("new._in_new"), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")).alias(c)
            if c in attributes
            else F.col(f"old.{c}").alias(c)
            for c in current.columns
        ]
    )
    unseen = _without(new, current, natural)
    added = dense_key(
        unseen.select(*natural, *attributes), surrogate, natural, area,
        largest_key(current, surrogate) + 1,
    )
    return updated.unionByName(added, allowMissingColumns=True)


def scd2(
    current: DataFrame, new: DataFrame, natural: Sequence[str], attributes: Sequence[str],
    surrogate: str, load_date, area: StagingArea,
) -> DataFrame:
    """Versions: a changed member's active row is closed and a new active row is added.

    A version never ends before it began: one that began on the load's own day ends on it.
    """
    new = one_per_key(new.select(*natural, *attributes), natural)
    day = F.lit(str(load_date)).cast("date")
    active = current.where("Fila_Activa")
    changed = area.table(
        _paired(active, new, natural, "inner")
        .where(_differs(attributes))
        .select(*[F.col(f"new.{c}").alias(c) for c in (*natural, *attributes)]),
        "changed",
    )
    unseen = _without(new, active, natural).select(*natural, *attributes)
    closing = changed.select(*natural, F.lit(True).alias("_closed"))
    closed = F.col("_closed") & F.col("Fila_Activa")
    history = attach(current, closing, natural, area, null_safe=True, name="closing").withColumns(
        {
            "Fecha_Fin": F.when(
                closed, F.greatest(F.date_sub(day, 1), F.col("Fecha_Inicio"))
            ).otherwise(F.col("Fecha_Fin")),
            "Fila_Activa": F.col("Fila_Activa") & F.col("_closed").isNull(),
        }
    )
    versions = dense_key(
        changed.unionByName(unseen), surrogate, natural, area, largest_key(current, surrogate) + 1
    ).withColumns(star.since(load_date))
    return history.select(current.columns).unionByName(versions.select(current.columns))


def scd3(
    current: DataFrame, new: DataFrame, natural: Sequence[str], attribute: str
) -> DataFrame:
    """The attribute's value before the last change in ``<attribute>_anterior``."""
    new = one_per_key(new.select(*natural, attribute), natural)
    before = f"{attribute}_anterior"
    changed = F.col("new._in_new") & _differs([attribute])
    old_value = F.col(f"old.{before}") if before in current.columns else F.lit(None).cast("string")
    return _paired(current, new, natural, "left").select(
        *[F.col(f"old.{c}").alias(c) for c in current.columns if c not in (attribute, before)],
        F.when(changed, F.col(f"new.{attribute}")).otherwise(F.col(f"old.{attribute}")).alias(attribute),
        F.when(changed, F.col(f"old.{attribute}")).otherwise(old_value).alias(before),
    )


# -- unknown members -----------------------------------------------------------------


def with_unknown_member(dim: DataFrame, surrogate: str, load_date) -> DataFrame:
    """The dimension plus its member -1 for facts whose member is not known."""
    fixed = {
        surrogate: F.lit(UNKNOWN_KEY),
        "Fila_Activa": F.lit(True),
        "Fecha_Inicio": F.lit(str(load_date)).cast("date"),
        **{c: F.lit(UNKNOWN_TEXT) for c in ("CarrierNombre", "Nombre", "Estacion")},
    }
    member = dim.sparkSession.range(1).select(
        *[
            (fixed[f.name] if f.name in fixed else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in dim.schema
        ]
    )
    return member.unionByName(dim)


def unknown_keys(resolved: DataFrame) -> DataFrame:
    """Keys that could not be resolved point to the unknown member."""
    return resolved.withColumns(
        {k: F.coalesce(k, F.lit(UNKNOWN_KEY)) for k in star.FACT_KEYS}
    )


def reject_log(fact: DataFrame, table: str = "Vuelo") -> DataFrame:
    """One row per refused row and reason."""
    _, rejected = star.dw_contract(table, fact)
    return rejected.select(
        *[c for c in rejected.columns if c != "reasons"], F.explode("reasons").alias("reason")
    )


# -- increments -------------------------------------------------------------------------


def new_members(
    dim: DataFrame, members: DataFrame, table: str, load_date, area: StagingArea
) -> DataFrame:
    """Members that the dimension has not seen, with the keys after its largest; null matches null."""
    natural, surrogate = list(star.NATURAL_KEYS[table]), f"{table}Key"
    added = dense_key(_without(members, dim, natural), surrogate, natural, area, largest_key(dim, surrogate) + 1)
    if "Fecha_Inicio" in dim.columns:
        added = added.withColumns(star.since(load_date))
    return added.select(dim.columns)


def add_members(
    dim: DataFrame, members: DataFrame, table: str, load_date, area: StagingArea
) -> DataFrame:
    """Known members keep their keys; unseen ones get the keys after the largest."""
    return dim.unionByName(new_members(dim, members, table, load_date, area))


def members_of(clean: DataFrame) -> dict[str, DataFrame]:
    return {
        "Tiempo": star.tiempo_members(clean),
        "Transportista": star.transportista_members(clean),
        "Aeropuerto": star.aeropuerto_members(clean),
    }


def active(dim: DataFrame) -> DataFrame:
    return dim.where("Fila_Activa") if "Fila_Activa" in dim.columns else dim


def changed_dimension(
    dim: DataFrame, members: DataFrame, table: str, load_date, area: StagingArea, kind: int
) -> DataFrame:
    """The whole dimension after a batch, with changing members of type 1 (overwritten) or 2 (versions)."""
    args = (dim, members, star.NATURAL_KEYS[table], star.ATTRIBUTES[table], f"{table}Key")
    if kind == 2:
        return scd2(*args, load_date, area)
    fresh = F.col("Fecha_Inicio").isNull()
    return scd1(*args, area).withColumns({
        c: F.when(fresh, value).otherwise(F.col(c)) for c, value in star.since(load_date).items()
    }).select(dim.columns)


def load_log(
    tables: Mapping[str, DataFrame], refused: DataFrame, batch: str, load_date, absent: Sequence[str] = ()
) -> DataFrame:
    """``load_metadata`` with the rows refused, the largest key, lines that could not be read, and absent lookups."""
    keys = None
    for name, df in tables.items():
        row = df.agg(F.max(f"{name}Key").cast("bigint").alias("clave_max")).select(
            F.lit(name).alias("tabla"), "clave_max"
        )
        keys = row if keys is None else keys.unionByName(row)
    loaded = (
        load_metadata(tables, batch, load_date)
        .join(refused.where(F.col("lote") == batch).groupBy("tabla").agg(F.count("*").alias("rechazadas")), "tabla", "left")
        .join(keys, "tabla")
        .select("lote", "tabla", "fecha_carga", "filas", F.coalesce("rechazadas", F.lit(0)).alias("rechazadas"),
                "clave_max", F.lit("cargada").alias("estado"))
    )
    unread = refused.where((F.col("lote") == batch) & ~F.col("tabla").isin(*tables)).groupBy("tabla").agg(
        F.count("*").alias("rechazadas")
    ).select(F.lit(batch).alias("lote"), "tabla", F.lit(str(load_date)).cast("date").alias("fecha_carga"),
             F.lit(0).cast("bigint").alias("filas"), "rechazadas", F.lit(None).cast("bigint").alias("clave_max"),
             F.lit("rechazada").alias("estado"))
    missing = loaded.sparkSession.createDataFrame(
        [(batch, name, str(load_date), 0, 0, None, "ausente") for name in absent],
        "lote string, tabla string, fecha_carga string, filas bigint, rechazadas bigint, clave_max bigint, estado string",
    )
    return loaded.unionByName(unread).unionByName(missing.withColumn("fecha_carga", F.col("fecha_carga").cast("date")))


def load_metadata(tables: Mapping[str, DataFrame], batch: str, load_date) -> DataFrame:
    """(lote, tabla, fecha_carga, filas) of one load, to be appended to the load log."""
    out = None
    for name, df in tables.items():
        row = df.agg(F.count("*").alias("filas")).select(
            F.lit(batch).alias("lote"), F.lit(name).alias("tabla"),
            F.lit(str(load_date)).cast("date").alias("fecha_carga"), "filas",
        )
        out = row if out is None else out.unionByName(row)
    return out
