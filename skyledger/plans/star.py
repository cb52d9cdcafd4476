"""The star schema: three dimensions with surrogate keys and the flight fact."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from skyledger.functions.measures import season_label
from skyledger.operators.asof import attach_as_of, open_beginning
from skyledger.operators.joins import attach
from skyledger.operators.keys import dense_key
from skyledger.operators.rows import order_key
from skyledger.schemas import STAR, STAR_LENGTHS
from skyledger.sources.warehouse import Load, Warehouse
from skyledger.staging import StagingArea

#: Warehouse column <- cleaned column, in the order of the fact.
FACT_NAMES = {
    "tipoServicio": "Class",
    "VProgramados": "DepScheduled",
    "VRealizados": "DepPerformed",
    "Asientos": "Seats",
    "Pasajeros": "Passengers",
    "OcupPasajeros": "OcupPasajeros",
    "Capacidad": "Payload",
    "Carga": "Freight",
    "OcupCarga": "OcupCarga",
    "Distancia": "Distance",
    "DemoraPista": "DemoraPista",
}
FACT_KEYS = ("TiempoKey", "TransportistaKey", "AeropuertoOrigenKey", "AeropuertoDestinoKey")
#: The dimension of every key of the fact.
ROLES = dict(zip(FACT_KEYS, ("Tiempo", "Transportista", "Aeropuerto", "Aeropuerto")))
NATURAL_KEYS = {
    "Tiempo": ("Anio", "Mes"),
    "Transportista": ("CarrierNombre",),
    "Aeropuerto": ("Nombre",),
}
#: What can change about a member.
ATTRIBUTES = {
    "Tiempo": (),
    "Transportista": ("CarrierGrupo", "Region"),
    "Aeropuerto": ("Ciudad", "Pais"),
}


def since(load_date: str | date) -> dict[str, Column]:
    """Validity columns of a row that is current from ``load_date``."""
    return {
        "Fecha_Inicio": F.lit(str(load_date)).cast("date"),
        "Fecha_Fin": F.lit(None).cast("date"),
        "Fila_Activa": F.lit(True),
    }


# -- members, without keys --------------------------------------------------------


def tiempo_members(clean: DataFrame) -> DataFrame:
    return clean.select("Year", "Month", "Estacion").distinct().select(
        F.col("Month").alias("Mes"), season_label(F.col("Estacion")).alias("Estacion"),
        F.col("Year").alias("Anio"),
    )


def aeropuerto_members(clean: DataFrame, order_by=("row_id",)) -> DataFrame:
    """One row per airport code: as an origin if it is one, then first in row order."""
    ends = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(place).alias("_end"), F.col(end).alias("Nombre"),
                    F.col(f"{end}CityName").alias("Ciudad"),
                    F.col(f"{end}CountryName").alias("Pais"),
                )
                for place, end in enumerate(("Origin", "Dest"))
            ]
        )
    )
    seen = (
        clean.select(order_key(order_by).alias("_order"), ends)
        .groupBy("Nombre", "Ciudad", "Pais", "_end")
        .agg(F.min("_order").alias("_order"))
    )
    first = F.min(F.struct("_end", "_order", "Ciudad", "Pais"))
    return seen.groupBy("Nombre").agg(first.alias("_first")).select(
        "Nombre", "_first.Ciudad", "_first.Pais"
    )


def transportista_members(clean: DataFrame, order_by=("row_id",)) -> DataFrame:
    """One row per carrier name: group and region of the first row."""
    seen = clean.groupBy(
        F.col("UniqueCarrierName").alias("CarrierNombre"),
        F.col("CarrierGroupNew").alias("CarrierGrupo"),
        F.col("CarrierRegion").alias("Region"),
    ).agg(F.min(order_key(order_by)).alias("_order"))
    first = F.min(F.struct("_order", "CarrierGrupo", "Region"))
    return seen.groupBy("CarrierNombre").agg(first.alias("_first")).select(
        "CarrierNombre", "_first.CarrierGrupo", "_first.Region"
    )


# -- dimensions ----------------------------------------------------------------------


def dim_tiempo(clean: DataFrame, area: StagingArea) -> DataFrame:
    return dense_key(tiempo_members(clean), "TiempoKey", ["Anio", "Mes", "Estacion"], area)


def dim_aeropuerto(clean: DataFrame, load_date, area: StagingArea) -> DataFrame:
    keyed = dense_key(aeropuerto_members(clean), "AeropuertoKey", ["Nombre"], area)
    return keyed.withColumns(since(load_date))


def dim_transportista(clean: DataFrame, load_date, area: StagingArea) -> DataFrame:
    keyed = dense_key(transportista_members(clean), "TransportistaKey", ["CarrierNombre"], area)
    return keyed.withColumns(since(load_date))


# -- fact -----------------------------------------------------------------------------------


def month_end() -> Column:
    """The last day of a cleaned row's month; none if there is no such month."""
    return F.when(F.col("Month").between(1, 12), F.last_day(F.make_date("Year", "Month", F.lit(1))))


def resolve_keys(
    clean: DataFrame, dims: Mapping[str, DataFrame], area: StagingArea, versioned: Collection[str] = ()
) -> DataFrame:
    """The cleaned rows with their four dimension keys; the number of rows does not change.

    A ``versioned`` dimension holds several versions of a member: a row gets the one
    that was valid at the end of its month, the first one also before it began.
    """
    tiempo = dims["Tiempo"].select(F.col("Anio").alias("Year"), F.col("Mes").alias("Month"), "TiempoKey")
    df = attach(clean, tiempo, ["Year", "Month"], area, name="keys-tiempo")
    roles = [("Transportista", "UniqueCarrierName", "TransportistaKey"),
             ("Aeropuerto", "Origin", "AeropuertoOrigenKey"), ("Aeropuerto", "Dest", "AeropuertoDestinoKey")]
    members, rows = {}, {}
    for name, column, key in roles:
        natural, surrogate = NATURAL_KEYS[name][0], f"{name}Key"
        if name not in members:
            wanted = [natural, surrogate, *(("Fecha_Inicio", "Fecha_Fin") if name in versioned else ())]
            members[name] = area.table(dims[name].select(*wanted), f"keys-{name}")
            rows[name] = members[name].count()
        role = members[name].withColumnsRenamed({natural: column, surrogate: key})
        if name in versioned:
            versions = open_beginning(role, [column], "Fecha_Inicio")
            dated = df.withColumn("_moment", month_end())
            df = attach_as_of(dated, versions, [column], "_moment", "Fecha_Inicio", "Fecha_Fin", key, area).drop("_moment")
        else:
            df = attach(df, role, [column], area, rows=rows[name])
    return df


def fact_rows(resolved: DataFrame) -> DataFrame:
    """The fact's columns under their warehouse names, still without ``VueloKey``."""
    extra = [c for c in ("row_id",) if c in resolved.columns]
    return resolved.select(
        *extra, *FACT_KEYS, *[F.col(source).alias(name) for name, source in FACT_NAMES.items()]
    )


def fact_vuelo(
    resolved: DataFrame, area: StagingArea, start: int = 1, order_by=("row_id",)
) -> DataFrame:
    """Numbered facts, ordered by time and then row order."""
    rows = fact_rows(resolved)
    rest = [c for c in rows.columns if c not in order_by and c != "TiempoKey"]
    return dense_key(
        rows, "VueloKey", ["TiempoKey", *order_by, *rest], area, start, "bigint", 1 + len(order_by)
    ).drop(*order_by)


def build_dims(clean: DataFrame, load_date, area: StagingArea) -> dict[str, DataFrame]:
    return {
        "Tiempo": dim_tiempo(clean, area),
        "Transportista": dim_transportista(clean, load_date, area),
        "Aeropuerto": dim_aeropuerto(clean, load_date, area),
    }


def build_star(clean: DataFrame, load_date, area: StagingArea, written: bool = False) -> dict[str, DataFrame]:
    clean = clean if written else area.table(clean, "clean")
    dims = build_dims(clean, load_date, area)
    return dims | {"Vuelo": fact_vuelo(resolve_keys(clean, dims, area), area)}


# -- contract -------------------------------------------------------------------------------------


def violations(table: str) -> Column:
    """Reasons to refuse a typed row (array, empty if none); ``_lost`` names values that did not fit."""
    reasons = [
        F.when(F.col(c).isNull() & ~F.array_contains("_lost", c), F.lit(f"{c} is null"))
        for c, _, required in STAR[table]
        if required
    ]
    reasons += [
        F.when(F.length(c) > STAR_LENGTHS[c], F.lit(f"{c} too long"))
        for c, _, _ in STAR[table]
        if c in STAR_LENGTHS
    ]
    if table == "Tiempo":
        reasons += [
            F.when(~F.col("Mes").between(1, 12), F.lit("Mes outside 1-12")),
            F.when(~F.col("Anio").between(1990, 2100), F.lit("Anio outside 1990-2100")),
        ]
    lost = F.transform("_lost", lambda c: F.concat(c, F.lit(" does not fit")))
    return F.concat(F.array_compact(F.array(*reasons)), lost)


def repeated_members(table: str, dim: DataFrame) -> DataFrame:
    """Adds a reason to members whose natural key an earlier member has; one row per member, so no key is hot.

    Closed versions of a member share its natural key.
    """
    if table not in NATURAL_KEYS:
        return dim
    key = NATURAL_KEYS[table]
    current = F.col("Fila_Activa") if "Fila_Activa" in dim.columns else F.lit(True)
    turn = F.row_number().over(Window.partitionBy(*key, current).orderBy(f"{table}Key"))
    again = F.array(F.lit(f"repeated {', '.join(key)}"))
    return dim.withColumn("_turn", turn).withColumn(
        "reasons", F.when((F.col("_turn") > 1) & current, F.concat("reasons", again)).otherwise(F.col("reasons"))
    ).drop("_turn")


def dw_contract(
    table: str, df: DataFrame, default_zero: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with reasons) under the table's types and checks.

    A value that its type cannot hold is a reason of its own, also where the
    column may be null.

    ``default_zero`` gives missing measures the warehouse default instead of
    refusing the row.
    """
    if default_zero:
        measures = [c for c, kind, required in STAR[table]
                    if required and not c.endswith("Key") and kind not in ("string", "date", "boolean")]
        df = df.withColumns({c: F.coalesce(c, F.lit(0)) for c in measures})
    fits = {c: F.col(c).try_cast(kind) for c, kind, _ in STAR[table]}
    lost = F.array_compact(F.array(*[
        F.when(F.col(c).isNotNull() & fit.isNull(), F.lit(c)) for c, fit in fits.items()
    ]))
    checked = repeated_members(
        table,
        df.select(*[fit.alias(c) for c, fit in fits.items()], lost.alias("_lost"))
        .withColumn("reasons", violations(table)).drop("_lost"),
    )
    accepted = checked.where(F.size("reasons") == 0).drop("reasons")
    return accepted, checked.where(F.size("reasons") > 0)


def duplicate_keys(df: DataFrame, *key: str) -> DataFrame:
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where("rows > 1")


def orphans(fact: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """Key values in the fact that their dimension does not have, with row counts."""
    cells = [x for column in ROLES for x in (F.lit(column), F.col(column).cast("int"))]
    used = (
        fact.select(F.stack(F.lit(len(ROLES)), *cells).alias("columna", "valor"))
        .groupBy("columna", "valor")
        .agg(F.count("*").alias("filas"))
    )
    known = None
    for column, table in ROLES.items():
        keys = dims[table].select(F.lit(column).alias("columna"), F.col(f"{table}Key").alias("valor"))
        known = keys if known is None else known.unionByName(keys)
    return used.join(known, ["columna", "valor"], "left_anti")


# -- load --------------------------------------------------------------------------------------------


REJECTS = "Rechazos"


def rejects(table: str, rejected: DataFrame, batch: str) -> DataFrame:
    """(lote, tabla, fila as JSON, motivos) of refused rows."""
    columns = [c for c in rejected.columns if c != "reasons"]
    return rejected.select(
        F.lit(batch).alias("lote"), F.lit(table).alias("tabla"),
        F.to_json(F.struct(*columns)).alias("fila"), F.col("reasons").alias("motivos"),
    )


def read_rejects(spark: SparkSession, target: str) -> DataFrame:
    """Refused rows of all loads; there may be none."""
    return Warehouse(spark, target).read(REJECTS)


def load_dw(
    clean: DataFrame, target: str, load_date, area: StagingArea, default_zero: bool = True,
    batch: str = "full", written: bool = False,
) -> dict[str, DataFrame]:
    """Load the four tables in place of what was there, all of them or none; facts are foldered by load and year."""
    load = Warehouse(clean.sparkSession, target).begin()
    tables = write_star(load, clean, load_date, area, default_zero, batch, written)
    load.commit()
    return tables


def write_star(
    load: Load, clean: DataFrame, load_date, area: StagingArea, default_zero: bool = True,
    batch: str = "full", written: bool = False,
) -> dict[str, DataFrame]:
    """The four tables as part of ``load``.

    Facts are resolved against accepted members only, so a fact of a refused
    member is refused itself. Every refused row of the four tables goes to
    ``Rechazos`` with its reasons. Pass ``written`` if ``clean`` is a written table.
    """
    clean = clean if written else area.table(clean, "clean")
    tables, refused = {}, []
    for name, members in build_dims(clean, load_date, area).items():
        accepted, rejected = dw_contract(name, members)
        tables[name] = load.replace(accepted, name)
        refused.append(rejects(name, rejected, batch))
    facts = fact_vuelo(resolve_keys(clean, tables, area), area)
    accepted, rejected = dw_contract("Vuelo", facts, default_zero)
    refused.append(rejects("Vuelo", rejected, batch))
    dated = with_year(accepted, tables["Tiempo"], area).withColumn("lote", F.lit(batch))
    facts = load.replace(dated, "Vuelo", "lote", "Anio")
    load.replace(reduce(DataFrame.unionByName, refused), REJECTS, "lote")
    return tables | {"Vuelo": facts.select(*accepted.columns)}


def with_year(facts: DataFrame, tiempo: DataFrame, area: StagingArea) -> DataFrame:
    return attach(facts, tiempo.select("TiempoKey", "Anio"), ["TiempoKey"], area, name="years")
