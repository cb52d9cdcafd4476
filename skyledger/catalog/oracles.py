"""SQL texts for DuckDB that compute what each query must return."""

from __future__ import annotations

from functools import cache

from skyledger import fixed_values as fv
from skyledger.catalog import inputs
from skyledger.catalog.queries import _LOOKUP_FILES, BUSINESS_KEY, CURRENT_YEAR, LOAD_DATE, NEXT_LOAD_DATE, SPLIT_YEAR
from skyledger.plans.star import FACT_KEYS, FACT_NAMES
from skyledger.schemas import FACT_COLUMNS
from skyledger.sources.files import WRONG_LINE

Ctes = list[tuple[str, str]]


def sql(final: str, *groups: Ctes) -> str:
    """``WITH`` the inputs and the given subqueries, then ``final``."""
    parts = list(inputs.oracle_ctes().items()) + [cte for group in groups for cte in group]
    return "WITH " + ",\n".join(f"{name} AS ({body})" for name, body in parts) + "\n" + final


def text_map(entries: dict[str, str]) -> str:
    pairs = ", ".join(f"'{k}': '{v}'" for k, v in entries.items())
    return f"MAP {{{pairs}}}"


def name_expr(x: str) -> str:
    bare = f"trim(regexp_replace(upper(trim({x})), '{fv.CORPORATE_SUFFIX}', ''))"
    words = (
        f"array_to_string(list_transform(regexp_split_to_array({bare}, '\\s+'), "
        f"lambda w: coalesce({text_map(fv.ABBREVIATIONS)}[w], w)), ' ')"
    )
    return f"coalesce({text_map(fv.CANONICAL_NAMES)}[{words}], {words})"


def load_expr(part: str, whole: str) -> str:
    return (
        f"coalesce(CASE WHEN {whole} > 0 THEN round_even(CAST({part} AS DOUBLE) / CAST({whole} AS DOUBLE) "
        f"* CAST(10000 AS DOUBLE), 0) / CAST(10000 AS DOUBLE) END, CAST(0 AS DOUBLE))"
    )


DELAY = "coalesce(RampTime - AirTime, 0)"
SEASON = ("CASE WHEN Month IN (12, 1, 2) THEN 1 WHEN Month IN (3, 4, 5) THEN 2 "
          "WHEN Month IN (6, 7, 8) THEN 3 WHEN Month IN (9, 10, 11) THEN 4 ELSE 0 END")


def label(x: str) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in fv.SEASON_LABELS.items())
    return f"CASE {x} {whens} END"


# -- rules: (source, name) -> subqueries ------------------------------------------------


def r10(src: str, out: str) -> Ctes:
    return [(out, f"SELECT * EXCLUDE (row_id), min(row_id) AS row_id FROM {src} GROUP BY ALL")]


def r07(src: str, out: str, same: str = "=") -> Ctes:
    nulls = "" if same != "=" else " AND Origin IS NOT NULL AND Dest IS NOT NULL"
    same = "IS NOT DISTINCT FROM" if same != "=" else "="
    value = "CASE WHEN s.Distance > 0 THEN s.Distance ELSE f.d END"
    return [
        (f"{out}_ref", f"SELECT Origin, Dest, max(Distance) AS d FROM {src} WHERE Distance > 0{nulls} GROUP BY ALL"),
        (out, f"SELECT s.* REPLACE ({value} AS Distance) FROM {src} s LEFT JOIN {out}_ref f "
              f"ON s.Origin {same} f.Origin AND s.Dest {same} f.Dest WHERE {value} > 0"),
    ]


def drop(src: str, out: str, condition: str) -> Ctes:
    return [(out, f"SELECT * FROM {src} WHERE NOT coalesce({condition}, false)")]


def replace(src: str, out: str, **columns: str) -> Ctes:
    items = ", ".join(f"{e} AS {c}" for c, e in columns.items())
    return [(out, f"SELECT * REPLACE ({items}) FROM {src}")]


def r01(src: str, out: str, trimmed: bool = True) -> Ctes:
    def bare(c):
        e = f"regexp_replace({c}, '{fv.CODE_SUFFIX}', '')"
        return f"trim({e})" if trimmed else e

    return replace(src, out, UniqueCarrier=bare("UniqueCarrier"), Carrier=bare("Carrier"))


def r17(src: str, out: str) -> Ctes:
    return replace(src, out, UniqCarrierEntity="UniqueCarrier", Carrier="UniqueCarrier",
                   CarrierName="UniqueCarrier")


def r02(src: str, out: str) -> Ctes:
    return replace(src, out, UniqueCarrierName=name_expr("UniqueCarrierName"))


def first_of(src: str, keys: str, value: str, where: str = "true") -> str:
    filled = " AND ".join(f"{k.strip()} IS NOT NULL" for k in keys.split(","))
    return (f"SELECT {keys}, {value} AS found FROM {src} WHERE {value} IS NOT NULL AND {filled} AND {where} "
            f"QUALIFY row_number() OVER (PARTITION BY {keys} ORDER BY row_id, {value}) = 1")


def mode_of(src: str, key: str, value: str) -> str:
    return (f"SELECT {key}, {value} AS found FROM (SELECT {key}, {value}, count(*) AS n FROM {src} "
            f"WHERE {key} IS NOT NULL AND {value} IS NOT NULL GROUP BY ALL) "
            f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY n DESC, {value}) = 1")


def fill(src: str, out: str, ref: str, keys: list[str], target: str, value: str) -> Ctes:
    on = " AND ".join(f"s.{k} = f.{k}" for k in keys)
    return [
        (f"{out}_ref", ref),
        (out, f"SELECT s.* REPLACE ({value} AS {target}) FROM {src} s LEFT JOIN {out}_ref f ON {on}"),
    ]


def unknown_carrier(src: str, out: str) -> Ctes:
    return replace(
        src, out,
        UniqueCarrier=f"CASE WHEN AirlineID = 0 THEN '{fv.UNKNOWN_CARRIER_CODE}' ELSE UniqueCarrier END",
        UniqueCarrierName=f"CASE WHEN AirlineID = 0 THEN '{fv.UNKNOWN_CARRIER_NAME}' ELSE UniqueCarrierName END",
    )


def r03(src: str, out: str) -> Ctes:
    ref = first_of(src, "UniqueCarrier", "AirlineID", "AirlineID > 0")
    value = "CASE WHEN coalesce(s.AirlineID, 0) = 0 THEN coalesce(f.found, 0) ELSE s.AirlineID END"
    return fill(src, f"{out}_id", ref, ["UniqueCarrier"], "AirlineID", value) + unknown_carrier(f"{out}_id", out)


def blanks(src: str, out: str) -> Ctes:
    columns = ("CarrierName", "Class", "OriginCityName", "DestCityName", "AircraftType")
    return replace(src, out, **{c: f"CASE WHEN trim({c}) = '' THEN NULL ELSE {c} END" for c in columns})


def r04a(src: str, out: str) -> Ctes:
    return replace(src, out, CarrierName="coalesce(CarrierName, Carrier)")


def r04b(src: str, out: str) -> Ctes:
    return fill(src, out, mode_of(src, "UniqueCarrier", "Class"), ["UniqueCarrier"], "Class",
                "coalesce(s.Class, f.found)")


CITIES: Ctes = [(
    "cities",
    "SELECT Code, trim(split_part(Description, ':', 1)) AS found FROM airports "
    "WHERE Code IS NOT NULL AND Description IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY Code ORDER BY row_id DESC) = 1",
)]


def r04_lookup(src: str, out: str) -> Ctes:
    return [(out, f"""SELECT s.* REPLACE (coalesce(s.OriginCityName, o.found) AS OriginCityName,
        coalesce(s.DestCityName, d.found) AS DestCityName)
        FROM {src} s LEFT JOIN cities o ON s.Origin = o.Code LEFT JOIN cities d ON s.Dest = d.Code""")]


def r04_modes(src: str, out: str, modes_from: str | None = None) -> Ctes:
    base = modes_from or src
    return [
        (f"{out}_o", mode_of(base, "Origin", "OriginCityName")),
        (f"{out}_d", mode_of(base, "Dest", "DestCityName")),
        (out, f"""SELECT s.* REPLACE (coalesce(s.OriginCityName, o.found) AS OriginCityName,
        coalesce(s.DestCityName, d.found) AS DestCityName)
        FROM {src} s LEFT JOIN {out}_o o ON s.Origin = o.Origin LEFT JOIN {out}_d d ON s.Dest = d.Dest"""),
    ]


def r04(src: str, out: str, with_blanks: bool = True) -> Ctes:
    start = blanks(src, f"{out}_b") if with_blanks else [(f"{out}_b", f"SELECT * FROM {src}")]
    return (start + r04a(f"{out}_b", f"{out}_n") + r04b(f"{out}_n", f"{out}_c")
            + r04_lookup(f"{out}_c", f"{out}_l") + r04_modes(f"{out}_l", out, f"{out}_c"))


def r05(src: str, out: str) -> Ctes:
    return replace(src, out, DepPerformed="CASE WHEN DepPerformed > DepScheduled THEN DepScheduled ELSE DepPerformed END")


def r06(src: str, out: str) -> Ctes:
    return replace(src, out, Passengers="CASE WHEN Seats > 0 AND Passengers > Seats THEN Seats ELSE Passengers END")


def r08(src: str, out: str) -> Ctes:
    ok = "CASE WHEN {c} BETWEEN 1 AND 9000 THEN {c} END"
    return replace(src, f"{out}_w", AirTime=ok.format(c="AirTime"), RampTime=ok.format(c="RampTime")) + replace(
        f"{out}_w", out,
        AirTime="CASE WHEN NOT coalesce(AirTime > RampTime, false) THEN AirTime END",
        RampTime="CASE WHEN NOT coalesce(AirTime > RampTime, false) THEN RampTime END",
    )


def r09(src: str, out: str) -> Ctes:
    return [
        (f"{out}_n", f"SELECT UniqueCarrier, AirlineID, count(*) AS n, coalesce(sum(Passengers), 0) AS p FROM {src} "
                     "WHERE UniqueCarrier IS NOT NULL AND AirlineID IS NOT NULL GROUP BY ALL"),
        (f"{out}_dom", f"SELECT UniqueCarrier, AirlineID AS found FROM {out}_n WHERE UniqueCarrier IN "
                       f"(SELECT UniqueCarrier FROM {out}_n GROUP BY 1 HAVING count(*) > 1) "
                       "QUALIFY row_number() OVER (PARTITION BY UniqueCarrier ORDER BY n DESC, p DESC, AirlineID) = 1"),
        (out, f"""SELECT s.* REPLACE (CASE WHEN f.found IS NOT NULL THEN f.found ELSE s.AirlineID END AS AirlineID),
        f.found IS NOT NULL AND s.AirlineID IS DISTINCT FROM f.found AS is_merged_carrier,
        s.AirlineID AS AirlineID_original
        FROM {src} s LEFT JOIN {out}_dom f ON s.UniqueCarrier = f.UniqueCarrier"""),
    ]


def _sound(src: str, out: str, end: str, target: str, keys: list[str]) -> Ctes:
    wrong = f"{target} = {end}AirportID"
    ref = first_of(src, ", ".join(keys), target, f"NOT coalesce({wrong}, false)")
    return fill(src, out, ref, keys, target,
                f"CASE WHEN s.{target} = s.{end}AirportID THEN coalesce(f.found, s.{target}) ELSE s.{target} END")


def r11(src: str, out: str) -> Ctes:
    return (_sound(src, f"{out}_o", "Origin", "OriginAirportSeqID", ["OriginAirportID", "Year"])
            + _sound(f"{out}_o", out, "Dest", "DestAirportSeqID", ["DestAirportID", "Year"]))


def r12(src: str, out: str) -> Ctes:
    return (_sound(src, f"{out}_o", "Origin", "OriginCityMarketID", ["OriginAirportID"])
            + _sound(f"{out}_o", out, "Dest", "DestCityMarketID", ["DestAirportID"]))


def r13(src: str, out: str) -> Ctes:
    return replace(src, out, Freight="CASE WHEN Freight > Payload THEN Payload ELSE Freight END")


def r14(src: str, out: str) -> Ctes:
    return [(out, f"SELECT *, CASE WHEN Seats = 0 AND Passengers > 0 THEN 1 ELSE 0 END AS Flag_Review_Seats FROM {src}")]


def r16(src: str, out: str) -> Ctes:
    return [
        (f"{out}_e", "SELECT DISTINCT TRY_CAST(AirlineID AS INT) AS id, UniqueCarrier AS uc FROM history "
                     f"WHERE EndDate IS NOT NULL AND trim(EndDate) <> '' AND TRY_CAST(EndDate AS DATE) < DATE '{fv.INACTIVE_BEFORE}'"),
        (out, f"SELECT s.*, CASE WHEN e.uc IS NOT NULL THEN 0 ELSE 1 END AS IsActive FROM {src} s "
              f"LEFT JOIN {out}_e e ON coalesce(s.AirlineID, 0) = e.id AND s.UniqueCarrier = e.uc"),
    ]


def region_nulls(src: str, out: str) -> Ctes:
    return replace(src, out, CarrierRegion="CASE WHEN CarrierRegion IN ('NULL', 'null', 'None', '', ' ') THEN NULL ELSE CarrierRegion END")


def r18(src: str, out: str) -> Ctes:
    return region_nulls(src, f"{out}_t") + fill(
        f"{out}_t", out, first_of(f"{out}_t", "UniqueCarrier", "CarrierRegion"), ["UniqueCarrier"],
        "CarrierRegion", f"coalesce(s.CarrierRegion, f.found, '{fv.UNKNOWN_REGION}')")


def measures(src: str, out: str) -> Ctes:
    return [(out, f"SELECT *, {load_expr('Passengers', 'Seats')} AS OcupPasajeros, "
                  f"{load_expr('Freight', 'Payload')} AS OcupCarga, {DELAY} AS DemoraPista, "
                  f"{SEASON} AS Estacion FROM {src}")]


def all_rules(src: str, p: str) -> Ctes:
    """Every rule in order, as subqueries whose names start with ``p``; the last is ``p``_clean."""
    out: Ctes = CITIES if p == "p" else []
    steps = [r10, r07, None, r01, r17, r02, r03, r04, r05, r06, r08, r09, r11, r12, r13, r14, r16, r18, r10]
    names = ["dedup", "dist", "freight", "code", "unified", "named", "ided", "texts", "deps", "pax", "times",
             "dom", "seq", "market", "cargo", "flag", "active", "region", "final"]
    for step, name in zip(steps, names):
        name = f"{p}_{name}"
        out = out + (drop(src, name, "Freight < 0") if step is None else step(src, name))
        src = name
    return out + measures(src, f"{p}_clean")


# -- star ----------------------------------------------------------------------------------


def aero_members(src: str) -> str:
    return f"""SELECT Nombre, Ciudad, Pais FROM (
        SELECT 0 AS e, row_id, Origin AS Nombre, OriginCityName AS Ciudad, OriginCountryName AS Pais FROM {src}
        UNION ALL SELECT 1, row_id, Dest, DestCityName, DestCountryName FROM {src})
        QUALIFY row_number() OVER (PARTITION BY Nombre ORDER BY e, row_id, Ciudad NULLS FIRST, Pais NULLS FIRST) = 1"""


def carrier_members(src: str) -> str:
    return f"""SELECT UniqueCarrierName AS CarrierNombre, CarrierGroupNew AS CarrierGrupo, CarrierRegion AS Region FROM {src}
        QUALIFY row_number() OVER (PARTITION BY UniqueCarrierName
        ORDER BY row_id, CarrierGroupNew NULLS FIRST, CarrierRegion NULLS FIRST) = 1"""


def tiempo_members(src: str) -> str:
    return f"SELECT DISTINCT Month AS Mes, {label('Estacion')} AS Estacion, Year AS Anio FROM {src}"


VALID = f"DATE '{LOAD_DATE}' AS Fecha_Inicio, CAST(NULL AS DATE) AS Fecha_Fin, true AS Fila_Activa"


def key(order: str, name: str, start: str = "0", kind: str = "INT") -> str:
    return f"CAST({start} + row_number() OVER (ORDER BY {order}) AS {kind}) AS {name}"


def dims(src: str, p: str = "d") -> Ctes:
    return [
        (f"{p}_tiempo", f"SELECT {key('Anio, Mes', 'TiempoKey')}, * FROM ({tiempo_members(src)})"),
        (f"{p}_carrier", f"SELECT {key('CarrierNombre', 'TransportistaKey')}, *, {VALID} FROM ({carrier_members(src)})"),
        (f"{p}_aero", f"SELECT {key('Nombre', 'AeropuertoKey')}, *, {VALID} FROM ({aero_members(src)})"),
    ]


def resolved(src: str, out: str, p: str = "d") -> Ctes:
    return [(out, f"""SELECT s.*, t.TiempoKey, c.TransportistaKey, o.AeropuertoKey AS AeropuertoOrigenKey,
        a.AeropuertoKey AS AeropuertoDestinoKey FROM {src} s
        LEFT JOIN {p}_tiempo t ON s.Year = t.Anio AND s.Month = t.Mes
        LEFT JOIN {p}_carrier c ON s.UniqueCarrierName = c.CarrierNombre
        LEFT JOIN {p}_aero o ON s.Origin = o.Nombre LEFT JOIN {p}_aero a ON s.Dest = a.Nombre""")]


FACT_SELECT = ", ".join([*FACT_KEYS, *[f"{c} AS {n}" for n, c in FACT_NAMES.items()]])
FACT_ORDER = ", ".join(
    f"{c} NULLS FIRST" for c in
    ["TiempoKey", "row_id", *[k for k in FACT_KEYS if k != "TiempoKey"], *FACT_NAMES]
)


def fact(src: str, out: str, start: str = "0") -> Ctes:
    return [
        (f"{out}_rows", f"SELECT row_id, {FACT_SELECT} FROM {src}"),
        (out, f"SELECT {key(FACT_ORDER, 'VueloKey', start, 'BIGINT')}, * EXCLUDE (row_id) FROM {out}_rows"),
    ]


def whole_star() -> Ctes:
    return (all_rules("t100", "p") + dims("p_clean") + resolved("p_clean", "resolved")
            + fact("resolved", "vuelo"))


def dec(c: str, kind: str) -> str:
    return f"TRY_CAST(CAST({c} AS VARCHAR) AS {kind})"


TYPED_FACT = (
    "VueloKey, TiempoKey, TransportistaKey, AeropuertoOrigenKey, AeropuertoDestinoKey, tipoServicio, "
    "VProgramados, VRealizados, Asientos, Pasajeros, "
    f"{dec('OcupPasajeros', 'DECIMAL(5,4)')} AS OcupPasajeros, {dec('Capacidad', 'DECIMAL(18,2)')} AS Capacidad, "
    "{carga} AS Carga, "
    f"{dec('OcupCarga', 'DECIMAL(5,4)')} AS OcupCarga, {dec('Distancia', 'DECIMAL(10,2)')} AS Distancia, DemoraPista"
)


# -- carrier history --------------------------------------------------------------------------


def history_steps() -> Ctes:
    return [
        ("h1", "SELECT row_id, AirlineID, UniqueCarrier, CarrierName, TRY_CAST(StartDate AS DATE) AS StartDate, "
               "TRY_CAST(EndDate AS DATE) AS EndDate FROM history WHERE NOT coalesce(contains(UniqueCarrier, '('), false)"),
        ("h2", "SELECT * REPLACE (CASE WHEN StartDate > EndDate THEN EndDate ELSE StartDate END AS StartDate, "
               "CASE WHEN StartDate > EndDate THEN StartDate ELSE EndDate END AS EndDate) FROM h1"),
        ("h3", f"SELECT * FROM h2 WHERE EndDate IS NULL OR year(EndDate) <= {CURRENT_YEAR}"),
        ("h4", "SELECT * FROM (SELECT * REPLACE (TRY_CAST(AirlineID AS INT) AS AirlineID) FROM h3) "
               f"WHERE AirlineID IS NULL OR AirlineID = 0 OR AirlineID BETWEEN {fv.AIRLINE_ID_MIN} AND {fv.AIRLINE_ID_MAX}"),
        ("h_primary", "SELECT UniqueCarrier, AirlineID AS PrimaryID FROM h4 WHERE AirlineID <> 0 "
                      "QUALIFY row_number() OVER (PARTITION BY UniqueCarrier ORDER BY StartDate NULLS LAST, row_id) = 1"),
        ("h_owner", "SELECT PrimaryID AS AirlineID, min(UniqueCarrier) AS Owner FROM h_primary GROUP BY 1 HAVING count(*) = 1"),
        ("h_closed", "SELECT DISTINCT h.UniqueCarrier FROM h4 h JOIN h_primary p ON h.UniqueCarrier = p.UniqueCarrier "
                     "AND h.AirlineID = p.PrimaryID WHERE h.EndDate IS NOT NULL"),
        ("h_claims", "SELECT DISTINCT h.UniqueCarrier, h.AirlineID FROM h4 h JOIN h_owner o ON h.AirlineID = o.AirlineID "
                     "WHERE h.AirlineID <> 0 AND o.Owner <> h.UniqueCarrier "
                     "AND h.UniqueCarrier NOT IN (SELECT UniqueCarrier FROM h_closed)"),
        ("h_final", "SELECT h.* FROM h4 h WHERE NOT EXISTS (SELECT 1 FROM h_claims c WHERE "
                    "c.UniqueCarrier = h.UniqueCarrier AND c.AirlineID = h.AirlineID)"),
    ]


CARRIERS: Ctes = [
    ("k1", "SELECT row_id, upper(trim(Code)) AS Code, nullif(trim(Description), '') AS Description "
           "FROM unique_carriers WHERE trim(Code) <> ''"),
    ("k2", "SELECT * FROM k1 WHERE NOT contains(Code, '(')"),
    ("k3", "SELECT Code, Description, Code NOT IN ('CO', 'US', 'FL', 'VX', 'CP', 'PA', 'EA', 'KS') AS IsActive FROM k2 "
           "QUALIFY row_number() OVER (PARTITION BY Code ORDER BY Description IS NULL, row_id) = 1"),
]

SEQ_CODES: Ctes = [(
    "seq_codes",
    "SELECT base, old, code AS found FROM (SELECT row_id, trim(Code) AS code, substr(trim(Code), 1, 5) AS base, "
    "coalesce(contains(lower(Description), 'pre-2005'), false) AS old FROM seq_ids WHERE length(trim(Code)) = 7) "
    "QUALIFY row_number() OVER (PARTITION BY base, old ORDER BY row_id DESC) = 1",
)]

MARKET_NAMES: Ctes = [(
    "market_names",
    "SELECT Code, Description AS found FROM markets WHERE Code IS NOT NULL "
    "QUALIFY row_number() OVER (PARTITION BY Code ORDER BY row_id DESC) = 1",
)]

SHIFTED: Ctes = [("moved", "SELECT * REPLACE (CAST(Year + 6 AS INT) AS Year) FROM t100")]


def v11(src: str, out: str) -> Ctes:
    def value(end, alias):
        t = f"s.{end}AirportSeqID"
        return (f"CASE WHEN {t} = s.{end}AirportID AND s.Year IS NOT NULL THEN {alias}.found "
                f"ELSE CAST({t} AS VARCHAR) END AS {end}AirportSeqID")

    return SEQ_CODES + [(out, f"""SELECT s.* REPLACE ({value('Origin', 'o')}, {value('Dest', 'd')}) FROM {src} s
        LEFT JOIN seq_codes o ON CAST(s.OriginAirportID AS VARCHAR) = o.base AND (s.Year < 2005) = o.old
        LEFT JOIN seq_codes d ON CAST(s.DestAirportID AS VARCHAR) = d.base AND (s.Year < 2005) = d.old""")]


def v12(src: str, out: str) -> Ctes:
    def values(end, alias):
        wrong = f"s.{end}CityMarketID = s.{end}AirportID"
        return (f"CASE WHEN {wrong} THEN {alias}.found ELSE s.{end}CityName END AS {end}CityName, "
                f"CASE WHEN {wrong} THEN NULL ELSE CAST(s.{end}CityMarketID AS VARCHAR) END AS {end}CityMarketID")

    return MARKET_NAMES + [(out, f"""SELECT s.* REPLACE ({values('Origin', 'o')}, {values('Dest', 'd')}) FROM {src} s
        LEFT JOIN market_names o ON CAST(s.OriginCityMarketID AS VARCHAR) = o.Code
        LEFT JOIN market_names d ON CAST(s.DestCityMarketID AS VARCHAR) = d.Code""")]


def chain_1_4() -> Ctes:
    return CITIES + r01("t100", "a1", False) + r02("a1", "a2") + unknown_carrier("a2", "a3") + r04("a3", "a4", False)


# -- later loads ---------------------------------------------------------------------------------

_CARRIER_NAME = "CASE WHEN c_custkey <> 1 THEN c_name END AS CarrierNombre"
_TOP = "(SELECT max(TransportistaKey) FROM cur)"
CARRIER_LOADS: Ctes = [
    ("old_c", f"SELECT {_CARRIER_NAME}, c_mktsegment AS CarrierGrupo, 'R' || CAST(c_nationkey % 4 AS VARCHAR) AS Region "
              "FROM customer WHERE c_custkey % 10 <> 0"),
    ("cur", f"SELECT {key('CarrierNombre NULLS FIRST', 'TransportistaKey')}, *, {VALID} FROM old_c"),
    ("feed", f"SELECT {_CARRIER_NAME}, CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 7 = 0 OR c_custkey = 1 THEN 'Merged' "
             "ELSE c_mktsegment END AS CarrierGrupo, "
             "'R' || CAST((c_nationkey + CASE WHEN c_custkey % 11 = 0 THEN 1 ELSE 0 END) % 4 AS VARCHAR) AS Region, c_custkey "
             "FROM customer WHERE c_custkey % 9 <> 0"),
    ("new_c", "SELECT CarrierNombre, CarrierGrupo, Region FROM (SELECT * FROM feed UNION ALL "
              "SELECT * REPLACE ('R9' AS Region) FROM feed WHERE c_custkey % 17 = 0) "
              "QUALIFY row_number() OVER (PARTITION BY CarrierNombre ORDER BY CarrierGrupo DESC NULLS LAST, Region DESC NULLS LAST) = 1"),
    ("changed_c", "SELECT n.* FROM new_c n JOIN old_c o ON n.CarrierNombre IS NOT DISTINCT FROM o.CarrierNombre "
                  "WHERE n.CarrierGrupo IS DISTINCT FROM o.CarrierGrupo OR n.Region IS DISTINCT FROM o.Region"),
    ("unseen_c", "SELECT * FROM new_c n WHERE NOT EXISTS (SELECT 1 FROM old_c o WHERE o.CarrierNombre IS NOT DISTINCT FROM n.CarrierNombre)"),
    ("both_c", "SELECT c.*, n.n IS NOT NULL AS fed, n.CarrierGrupo AS new_grupo, n.Region AS new_region FROM cur c "
               "LEFT JOIN (SELECT *, 1 AS n FROM new_c) n ON c.CarrierNombre IS NOT DISTINCT FROM n.CarrierNombre"),
    ("versions_c", "SELECT TransportistaKey, CarrierNombre, CarrierGrupo, Region, Fecha_Inicio, "
                   f"CASE WHEN differs THEN DATE '{NEXT_LOAD_DATE}' - INTERVAL 1 DAY END::DATE AS Fecha_Fin, NOT differs AS Fila_Activa "
                   "FROM (SELECT *, fed AND (new_grupo IS DISTINCT FROM CarrierGrupo OR new_region IS DISTINCT FROM Region) AS differs FROM both_c) "
                   f"UNION ALL SELECT {key('CarrierNombre NULLS FIRST', 'TransportistaKey', _TOP)}, *, DATE '{NEXT_LOAD_DATE}', CAST(NULL AS DATE), true "
                   "FROM (SELECT * FROM changed_c UNION ALL SELECT * FROM unseen_c)"),
]


def _union(*selects: str) -> str:
    return " UNION ALL ".join(selects)


def _rules_audit() -> str:
    def n(rule, metric, src, where="true"):
        return f"SELECT '{rule}' AS rule, '{metric}' AS metric, count(*) AS value FROM {src} WHERE {where}"

    bad = "NOT coalesce(Distance > 0, false)"
    seq, market = "{e}AirportSeqID = {e}AirportID", "{e}CityMarketID = {e}AirportID"
    parts = [
        "SELECT 'R10' AS rule, 'removed' AS metric, (SELECT count(*) FROM t100) - (SELECT count(*) FROM p_dedup) AS value",
        n("R07", "invalid", "p_dedup", bad),
        n("R07", "imputed", "p_dedup s", f"{bad} AND EXISTS (SELECT 1 FROM p_dist_ref f WHERE f.Origin = s.Origin AND f.Dest = s.Dest)"),
        n("R15", "removed", "p_dist", "Freight < 0"),
        n("R01", "suffixes", "p_freight", f"regexp_matches(UniqueCarrier, '{fv.CODE_SUFFIX}')"),
        n("R17", "unified", "p_unified"),
        "SELECT 'R02', 'names_before', count(DISTINCT UniqueCarrierName) FROM p_unified",
        "SELECT 'R02', 'names_after', count(DISTINCT UniqueCarrierName) FROM p_named",
        n("R03", "missing", "p_named", "coalesce(AirlineID, 0) = 0"),
        n("R03", "unknown", "p_ided", "AirlineID = 0"),
        n("R04", "carrier_name", "p_texts_b", "CarrierName IS NULL"),
        n("R04", "class", "p_texts_b", "Class IS NULL"),
        n("R04", "origin_city", "p_texts_b", "OriginCityName IS NULL"),
        n("R04", "dest_city", "p_texts_b", "DestCityName IS NULL"),
        n("R04", "aircraft_type_kept_null", "p_texts_b", "AircraftType IS NULL"),
        n("R05", "capped", "p_texts", "DepPerformed > DepScheduled"),
        n("R06", "capped", "p_deps", "Seats > 0 AND Passengers > Seats"),
        n("R08", "air_time", "p_pax", "AirTime < 1 OR AirTime > 9000"),
        n("R08", "ramp_time", "p_pax", "RampTime < 1 OR RampTime > 9000"),
        n("R08", "incoherent", "p_times_w", "AirTime > RampTime"),
        n("R09", "merged", "p_dom", "is_merged_carrier"),
        n("R13", "capped", "p_market", "Freight > Payload"),
        n("R14", "flagged", "p_flag", "Flag_Review_Seats = 1"),
        n("R16", "inactive", "p_active", "IsActive = 0"),
        n("R18", "missing", "p_region_t", "CarrierRegion IS NULL"),
        n("R18", "unknown", "p_region", f"CarrierRegion = '{fv.UNKNOWN_REGION}'"),
        "SELECT 'R10', 'removed_at_end', (SELECT count(*) FROM p_region) - (SELECT count(*) FROM p_final)",
    ]
    for end in ("Origin", "Dest"):
        e = end.lower()
        parts += [
            n("R11", f"{e}_affected", "p_dom", seq.format(e=end)), n("R11", f"{e}_left", "p_seq", seq.format(e=end)),
            n("R12", f"{e}_affected", "p_seq", market.format(e=end)), n("R12", f"{e}_left", "p_market", market.format(e=end)),
        ]
    return _union(*parts)


@cache
def oracles() -> dict[str, str]:
    o: dict[str, str] = {}
    t = "t100"
    rules = all_rules(t, "p")
    cols = ", ".join(FACT_COLUMNS)

    def rule(name: str, columns: str, ctes: Ctes, src: str = "x") -> None:
        o[name] = sql(f"SELECT {columns} FROM {src}", ctes)

    o["load_factor_by_carrier_season"] = sql(
        f"SELECT UniqueCarrier, {label('Estacion')} AS season, count(*) AS segments, "
        "CAST(sum(Passengers) AS BIGINT) AS passengers, "
        "CAST(round(CAST(sum(CAST(CAST(OcupPasajeros AS VARCHAR) AS DECIMAL(9,4))) AS DECIMAL(28,10)) / count(*), 8) AS DECIMAL(9,8)) AS mean_passenger_load "
        "FROM p_clean GROUP BY ALL", rules)

    # scans, staging, sinks
    na = ", ".join(f"'{x}'" for x in fv.NA_TOKENS)
    texts = [c for c in FACT_COLUMNS if c not in inputs._INTS and c not in ("Freight", "Mail", "Payload", "Distance")]
    o["scan_fact_csv"] = sql(
        "SELECT * EXCLUDE (row_id) REPLACE (CASE WHEN row_id % 3 < 2 THEN Mail END AS Mail, "
        + ", ".join(f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {c} END AS {c}" for c in texts)
        + "), row_number() OVER (ORDER BY row_id % 3, row_id, Payload, Passengers) AS orden FROM t100")
    o["scan_refused_lines"] = sql(
        "SELECT 'stg_t100' AS tabla, CASE WHEN row_id % 3 = 0 THEN 'short' ELSE '1999,C1,' END || row_id AS linea, "
        f"'{WRONG_LINE}' AS motivos FROM t100 WHERE row_id % 50 = 7")
    value = lambda c: f"CASE WHEN {c} IN ({na}) THEN NULL ELSE {c} END"
    own = ("AirlineID", "UniqueCarrier", "CarrierName", "StartDate", "EndDate")
    o["scan_lookup_csv"] = sql(_union(
        f"SELECT 'stg_carrier_history' AS tabla, {', '.join(f'{value(c)} AS {c}' for c in own)}, NULL AS Code, NULL AS Description FROM history",
        *[f"SELECT '{fv.LOOKUP_TABLES[file]}', {', '.join('NULL' for _ in own)}, {value('Code')}, {value('Description')} FROM {name}"
          for name, file in _LOOKUP_FILES.items() if name != "history"]))
    o["stage_overwrite"] = sql("SELECT row_id, Year, Month, UniqueCarrier, Origin, Dest, Seats, Freight FROM t100")
    o["scan_table"] = sql("SELECT * FROM history")
    o["scan_projected_filtered"] = sql("SELECT Code, Description FROM airports WHERE Code IS NOT NULL AND Description IS NOT NULL")
    o["scan_history_filtered"] = sql("SELECT AirlineID, UniqueCarrier, EndDate FROM history WHERE trim(EndDate) <> ''")
    staged = {"stg_t100": "t100", "stg_airports": "airports", "stg_unique_carriers": "unique_carriers",
              "stg_carrier_history": "history", "stg_city_market_ids": "markets", "stg_airport_seq_ids": "seq_ids"}
    o["staging_row_counts"] = sql(
        "SELECT coalesce(tabla, 'TOTAL') AS tabla, CAST(sum(filas) AS BIGINT) AS filas FROM ("
        + _union(*[f"SELECT '{k}' AS tabla, count(*) AS filas FROM {v}" for k, v in staged.items()])
        + ") GROUP BY ROLLUP (tabla)")
    o["sink_transformed_audit"] = o["clean_all_rules"] = sql("SELECT * FROM p_clean", rules)
    o["sink_dim"] = o["dim_transportista"] = sql("SELECT * FROM d_carrier", rules, dims("p_clean"))
    o["dim_aeropuerto"] = sql("SELECT * FROM d_aero", rules, dims("p_clean"))
    o["dim_tiempo"] = sql("SELECT * FROM d_tiempo", rules, dims("p_clean"))
    o["sink_fact"] = sql(
        "SELECT t.Anio, count(*) AS filas, CAST(sum(v.Pasajeros) AS BIGINT) AS pasajeros FROM vuelo v "
        "JOIN d_tiempo t ON v.TiempoKey = t.TiempoKey GROUP BY 1", whole_star())
    keyed = {"Tiempo": "d_tiempo", "Transportista": "d_carrier", "Aeropuerto": "d_aero", "Vuelo": "vuelo"}
    o["full_reload"] = sql(_union(*[
        f"SELECT '{k}' AS tabla, count(*) AS filas, CAST(max({k}Key) AS BIGINT) AS max_key FROM {v}" for k, v in keyed.items()
    ]), whole_star())

    # projections, filters, coercions
    o["coerce_numeric"] = sql("SELECT row_id, TRY_CAST(AirlineID AS INT) AS AirlineID FROM history")
    o["coerce_date"] = sql("SELECT row_id, TRY_CAST(StartDate AS DATE) AS StartDate, TRY_CAST(EndDate AS DATE) AS EndDate FROM history")
    required = "CarrierName, Class, OriginCityName, DestCityName, AircraftType"
    rule("blank_to_null", f"row_id, {required}", blanks(t, "x"))
    rule("null_tokens", "row_id, CarrierRegion", region_nulls(t, "x"))
    o["project_rename"] = sql("SELECT row_id, " + ", ".join(f"{c} AS {n}" for n, c in FACT_NAMES.items()) + " FROM x", measures(t, "x"))
    o["filter_length_prefix"] = sql("SELECT row_id, trim(Code) AS Code, substr(trim(Code), 1, 5) AS BaseAirportID FROM seq_ids WHERE length(trim(Code)) = 7")
    o["filter_contains_ci"] = sql("SELECT row_id, Code, coalesce(contains(lower(Description), 'pre-2005'), false) AS is_pre FROM seq_ids")
    o["filter_range_ids"] = sql(
        "SELECT * FROM (SELECT row_id, TRY_CAST(AirlineID AS INT) AS AirlineID, UniqueCarrier FROM history) "
        "WHERE AirlineID IS NULL OR AirlineID = 0 OR AirlineID BETWEEN 10000 AND 90000")

    # rules
    rule("r10_dedupe", f"row_id, {cols}", r10(t, "x"))
    rule("r07_distance", "row_id, Origin, Dest, Distance", r07(t, "x"))
    rule("r15_negative_freight", "row_id, Freight", drop(t, "x", "Freight < 0"))
    rule("r01_suffix", "row_id, UniqueCarrier, Carrier", r01(t, "x"))
    rule("r17_unify_carrier", "row_id, UniqueCarrier, UniqCarrierEntity, Carrier, CarrierName", r17(t, "x"))
    rule("r02_names", "row_id, UniqueCarrierName", r02(t, "x"))
    rule("r03_airline_id", "row_id, AirlineID, UniqueCarrier, UniqueCarrierName", r01(t, "y") + r03("y", "x"))
    rule("r04_required", f"row_id, {required}", CITIES + r04(t, "x"))
    rule("r04_carrier_name", "row_id, CarrierName", blanks(t, "y") + r04a("y", "x"))
    rule("r04_class_mode", "row_id, UniqueCarrier, Class", blanks(t, "y") + r04b("y", "x"))
    cities = "row_id, Origin, OriginCityName, Dest, DestCityName"
    rule("r04_city_lookup", cities, CITIES + blanks(t, "y") + r04_lookup("y", "x"))
    rule("r04_city_mode", cities, blanks(t, "y") + r04_modes("y", "x"))
    rule("r05_cap_departures", "row_id, DepScheduled, DepPerformed", r05(t, "x"))
    rule("r06_cap_passengers", "row_id, Seats, Passengers", r06(t, "x"))
    rule("r08_times", "row_id, AirTime, RampTime", r08(t, "x"))
    rule("r09_dominant_id", "row_id, UniqueCarrier, AirlineID, AirlineID_original, is_merged_carrier",
         r01(t, "y") + r03("y", "z") + r09("z", "x"))
    rule("r11_airport_seq", "row_id, Year, OriginAirportID, OriginAirportSeqID, DestAirportID, DestAirportSeqID", r11(t, "x"))
    rule("r12_city_market", "row_id, OriginAirportID, OriginCityMarketID, DestAirportID, DestCityMarketID", r12(t, "x"))
    rule("r13_cap_freight", "row_id, Freight, Payload", r13(t, "x"))
    rule("r14_seat_flag", "row_id, Seats, Passengers, Flag_Review_Seats", r14(t, "x"))
    rule("r16_inactive", "row_id, AirlineID, UniqueCarrier, IsActive", r01(t, "y") + r16("y", "x"))
    rule("r18_region", "row_id, UniqueCarrier, CarrierRegion", r01(t, "y") + r18("y", "x"))
    o["r10_dedupe_final"] = sql("SELECT * FROM p_final", rules)

    # variants
    rule("v01_suffix_nostrip", "row_id, UniqueCarrier, Carrier", r01(t, "x", False))
    o["v02_names"] = sql(f"SELECT UniqueCarrierName AS spelling, {name_expr('UniqueCarrierName')} AS name FROM (SELECT DISTINCT UniqueCarrierName FROM t100)")
    rule("v03_sentinel_only", "row_id, AirlineID, UniqueCarrier, UniqueCarrierName", unknown_carrier(t, "x"))
    rule("v04_impute", f"row_id, {required}", CITIES + r04(t, "x", False))
    anynull = " OR ".join(f"{c} IS NULL" for c in fv.REQUIRED_COLUMNS)
    o["v04_rule_summary"] = sql(_union(
        f"SELECT 'R01' AS regla, '{fv.RULE_TEXTS['R01']}' AS descripcion, count(*) AS filas_afectadas FROM t100 WHERE regexp_matches(UniqueCarrier, '{fv.CODE_SUFFIX}')",
        f"SELECT 'R02', '{fv.RULE_TEXTS['R02']}', count(*) FROM a4",
        f"SELECT 'R03', '{fv.RULE_TEXTS['R03']}', count(*) FROM a4 WHERE AirlineID = 0",
        f"SELECT 'R04', '{fv.RULE_TEXTS['R04']}', count(*) FROM a4 WHERE {anynull}"), chain_1_4())
    o["v_chain_1_4"] = sql("SELECT * FROM a4", chain_1_4())
    rule("v05_cap", "row_id, DepPerformed", r05(t, "x"))
    rule("v06_cap", "row_id, Passengers", r06(t, "x"))
    rule("v07_distance_nullsafe", "row_id, Origin, Dest, Distance", replace(
        t, "y", Origin="CASE WHEN OriginAirportID % 4 <> 0 THEN Origin END",
        Dest="CASE WHEN DestAirportID % 6 <> 0 THEN Dest END") + r07("y", "x", "null-safe"))
    rule("v_chain_5_7", "row_id, DepPerformed, Passengers, Distance", r05(t, "y") + r06("y", "z") + r07("z", "x", "null-safe"))
    o["v13_freight_filter"] = sql("SELECT row_id, Freight, Payload FROM t100 WHERE Freight < Payload AND Freight >= 0")
    rule("v12_market_lookup", "row_id, OriginCityMarketID, OriginCityName, DestCityMarketID, DestCityName", v12(t, "x"))
    rule("v11_seq_period_lookup", "row_id, Year, OriginAirportSeqID, DestAirportSeqID", SHIFTED + v11("moved", "x"))
    o["v_chain_11_13"] = sql("SELECT * FROM x", SHIFTED + [
        ("kept", "SELECT * FROM moved WHERE Freight < Payload AND Freight >= 0")] + v12("kept", "y") + v11("y", "x"))
    o["v11_audit_extract"] = sql(
        "SELECT row_id, Year, OriginAirportID, OriginAirportSeqID, DestAirportID, DestAirportSeqID FROM x",
        SHIFTED + [("hit", "SELECT * FROM moved WHERE OriginAirportSeqID = OriginAirportID OR DestAirportSeqID = DestAirportID")]
        + v11("hit", "x"))

    # lookups
    steps = history_steps()
    o["lk_unique_carriers"] = sql("SELECT * FROM k3", CARRIERS)
    o["lk_history_suffix"] = sql("SELECT * FROM history WHERE NOT coalesce(contains(UniqueCarrier, '('), false)")
    dated = [("hd", "SELECT row_id, TRY_CAST(StartDate AS DATE) AS s, TRY_CAST(EndDate AS DATE) AS e FROM history")]
    o["lk_history_swap_dates"] = sql("SELECT row_id, CASE WHEN s > e THEN e ELSE s END AS StartDate, CASE WHEN s > e THEN s ELSE e END AS EndDate FROM hd", dated)
    o["lk_history_future"] = sql(f"SELECT row_id, e AS EndDate FROM hd WHERE e IS NULL OR year(e) <= {CURRENT_YEAR}", dated)
    o["lk_history_bad_ids"] = sql("SELECT * FROM h4", steps)
    o["lk_history_primary_id"] = sql("SELECT * FROM h_primary", steps)
    o["lk_history_sole_owner"] = sql("SELECT * FROM h_owner", steps)
    o["lk_history_closed"] = sql("SELECT * FROM h_closed", steps)
    o["lk_history_cross_assign"] = sql("SELECT * FROM h_claims", steps)
    o["lk_carrier_history"] = sql("SELECT * FROM h_final", steps)
    groups = ", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in fv.CARRIER_GROUPS)
    o["lk_group_compact"] = sql(
        f"SELECT g.Code, g.Type, g.Description, u.segments FROM (VALUES {groups}) g(Code, Type, Description) "
        "JOIN (SELECT CarrierGroupNew AS Code, count(*) AS segments FROM t100 GROUP BY 1) u ON g.Code = u.Code")
    o["lk_all"] = sql(_union(
        "SELECT 'unique_carriers' AS tabla, count(*) AS filas FROM k3", "SELECT 'carrier_history', count(*) FROM h_final",
        f"SELECT 'carrier_group_compact', count(*) FROM (VALUES {groups}) g"), CARRIERS, steps)

    # measures
    o["m_passenger_load"] = sql(f"SELECT row_id, {load_expr('Passengers', 'Seats')} AS OcupPasajeros FROM t100")
    o["m_freight_load"] = sql(f"SELECT row_id, {load_expr('Freight', 'Payload')} AS OcupCarga FROM t100")
    rule("m_runway_delay", f"row_id, {DELAY} AS DemoraPista", r08(t, "x"))
    o["m_season"] = sql(f"SELECT row_id, Month, {SEASON} AS Estacion FROM t100")
    o["m_season_label"] = sql(f"SELECT row_id, Month, {label(f'({SEASON})')} AS Estacion FROM t100")

    # star
    order = "Year, Month, row_id, Seats, Passengers, Freight NULLS FIRST"
    o["dense_key"] = sql(f"SELECT {key(order, 'VueloKey', kind='BIGINT')}, Year, Month, row_id, Seats, Passengers, Freight FROM t100")
    o["resolve_keys"] = sql(f"SELECT row_id, Year, Month, UniqueCarrierName, Origin, Dest, {', '.join(FACT_KEYS)} FROM resolved", whole_star())
    o["fact_vuelo"] = sql("SELECT * FROM vuelo", whole_star())
    zero = f"coalesce({dec('Carga', 'DECIMAL(18,2)')}, 0)"
    typed = TYPED_FACT.format(carga="CAST(" + zero + " AS DECIMAL(18,2))")
    o["load_dw"] = sql(f"SELECT {typed} FROM vuelo", whole_star())
    o["dw_contract"] = sql(f"SELECT {TYPED_FACT.format(carga=dec('Carga', 'DECIMAL(18,2)'))} FROM vuelo WHERE Carga IS NOT NULL AND tipoServicio IS NOT NULL", whole_star())

    # audit
    o["audit_rule_counts"] = sql(_rules_audit(), rules)
    o["audit_run_counts"] = sql(_union("SELECT 'iniciales' AS registros, count(*) AS filas FROM t100", "SELECT 'finales', count(*) FROM p_final"), rules)
    def listed(rule: str, metric: str, src: str, where: str = "true", codes: str | None = None) -> str:
        names = f"coalesce(string_agg(DISTINCT {codes}, ',' ORDER BY {codes}), '')" if codes else "CAST(NULL AS VARCHAR)"
        return f"SELECT '{rule}' AS rule, '{metric}' AS metric, count(*) AS value, {names} AS codes FROM {src} WHERE {where}"

    outside = f"AirlineID <> 0 AND (AirlineID < {fv.AIRLINE_ID_MIN} OR AirlineID > {fv.AIRLINE_ID_MAX})"
    ids = f"(SELECT DISTINCT AirlineID FROM (SELECT TRY_CAST(AirlineID AS INT) AS AirlineID FROM h3) WHERE {outside})"
    o["audit_lookup_counts"] = sql(_union(
        listed("carriers", "original", "unique_carriers"), listed("carriers", "coded", "k1"),
        listed("carriers", "suffixed", "k1", "contains(Code, '(')", "Code"),
        "SELECT 'carriers', 'duplicates', (SELECT count(*) FROM k2) - (SELECT count(*) FROM k3), CAST(NULL AS VARCHAR)",
        listed("carriers", "final", "k3"), listed("carriers", "inactive", "k3", "NOT IsActive", "Code"),
        listed("history", "original", "history"), listed("history", "suffixed", "history", "contains(UniqueCarrier, '(')", "UniqueCarrier"),
        listed("history", "inverted", "h1", "StartDate > EndDate", "UniqueCarrier"),
        listed("history", "future", "h2", f"year(EndDate) > {CURRENT_YEAR}", "UniqueCarrier"),
        listed("history", "before_id_check", "h3"),
        "SELECT 'history', 'bad_ids', (SELECT count(*) FROM h3) - (SELECT count(*) FROM h4), "
        f"(SELECT coalesce(string_agg(CAST(AirlineID AS VARCHAR), ',' ORDER BY AirlineID), '') FROM {ids})",
        listed("history", "before_owner_check", "h4"),
        listed("history", "foreign_claims", "(SELECT * FROM h4 WHERE row_id NOT IN (SELECT row_id FROM h_final))", codes="UniqueCarrier"),
        listed("history", "final", "h_final")), CARRIERS, steps)

    def defect(name: str, where: str, src: str = "t100") -> str:
        return f"SELECT '{name}' AS defect, count(*) AS rows FROM {src} WHERE {where}"

    blank = " OR ".join(f"{c} IS NULL OR trim({c}) = ''" for c in fv.REQUIRED_COLUMNS)
    o["profile_defects"] = sql(_union(
        defect("01_code_suffix", f"regexp_matches(UniqueCarrier, '{fv.CODE_SUFFIX}')"),
        "SELECT '02_name_spellings', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT name, count(*) AS n FROM "
        f"(SELECT {name_expr('UniqueCarrierName')} AS name FROM (SELECT DISTINCT UniqueCarrierName FROM t100 WHERE UniqueCarrierName IS NOT NULL)) "
        "GROUP BY 1 HAVING count(*) > 1)",
        defect("03_airline_id_zero", "AirlineID = 0"), defect("04_required_blank", blank),
        defect("05_departures", "DepPerformed > DepScheduled"), defect("06_passengers", "Seats > 0 AND Passengers > Seats"),
        defect("07_distance", "Distance <= 0"),
        defect("08_times", "AirTime < 1 OR AirTime > 9000 OR RampTime < 1 OR RampTime > 9000"),
        "SELECT '09_reused_code', CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT UniqueCarrier, sum(n) - max(n) AS n FROM "
        "(SELECT UniqueCarrier, AirlineID, count(*) AS n FROM t100 WHERE AirlineID > 0 GROUP BY ALL) GROUP BY 1)",
        "SELECT '10_copies', (SELECT count(*) FROM t100) - (SELECT count(*) FROM dd)",
        defect("11_origin_seq", "OriginAirportSeqID = OriginAirportID"),
        defect("12_origin_market", "OriginCityMarketID = OriginAirportID"),
        defect("13_freight", "Freight > Payload"), defect("14_seats_zero", "Seats = 0 AND Passengers > 0"),
        defect("15_negative_freight", "Freight < 0"), defect("16_inactive", "IsActive = 0", "x")),
        r10(t, "dd"), r16(t, "x"))

    # discard rules
    rule("s_drop_dep_excess", "row_id, DepScheduled, DepPerformed", drop(t, "x", "DepPerformed > DepScheduled"))
    rule("s_drop_pax_excess", "row_id, Seats, Passengers, Flag_Review_Seats",
         drop(t, "y", "Seats <> 0 AND Passengers > Seats") + r14("y", "x"))
    rule("s_drop_distance", "row_id, Distance", drop(t, "x", "Distance <= 0"))
    rule("s_drop_airtime", "row_id, AirTime", drop(t, "x", "AirTime <= 0 OR AirTime > 1200"))
    rule("s_drop_freight", "row_id, Freight, Payload", drop(t, "x", "coalesce(Freight > Payload, false) OR coalesce(Freight < 0, false)"))
    bk = ", ".join(BUSINESS_KEY)
    rest = ", ".join(f"{c} NULLS FIRST" for c in FACT_COLUMNS if c not in BUSINESS_KEY)
    o["s_dedupe_business_key"] = sql(f"SELECT row_id, {bk} FROM t100 QUALIFY row_number() OVER (PARTITION BY {bk} ORDER BY row_id, {rest}) = 1")
    rule("s_exclude_unknown_id", "row_id, AirlineID", drop(t, "x", "AirlineID = 0"))

    # later loads
    o["x_unknown_member"] = sql(
        "SELECT row_id, " + ", ".join(f"coalesce({k}, -1) AS {k}" for k in FACT_KEYS) + " FROM res",
        r02(t, "named") + measures("named", "measured")
        + [("early", f"SELECT * FROM measured WHERE Year < {SPLIT_YEAR}")] + dims("early", "e") + resolved("measured", "res", "e"))
    o["x_referential_check"] = sql(
        "SELECT 'TiempoKey' AS columna, v.TiempoKey AS valor, count(*) AS filas FROM vuelo v JOIN d_tiempo t "
        f"ON v.TiempoKey = t.TiempoKey WHERE t.Anio >= {SPLIT_YEAR} GROUP BY ALL", whole_star())
    o["x_orphan_keys"] = sql(
        "SELECT DISTINCT 'TiempoKey' AS columna, CAST(v.TiempoKey AS BIGINT) AS valor FROM vuelo v JOIN d_tiempo t "
        f"ON v.TiempoKey = t.TiempoKey WHERE t.Anio >= {SPLIT_YEAR}", whole_star())
    o["x_reject_log"] = sql(_union(
        "SELECT VueloKey, TiempoKey, 'Carga is null' AS reason FROM vuelo WHERE Carga IS NULL",
        "SELECT VueloKey, TiempoKey, 'tipoServicio is null' FROM vuelo WHERE tipoServicio IS NULL"), whole_star())
    known = "EXISTS (SELECT 1 FROM {t} WHERE {t}.CarrierNombre IS NOT DISTINCT FROM old_c.CarrierNombre)"
    o["x_change_detect"] = sql(_union(
        "SELECT CarrierNombre, 'new' AS state FROM unseen_c", "SELECT CarrierNombre, 'changed' FROM changed_c",
        f"SELECT CarrierNombre, 'absent' FROM old_c WHERE NOT {known.format(t='new_c')}",
        f"SELECT CarrierNombre, 'unchanged' FROM old_c WHERE {known.format(t='new_c')} AND NOT {known.format(t='changed_c')}"), CARRIER_LOADS)
    o["x_hash_changes"] = o["x_change_detect"]
    o["x_upsert"] = sql(f"SELECT * FROM new_c UNION ALL SELECT * FROM old_c WHERE NOT {known.format(t='new_c')}", CARRIER_LOADS)
    o["x_scd1"] = sql(_union(
        "SELECT TransportistaKey, CarrierNombre, CASE WHEN fed THEN new_grupo ELSE CarrierGrupo END AS CarrierGrupo, "
        "CASE WHEN fed THEN new_region ELSE Region END AS Region FROM both_c",
        f"SELECT {key('CarrierNombre', 'TransportistaKey', _TOP)}, * FROM unseen_c"), CARRIER_LOADS)
    o["x_scd2"] = sql("SELECT * FROM versions_c", CARRIER_LOADS)
    o["x_scd3"] = sql(
        "SELECT TransportistaKey, CarrierNombre, Region, CASE WHEN fed THEN new_grupo ELSE CarrierGrupo END AS CarrierGrupo, "
        "CASE WHEN fed AND new_grupo IS DISTINCT FROM CarrierGrupo THEN CarrierGrupo END AS CarrierGrupo_anterior FROM both_c", CARRIER_LOADS)
    o["x_asof_keys"] = sql(
        "SELECT o_orderkey, dia, CAST(coalesce(max(v.TransportistaKey), -1) AS INT) AS TransportistaKey FROM facts f LEFT JOIN versions_c v "
        "ON v.CarrierNombre IS NOT DISTINCT FROM f.CarrierNombre AND v.Fecha_Inicio <= dia AND coalesce(v.Fecha_Fin >= dia, true) "
        "GROUP BY o_orderkey, dia", CARRIER_LOADS,
        [("facts", f"SELECT o_orderkey, {_CARRIER_NAME}, CAST(DATE '{LOAD_DATE}' + CAST(o_orderkey % 60 - 10 AS INT) AS DATE) AS dia "
                   "FROM orders JOIN customer ON o_custkey = c_custkey")])
    totals = lambda moment, tables: _union(*[
        f"SELECT '{moment}' AS momento, '{k}' AS tabla, count(*) AS filas, CAST(max({k}Key) AS BIGINT) AS max_key FROM {v}" for k, v in tables.items()
    ])
    early = {"Tiempo": "e_tiempo", "Transportista": "e_carrier", "Aeropuerto": "e_aero", "Vuelo": "e_vuelo"}
    o["x_atomic_reload"] = sql(
        _union(totals("before", early), totals("broken", early), totals("after", keyed)), whole_star(),
        [("early", f"SELECT * FROM p_clean WHERE Year < {SPLIT_YEAR}")], dims("early", "e"), resolved("early", "e_res", "e"), fact("e_res", "e_vuelo"))
    increment = [
        ("i_tiempo", "SELECT * FROM d_tiempo UNION ALL SELECT " + key("Anio, Mes", "TiempoKey", "(SELECT max(TiempoKey) FROM d_tiempo)")
         + f", * FROM ({tiempo_members('q_clean')}) m WHERE NOT EXISTS (SELECT 1 FROM d_tiempo d WHERE d.Anio = m.Anio AND d.Mes = m.Mes)"),
        ("i_carrier", "SELECT TransportistaKey, CarrierNombre FROM d_carrier UNION ALL SELECT "
         + key("CarrierNombre", "TransportistaKey", "(SELECT max(TransportistaKey) FROM d_carrier)")
         + f", CarrierNombre FROM ({carrier_members('q_clean')}) m WHERE CarrierNombre NOT IN (SELECT CarrierNombre FROM d_carrier)"),
        ("i_aero", "SELECT AeropuertoKey, Nombre FROM d_aero UNION ALL SELECT "
         + key("Nombre", "AeropuertoKey", "(SELECT max(AeropuertoKey) FROM d_aero)")
         + f", Nombre FROM ({aero_members('q_clean')}) m WHERE Nombre NOT IN (SELECT Nombre FROM d_aero)"),
    ]
    # p_clean is the first load, q_clean the second.
    two_loads = lambda *clean: sql(
        f"SELECT {typed}, '1' AS lote FROM v1 UNION ALL SELECT {typed}, '2' AS lote FROM v2", *clean,
        dims("p_clean"), resolved("p_clean", "res1"), fact("res1", "v1"), increment,
        resolved("q_clean", "res2", "i"), fact("res2", "v2", "(SELECT max(VueloKey) FROM v1)"))
    o["x_incremental_load"] = o["x_known_copies"] = o["x_stream_load"] = two_loads(
        [("raw1", f"SELECT * FROM t100 WHERE Year < {SPLIT_YEAR}"), ("raw2", f"SELECT * FROM t100 WHERE Year >= {SPLIT_YEAR}")],
        all_rules("raw1", "p"), all_rules("raw2", "q"))
    middle = "(SELECT max(l_orderkey) * 4 FROM lineitem)"
    o["x_evidence_load"] = two_loads(
        [("raw1", f"SELECT * FROM t100 WHERE row_id < {middle}")], all_rules("raw1", "p"), all_rules("t100", "w"),
        [("q_clean", f"SELECT * FROM w_clean WHERE row_id >= {middle}")])
    o["x_stream_distinct"] = sql("SELECT DISTINCT * EXCLUDE (row_id) FROM t100")
    months = "(Anio = 1995 AND Mes = 3) OR (Anio = 1996 AND Mes = 7)"
    turn = "row_number() OVER (PARTITION BY Anio, Mes ORDER BY row_id, Payload, Passengers)"
    o["x_correct_months"] = sql(
        f"SELECT VueloKey, Anio, Mes, row_id, Seats, Passengers, Payload FROM keyed WHERE NOT ({months}) UNION ALL "
        "SELECT CAST(coalesce(k.VueloKey, (SELECT max(VueloKey) FROM keyed) + row_number() OVER (PARTITION BY k.VueloKey IS NULL "
        "ORDER BY l.Anio, l.Mes, l.turn)) AS BIGINT), l.Anio, l.Mes, l.row_id, l.Seats, l.Passengers, l.Payload "
        "FROM late l LEFT JOIN keyed k ON k.Anio = l.Anio AND k.Mes = l.Mes AND k.turn = l.turn",
        [("monthly", "SELECT Year AS Anio, Month AS Mes, row_id, Seats, Passengers, Payload FROM t100"),
         ("keyed", f"SELECT *, {turn} AS turn, CAST(row_number() OVER (ORDER BY Anio, Mes, row_id, Payload, Passengers) AS BIGINT) AS VueloKey FROM monthly"),
         ("late", f"SELECT *, {turn} AS turn FROM (SELECT * REPLACE (Seats + 1 AS Seats) FROM monthly "
                  f"WHERE ({months}) AND (Anio = 1996 OR row_id % 5 <> 0) UNION ALL SELECT * REPLACE (row_id + 1000000000 AS row_id) FROM monthly "
                  "WHERE Anio = 1996 AND Mes = 7 AND row_id % 3 = 0)")])
    o["x_merged_profile"] = sql(_union(*[
        f"SELECT '{c}' AS columna, count(*) AS filas, count(*) - count({c}) AS nulos, true AS distintos_en_margen FROM t100"
        for c in ("UniqueCarrier", "OriginAirportSeqID", "AirlineID", "Passengers", "Payload", "CarrierRegion")]))
    o["x_load_metadata"] = sql(_union(*[
        f"SELECT '1' AS lote, '{k}' AS tabla, DATE '{LOAD_DATE}' AS fecha_carga, count(*) AS filas, CAST(0 AS BIGINT) AS rechazadas, "
        f"CAST(max({k}Key) AS BIGINT) AS clave_max, 'cargada' AS estado FROM {v}" for k, v in keyed.items()
    ]), whole_star())
    return o
