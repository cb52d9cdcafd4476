"""Table shapes: the raw fact, the lookups and the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

_INT, _DOUBLE, _STR = T.IntegerType(), T.DoubleType(), T.StringType()

ROW_ID = "row_id"


def _fields(kind: T.DataType, *names: str) -> list[T.StructField]:
    return [T.StructField(n, kind, True) for n in names]


def _endpoint(prefix: str) -> list[T.StructField]:
    return [
        *_fields(_STR, prefix),
        *_fields(_INT, f"{prefix}AirportID", f"{prefix}AirportSeqID", f"{prefix}CityMarketID"),
        *_fields(_STR, f"{prefix}CityName", f"{prefix}Country", f"{prefix}CountryName"),
        *_fields(_INT, f"{prefix}WAC"),
    ]


#: Raw airline segment traffic: 43 columns, one row per month, carrier, route,
#: aircraft and class.
FACT_RAW = T.StructType(
    [
        *_fields(_INT, "Year", "Quarter", "Month"),
        *_fields(_STR, "UniqueCarrier"),
        *_fields(_INT, "AirlineID"),
        *_fields(_STR, "UniqueCarrierName", "UniqCarrierEntity", "CarrierRegion", "Carrier",
                 "CarrierName", "CarrierGroup", "CarrierGroupNew"),
        *_endpoint("Origin"),
        *_endpoint("Dest"),
        *_fields(_STR, "AircraftGroup", "AircraftType", "AircraftConfig", "Class"),
        *_fields(_INT, "DepScheduled", "DepPerformed", "Seats", "Passengers"),
        *_fields(_DOUBLE, "Freight", "Mail", "Payload", "Distance"),
        *_fields(_INT, "DistanceGroup", "RampTime", "AirTime"),
    ]
)
FACT_COLUMNS = FACT_RAW.fieldNames()

LOOKUP = T.StructType(_fields(_STR, "Code", "Description"))
CARRIER_HISTORY = T.StructType(
    _fields(_STR, "AirlineID", "UniqueCarrier", "CarrierName", "StartDate", "EndDate")
)


def all_text(schema: T.StructType) -> T.StructType:
    """The same columns, every one a string."""
    return T.StructType(_fields(_STR, *schema.fieldNames()))


#: Warehouse columns: (name, Spark type, required).
STAR = {
    "Tiempo": [
        ("TiempoKey", "int", True), ("Mes", "int", True), ("Estacion", "string", True),
        ("Anio", "int", True),
    ],
    "Transportista": [
        ("TransportistaKey", "int", True), ("CarrierNombre", "string", True),
        ("CarrierGrupo", "string", False), ("Region", "string", False),
        ("Fecha_Inicio", "date", True), ("Fecha_Fin", "date", False),
        ("Fila_Activa", "boolean", True),
    ],
    "Aeropuerto": [
        ("AeropuertoKey", "int", True), ("Nombre", "string", True), ("Ciudad", "string", False),
        ("Pais", "string", False), ("Fecha_Inicio", "date", True), ("Fecha_Fin", "date", False),
        ("Fila_Activa", "boolean", True),
    ],
    "Vuelo": [
        ("VueloKey", "bigint", True), ("TiempoKey", "int", True),
        ("TransportistaKey", "int", True), ("AeropuertoOrigenKey", "int", True),
        ("AeropuertoDestinoKey", "int", True), ("tipoServicio", "string", True),
        ("VProgramados", "int", True), ("VRealizados", "int", True), ("Asientos", "int", True),
        ("Pasajeros", "int", True), ("OcupPasajeros", "decimal(5,4)", False),
        ("Capacidad", "decimal(18,2)", True), ("Carga", "decimal(18,2)", True),
        ("OcupCarga", "decimal(5,4)", False), ("Distancia", "decimal(10,2)", True),
        ("DemoraPista", "int", True),
    ],
}

#: Longest text per warehouse column.
STAR_LENGTHS = {
    "Estacion": 20, "CarrierNombre": 150, "CarrierGrupo": 50, "Region": 50, "Nombre": 150,
    "Ciudad": 100, "Pais": 100, "tipoServicio": 50,
}
