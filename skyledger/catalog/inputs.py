"""Airline inputs derived from the given star tables.

The given tables hold no flights, so raw segments and lookups are computed from
them, with defects placed by key arithmetic. One SQL text serves Spark and the
oracle; only the copying of rows is spelled differently. ``row_id`` is the row
order: the order key and line number of the source row.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType

from skyledger.schemas import FACT_RAW

_FACT_BASE = """
  SELECT l.l_orderkey AS ok, l.l_linenumber AS ln, l.l_partkey AS pk,
         CAST(l.l_quantity AS INT) AS qty, l.l_extendedprice AS ep, l.l_discount AS disc,
         CAST(year(l.l_shipdate) AS INT) AS yr, CAST(month(l.l_shipdate) AS INT) AS mo,
         CAST(l.l_suppkey % 20 AS INT) AS car, s.s_nationkey AS onk, c.c_nationkey AS dnk
  FROM {lineitem} l
  JOIN {orders} o   ON l.l_orderkey = o.o_orderkey
  JOIN {supplier} s ON l.l_suppkey  = s.s_suppkey
  JOIN {customer} c ON o.o_custkey  = c.c_custkey"""

# Texts that several columns share.
_FACT_TEXTS = """
  SELECT *, CAST(car AS STRING) AS cs, CAST(onk AS STRING) AS os, CAST(dnk AS STRING) AS ds,
    CAST(onk % 5 AS STRING) AS oc, CAST(dnk % 5 AS STRING) AS dc, abs(onk - dnk) AS gap,
    concat('C', CAST(car AS STRING), CASE WHEN ok % 97 = 0 THEN '(1)' ELSE '' END) AS code
  FROM base"""

_FACT = """
  SELECT ok * 8 + ln AS row_id,
    yr AS Year, CAST((mo + 2 - (mo + 2) % 3) / 3 AS INT) AS Quarter, mo AS Month,
    code AS UniqueCarrier,
    CAST(CASE WHEN ok % 83 = 0 THEN NULL WHEN ok % 89 = 0 OR car = 19 THEN 0
         WHEN ok % 61 = 0 THEN 20000 + (car + 1) % 20 ELSE 20000 + car END AS INT) AS AirlineID,
    concat(CASE pk % 4 WHEN 1 THEN ' CARRIER ' WHEN 2 THEN 'carrier ' ELSE 'Carrier ' END, cs,
           CASE pk % 4 WHEN 0 THEN ' Air Lines Inc.' WHEN 1 THEN ' AIR LINES, INC.' WHEN 2 THEN ' Airls. Co.' ELSE ' Airls LLC' END) AS UniqueCarrierName,
    concat('E', cs) AS UniqCarrierEntity,
    CASE WHEN ok % 19 = 0 THEN 'NULL' WHEN ok % 23 = 0 THEN NULL WHEN car = 18 THEN '' ELSE concat('R', CAST(car % 4 AS STRING)) END AS CarrierRegion,
    code AS Carrier,
    CASE WHEN ok % 79 = 0 THEN NULL ELSE concat('C', cs) END AS CarrierName,
    CASE car % 3 WHEN 0 THEN 'Major' WHEN 1 THEN 'National' ELSE 'Regional' END AS CarrierGroup,
    CASE car % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B' WHEN 2 THEN 'C' WHEN 3 THEN 'E' ELSE NULL END AS CarrierGroupNew,
    concat('N', os) AS Origin, 10000 + onk AS OriginAirportID,
    CASE WHEN ok % 53 = 0 THEN 10000 + onk ELSE (10000 + onk) * 100 + 1 + ok % 2 END AS OriginAirportSeqID,
    CASE WHEN ok % 47 = 0 THEN 10000 + onk ELSE 30000 + onk END AS OriginCityMarketID,
    CASE WHEN ok % 103 = 0 THEN '' WHEN ok % 3 = 0 THEN concat('CITY ', os) ELSE concat('City ', os) END AS OriginCityName,
    concat('P', oc) AS OriginCountry, concat('Country ', oc) AS OriginCountryName, onk % 5 AS OriginWAC,
    concat('N', ds) AS Dest, 10000 + dnk AS DestAirportID,
    CASE WHEN ok % 107 = 0 THEN 10000 + dnk ELSE (10000 + dnk) * 100 + 1 + ok % 2 END AS DestAirportSeqID,
    CASE WHEN ok % 109 = 0 THEN 10000 + dnk ELSE 30000 + dnk END AS DestCityMarketID,
    CASE WHEN ok % 113 = 0 THEN NULL ELSE concat('City ', ds) END AS DestCityName,
    concat('P', dc) AS DestCountry, concat('Country ', dc) AS DestCountryName, dnk % 5 AS DestWAC,
    'JET' AS AircraftGroup, CASE WHEN ok % 127 = 0 THEN NULL ELSE concat('T', CAST(pk % 7 AS STRING)) END AS AircraftType, 'TWIN' AS AircraftConfig,
    CASE WHEN ok % 43 = 0 THEN NULL WHEN ok % 41 = 0 THEN ' ' WHEN ok % 7 = 0 THEN 'G' WHEN car % 2 = 0 THEN 'F' ELSE 'L' END AS Class,
    qty AS DepScheduled, qty + ln - 5 AS DepPerformed,
    CASE WHEN ok % 37 = 0 THEN 0 ELSE qty * 150 END AS Seats, CAST(qty * (100 + pk % 60) AS INT) AS Passengers,
    CASE WHEN ok % 29 = 0 THEN CAST(-1 AS DOUBLE) WHEN ok % 71 = 0 THEN NULL ELSE ep * disc * 12 END AS Freight,
    CAST(0 AS DOUBLE) AS Mail, ep AS Payload,
    CASE WHEN ok % 31 = 0 THEN NULL WHEN ok % 59 = 0 THEN CAST(-5 AS DOUBLE) ELSE CAST(250 * gap AS DOUBLE) END AS Distance,
    CAST(CASE WHEN gap = 0 THEN NULL ELSE gap + 1 END AS INT) AS DistanceGroup,
    CAST(CASE WHEN ok % 67 = 0 THEN 9999 ELSE 60 + pk % 300 END AS INT) AS RampTime,
    CAST(CASE WHEN ok % 73 = 0 THEN 0 ELSE 40 + pk % 300 + ln * 3 END AS INT) AS AirTime
  FROM texts"""

# Airport code -> description. Some airports are missing, some have several
# entries, some an empty one.
_AIRPORTS = """
  SELECT s_suppkey AS row_id,
    CASE WHEN s_suppkey % 11 = 0 THEN NULL ELSE concat('N', CAST(s_nationkey AS STRING)) END AS Code,
    CASE WHEN s_suppkey % 10 = 0 THEN NULL
         ELSE concat(' Town ', CAST(s_nationkey AS STRING), CASE WHEN s_suppkey % 2 = 0 THEN 'x' ELSE 'y' END,
                     ', ST : Field ', s_name) END AS Description
  FROM {supplier} WHERE s_nationkey % 3 <> 0"""

# Carrier codes: spaces, lower case, suffixes, blanks, several entries per code.
_UNIQUE_CARRIERS = """
  SELECT c_custkey AS row_id,
    CASE WHEN c_custkey % 23 = 0 THEN NULL WHEN c_custkey % 19 = 0 THEN '  '
         WHEN c_custkey % 7 = 0 THEN concat(' ', base)
         WHEN c_custkey % 11 = 0 THEN lower(base)
         WHEN c_custkey % 13 = 0 THEN concat(base, ' ')
         WHEN c_custkey % 17 = 0 THEN concat(base, '(1)') ELSE base END AS Code,
    CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 31 = 0 THEN NULL
         ELSE concat(c_name, CASE WHEN c_custkey % 3 = 0 THEN ' ' ELSE '' END) END AS Description
  FROM (SELECT c_custkey, c_name,
          CASE WHEN c_custkey % 29 = 0 THEN
                 CASE c_custkey % 8 WHEN 0 THEN 'CO' WHEN 1 THEN 'US' WHEN 2 THEN 'FL' WHEN 3 THEN 'VX'
                                    WHEN 4 THEN 'CP' WHEN 5 THEN 'PA' WHEN 6 THEN 'EA' ELSE 'KS' END
               ELSE concat('K', CAST((c_custkey - c_custkey % 3) AS STRING)) END AS base
        FROM {customer}) coded"""

# Carrier history, all text: foreign, zero, impossible and unreadable ids;
# blank, inverted, far-future and unreadable end dates.
_HISTORY = """
  SELECT c_custkey AS row_id,
    CASE WHEN c_custkey % 37 = 0 THEN 'x' WHEN c_custkey % 17 = 0 THEN '0' WHEN c_custkey % 19 = 0 THEN '99999'
         WHEN c_custkey % 7 = 0 THEN CAST(20000 + (carrier + 1) % 60000 AS STRING)
         ELSE CAST(20000 + carrier % 60000 AS STRING) END AS AirlineID,
    concat('C', CAST(carrier AS STRING), CASE WHEN c_custkey % 31 = 0 THEN '(1)' ELSE '' END) AS UniqueCarrier,
    c_name AS CarrierName,
    CASE WHEN c_custkey % 43 = 0 THEN NULL
         ELSE concat(CAST(1990 + c_custkey % 9 AS STRING), '-0', CAST(1 + c_custkey % 7 AS STRING), '-01') END AS StartDate,
    CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 41 = 0 THEN '  '
         WHEN c_custkey % 11 = 0 THEN '1985-06-30' WHEN c_custkey % 13 = 0 THEN '2099-12-31'
         WHEN c_custkey % 29 = 0 THEN 'unknown'
         ELSE concat(CAST(2000 + c_custkey % 26 AS STRING), '-1', CAST(c_custkey % 3 AS STRING), '-15') END AS EndDate
  FROM (SELECT c_custkey, c_name,
          CAST(CASE WHEN c_custkey < 100 THEN c_custkey % 20 ELSE 100 + c_custkey - c_custkey % 4 END AS BIGINT) AS carrier
        FROM {customer}) numbered"""

# City markets by id; airport ids appear among them by mistake.
_MARKETS = """
  SELECT s_suppkey AS row_id,
    CASE WHEN s_suppkey % 13 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN CAST(30000 + s_nationkey AS STRING)
         ELSE CAST(10000 + s_nationkey AS STRING) END AS Code,
    CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE concat('Market ', CAST(s_nationkey AS STRING), ' ', s_name) END AS Description
  FROM {supplier} WHERE s_nationkey % 4 <> 0"""

# Airport versions: seven-digit codes for two periods, and unusable codes.
_SEQ_IDS = """
  SELECT s_suppkey AS row_id,
    CASE WHEN s_suppkey % 17 = 0 THEN CAST(10000 + s_nationkey AS STRING)
         WHEN s_suppkey % 2 = 0 THEN concat(CAST(10000 + s_nationkey AS STRING), '0', CAST(s_suppkey % 5 AS STRING))
         ELSE concat(' ', CAST(10000 + s_nationkey AS STRING), '1', CAST(s_suppkey % 5 AS STRING)) END AS Code,
    CASE WHEN s_suppkey % 19 = 0 THEN NULL WHEN s_suppkey % 2 = 0 THEN 'Airport (2005-)' WHEN s_suppkey % 3 = 0 THEN 'Airport (Pre-2005)'
         ELSE 'Airport (pre-2005)' END AS Description
  FROM {supplier} WHERE s_nationkey % 6 <> 0"""

_LOOKUPS = {
    "airports": _AIRPORTS,
    "unique_carriers": _UNIQUE_CARRIERS,
    "history": _HISTORY,
    "markets": _MARKETS,
    "seq_ids": _SEQ_IDS,
}

# The second copy of a row is an exact duplicate.
_COPIES_SPARK = " LATERAL VIEW explode(sequence(1, CASE WHEN ok % 101 = 0 THEN 2 ELSE 1 END)) c AS copy"
_COPIES_ORACLE = ", (VALUES (1), (2)) c(copy) WHERE copy = 1 OR ok % 101 = 0"


def _spread(df: DataFrame) -> DataFrame:
    """Rows over all cores if the files have fewer splits than there are cores.

    A small file is often one row group, which only one task can read. Large
    inputs have more splits than cores and are left as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def _run(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = ("lineitem", "orders", "supplier", "customer")
    used = {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names if "{%s}" % n in text}
    if "lineitem" in used:
        used["lineitem"] = _spread(used["lineitem"])
    return spark.sql(text, **used)


def given(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Source rows per file of a query that writes its input first.
_PIECE_ROWS = 250_000


def pieces(source: DataFrame, least: int) -> int:
    """How many files rows made from ``source`` go to, so that no task's share grows with the input; rows are counted from footers."""
    return max(least, -(-source.count() // _PIECE_ROWS))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw segments: 43 columns and ``row_id``."""
    text = f"WITH base AS ({_FACT_BASE}), texts AS ({_FACT_TEXTS}), t100 AS ({_FACT}{_COPIES_SPARK}) SELECT * FROM t100"
    fact = _run(spark, sf_dir, text)
    return fact.select("row_id", *[fact[c].cast(kind) if kind != fact.schema[c].dataType else c for c, kind in _TYPES.items()])


def lookup(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return _run(spark, sf_dir, _LOOKUPS[name])


_TYPES = {field.name: field.dataType for field in FACT_RAW}
_INTS = [name for name, kind in _TYPES.items() if isinstance(kind, IntegerType)]


@cache
def oracle_ctes() -> dict[str, str]:
    """The same inputs as named SQL subqueries for the oracle."""
    plain = {t: t for t in ("lineitem", "orders", "supplier", "customer")}
    ints = ", ".join(f"CAST({c} AS INT) AS {c}" for c in _INTS)
    return {
        "base": _FACT_BASE.format(**plain),
        "texts": _FACT_TEXTS,
        "t100": f"SELECT * REPLACE ({ints}) FROM ({_FACT}{_COPIES_ORACLE})",
        **{name: text.format(**plain) for name, text in _LOOKUPS.items()},
    }
