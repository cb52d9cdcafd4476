"""Fixed values.

Word lists, tables, patterns and limits that decide the results. They are
facts about the domain, not logic, and are stated here in plain text.
"""

from __future__ import annotations

# -- scanning ---------------------------------------------------------------

# Texts a CSV scan reads as null.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Every character that counts as white space when text is stripped.
WHITESPACE = (
    " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0 "
    "           "
    "    　"
)

FACT_FILE = "t100_carriers_2023.csv"
FACT_TABLE = "stg_t100"
CLEAN_TABLE = "stg_t100_transformed"

# Lookup file -> staging table.
LOOKUP_TABLES = {
    "l_unique_carriers.csv": "stg_unique_carriers",
    "l_carrier_history.csv": "stg_carrier_history",
    "l_carrier_group.csv": "stg_carrier_group",
    "l_carrier_group_new.csv": "stg_carrier_group_new",
    "l_strport.csv": "stg_airports",
    "l_strport_id.csv": "stg_airport_ids",
    "l_strport_seq_id.csv": "stg_airport_seq_ids",
    "l_country_code.csv": "stg_country_codes",
    "l_world_area_codes.csv": "stg_world_area_codes",
    "l_city_market_id.csv": "stg_city_market_ids",
    "l_service_class.csv": "stg_service_class",
    "l_strcraft_type.csv": "stg_aircraft_type",
    "l_strcraft_group.csv": "stg_aircraft_group",
    "l_strcraft_config.csv": "stg_aircraft_config",
    "l_distance_group_500.csv": "stg_distance_group",
    "l_months.csv": "stg_months",
    "l_quarters.csv": "stg_quarters",
    "l_region.csv": "stg_regions",
    "l_strline_id.csv": "stg_airline_ids",
    "l_unique_carrier_entities.csv": "stg_unique_carrier_entities",
}

# -- carrier codes and names ------------------------------------------------

CODE_SUFFIX = r"\(\d+\)$"

# One corporate suffix at the end of a carrier name, any case.
CORPORATE_SUFFIX = (
    r"(?i)(,?\s*INC\.?|,?\s*CO\.?|,?\s*LTD\.?|,?\s*LLC\.?|,?\s*CORP\.?"
    r"|,?\s*S\.A\.?|,?\s*LIMITED)\s*$"
)

ABBREVIATIONS = {
    "AMER.": "AMERICAN",
    "AMER": "AMERICAN",
    "AIRLS.": "AIR LINES",
    "AIRLS": "AIR LINES",
    "INTL.": "INTERNATIONAL",
    "INTL": "INTERNATIONAL",
}

CANONICAL_NAMES = {
    "AMERICANAIRLINES": "AMERICAN AIRLINES",
    "DELTA AIRLINES": "DELTA AIR LINES",
    "UNITED AIR LINES": "UNITED AIRLINES",
    "SOUTHWEST AIR": "SOUTHWEST AIRLINES",
    "ALASKA AIR LINES": "ALASKA AIRLINES",
    "ALASKA AIR": "ALASKA AIRLINES",
    "JETBLUE": "JETBLUE AIRWAYS",
    "JET BLUE AIRWAYS": "JETBLUE AIRWAYS",
    "JET BLUE": "JETBLUE AIRWAYS",
    "FRONTIER AIR LINES": "FRONTIER AIRLINES",
    "FRONTIER AIR": "FRONTIER AIRLINES",
    "ALLEGIANT AIRLINES": "ALLEGIANT AIR",
    "SPIRIT AIRLINES": "SPIRIT AIR LINES",
    "SKYWEST AIR LINES": "SKYWEST AIRLINES",
    "SKY WEST AIRLINES": "SKYWEST AIRLINES",
    "SKY WEST AIR LINES": "SKYWEST AIRLINES",
    "REPUBLIC AIR LINES": "REPUBLIC AIRLINES",
    "REPUBLIC AIR": "REPUBLIC AIRLINES",
    "ENDEAVOR AIRLINES": "ENDEAVOR AIR",
    "ENDEAVOR AIR LINES": "ENDEAVOR AIR",
    "ENVOY AIRLINES": "ENVOY AIR",
    "AMERICAN EAGLE (ENVOY)": "ENVOY AIR",
    "MESA AIRLINES": "MESA AIR",
    "COMMUTAIR": "COMMUT AIR",
}

UNKNOWN_CARRIER_CODE = "UNK"
UNKNOWN_CARRIER_NAME = "DESCONOCIDO"
UNKNOWN_REGION = "Desconocido"
REGION_NULL_TOKENS = ("NULL", "null", "None", "", " ")

INACTIVE_CARRIERS = ("CO", "US", "FL", "VX", "CP", "PA", "EA", "KS")
INACTIVE_BEFORE = "2023-01-01"

# -- physical limits --------------------------------------------------------

MINUTES_MIN, MINUTES_MAX = 1, 9000
STRICT_AIR_MINUTES_MAX = 1200
AIRLINE_ID_MIN, AIRLINE_ID_MAX = 10000, 90000

# -- airport periods --------------------------------------------------------

SEQ_CODE_LENGTH, AIRPORT_ID_LENGTH = 7, 5
OLD_PERIOD_TEXT, OLD_PERIOD_BEFORE_YEAR = "pre-2005", 2005

# -- seasons ----------------------------------------------------------------

SEASON_MONTHS = {1: (12, 1, 2), 2: (3, 4, 5), 3: (6, 7, 8), 4: (9, 10, 11)}
SEASON_LABELS = {1: "Invierno", 2: "Primavera", 3: "Verano", 4: "Otoño"}

# -- carrier groups: code, type, description (a code may have two types) -----

CARRIER_GROUPS = (
    ("A", "Major", "Large Network Carriers (>40B ASMs)"),
    ("B", "National", "Medium Network Carriers (10-40B ASMs)"),
    ("C", "Major", "Low-Cost Carriers"),
    ("C", "National", "Low-Cost Carriers"),
    ("D", "National", "Ultra Low-Cost Carriers"),
    ("E", "Regional", "Regional/Feeder Carriers"),
    ("F", "Other", "Other/Charter"),
    ("G", "Unknown", "Unknown"),
)

# -- report texts of the first four rules -----------------------------------

RULE_TEXTS = {
    "R01": "Sufijo numérico en código IATA eliminado",
    "R02": "Normalización UniqueCarrierName",
    "R03": "AirlineID 0/NULL → Desconocido",
    "R04": "Campos con NULL: imputados o mantenidos",
}
REQUIRED_COLUMNS = ("CarrierName", "AircraftType", "Class", "OriginCityName", "DestCityName")
