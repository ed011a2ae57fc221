"""The data contract: column names, types, keys and default column lists."""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: names, order and types every other module relies on. -----------------

# One flattened row: a country at one moment.
CASES = T.StructType(
    [
        T.StructField("updated", T.LongType()),
        T.StructField("country", T.StringType()),
        T.StructField("iso2", T.StringType()),
        T.StructField("iso3", T.StringType()),
        T.StructField("continent", T.StringType()),
        T.StructField("population", T.LongType()),
        T.StructField("cases", T.LongType()),
        T.StructField("deaths", T.LongType()),
        T.StructField("recovered", T.LongType()),
        T.StructField("active", T.LongType()),
        T.StructField("critical", T.LongType()),
        T.StructField("tests", T.LongType()),
        T.StructField("casesPerOneMillion", T.LongType()),
        T.StructField("deathsPerOneMillion", T.LongType()),
    ]
)

# The day counters a feed carries on top of CASES, and the full record with them.
DAY_COUNTERS = ("todayCases", "todayDeaths")
FULL_COLUMNS = (
    "updated",
    "country",
    "iso2",
    "iso3",
    "continent",
    "population",
    "cases",
    "todayCases",
    "deaths",
    "todayDeaths",
    "recovered",
    "active",
    "critical",
    "tests",
    "casesPerOneMillion",
    "deathsPerOneMillion",
)

# The narrow record of the text-column parse.
NARROW = T.StructType(
    [
        T.StructField("country", T.StringType()),
        T.StructField("cases", T.LongType()),
        T.StructField("deaths", T.LongType()),
        T.StructField("recovered", T.LongType()),
        T.StructField("population", T.LongType()),
        T.StructField("tests", T.LongType()),
        T.StructField("casesPerOneMillion", T.LongType()),
        T.StructField("deathsPerOneMillion", T.LongType()),
    ]
)

# Primary key of the case tables; both columns are NOT NULL and the pair is unique.
KEYS = ("country", "updated")

# Columns the quality checks insist on.
REQUIRED = (
    "country",
    "cases",
    "deaths",
    "active",
    "critical",
    "tests",
    "population",
    "casesPerOneMillion",
    "deathsPerOneMillion",
)

# Columns of the top-k report, in display order.
REPORT_COLUMNS = (
    "country",
    "cases",
    "active",
    "critical",
    "population",
    "deaths",
    "tests",
    "casesPerOneMillion",
    "deathsPerOneMillion",
)

# Model inputs (vector order matters) and target.
FEATURES = (
    "cases",
    "active",
    "critical",
    "tests",
    "population",
    "casesPerOneMillion",
    "deathsPerOneMillion",
)
STRICT_FEATURES = (
    "cases",
    "active",
    "critical",
    "population",
    "tests",
    "casesPerOneMillion",
    "deathsPerOneMillion",
)
TARGET = "deaths"

# Lengths of the VARCHAR columns in a relational target.
VARCHAR_LENGTHS = {"country": 100, "iso2": 5, "iso3": 5, "continent": 50}

# --- Derived from the above. ------------------------------------------------------------

COLUMNS = tuple(CASES.fieldNames())
STRINGS = tuple(f.name for f in CASES if isinstance(f.dataType, T.StringType))
COUNTERS = tuple(f.name for f in CASES if isinstance(f.dataType, T.LongType))


# Landed numbers. A BIGINT declaration turns 1.5 into null and marks every row of its document
# corrupt; a double is exact only up to 2**53. This type takes every BIGINT exactly and ten
# decimals; `flatten` cuts at the contract boundary.
LANDED_NUMBER = T.DecimalType(38, 10)

# The column of a scan that holds the text of a document that could not be read.
CORRUPT = "_corrupt_record"


def _json_field(name: str) -> T.StructField:
    return T.StructField(name, T.StringType() if name in STRINGS else LANDED_NUMBER)


# One element of a landed JSON document.
RAW = T.StructType(
    [
        _json_field("updated"),
        _json_field("country"),
        T.StructField("countryInfo", T.StructType([_json_field("iso2"), _json_field("iso3")])),
        *(_json_field(c) for c in FULL_COLUMNS[4:]),
    ]
)
