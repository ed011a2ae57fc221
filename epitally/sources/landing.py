"""Landed JSON snapshots to flat case rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.functions.expressions import whole
from epitally.schema import (
    CASES,
    COLUMNS,
    CORRUPT,
    DAY_COUNTERS,
    FULL_COLUMNS,
    LANDED_NUMBER,
    NARROW,
    RAW,
    STRINGS,
)
from epitally.workspace import written

LAYOUTS = ("documents", "lines")
SCHEMAS = ("declared", "infer")


def scan_json(
    spark: SparkSession,
    path: str | list[str],
    layout: str = "documents",
    schema: str = "declared",
    mode: str = "FAILFAST",
    corrupt: bool = False,
) -> DataFrame:
    """One row per element of the JSON arrays under ``path``.

    ``documents``: one array (or object) per file, read in parallel over files; a file is
    never split. ``lines``: one array or object per line, which also splits large files and
    is the layout to land big feeds in.

    ``declared`` reads the contract without a pass over the data. ``infer`` scans the files
    once more to find the types, which then depend on the data. A malformed document fails
    the scan unless ``mode`` says otherwise (PERMISSIVE or DROPMALFORMED). ``corrupt`` adds a
    column with the text of what a PERMISSIVE scan could not read.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"Unsupported layout={layout} ({'|'.join(LAYOUTS)})")
    if schema not in SCHEMAS:
        raise ValueError(f"Unsupported schema={schema} ({'|'.join(SCHEMAS)})")
    reader = spark.read.option("multiLine", layout == "documents").option("mode", mode)
    if schema == "declared":
        extra = [T.StructField(CORRUPT, T.StringType())] if corrupt else []
        reader = reader.schema(T.StructType([*RAW.fields, *extra]))
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    return reader.json(path)


def flatten(raw: DataFrame, day_counters: bool = False) -> DataFrame:
    """Project scanned elements to the contract columns and types.

    A contract column that the scan does not have is an error that names it.
    """
    names = FULL_COLUMNS if day_counters else COLUMNS
    nested = {"iso2": "countryInfo.iso2", "iso3": "countryInfo.iso3"}
    info = raw.schema["countryInfo"].dataType if "countryInfo" in raw.columns else None
    inner = info.fieldNames() if isinstance(info, T.StructType) else []
    absent = [n for n in names if n not in (inner if n in nested else raw.columns)]
    if absent:
        raise ValueError(f"Scanned JSON lacks contract fields: {', '.join(absent)}")
    return raw.select(
        *[
            F.col(nested.get(n, n)).cast("string").alias(n)
            if n in STRINGS
            else whole(n).alias(n)
            for n in names
        ]
    )


def read_cases(spark: SparkSession, path: str | list[str], **options) -> DataFrame:
    """Scan and flatten in one call; options are those of :func:`scan_json`."""
    return flatten(scan_json(spark, path, **options))


def read_with_rejects(
    spark: SparkSession, path: str | list[str], layout: str = "documents"
) -> tuple[DataFrame, DataFrame]:
    """The rows that can be read, and ``(document)``: the texts that cannot, each one counted.

    A document is rejected whole, a line in the layout of lines and a file in that of
    documents; it does not fail the scan. A document that occurs and fails twice is two rejects.
    Empty documents and nulls hold no rows and are no rejects.

    Texts are parsed once, each a row of one written table, so that both frames, and a count of
    either, agree; ``discard`` of either frame deletes that table.
    """
    if layout not in LAYOUTS:
        raise ValueError(f"Unsupported layout={layout} ({'|'.join(LAYOUTS)})")
    texts = spark.read.text(path, wholetext=layout == "documents").select(
        F.col("value").alias("document")
    )
    body = F.trim(F.translate("document", "\r\n\t\ufeff", "   "))
    # Inside an object the parser reports what it could not read; a lone object is an array of one.
    listed = F.when(body.startswith("["), body).otherwise(F.concat(F.lit("["), body, F.lit("]")))
    wrapped = F.concat(F.lit('{"items":'), listed, F.lit("}"))
    inner = T.StructType([T.StructField("items", T.ArrayType(RAW)), T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = texts.where(body != "").select("document", F.from_json(wrapped, inner, options).alias("read"))
    bad = F.col(f"read.{CORRUPT}").isNotNull() | F.col("read.items").isNull()
    raw = written(
        read.select(
            F.when(bad, F.col("document")).alias("document"),
            # Fields before the fault may have been read; no row of a rejected document is kept.
            F.when(~bad, F.filter("read.items", lambda x: x.isNotNull())).alias("items"),
        ),
        "scanned",
    )
    rejects = raw.where(F.col("document").isNotNull()).select("document")
    good = flatten(raw.where(F.col("document").isNull()).select(F.inline("items")))
    good._written_path = rejects._written_path = raw._written_path
    return good, rejects


def parse_documents(documents: DataFrame, body: str = "body") -> DataFrame:
    """Narrow records from a text column holding one JSON array per row.

    Rows parse independently, so a table of documents is as parallel as its files.
    """
    element = T.StructType(
        [
            T.StructField(f.name, f.dataType if f.name in STRINGS else LANDED_NUMBER)
            for f in NARROW
        ]
    )
    records = F.from_json(F.col(body), T.ArrayType(element), {"mode": "FAILFAST"})
    return documents.select(F.inline(records)).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in NARROW]
    )


def to_raw(cases: DataFrame) -> DataFrame:
    """The nested shape of a landed element, from flat rows; inverse of :func:`flatten`."""
    day = [c for c in DAY_COUNTERS if c in cases.columns]
    rest = [f.name for f in CASES if f.name not in ("updated", "country", "iso2", "iso3")]
    return cases.select(
        "updated", "country", F.struct("iso2", "iso3").alias("countryInfo"), *rest, *day
    )
