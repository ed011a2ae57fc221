"""Data-quality checks as rows, and a wrapper that raises."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.operators.profile import profile, profile_columns
from epitally.schema import KEYS, REQUIRED
from epitally.workspace import new_path

# Fewer rows than this only warn.
SMALL_DATA_ROWS = 10


class QualityError(ValueError):
    """Raised by :func:`require` when a check of severity ``error`` fails."""


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Required names the frame lacks, in the order given; runs no job."""
    return [c for c in required if c not in df.columns]


def _check(name: str, severity: str, value: Column, passed: Column) -> Column:
    return F.struct(
        F.lit(name).alias("check"),
        F.lit(severity).alias("severity"),
        value.cast("double").alias("value"),
        F.coalesce(passed, F.lit(False)).alias("passed"),
    )


def validate(
    df: DataFrame,
    required: Sequence[str] = REQUIRED,
    max_null_ratio: Mapping[str, float] | None = None,
    bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
) -> DataFrame:
    """Rows ``(check, severity, value, passed)`` from one scan of ``df``.

    Missing columns are found from the schema. Null counts and ranges are metrics of
    severity ``info`` that always pass, unless ``max_null_ratio`` (by column) or ``bounds``
    (low and high by metric: min_cases, max_cases, avg_population) make them errors.
    """
    present = [c for c in required if c in df.columns]
    row = profile(_with_ranged(df), present)
    return _checked(row, df.columns, required, max_null_ratio, bounds)


def _with_ranged(df: DataFrame) -> DataFrame:
    """``df`` with the columns that ranges are taken of; null where it lacks them."""
    absent = [c for c in ("cases", "population") if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("long") for c in absent})


def _checked(
    row: DataFrame,
    columns: Sequence[str],
    required: Sequence[str],
    max_null_ratio: Mapping[str, float] | None,
    bounds: Mapping[str, tuple[float | None, float | None]] | None,
) -> DataFrame:
    """The checks from the one row of a profile."""
    missing = [c for c in required if c not in columns]
    present = [c for c in required if c not in missing]
    rows = F.col("row_count")

    checks = [
        _check("non_empty", "error", rows, rows > 0),
        _check("enough_rows", "warn", rows, rows >= SMALL_DATA_ROWS),
        *[
            _check(
                f"has_{c}",
                "error",
                F.lit(0 if c in missing else 1),
                F.lit(c not in missing),
            )
            for c in required
        ],
    ]
    ratios = max_null_ratio or {}
    for name in present:
        nulls = F.col(f"{name}_nulls")
        if name in ratios:
            ratio = nulls / F.nullif(rows, F.lit(0))
            passed = F.coalesce(ratio <= F.lit(float(ratios[name])), F.lit(True))
            checks.append(_check(f"{name}_nulls", "error", nulls, passed))
        else:
            checks.append(_check(f"{name}_nulls", "info", nulls, F.lit(True)))
    limits = bounds or {}
    for name in ("min_cases", "max_cases", "avg_population"):
        metric = F.col(name)
        if name in limits:
            low, high = limits[name]
            passed = F.lit(True)
            if low is not None:
                passed = passed & (metric >= low)
            if high is not None:
                passed = passed & (metric <= high)
            checks.append(_check(name, "error", metric, passed))
        else:
            checks.append(_check(name, "info", metric, F.lit(True)))
    return row.select(F.inline(F.array(*checks)))


class ObservedProfile:
    """A profile that a write takes in passing; see :func:`observe_profile`."""

    def __init__(self, columns: Sequence[str], required: Sequence[str]):
        self.columns, self.required = tuple(columns), tuple(required)
        self.observation = Observation()

    def metrics(self) -> dict[str, object]:
        """What the first action on the observed frame found; waits for its end."""
        return self.observation.get

    def checks(
        self,
        spark: SparkSession,
        max_null_ratio: Mapping[str, float] | None = None,
        bounds: Mapping[str, tuple[float | None, float | None]] | None = None,
    ) -> DataFrame:
        """The rows of :func:`validate`, without reading the data."""
        found = self.metrics()
        fields = [
            T.StructField(n, T.DoubleType() if n.startswith("avg_") else T.LongType())
            for n in found
        ]
        row = spark.createDataFrame([tuple(found.values())], T.StructType(fields))
        return _checked(row, self.columns, self.required, max_null_ratio, bounds)


def observe_profile(
    df: DataFrame, required: Sequence[str] = REQUIRED
) -> tuple[DataFrame, ObservedProfile]:
    """``df`` to be written, and the profile that its write will find.

    Null counts and ranges are side results of the tasks that write, so checking a batch needs
    no scan of its own. Let the write be the first action on the frame and put nothing behind
    the observation: a task that is repeated in the last stage counts once, one in an earlier
    stage might count twice.
    """
    seen = ObservedProfile(df.columns, required)
    present = [c for c in required if c in df.columns]
    observed = _with_ranged(df).observe(
        seen.observation, *profile_columns(df.columns, present)
    )
    return observed.select(*df.columns), seen


# Rules of a case row: what must hold where the columns are known. The contract.
def case_rules(columns: Sequence[str]) -> dict[str, Column]:
    """Rules by name, as far as ``columns`` go; a null in a comparison breaks no rule."""
    rules = {f"{c}_missing": F.col(c).isNotNull() for c in KEYS if c in columns}
    counters = ("cases", "deaths", "recovered", "active", "critical", "tests", "population")
    rules |= {f"{c}_negative": F.col(c) >= 0 for c in counters if c in columns}
    for part, whole in (("deaths", "cases"), ("recovered", "cases"), ("critical", "active")):
        if part in columns and whole in columns:
            rules[f"{part}_over_{whole}"] = F.col(part) <= F.col(whole)
    return rules


def flag_rows(
    df: DataFrame, rules: Mapping[str, Column] | None = None, broken: str = "broken"
) -> DataFrame:
    """``df`` with an array of the names of the rules each row breaks, in the rules' order.

    A rule is a condition that good rows meet; null counts as met. Empty array: a good row.
    """
    rules = case_rules(df.columns) if rules is None else rules
    if broken in df.columns:
        raise ValueError(f"Column {broken} exists already")
    names = [F.when(~met, F.lit(name)) for name, met in rules.items()]
    none = F.array().cast("array<string>")
    return df.withColumn(broken, F.array_compact(F.array(*names)) if names else none)


class Quarantined:
    """Good and bad rows of one written table, and how many rows broke each rule."""

    def __init__(self, df: DataFrame, rules: Mapping[str, Column] | None, broken: str):
        spark = df.sparkSession
        flagged = flag_rows(df, rules, broken)
        names = list(case_rules(df.columns) if rules is None else rules)
        sound = F.size(broken) == 0
        seen = Observation()
        counts = [
            F.coalesce(F.sum(F.array_contains(broken, n).cast("long")), F.lit(0)).alias(f"r{i}")
            for i, n in enumerate(names)
        ]
        path = new_path(spark, "quarantine")
        observed = flagged.withColumn("_sound", sound).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(~F.col("_sound")).alias("bad"), *counts
        )
        observed.write.partitionBy("_sound").parquet(path)
        found = seen.get
        self.rows, self.bad_rows = found["rows"], found["bad"]
        self.by_rule = {n: found[f"r{i}"] for i, n in enumerate(names)}
        table = spark.read.schema(observed.schema).parquet(path)
        # A filter on the folder's name: neither frame reads a file of the other.
        self.good = table.where("_sound").select(*df.columns)
        self.bad = table.where("NOT _sound").select(*df.columns, broken)
        self.good._written_path = self.bad._written_path = path


def quarantine(
    df: DataFrame, rules: Mapping[str, Column] | None = None, broken: str = "broken"
) -> Quarantined:
    """Part ``df`` into rows that keep all rules and rows that do not, in one pass.

    Rows are written once, in a folder for the good and one for the bad, which keep a list of
    the rules they broke; numbers by rule come from the same write. ``discard`` of either frame
    deletes the table under both. Rules default to those of case rows.
    """
    return Quarantined(df, rules, broken)


def require(checks: DataFrame) -> list[str]:
    """Raise on failed errors; return the names of failed warnings.

    A check list has a handful of rows, whatever the size of the data.
    """
    failed = checks.where(~F.col("passed")).select("check", "severity", "value").collect()
    errors = [r["check"] for r in failed if r["severity"] == "error"]
    if "non_empty" in errors:
        raise QualityError("Dataset is empty! Cannot proceed.")
    absent = [e.removeprefix("has_") for e in errors if e.startswith("has_")]
    if absent:
        raise QualityError(f"Missing required columns: {', '.join(absent)}")
    if errors:
        raise QualityError(f"Quality checks failed: {', '.join(errors)}")
    return [r["check"] for r in failed]


def key_checks(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The table contract as rows: keys present and unique.

    Equal keys meet as partial counts, so one key with very many copies stays cheap.
    """
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    row = per_key.agg(
        F.coalesce(F.sum(F.when(null_key, F.col("copies"))), F.lit(0)).alias("null_keys"),
        F.coalesce(F.sum(F.when(~null_key, F.col("copies") - 1)), F.lit(0)).alias("repeats"),
    )
    return row.select(
        F.inline(
            F.array(
                _check("keys_not_null", "error", F.col("null_keys"), F.col("null_keys") == 0),
                _check("keys_unique", "error", F.col("repeats"), F.col("repeats") == 0),
            )
        )
    )


def fraction_counts(raw: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with ``<column>_fractions``: scanned numbers that truncation would change."""
    return raw.agg(
        *[
            F.coalesce(F.sum(F.when(F.col(c) != F.floor(c), 1).otherwise(0)), F.lit(0)).alias(
                f"{c}_fractions"
            )
            for c in columns
        ]
    )
