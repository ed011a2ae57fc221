"""Queries over the given tables, one or more for each operator.

Every callable takes ``(spark, base)``, the folder of the Parquet tables, and reads whole
tables. Queries that exercise a sink write to the shared folder and return what they read
back.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.functions.expressions import per_million
from epitally.operators import evaluate as ev
from epitally.operators import features as ft
from epitally.operators import profile as pf
from epitally.operators import quality as q
from epitally.operators import summary as sm
from epitally.operators import upsert as up
from epitally.operators.forest import (
    ForestParams,
    GridParams,
    fit_forest,
    fit_forest_on_vectors,
    grid_results,
    predict,
    with_fold,
)
from epitally.operators.split import hash_split, random_split, stratified_split
from epitally.plans import bucketed, totals
from epitally.plans.history import merge_into_history
from epitally.plans.job import JobConfig, run_job
from epitally.plans.learning import (
    LearningConfig,
    LearningResult,
    dealt_rows,
    run_learning,
    train_and_test,
)
from epitally.schema import (
    CASES,
    COLUMNS,
    FEATURES,
    KEYS,
    REPORT_COLUMNS,
    STRICT_FEATURES,
)
from epitally.sinks import lake, models, runlog
from epitally.sources import landing, ledger
from epitally.sources import tables as tb
from epitally.workspace import ROWS_PER_TASK, exists, new_path, written

Query = Callable[[SparkSession, str], DataFrame]

# 2024-06-01 12:00:00 UTC, the moment stamped on exported batches.
BATCH_MICROS = 1_717_243_200_000_000

# Documents hold the customers of one key range, so at most this many rows: one page in a
# line of text, and a whole file.
PAGE_ROWS = 1000
FILE_ROWS = 20_000

HASHED = LearningConfig(split="hash", keys=KEYS)
# The default grid. A search of many small fits is bound by the driver, so it works on few
# partitions and many settings at once.
SEARCHED = LearningConfig(
    split="hash",
    keys=KEYS,
    cross_validation=True,
    train_partitions=4,
    grid=GridParams(parallelism=8),
)
# Fixed value: the largest rmse of an acceptable model.
RMSE_BOUND = 10_000.0


# --- Summaries ---------------------------------------------------------------------------


def global_summary(spark: SparkSession, base: str) -> DataFrame:
    return sm.global_summary(tb.snapshot(spark, base))


def continent_summary(spark: SparkSession, base: str) -> DataFrame:
    return sm.continent_summary(tb.snapshot(spark, base))


def wide_summary(spark: SparkSession, base: str) -> DataFrame:
    totals = sm.global_summary(tb.snapshot(spark, base), wide=True)
    return totals.select(
        *[F.col(c).cast("string").alias(c) for c in totals.columns if c.startswith("global")]
    )


def top_countries(spark: SparkSession, base: str) -> DataFrame:
    return sm.top_countries(tb.snapshot(spark, base))


def epidemic_view(spark: SparkSession, base: str) -> DataFrame:
    sm.register_view(tb.snapshot(spark, base))
    return spark.sql(f"SELECT {', '.join(REPORT_COLUMNS)} FROM {sm.VIEW}")


def per_million_rates(spark: SparkSession, base: str) -> DataFrame:
    rows = tb.order_history(spark, base)
    return rows.select(
        *KEYS,
        per_million("recovered", "population").alias("recovered_per_million"),
        per_million("tests", "population").alias("tests_per_million"),
    )


def trend(spark: SparkSession, base: str) -> DataFrame:
    return sm.trend(written(tb.event_history(spark, base), "series"))


# --- Profile and checks ------------------------------------------------------------------


def row_column_count(spark: SparkSession, base: str) -> DataFrame:
    return pf.size(tb.snapshot(spark, base))


def null_profile(spark: SparkSession, base: str) -> DataFrame:
    return pf.null_counts(tb.snapshot(spark, base))


def range_stats(spark: SparkSession, base: str) -> DataFrame:
    stats = pf.ranges(tb.snapshot(spark, base))
    return stats.withColumn("avg_population", F.round("avg_population", 6))


def profile_one_pass(spark: SparkSession, base: str) -> DataFrame:
    found = pf.profile(tb.snapshot(spark, base))
    return found.withColumn("avg_population", F.round("avg_population", 6))


def quality_checks(spark: SparkSession, base: str) -> DataFrame:
    checks = q.validate(
        tb.snapshot(spark, base),
        max_null_ratio={"active": 0.1, "cases": 0.5},
        bounds={"min_cases": (0, None), "avg_population": (None, 1e9)},
    )
    return checks.withColumn("value", F.round("value", 6))


def observed_checks(spark: SparkSession, base: str) -> DataFrame:
    """The checks of :func:`quality_checks`, counted by the write of the batch."""
    rows, seen = q.observe_profile(tb.snapshot(spark, base))
    written(rows, "cases")
    checks = seen.checks(
        spark,
        max_null_ratio={"active": 0.1, "cases": 0.5},
        bounds={"min_cases": (0, None), "avg_population": (None, 1e9)},
    )
    return checks.withColumn("value", F.round("value", 6))


def _rules(columns: list[str]) -> dict[str, Column]:
    """The rules of case rows, one on a missing counter and two that many rows break."""
    return {
        **q.case_rules(columns),
        "active_missing": F.col("active").isNotNull(),
        "few_tests": F.col("tests") >= 10,
        "many_recovered": F.col("recovered") * 4 <= F.col("cases"),
    }


def quarantine_rows(spark: SparkSession, base: str) -> DataFrame:
    """Every row, and the rules a quarantined one broke."""
    rows = tb.snapshot(spark, base)
    parts = q.quarantine(rows, _rules(rows.columns))
    bad = parts.bad.select(*COLUMNS, F.concat_ws(",", "broken").alias("broken"))
    return parts.good.select(*COLUMNS, F.lit("").alias("broken")).unionByName(bad)


def quarantine_counts(spark: SparkSession, base: str) -> DataFrame:
    """How many rows broke each rule, as the write of the two parts counted them."""
    rows = tb.snapshot(spark, base)
    parts = q.quarantine(rows, _rules(rows.columns))
    found = {"(all)": parts.rows, "(bad)": parts.bad_rows, **parts.by_rule}
    return spark.createDataFrame(list(found.items()), "rule string, row_count long")


def missing_column_checks(spark: SparkSession, base: str) -> DataFrame:
    checks = q.validate(tb.snapshot(spark, base).drop("tests", "critical"))
    return checks.withColumn("value", F.round("value", 6))


def key_checks(spark: SparkSession, base: str) -> DataFrame:
    return q.key_checks(tb.shipment_feed(spark, base))


# --- Landed JSON -------------------------------------------------------------------------


def _pages(cases: DataFrame, rows: int = PAGE_ROWS) -> DataFrame:
    """Documents of at most ``rows`` elements: ``population`` is unique per row."""
    raw = landing.to_raw(cases)
    element = F.struct(*raw.columns)
    page = F.floor(F.col("population") / rows).alias("page")
    return raw.groupBy(page).agg(F.to_json(F.collect_list(element)).alias("body"))


def landing_lines(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    landing.to_raw(tb.snapshot(spark, base)).write.json(path)
    return landing.read_cases(spark, path, layout="lines")


def landing_array_lines(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    _pages(tb.snapshot(spark, base)).select("body").write.text(path)
    return landing.read_cases(spark, path, layout="lines")


def landing_documents(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    pages = _pages(tb.snapshot(spark, base), FILE_ROWS)
    pages.write.partitionBy("page").text(path)
    return landing.read_cases(spark, path, layout="documents")


def landing_inferred(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    landing.to_raw(tb.snapshot(spark, base)).write.json(path)
    return landing.read_cases(spark, path, layout="lines", schema="infer")


def landing_day_counters(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    rows = (
        tb.snapshot(spark, base)
        .withColumn("todayCases", F.col("cases") - F.col("recovered"))
        .withColumn("todayDeaths", F.col("deaths"))
    )
    landing.to_raw(rows).write.json(path)
    return landing.flatten(landing.scan_json(spark, path, layout="lines"), day_counters=True)


def landing_fractions(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "landing")
    halves = F.when(F.col("population") % 3 == 0, F.lit(0.5)).otherwise(F.lit(0.0))
    rows = tb.snapshot(spark, base).withColumn("cases", F.col("cases") + halves)
    landing.to_raw(rows).write.json(path)
    raw = landing.scan_json(spark, path, layout="lines")
    counts = q.fraction_counts(raw, ["cases", "deaths"])
    total = landing.flatten(raw).agg(F.sum("cases")).first()[0]
    return counts.withColumn("cases_total", F.lit(total).cast("long"))


def landing_exact(spark: SparkSession, base: str) -> DataFrame:
    """Counters beyond 2**53 land as they were written."""
    path = new_path(spark, "landing")
    huge = F.lit(2**53 + 1) + F.col("population")
    landing.to_raw(tb.snapshot(spark, base).withColumn("cases", huge)).write.json(path)
    return landing.read_cases(spark, path, layout="lines").select("country", "population", "cases")


def landing_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rows read and lines rejected from a feed in which every seventh line is cut off."""
    path = new_path(spark, "landing")
    raw = landing.to_raw(tb.snapshot(spark, base))
    line = F.to_json(F.struct(*raw.columns))
    broken = F.concat(F.lit('{"country": "'), F.col("country"), F.lit('", "cases": '))
    raw.select(F.when(F.col("population") % 7 == 0, broken).otherwise(line)).write.text(path)
    good, bad = landing.read_with_rejects(spark, path, "lines")
    read = good.select(F.lit("read").alias("kind"), F.col("country").alias("value"))
    return read.unionByName(bad.select(F.lit("rejected").alias("kind"), F.col("document").alias("value")))


def landing_repeated_rejects(spark: SparkSession, base: str) -> DataFrame:
    """Rejected lines with their number, from a feed that repeats broken lines."""
    path = new_path(spark, "landing")
    rows = tb.snapshot(spark, base)
    line = F.to_json(F.struct(*landing.to_raw(rows).columns))
    broken = F.concat(F.lit('[{"continent": "'), F.col("continent"), F.lit('"}, {"cases": '))
    feed = landing.to_raw(rows.where("population % 4 <> 0")).select(line.alias("value"))
    feed.union(rows.where("population % 4 = 0").select(broken)).write.text(path)
    good, bad = landing.read_with_rejects(spark, path, "lines")
    counted = bad.groupBy("document").agg(F.count(F.lit(1)).alias("row_count"))
    read = good.agg(F.lit("(read)").alias("document"), F.count(F.lit(1)).alias("row_count"))
    return counted.unionByName(read)


def landing_new_files(spark: SparkSession, base: str) -> DataFrame:
    """Rows of two batches over one folder, each with the batch that read it."""
    folder, entries = new_path(spark, "landing"), new_path(spark, "ledger")
    rows = written(tb.snapshot(spark, base), "cases")
    parts = []
    for batch in range(3):
        # The third time nothing has landed.
        if batch < 2:
            landed = landing.to_raw(rows.where(F.col("population") % 2 == batch))
            landed.write.mode("append").json(folder)
        found = ledger.new_cases(spark, folder, entries, str(batch), "*.json", layout="lines")
        parts.append(written(found.cases.withColumn("batch", F.lit(batch)), "batch"))
        found.commit()
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def document_parse(spark: SparkSession, base: str) -> DataFrame:
    return landing.parse_documents(_pages(tb.snapshot(spark, base)))


# --- Lake --------------------------------------------------------------------------------


def _main(spark: SparkSession, base: str, fmt: str, **options) -> DataFrame:
    path = new_path(spark, f"main-{fmt}")
    lake.write_main(tb.snapshot(spark, base), path, fmt, **options)
    return lake.read_main(spark, path, CASES, fmt)


def lake_main_parquet(spark: SparkSession, base: str) -> DataFrame:
    return _main(spark, base, "parquet")


def lake_main_orc(spark: SparkSession, base: str) -> DataFrame:
    return _main(spark, base, "orc")


def lake_main_json(spark: SparkSession, base: str) -> DataFrame:
    return _main(spark, base, "json")


def lake_partitioned(spark: SparkSession, base: str) -> DataFrame:
    return _main(spark, base, "parquet", partition_by=("continent",))


def lake_save_modes(spark: SparkSession, base: str) -> DataFrame:
    rows = written(tb.snapshot(spark, base), "cases")
    path = new_path(spark, "modes")
    copies = []
    for mode in ("append", "append", "overwrite", "append"):
        lake.write_main(rows, path, mode=mode)
        copies.append(lake.read_main(spark, path, CASES).count())
    last = lake.read_main(spark, path, CASES)
    return last.agg(
        F.lit(copies[0]).cast("long").alias("after_first"),
        F.lit(copies[1]).cast("long").alias("after_append"),
        F.lit(copies[2]).cast("long").alias("after_overwrite"),
        F.count(F.lit(1)).alias("at_the_end"),
        F.sum("cases").alias("cases_at_the_end"),
    )


def lake_overwrite_partitions(spark: SparkSession, base: str) -> DataFrame:
    """A partitioned copy of which a second write replaces two continents."""
    path = new_path(spark, "partitions")
    rows = written(tb.snapshot(spark, base), "cases")
    lake.write_main(rows, path, partition_by=("continent",))
    again = rows.where(F.col("continent").isin("ASIA", "EUROPE") & (F.col("population") % 2 == 0))
    again = again.withColumn("cases", -F.col("cases"))
    lake.write_main(again, path, mode="overwrite_partitions", partition_by=("continent",))
    return lake.read_main(spark, path, CASES)


def lake_key_lookup(spark: SparkSession, base: str) -> DataFrame:
    """One country's rows, and a span of time, of copies laid out for such searches."""
    by_time, by_name = new_path(spark, "ordered"), new_path(spark, "bloom")
    rows = written(tb.order_history(spark, base), "history")
    lake.write_main(rows, by_time, order_by=("updated", "country"))
    lake.write_main(rows, by_name, bloom=("country",))
    named = lake.read_main(spark, by_name, CASES).where("country = 'C100'")
    spanned = lake.read_main(spark, by_time, CASES).where("updated < 725846400000")
    return named.withColumn("search", F.lit("country")).unionByName(
        spanned.withColumn("search", F.lit("time"))
    )


def lake_analyst_csv(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "analyst-csv")
    lake.write_analyst(tb.snapshot(spark, base), path, "csv")
    return lake.read_analyst(spark, path, CASES, "csv")


def lake_analyst_parquet(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "analyst-parquet")
    lake.write_analyst(tb.snapshot(spark, base), path, "parquet")
    return lake.read_analyst(spark, path, CASES, "parquet")


def lake_dual_write(spark: SparkSession, base: str) -> DataFrame:
    config = lake.LakeConfig(new_path(spark, "lake"), partition_by=("continent",))
    rows = written(tb.snapshot(spark, base), "cases")
    stamped = lake.export(rows, config, "customers", BATCH_MICROS)
    main = lake.read_main(spark, config.main_path("customers"), stamped.schema)
    analyst = lake.read_analyst(spark, config.analyst_path("customers"), stamped.schema)
    both = main.withColumn("copy", F.lit("main")).union(
        analyst.withColumn("copy", F.lit("analyst"))
    )
    return both.select("copy", *COLUMNS, F.unix_millis("ingest_ts").alias("ingest_millis"))


def audit_columns(spark: SparkSession, base: str) -> DataFrame:
    stamped = lake.stamp(tb.snapshot(spark, base), BATCH_MICROS)
    return stamped.select(
        *KEYS,
        F.unix_millis("ingest_ts").alias("ingest_millis"),
        F.col("ingest_date").cast("string").alias("ingest_date"),
    )


# --- Upsert ------------------------------------------------------------------------------


def _merged(spark: SparkSession, base: str, rule: up.MergeRule) -> DataFrame:
    tasks = tb.shipment_tasks(spark, base)
    return up.merge(
        tb.order_history(spark, base), tb.shipment_batch(spark, base), rule, partitions=tasks
    )


def upsert_mysql_rule(spark: SparkSession, base: str) -> DataFrame:
    return _merged(spark, base, up.MYSQL)


def upsert_postgres_rule(spark: SparkSession, base: str) -> DataFrame:
    return _merged(spark, base, up.POSTGRES)


def upsert_all_columns(spark: SparkSession, base: str) -> DataFrame:
    return _merged(spark, base, up.ALL_COLUMNS)


def upsert_day_counters(spark: SparkSession, base: str) -> DataFrame:
    target = (
        tb.order_history(spark, base)
        .withColumn("today_cases", F.col("tests"))
        .withColumn("today_deaths", F.col("critical"))
    )
    staging = (
        tb.shipment_batch(spark, base)
        .withColumn("today_cases", F.col("cases") - F.col("deaths"))
        .withColumn("today_deaths", F.col("deaths"))
    )
    tasks = tb.shipment_tasks(spark, base)
    return up.merge(target, staging, up.WITH_DAY_COUNTERS, partitions=tasks)


def upsert_landed_day_counters(spark: SparkSession, base: str) -> DataFrame:
    """Day counters from a landed feed to the merge."""
    path = new_path(spark, "landing")
    rows = (
        tb.shipment_batch(spark, base)
        .withColumn("todayCases", F.col("cases") - F.col("deaths"))
        .withColumn("todayDeaths", F.col("deaths"))
    )
    # Compressed: names of fields are most of the text. A compressed file is read by one task.
    feed = landing.to_raw(rows).write.option("maxRecordsPerFile", ROWS_PER_TASK)
    feed.json(path, compression="gzip")
    landed = landing.flatten(landing.scan_json(spark, path, layout="lines"), day_counters=True)
    target = (
        tb.order_history(spark, base)
        .withColumn("today_cases", F.col("tests"))
        .withColumn("today_deaths", F.col("critical"))
    )
    tasks = tb.shipment_tasks(spark, base)
    return up.merge(
        target, up.rename_day_counters(landed), up.WITH_DAY_COUNTERS, partitions=tasks
    )


def upsert_latest(spark: SparkSession, base: str) -> DataFrame:
    return up.merge(
        tb.order_history(spark, base),
        tb.shipment_feed(spark, base),
        up.MYSQL,
        on_duplicate="latest",
        order_by=["sequence"],
        partitions=tb.shipment_tasks(spark, base),
    )


def upsert_written_batch(spark: SparkSession, base: str) -> DataFrame:
    batch = written(tb.shipment_batch(spark, base), "batch")
    tasks = tb.shipment_tasks(spark, base)
    return up.merge_batch(tb.order_history(spark, base), batch, partitions=tasks)


def history_merge(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "history")
    merge_into_history(tb.order_history(spark, base), path, up.ALL_COLUMNS)
    return merge_into_history(tb.shipment_batch(spark, base), path).select(*COLUMNS)


def bucketed_merge(spark: SparkSession, base: str) -> DataFrame:
    path = new_path(spark, "bucketed")
    buckets = tb.shipment_tasks(spark, base)
    bucketed.write_bucketed(tb.order_history(spark, base), path, buckets)
    return bucketed.merge_into_bucketed(tb.shipment_batch(spark, base), path)


def kept_totals(spark: SparkSession, base: str) -> DataFrame:
    """Totals of each continent from sums kept by day over two merges, and days read for them."""
    path, state = new_path(spark, "history"), new_path(spark, "totals")
    merge_into_history(tb.order_history(spark, base), path, up.ALL_COLUMNS)
    first = totals.refresh(spark, path, state)
    batch = tb.shipment_batch(spark, base).where("updated >= 883612800000")
    merge_into_history(batch, path)
    second = totals.refresh(spark, path, state)
    third = totals.refresh(spark, path, state)
    return totals.kept_summary(spark, state, "continent").select(
        "*",
        F.lit(len(first)).cast("long").alias("days_first"),
        F.lit(len(second)).cast("long").alias("days_second"),
        F.lit(len(third)).cast("long").alias("days_third"),
    )


# --- Features and split ------------------------------------------------------------------


def _spread(prepared: DataFrame, names: tuple[str, ...]) -> DataFrame:
    values = vector_to_array("features")
    return prepared.select(
        "country", "label", *[values[i].alias(f"f{i}_{n}") for i, n in enumerate(names)]
    )


def assemble_features(spark: SparkSession, base: str) -> DataFrame:
    prepared = ft.prepare(tb.snapshot(spark, base), keep=["country"])
    return _spread(prepared, FEATURES)


def assemble_strict(spark: SparkSession, base: str) -> DataFrame:
    complete = tb.snapshot(spark, base).dropna(subset=list(STRICT_FEATURES))
    return _spread(ft.prepare_strict(complete, keep=["country"]), STRICT_FEATURES)


def usable_rows(spark: SparkSession, base: str) -> DataFrame:
    return ft.usable_rows(tb.snapshot(spark, base), keep=KEYS)


def dropped_rows(spark: SparkSession, base: str) -> DataFrame:
    return ft.dropped_rows(tb.snapshot(spark, base))


def hash_split_rows(spark: SparkSession, base: str) -> DataFrame:
    train, test = hash_split(tb.snapshot(spark, base).select(*KEYS), KEYS)
    return train.withColumn("part", F.lit("train")).union(
        test.withColumn("part", F.lit("test"))
    )


def stratified_split_rows(spark: SparkSession, base: str) -> DataFrame:
    rows = written(tb.order_history(spark, base).select(*KEYS, "iso2", "iso3"), "rows")
    train, test = stratified_split(rows, ("iso2", "iso3"), KEYS)
    return train.withColumn("part", F.lit("train")).union(
        test.withColumn("part", F.lit("test"))
    )


def random_split_parts(spark: SparkSession, base: str) -> DataFrame:
    rows = written(tb.event_history(spark, base).select(*KEYS), "rows")
    train, test = random_split(rows)
    again, _ = random_split(rows)
    sides = (
        train.withColumn("side", F.lit(1))
        .unionByName(test.withColumn("side", F.lit(2)))
        .unionByName(again.withColumn("side", F.lit(4)))
    )
    per_row = sides.groupBy(*KEYS).agg(
        F.sum(F.when(F.col("side") < 4, 1).otherwise(0)).alias("copies"), F.sum("side").alias("sides")
    )
    share = F.sum(F.when(F.col("sides").isin(1, 5), 1).otherwise(0)) / F.sum("copies")
    return per_row.agg(
        F.sum("copies").alias("row_count"),
        F.sum(F.when(F.col("copies") > 1, 1).otherwise(0)).alias("repeated"),
        # Five hundredths, and what chance allows a small table.
        (F.abs(share - 0.8) <= 0.05 + 1 / F.sqrt(F.sum("copies"))).alias("share_as_asked"),
        # On both draws of the training part, or on none.
        F.bool_and(F.col("sides").isin(2, 5)).alias("same_on_repeat"),
    )


# --- Evaluation of a rule-made prediction ------------------------------------------------


def _predicted(spark: SparkSession, base: str) -> DataFrame:
    rows = tb.snapshot(spark, base).where(F.col("deaths").isNotNull())
    guess = F.col("cases") * F.lit(0.35) - F.lit(9.0)
    return rows.select("country", F.col("deaths").alias("label"), guess.alias("prediction"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(c, 6).alias(c) for c in df.columns])


def regression_metrics(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(ev.regression_metrics(_predicted(spark, base)))


def target_stats(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(ev.target_stats(_predicted(spark, base)))


def evaluation(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(ev.evaluate(_predicted(spark, base)))


def error_stats(spark: SparkSession, base: str) -> DataFrame:
    return ev.error_stats(_predicted(spark, base))


def label_prediction_corr(spark: SparkSession, base: str) -> DataFrame:
    return _rounded(ev.correlation(_predicted(spark, base)))


def prediction_sample(spark: SparkSession, base: str) -> DataFrame:
    return ev.sample_predictions(_predicted(spark, base), order_by="country")


def negative_predictions(spark: SparkSession, base: str) -> DataFrame:
    return ev.negative_predictions(_predicted(spark, base))


def missing_features(spark: SparkSession, base: str) -> DataFrame:
    """Names of the model's columns that a frame lacks, one row each."""
    rows = tb.snapshot(spark, base).drop("tests", "critical", "deaths")
    lacking = [c for c in (*FEATURES, "deaths") if c not in rows.columns]
    try:
        ft.check_columns(rows)
        said = ""
    except ValueError as error:
        said = str(error)
    named = F.lit(said).contains(F.col("missing"))
    return rows.select(F.explode(F.array(*[F.lit(c) for c in lacking])).alias("missing")).groupBy(
        "missing"
    ).agg(F.count(F.lit(1)).alias("row_count")).withColumn("named", named)


def acceptance(spark: SparkSession, base: str) -> DataFrame:
    """Whether the rule-made prediction passes at two thresholds of its rmse."""
    found = ev.regression_metrics(_predicted(spark, base)).first().asDict()
    totals = _predicted(spark, base).agg(F.count(F.lit(1)).alias("row_count"))
    return totals.select(
        "row_count",
        F.lit(ev.accept_model(found, 1000.0)).alias("at_1000"),
        F.lit(ev.accept_model(found, 0.1)).alias("at_a_tenth"),
    )


def refused_formats(spark: SparkSession, base: str) -> DataFrame:
    """Each continent's name as a lake format, with the refusal it gets."""
    rows = tb.snapshot(spark, base)
    out = []
    for r in rows.select("continent").distinct().orderBy("continent").collect():
        for kind, write in (("main", lake.write_main), ("analyst", lake.write_analyst)):
            try:
                write(rows, new_path(spark, "refused"), r["continent"])
                out.append((r["continent"], kind, False))
            except ValueError as error:
                out.append((r["continent"], kind, r["continent"] in str(error)))
    return spark.createDataFrame(out, "format string, copy string, refused boolean")


# --- Learning ----------------------------------------------------------------------------


def _quality(predictions: DataFrame) -> dict[str, object]:
    """Facts about predictions that a wrong model would turn: it must follow the labels."""
    found = ev.evaluate(predictions).first().asDict()
    corr, spread = predictions.agg(
        F.corr(F.col("label").cast("double"), "prediction"), F.stddev_pop("label")
    ).first()
    return {
        "correlated": corr is not None and corr > 0.5,
        "beats_the_mean": found["rmse"] is not None and found["rmse"] < spread,
        "rmse_bounded": found["rmse"] is not None and found["rmse"] < RMSE_BOUND,
    }


def _forest_flags(forest, params, seeded: bool = True) -> dict[str, bool]:
    """Whether the fitted stage has the settings asked for."""
    want = {
        "maxDepth": params.max_depth,
        "maxBins": params.max_bins,
        "minInstancesPerNode": params.min_instances_per_node,
        "featureSubsetStrategy": params.feature_subset_strategy,
    }
    if seeded:
        want["seed"] = params.seed
    same = all(forest.getOrDefault(k) == v for k, v in want.items())
    return {"settings_as_asked": same and forest.getNumTrees == params.num_trees}


def _flagged(rows: DataFrame, flags: dict[str, object]) -> DataFrame:
    return rows.withColumns({k: F.lit(bool(v)) for k, v in flags.items()})


def forest_predictions(spark: SparkSession, base: str) -> DataFrame:
    """Each test row, and whether the predictions follow the labels."""
    result = run_learning(tb.snapshot(spark, base), HASHED)
    rows = result.predictions.select(*KEYS, "label", (F.col("prediction") >= 0).alias("not_negative"))
    return _flagged(rows, _quality(result.predictions))


def forest_evaluation(spark: SparkSession, base: str) -> DataFrame:
    """The one-pass metrics against the library's own evaluator."""
    result = run_learning(tb.snapshot(spark, base), HASHED)
    found = result.metrics.first().asDict()
    flags = {}
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(metricName=name, labelCol="label").evaluate(result.predictions)
        flags[f"{name}_agrees"] = abs(found[name] - theirs) <= 1e-9 * max(1.0, abs(theirs))
    rows = result.predictions.agg(F.count(F.lit(1)).alias("tested"), F.sum("label").alias("labels"))
    return _flagged(rows, {**flags, **_quality(result.predictions)})


def forest_check(spark: SparkSession, base: str) -> DataFrame:
    """Each test row, and that the default forest has its settings and can be fitted again."""
    rows = written(tb.snapshot(spark, base), "cases")
    result = run_learning(rows, HASHED)
    again = run_learning(rows.repartition(3), HASHED)
    second = again.predictions.select(*KEYS, F.col("prediction").alias("second"))
    forest = result.model.stages[-1]
    flags = {**_forest_flags(forest, HASHED.forest), **_quality(result.predictions)}
    compared = result.predictions.join(second, list(KEYS)).select(
        *KEYS,
        "label",
        F.size(vector_to_array("features")).alias("dimensions"),
        (F.abs(F.col("prediction") - F.col("second")) <= 1e-9).alias("repeatable"),
    )
    return _flagged(compared, flags)


def minimal_forest_check(spark: SparkSession, base: str) -> DataFrame:
    prepared = ft.prepare(
        written(tb.snapshot(spark, base), "cases").dropna(subset=["deaths"]), keep=KEYS
    )
    train, test = hash_split(prepared, KEYS)
    vectors = dealt_rows(train.select(*KEYS, "features", "label"), HASHED)
    model = fit_forest_on_vectors(vectors)
    found = model.transform(test).select(*KEYS, "label", "prediction")
    flags = {**_forest_flags(model, HASHED.forest, seeded=False), **_quality(found)}
    return _flagged(found.drop("prediction"), flags)


_searches: dict[tuple[str, str], LearningResult] = {}


def _searched(spark: SparkSession, base: str) -> LearningResult:
    """The search of the default grid, once for each application and folder of tables."""
    name = (spark.sparkContext.applicationId, base)
    if name not in _searches:
        _searches[name] = run_learning(tb.snapshot(spark, base), SEARCHED)
    return _searches[name]


def _refitted(spark: SparkSession, result: LearningResult) -> bool:
    forest, best = result.model.stages[-1], grid_results(result.search, spark).where("is_best").first()
    return (forest.getNumTrees, forest.getOrDefault("maxDepth"), forest.getOrDefault(
        "minInstancesPerNode")) == (best["num_trees"], best["max_depth"], best["min_instances"])


def cross_validation_grid(spark: SparkSession, base: str) -> DataFrame:
    """Every setting of the default grid, that exactly the one with least rmse is best, and that
    its forest, fitted on all training rows, follows the labels."""
    result = _searched(spark, base)
    grid = grid_results(result.search, spark)
    least, bests = grid.agg(
        F.min("avg_metric"), F.sum(F.col("is_best").cast("int"))
    ).first()
    right = (F.col("avg_metric") == least) == F.col("is_best")
    rows = grid.select("num_trees", "max_depth", "min_instances", right.alias("best_is_least"))
    flags = {"one_best": bests == 1, "best_setting_refitted": _refitted(spark, result)}
    return _flagged(rows, {**flags, **_quality(result.predictions)})


def cross_validation_check(spark: SparkSession, base: str) -> DataFrame:
    """Each test row, and that the best model of the default grid is one and follows the labels."""
    result = _searched(spark, base)
    rows = result.predictions.select(*KEYS, "label")
    flags = {"best_setting_refitted": _refitted(spark, result)}
    return _flagged(rows, {**flags, **_quality(result.predictions)})


def cross_validation_folds(spark: SparkSession, base: str) -> DataFrame:
    """Each usable row with the fold a search tests it in."""
    rows = ft.usable_rows(tb.snapshot(spark, base), keep=KEYS)
    return with_fold(rows, KEYS, SEARCHED.grid.folds, SEARCHED.grid.seed).select(*KEYS, "fold")


def released_caches(spark: SparkSession, base: str) -> DataFrame:
    """Rows tested by a small run, and that closing it leaves nothing cached or written."""
    def cached() -> int:
        return spark.sparkContext._jsc.sc().getPersistentRDDs().size()

    config = replace(HASHED, forest=ForestParams(num_trees=5, max_depth=3), train_partitions=2)
    before = cached()
    result = run_learning(tb.snapshot(spark, base), config)
    tested = result.predictions.count()
    during = cached()
    result.close()
    left = [t._written_path for t in result.scratch if exists(spark, t._written_path)]
    return spark.createDataFrame(
        [(tested, during > before, cached() - before, len(left))],
        "tested long, cached_while_open boolean, cached_after int, tables_after int",
    )


def model_registry(spark: SparkSession, base: str) -> DataFrame:
    """Test rows, and that a model saved and loaded by name predicts the same."""
    folder = new_path(spark, "models")
    train, test = train_and_test(written(tb.snapshot(spark, base), "cases"), HASHED)
    model = fit_forest(dealt_rows(train, HASHED), HASHED.forest)
    models.save_model(model, folder)
    loaded = models.load_model(spark, folder)
    first = predict(model, test).withColumnRenamed("prediction", "saved").drop("features")
    return predict(loaded, first).select(
        *KEYS, "label", (F.col("saved") == F.col("prediction")).alias("same_prediction")
    )


def run_log(spark: SparkSession, base: str) -> DataFrame:
    folder = new_path(spark, "runlog")
    row = sm.global_summary(tb.snapshot(spark, base)).first().asDict()
    runlog.log_run(
        spark,
        folder,
        "run-1",
        params={"model_type": "RandomForestRegressor"},
        metrics={k: v for k, v in row.items() if k.startswith(("global", "total"))},
    )
    return runlog.read_log(spark, folder).select("run_id", "kind", "key", "value")


def compacted_run_log(spark: SparkSession, base: str) -> DataFrame:
    """One logged run for each continent, read after the log's files were made one."""
    folder = new_path(spark, "runlog")
    for r in sm.continent_summary(tb.snapshot(spark, base)).collect():
        row = r.asDict()
        runlog.log_run(spark, folder, row.pop("continent"), metrics=row)
    files = runlog.compact_log(spark, folder, least_files=2)
    again = runlog.compact_log(spark, folder, least_files=2)
    found = runlog.read_log(spark, folder).select("run_id", "kind", "key", "value")
    return _flagged(found, {"one_file": files == again == 1}).where("key <> 'avg_deaths_per_million'")


# --- The whole batch ---------------------------------------------------------------------


def whole_batch(spark: SparkSession, base: str) -> DataFrame:
    """One row about a batch: what was checked, predicted and exported."""
    folder = new_path(spark, "batch")
    landing.to_raw(tb.snapshot(spark, base)).write.json(f"{folder}/landing")
    config = JobConfig(
        landing=f"{folder}/landing",
        layout="lines",
        lake=lake.LakeConfig(f"{folder}/lake"),
        models=f"{folder}/models",
        run_log=f"{folder}/runs",
        batch_micros=BATCH_MICROS,
    )
    result = run_job(spark, config)
    schema = result.exported.schema
    main = lake.read_main(spark, config.lake.main_path(config.dataset), schema)
    analyst = lake.read_analyst(spark, config.lake.analyst_path(config.dataset), schema)
    analyst_rows, analyst_cases = analyst.agg(F.count(F.lit(1)), F.sum("cases")).first()
    tested = result.learning.predictions.count()
    warnings, checks = len(result.warnings), result.checks.count()
    flags = _forest_flags(result.learning.model.stages[-1], config.learning.forest)
    result.close()
    return main.agg(
        F.count(F.lit(1)).alias("main_rows"),
        F.sum("cases").alias("main_cases"),
        F.lit(analyst_rows).cast("long").alias("analyst_rows"),
        F.lit(analyst_cases).cast("long").alias("analyst_cases"),
        F.lit(tested).cast("long").alias("tested_rows"),
        F.lit(warnings).cast("long").alias("warnings"),
        F.lit(checks).cast("long").alias("checks"),
        F.lit(flags["settings_as_asked"]).alias("default_forest"),
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        global_summary,
        continent_summary,
        wide_summary,
        top_countries,
        epidemic_view,
        per_million_rates,
        trend,
        row_column_count,
        null_profile,
        range_stats,
        profile_one_pass,
        quality_checks,
        observed_checks,
        quarantine_rows,
        quarantine_counts,
        missing_column_checks,
        key_checks,
        landing_lines,
        landing_array_lines,
        landing_documents,
        landing_inferred,
        landing_day_counters,
        landing_fractions,
        landing_exact,
        landing_rejects,
        landing_repeated_rejects,
        landing_new_files,
        document_parse,
        lake_main_parquet,
        lake_main_orc,
        lake_main_json,
        lake_partitioned,
        lake_save_modes,
        lake_overwrite_partitions,
        lake_key_lookup,
        lake_analyst_csv,
        lake_analyst_parquet,
        lake_dual_write,
        audit_columns,
        upsert_mysql_rule,
        upsert_postgres_rule,
        upsert_all_columns,
        upsert_day_counters,
        upsert_landed_day_counters,
        upsert_latest,
        upsert_written_batch,
        history_merge,
        bucketed_merge,
        kept_totals,
        assemble_features,
        assemble_strict,
        usable_rows,
        dropped_rows,
        hash_split_rows,
        stratified_split_rows,
        random_split_parts,
        regression_metrics,
        target_stats,
        evaluation,
        error_stats,
        label_prediction_corr,
        prediction_sample,
        negative_predictions,
        missing_features,
        acceptance,
        refused_formats,
        forest_predictions,
        forest_evaluation,
        forest_check,
        minimal_forest_check,
        cross_validation_grid,
        cross_validation_check,
        cross_validation_folds,
        released_caches,
        model_registry,
        run_log,
        compacted_run_log,
        whole_batch,
    )
}
