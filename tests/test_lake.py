from __future__ import annotations

import time
from datetime import date, datetime, timezone
from pathlib import Path
from unittest.mock import patch

import pytest
from conftest import case_rows
from pyspark.sql import functions as F

from epitally.schema import CASES
from epitally.sinks import lake

MICROS = 1_717_243_200_000_000


@pytest.fixture
def rows(spark):
    return case_rows(
        spark,
        [
            {"country": "A", "updated": 1, "continent": "X", "cases": 1},
            {"country": 'B "b", \\', "updated": 2, "continent": "Y", "iso2": None},
            {"country": "C", "updated": 3, "continent": None, "cases": 2**53 + 1},
        ],
    )


@pytest.mark.parametrize("fmt", lake.MAIN_FORMATS)
@pytest.mark.parametrize("partition_by", [(), ("continent",)])
def test_main_copy_is_whole(spark, rows, shared, fmt, partition_by):
    lake.write_main(rows, shared, fmt.upper(), partition_by=partition_by)
    assert sorted(lake.read_main(spark, shared, CASES, fmt).collect()) == sorted(rows.collect())


def files(path: str, suffix: str) -> list[Path]:
    return sorted(Path(path.removeprefix("file:")).rglob(f"*{suffix}"))


def test_parquet_is_snappy(rows, shared):
    lake.write_main(rows, shared)
    assert files(shared, ".snappy.parquet")


def test_save_modes(spark, rows, shared):
    for mode, total in (("append", 3), ("append", 6), ("overwrite", 3)):
        lake.write_main(rows, shared, mode=mode)
        assert spark.read.parquet(shared).count() == total


def test_overwrite_replaces_all_partitions(spark, rows, shared):
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        lake.write_main(rows, shared, partition_by=["continent"])
        lake.write_main(rows.where("continent = 'X'"), shared, partition_by=["continent"])
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert lake.read_main(spark, shared, CASES).count() == 1


def test_partitions_are_pruned_and_keep_their_type(spark, shared):
    rows = case_rows(spark, [{"country": "A", "iso2": "01"}, {"country": "B", "iso2": "1"}])
    lake.write_main(rows, shared, partition_by=["iso2"])
    one = lake.read_main(spark, shared, CASES).where("iso2 = '01'")
    assert [r["country"] for r in one.collect()] == ["A"]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(iso2" in plan


def test_partitioned_write_splits_a_hot_value(spark, shared):
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        hot = spark.range(60_000).select(
            F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("continent"),
            F.sha2(F.col("id").cast("string"), 256).alias("country"),
        )
        lake.write_main(hot.repartition(8), shared, partition_by=["continent"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{shared}/continent=hot", ".parquet")) > 1


def test_csv_dialect(spark, rows, shared):
    lake.write_analyst(rows, shared, files=1)
    (path,) = files(shared, ".csv")
    lines = path.read_text().splitlines()
    assert lines[0].startswith("updated,country,iso2,")
    assert len(lines) == 4
    assert any('"B ""b"", \\"' in line for line in lines)
    assert sorted(lake.read_analyst(spark, shared, CASES).collect()) == sorted(rows.collect())


def test_csv_null_and_empty(spark, shared):
    table = spark.createDataFrame([(1, None), (2, "")], "n int, s string")
    lake.write_analyst(table, shared, files=1)
    (path,) = files(shared, ".csv")
    assert sorted(path.read_text().splitlines()) == ["1,", '2,""', "n,s"]
    back = lake.read_analyst(spark, shared, table.schema)
    assert [r["s"] for r in back.collect()] == [None, None]


def test_csv_line_breaks(spark, shared):
    table = spark.createDataFrame([("a\nb",)], "s string")
    lake.write_analyst(table, shared)
    back = lake.read_analyst(spark, shared, table.schema, multi_line=True)
    assert back.collect() == [("a\nb",)]


def test_csv_file_counts(spark, shared):
    wide = spark.range(100).repartition(4)
    lake.write_analyst(wide, shared)
    assert len(files(shared, ".csv")) == 4
    lake.write_analyst(wide, shared, files=2)
    assert len(files(shared, ".csv")) == 2


def test_analyst_parquet_always_replaces(spark, rows, shared):
    for _ in range(2):
        lake.write_analyst(rows, shared, "parquet")
    assert lake.read_analyst(spark, shared, CASES, "parquet").count() == 3


def test_unknown_formats_fail_before_any_write(rows, shared):
    for settings, message in (
        ({"main_format": "avro"}, r"Unsupported main_format=avro \(parquet\|orc\|json\)"),
        ({"analyst_format": "xls"}, r"Unsupported analyst_format=xls \(csv\|parquet\)"),
        ({"mode": "upsert"}, r"Unsupported mode=upsert \(overwrite\|append\|overwrite_partitions\)"),
        ({"analyst_files": 0}, "at least 1"),
    ):
        with pytest.raises(ValueError, match=message):
            lake.LakeConfig(shared, **settings)
    with pytest.raises(ValueError, match="Unsupported main_format=avro"):
        lake.write_main(rows, shared, "avro")


def test_stamp_is_one_instant(spark, rows):
    stamped = lake.stamp(rows, MICROS)
    assert stamped.columns[-2:] == ["ingest_ts", "ingest_date"]
    (only,) = stamped.select("ingest_ts", "ingest_date").distinct().collect()
    assert only["ingest_date"] == date(2024, 6, 1)
    assert stamped.select(F.unix_micros("ingest_ts")).first()[0] == MICROS
    now = datetime.now(timezone.utc).timestamp()
    unset = lake.stamp(rows).select(F.unix_micros("ingest_ts")).first()[0]
    assert abs(unset / 1e6 - now) < 60


def test_export_writes_both_copies_with_one_stamp(spark, rows, shared):
    config = lake.LakeConfig(shared, mode="append", partition_by=("continent",))
    for _ in range(2):
        stamped = lake.export(rows, config, "d")
    main = lake.read_main(spark, f"{shared}/main/d", stamped.schema)
    analyst = lake.read_analyst(spark, f"{shared}/analyst/d", stamped.schema)
    assert (main.count(), analyst.count()) == (6, 3)
    assert main.select("ingest_ts").distinct().count() == 2
    latest = stamped.select("ingest_ts").first()[0]
    assert main.where(F.col("ingest_ts") == F.lit(latest)).count() == 3


def test_export_fails_when_one_copy_fails(spark, rows, shared):
    with patch.object(lake, "write_analyst", side_effect=OSError("disk")):
        with pytest.raises(OSError, match="disk"):
            lake.export(rows, lake.LakeConfig(shared), "d")
    assert spark.read.parquet(f"{shared}/main/d").count() == 3


def test_export_cancels_its_jobs_after_the_timeout(spark, shared):
    slow = spark.range(0, 200_000_000_000, 1, 8).select(
        F.sum(F.sqrt(F.col("id") * 1.5)).alias("s")
    )
    started = time.time()
    with pytest.raises(Exception, match="(?i)cancel"):
        lake.export(slow, lake.LakeConfig(shared), "d", timeout_seconds=0.5)
    assert time.time() - started < 20
    assert len(spark.sparkContext.getJobTags()) == 0
    assert spark.range(5).count() == 5


def test_background_export(spark, rows, shared):
    thread = lake.export_in_background(rows, lake.LakeConfig(shared), "d")
    thread.join(60)
    assert spark.read.parquet(f"{shared}/main/d").count() == 3


@pytest.mark.parametrize("fmt", lake.MAIN_FORMATS)
def test_overwrite_of_partitions_leaves_the_others(spark, shared, fmt):
    rows = case_rows(
        spark,
        [{"country": f"{k}{i}", "updated": i, "continent": k, "cases": 1} for k in "XYZ" for i in range(4)],
    )
    lake.write_main(rows, shared, fmt, partition_by=("continent",))
    before = {f: f.stat().st_mtime_ns for f in _parts(shared, "X") + _parts(shared, "Z")}
    again = rows.where("continent = 'Y' AND updated < 2").withColumn("cases", F.lit(9).cast("long"))
    lake.write_main(again, shared, fmt, "overwrite_partitions", ("continent",))
    found = lake.read_main(spark, shared, CASES, fmt)
    assert sorted((r.country, r.cases) for r in found.collect()) == sorted(
        [(f"{k}{i}", 1) for k in "XZ" for i in range(4)] + [("Y0", 9), ("Y1", 9)]
    )
    assert {f: f.stat().st_mtime_ns for f in before} == before
    # Rows of no partition replace nothing.
    lake.write_main(again.limit(0), shared, fmt, "overwrite_partitions", ("continent",))
    assert lake.read_main(spark, shared, CASES, fmt).count() == 10


def _parts(path: str, continent: str) -> list[Path]:
    return sorted(Path(path.removeprefix("file:")).glob(f"continent={continent}/part-*"))


def test_overwrite_of_partitions_needs_partitions(rows, shared):
    with pytest.raises(ValueError, match="partition_by"):
        lake.write_main(rows, shared, mode="overwrite_partitions")
    with pytest.raises(ValueError, match="partition_by"):
        lake.LakeConfig("x", mode="overwrite_partitions")


def _scanned(df) -> int:
    """Rows that the scan gave to the filter above it."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while plan.children().size():
        plan = plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def _many(spark):
    """Rows in no order by key."""
    return spark.range(40_000).selectExpr(
        "CAST(id AS BIGINT) AS updated", "md5(CAST(id AS STRING)) AS country", "id % 7 AS cases"
    ).repartition(2)


def test_bloom_filters_skip_row_groups(spark, shared):
    rows = _many(spark)
    lake.write_main(rows, f"{shared}/plain", row_group_bytes=64 * 1024)
    lake.write_main(rows, f"{shared}/bloom", bloom=("country",), row_group_bytes=64 * 1024)
    # Between the least and the greatest value of every row group, and in one of them.
    wanted = "country = md5('12345')"
    plain = spark.read.parquet(f"{shared}/plain").where(wanted)
    bloom = spark.read.parquet(f"{shared}/bloom").where(wanted)
    assert plain.count() == bloom.count() == 1
    assert _scanned(bloom) < _scanned(plain) / 2
    with pytest.raises(ValueError, match="Bloom"):
        lake.write_main(rows, f"{shared}/orc", "orc", bloom=("country",))


def test_order_in_files_skips_row_groups(spark, shared):
    rows = _many(spark)
    lake.write_main(rows, f"{shared}/plain", row_group_bytes=64 * 1024)
    lake.write_main(rows, f"{shared}/ordered", order_by=("updated",), row_group_bytes=64 * 1024)
    wanted = "updated BETWEEN 12000 AND 12500"
    plain = spark.read.parquet(f"{shared}/plain").where(wanted)
    ordered = spark.read.parquet(f"{shared}/ordered").where(wanted)
    assert plain.count() == ordered.count() == 501
    assert _scanned(ordered) < _scanned(plain) / 4


def test_order_goes_with_partitions(spark, shared):
    rows = case_rows(
        spark,
        [{"country": f"c{i:03}", "updated": i, "continent": "XY"[i % 2]} for i in range(100)],
    )
    lake.write_main(rows, shared, partition_by=("continent",), order_by=("country",), bloom=("country",))
    assert lake.read_main(spark, shared, CASES).count() == 100
    for file in _parts(shared, "X"):
        names = [r.country for r in spark.read.parquet(str(file)).collect()]
        assert names == sorted(names)
