from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from epitally.functions.expressions import epoch_millis, hash_bucket, null_flag, per_million
from epitally.sources.tables import TABLES, table
from epitally.workspace import dealt, discard, new_path, shared_dir, written


def test_epoch_millis_ignores_the_session_zone(spark):
    wall = spark.sql(
        "SELECT TIMESTAMP_NTZ '2024-03-31 02:30:00.123456' AS ts, "
        "TIMESTAMP '2024-03-31 02:30:00.123456Z' AS instant"
    )
    for zone in ("UTC", "Europe/Paris", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            row = wall.select(
                epoch_millis(wall, "ts").alias("a"), epoch_millis(wall, "instant").alias("b")
            ).first()
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        assert row == (1711852200123, 1711852200123)


def test_per_million(spark):
    rows = spark.createDataFrame([(5, 3), (1, 0), (None, 2)], "c bigint, p bigint")
    assert [r[0] for r in rows.select(per_million("c", "p")).collect()] == [1666666, None, None]


def test_null_flag(spark):
    rows = spark.createDataFrame([(1,), (None,)], "c int")
    assert [r[0] for r in rows.select(null_flag("c")).collect()] == [0, 1]


def test_hash_bucket_depends_on_key_and_seed(spark):
    rows = spark.range(200)
    one, again, other = (
        [r[0] for r in rows.select(hash_bucket(["id"], seed)).collect()] for seed in (1, 1, 2)
    )
    assert one == again != other
    assert all(0 <= b < 10_000 for b in one)


def test_declared_tables_match_the_files(spark, base):
    for name in TABLES:
        found = spark.read.parquet(f"{base}/{name}.parquet")
        declared = table(spark, base, name)
        assert [(f.name, f.dataType) for f in declared.schema] == [
            (f.name, f.dataType) for f in found.schema
        ]


def test_written_tables_live_in_the_shared_folder(spark):
    rows = spark.range(3).withColumn("n", F.lit(None).cast("string"))
    back = written(rows, "t")
    assert back.schema.simpleString() == rows.schema.simpleString()
    assert back.count() == 3
    folder = shared_dir(spark).removeprefix("file:")
    assert all(folder in f for f in back.inputFiles())
    assert new_path(spark, "x") != new_path(spark, "x")


def test_discard_deletes_only_written_tables(spark, shared):
    table = written(spark.range(3), "t")
    discard(spark, table)
    with pytest.raises(Exception, match="(?i)does not exist|not found"):
        table.collect()
    spark.range(3).write.parquet(f"{shared}/deeper")
    with pytest.raises(ValueError, match="Not a table written to the shared folder"):
        discard(spark, spark.read.parquet(f"{shared}/deeper"))
    with pytest.raises(ValueError, match="Not a table written to the shared folder"):
        discard(spark, spark.read.parquet("/root/testdata/sf0.001/region.parquet"))


def test_rows_are_dealt_by_key_alone(spark):
    rows = spark.range(500).selectExpr("id AS k", "id % 7 AS v")
    layouts = [
        dealt(rows.repartition(n), ["k"], 5).rdd.glom().collect()
        for n in (1, 4, 9)
    ]
    assert layouts[0] == layouts[1] == layouts[2] and len(layouts[0]) == 5


def test_only_local_sessions_get_a_temporary_folder():
    class Context:
        def __init__(self, master):
            self.master = master

        def getCheckpointDir(self):
            return None

    class Session:
        class conf:
            @staticmethod
            def get(*_):
                return None

    for master in ("local-cluster[2,1,1024]", "yarn", "spark://host:7077"):
        session = Session()
        session.sparkContext = Context(master)
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session)
