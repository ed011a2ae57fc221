from __future__ import annotations

import os
from unittest.mock import patch

import pytest
from conftest import SMALL, valid_rows
from pyspark.sql import functions as F

from epitally.operators.forest import ForestParams
from epitally.operators.quality import QualityError, quarantine
from epitally.plans.job import JobConfig, run_job
from epitally.plans.learning import LearningConfig
from epitally.schema import CASES, KEYS
from epitally.sinks import jdbc, lake, models, runlog
from epitally.sources.landing import to_raw
from epitally.sources.tables import snapshot
from epitally.workspace import shared_dir

SMALL_FOREST = LearningConfig(split="hash", keys=KEYS, forest=ForestParams(5, 3))


def config_for(shared: str, **changes) -> JobConfig:
    settings = {
        "landing": f"{shared}/landing",
        "layout": "lines",
        "lake": lake.LakeConfig(f"{shared}/lake"),
        "models": f"{shared}/models",
        "run_log": f"{shared}/runs",
        "learning": SMALL_FOREST,
    }
    return JobConfig(**{**settings, **changes})


@pytest.fixture
def landed(spark, shared):
    to_raw(snapshot(spark, SMALL)).write.json(f"{shared}/landing")
    return shared


def test_whole_batch(spark, landed):
    result = run_job(spark, config_for(landed))
    assert result.warnings == []
    assert result.top.count() == 20
    assert result.summary.first()["total_countries"] == 150
    assert spark.table("epidemic").count() == 150
    assert result.sample.count() == 10
    assert result.errors.first()["mean_absolute_error"] == round(
        result.metrics["mae"], 2
    )

    main = lake.read_main(spark, f"{landed}/lake/main/epidemic_countries", result.exported.schema)
    assert main.count() == 150
    analyst = lake.read_analyst(spark, f"{landed}/lake/analyst/epidemic_countries", CASES)
    assert analyst.count() == 150

    (entry,) = models.registry(spark, f"{landed}/models").collect()
    assert entry["version"] == result.model_version
    assert entry["metrics"]["rmse"] == result.metrics["rmse"]
    logged = {r["key"]: r["value"] for r in runlog.read_log(spark, f"{landed}/runs").collect()}
    assert logged["num_trees"] == "5" and logged["enable_cv"] == "False"
    assert float(logged["rmse"]) == result.metrics["rmse"]


def test_a_closed_batch_leaves_nothing(spark, landed):
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    result = run_job(spark, config_for(landed))
    result.close()
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
    assert not result.learning.predictions.is_cached
    with pytest.raises(OSError, match="full"), patch(
        "epitally.plans.job.export", side_effect=OSError("full")
    ):
        run_job(spark, config_for(landed))
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before


def test_bad_model_is_not_saved(spark, landed):
    results = [run_job(spark, config_for(landed, rmse_threshold=0.0)) for _ in range(2)]
    result = results[0]
    assert result.model_version is None and result.appended is None
    logged = runlog.read_log(spark, f"{landed}/runs").where("key = 'model_version'").collect()
    assert {r["run_id"] for r in logged} == {r.run_id for r in results}
    assert [r["value"] for r in logged] == [None, None]
    assert models.registry(spark, f"{landed}/models").count() == 0


def test_empty_landing_fails(spark, shared):
    to_raw(snapshot(spark, SMALL)).where(F.lit(False)).write.json(f"{shared}/landing")
    with pytest.raises(QualityError, match="Dataset is empty!"):
        run_job(spark, config_for(shared))


def test_database_failure_is_fatal_only_if_required(spark, landed):
    target = jdbc.JdbcTarget("jdbc:postgresql://host/db", "org.postgresql.Driver")
    with patch.object(jdbc, "append", side_effect=OSError("refused")) as append:
        assert run_job(spark, config_for(landed, database=target)).appended is False
        append.assert_called_once()
        with pytest.raises(OSError, match="refused"):
            run_job(spark, config_for(landed, database=target, jdbc_required=True))


def test_run_log_appends(spark, shared):
    runlog.log_run(spark, shared, "a", params={"k": 1}, metrics={"m": None})
    runlog.log_run(spark, shared, "b", metrics={"m": 2.5})
    rows = runlog.read_log(spark, shared).orderBy("run_id", "kind").collect()
    assert [(r["run_id"], r["kind"], r["key"], r["value"]) for r in rows] == [
        ("a", "metric", "m", None),
        ("a", "param", "k", "1"),
        ("b", "metric", "m", "2.5"),
    ]


def test_generated_rows_keep_all_rules(spark):
    assert valid_rows(spark, 30).count() == 30
    assert quarantine(valid_rows(spark, 30)).bad_rows == 0


def test_batches_with_a_ledger_take_each_file_once(spark, shared):
    rows = snapshot(spark, SMALL)
    config = config_for(shared, ledger=f"{shared}/ledger", lake=lake.LakeConfig(f"{shared}/lake", mode="append"))
    main = f"{shared}/lake/main/epidemic_countries"
    seen = []
    for part in range(2):
        to_raw(rows.where(F.col("population") % 2 == part)).write.mode("append").json(f"{shared}/landing")
        with pytest.raises(OSError, match="full"), patch(
            "epitally.plans.job.export", side_effect=OSError("full")
        ):
            run_job(spark, config)
        # A batch that failed has entered nothing, so this one reads the same files.
        result = run_job(spark, config)
        seen.append(result.summary.first()["total_countries"])
        schema = result.exported.schema
        result.close()
    assert seen == [75, 75]
    assert lake.read_main(spark, main, schema).count() == 150
    assert lake.read_main(spark, main, schema).select("country").distinct().count() == 150
    with pytest.raises(QualityError, match="empty"):
        run_job(spark, config)


def test_a_batch_with_quarantine_keeps_bad_rows_out(spark, shared):
    rows = snapshot(spark, SMALL)
    bad = F.col("population") % 10 == 0
    to_raw(rows.withColumn("deaths", F.when(bad, -1).otherwise(F.col("deaths")))).write.json(
        f"{shared}/landing"
    )
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    result = run_job(spark, config_for(shared, quarantine=True))
    checks = {r.check: r.value for r in result.checks.collect()}
    wrong = result.broken_rules["deaths_negative"]
    assert wrong == 15 and checks["non_empty"] == 150
    kept_out = result.quarantined.count()
    assert result.summary.first()["total_countries"] == 150 - kept_out and kept_out >= wrong
    assert result.exported.count() == 150 - kept_out
    assert result.quarantined.where("array_contains(broken, 'deaths_negative')").count() == wrong
    result.close()
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before
