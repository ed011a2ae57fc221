"""The whole batch: scan, check, report, learn, save, export."""

from __future__ import annotations

import logging
import uuid
from contextlib import ExitStack
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from epitally.operators.evaluate import accept_model, error_stats, sample_predictions
from epitally.operators.quality import observe_profile, quarantine, require
from epitally.operators.summary import global_summary, register_view, top_countries
from epitally.plans.learning import LearningConfig, LearningResult, run_learning
from epitally.schema import KEYS
from epitally.sinks import jdbc
from epitally.sinks.lake import LakeConfig, export
from epitally.sinks.models import MODEL_NAME, save_model
from epitally.sinks.runlog import log_run
from epitally.sources.landing import read_cases
from epitally.sources.ledger import new_cases
from epitally.workspace import discard, written

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class JobConfig:
    """Settings of one batch. The dataset name and the rmse threshold."""

    landing: str
    lake: LakeConfig
    models: str
    run_log: str
    layout: str = "documents"
    dataset: str = "epidemic_countries"
    top: int = 20
    sample: int = 10
    learning: LearningConfig = field(
        default_factory=lambda: LearningConfig(split="hash", keys=KEYS, materialize=False)
    )
    model_name: str = MODEL_NAME
    overwrite_model: bool = True
    rmse_threshold: float | None = None
    database: jdbc.JdbcTarget | None = None
    jdbc_required: bool = False
    batch_micros: int | None = None
    export_timeout_seconds: float | None = None
    ledger: str | None = None
    """Where the files that batches took are entered; None reads all that is landed."""
    quarantine: bool = False
    """Whether rows that break a rule of case rows are kept out of everything but the checks."""


@dataclass(frozen=True)
class JobResult:
    cases: DataFrame
    checks: DataFrame
    warnings: list[str]
    top: DataFrame
    summary: DataFrame
    learning: LearningResult
    sample: DataFrame
    errors: DataFrame
    metrics: dict[str, float | None]
    model_version: str | None
    exported: DataFrame
    run_id: str
    quarantined: DataFrame | None
    """Rows kept out, with the rules they broke; None without a quarantine."""
    broken_rules: dict[str, int]
    """How many rows broke each rule; empty without a quarantine."""
    appended: bool | None
    """Whether the database took all rows; None without a database. False may mean some."""

    def close(self) -> None:
        """Release caches and delete the batch's tables; the frames cannot be read any more."""
        self.learning.close()
        discard(self.cases.sparkSession, self.cases)


def _append_to_database(cases: DataFrame, config: JobConfig) -> bool:
    try:
        jdbc.append(cases, config.database)
        return True
    except Exception:
        if config.jdbc_required:
            raise
        log.exception("Append to the database failed; going on without it")
        return False


def run_job(
    spark: SparkSession, config: JobConfig, cross_validation: bool | None = None
) -> JobResult:
    """Run the batch over the landed documents.

    The scan is written once as a columnar table, and the write counts what the checks need.
    Reports, learning and exports read the columns they need from the table; none of them parses
    JSON again.

    Each step fails the batch, except the database append unless ``jdbc_required``. A model
    whose rmse is over ``rmse_threshold``, if one is set, is not saved.

    The frames of the result read the batch's tables; ``close()`` it when they are no longer
    needed. A batch that fails cleans up itself.

    With a ``ledger`` only files are read that no earlier batch took, and they are entered last,
    when all exports are done: a batch that fails reads them again. With ``quarantine`` the
    checks cover all rows, and reports, learning and exports the good ones.
    """
    learning_config = config.learning
    if cross_validation is not None:
        learning_config = replace(learning_config, cross_validation=cross_validation)

    with ExitStack() as stack:

        def keep(table: DataFrame) -> DataFrame:
            stack.callback(discard, spark, table)
            return table

        run_id = uuid.uuid4().hex
        taken = None
        if config.ledger is None:
            landed = read_cases(spark, config.landing, layout=config.layout)
        else:
            taken = new_cases(spark, config.landing, config.ledger, run_id, layout=config.layout)
            landed = taken.cases
        scanned, seen = observe_profile(landed)
        parts = None
        if config.quarantine:
            parts = quarantine(scanned)
            cases = keep(parts.good)
            log.info("Quarantined %d of %d rows", parts.bad_rows, parts.rows)
        else:
            cases = keep(written(scanned, "cases"))
        checks = seen.checks(spark)
        warnings = require(checks)
        for name in warnings:
            log.warning("Quality check failed: %s", name)

        register_view(cases)
        top, summary = top_countries(cases, config.top), global_summary(cases)

        learning = run_learning(cases, learning_config)
        stack.callback(learning.close)
        metrics = learning.metrics.first().asDict()
        version = None
        if config.rmse_threshold is None or accept_model(metrics, config.rmse_threshold):
            version = save_model(
                learning.model,
                config.models,
                config.model_name,
                overwrite=config.overwrite_model,
                metrics=metrics,
            )
        else:
            log.warning("Model rejected: rmse %s", metrics["rmse"])
        log_run(
            spark,
            config.run_log,
            run_id=run_id,
            params={
                "model_version": version,
                "model_type": "RandomForestRegressor",
                "enable_cv": learning_config.cross_validation,
                "num_trees": learning_config.forest.num_trees,
                "max_depth": learning_config.forest.max_depth,
            },
            metrics=metrics,
        )

        appended = None if config.database is None else _append_to_database(cases, config)
        exported = export(
            cases, config.lake, config.dataset, config.batch_micros, config.export_timeout_seconds
        )
        result = JobResult(
            cases=cases,
            checks=checks,
            warnings=warnings,
            top=top,
            summary=summary,
            learning=learning,
            sample=sample_predictions(learning.predictions, config.sample),
            errors=error_stats(learning.predictions),
            metrics=metrics,
            model_version=version,
            exported=exported,
            run_id=run_id,
            quarantined=None if parts is None else parts.bad,
            broken_rules={} if parts is None else parts.by_rule,
            appended=appended,
        )
        if taken is not None:
            taken.commit()
        stack.pop_all()
        return result
