from __future__ import annotations

import time

import pytest
from conftest import as_dicts, valid_rows
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from epitally.functions.expressions import hash_place, null_where
from epitally.operators import evaluate as ev
from epitally.operators import features as ft
from epitally.operators.forest import (
    ForestParams,
    GridParams,
    fit_forest_on_vectors,
    with_fold,
)
from epitally.operators.split import hash_split, random_split, stratified_split, stratum_cuts
from epitally.plans.learning import LearningConfig, run_learning, train_and_test
from epitally.schema import FEATURES, STRICT_FEATURES
from epitally.workspace import written


@pytest.fixture(scope="module")
def hundred(spark):
    """A run with the default settings on 100 rows, and how long it took."""
    rows = valid_rows(spark, 100)
    started = time.time()
    result = run_learning(rows)
    result.predictions.count()
    yield result, time.time() - started
    result.predictions.unpersist()


@pytest.fixture(scope="module")
def two_hundred(spark):
    result = run_learning(valid_rows(spark, 200))
    yield result
    result.predictions.unpersist()


def test_trains_and_predicts(hundred):
    result, _ = hundred
    assert result.model is not None
    assert result.predictions.count() > 0
    assert {"label", "prediction", "features"} <= set(result.predictions.columns)


def test_no_negative_predictions(hundred):
    assert ev.negative_predictions(hundred[0].predictions).count() == 0


def test_predictions_are_cached(hundred):
    assert hundred[0].predictions.storageLevel.useMemory


def test_training_time(hundred):
    assert hundred[1] < 30


def test_vector_dimensions(hundred):
    size = hundred[0].predictions.select(F.size(vector_to_array("features"))).first()[0]
    assert size == len(FEATURES)


def test_model_quality(two_hundred):
    metrics = two_hundred.metrics.first().asDict()
    assert metrics["rmse"] < 10_000
    assert ev.accept_model(metrics)
    assert ev.correlation(two_hundred.predictions).first()["corr"] > 0.5


def test_metrics_equal_the_evaluator(two_hundred):
    metrics = two_hundred.metrics.first().asDict()
    for name in ("rmse", "mae", "r2"):
        theirs = RegressionEvaluator(metricName=name, labelCol="label").evaluate(
            two_hundred.predictions
        )
        assert metrics[name] == pytest.approx(theirs, rel=1e-9)


def test_ten_rows_are_enough(spark):
    for split in ("random", "hash"):
        result = run_learning(valid_rows(spark, 10), LearningConfig(split=split))
        assert result.metrics.count() == 1
        result.predictions.unpersist()


def test_missing_columns(spark):
    short = spark.createDataFrame([(1000, 50, 2.5)], "cases bigint, active bigint, deaths double")
    with pytest.raises(ValueError, match="missing required columns: critical, tests"):
        run_learning(short)
    empty = spark.createDataFrame([], "x int").drop("x")
    with pytest.raises(ValueError, match="missing required columns"):
        run_learning(empty)


def fifth():
    """0 to 4 in turn, row by row of ``valid_rows``."""
    return (F.col("population") - 40_000) / 3_571 % 5


def with_nulls(spark, n):
    rows = valid_rows(spark, n)
    return rows.withColumn("cases", null_where("cases", fifth() == 0)).withColumn(
        "active", null_where("active", fifth() == 1)
    )


def test_rows_with_nulls_are_skipped(spark):
    rows = with_nulls(spark, 100)
    train, test = train_and_test(rows, LearningConfig(split="hash"))
    assert train.count() + test.count() == 60
    assert ft.prepare(rows).count() == 60
    result = run_learning(rows)
    assert 0 < result.predictions.count() < 60
    result.predictions.unpersist()


def test_null_labels_are_dropped_and_counted(spark):
    rows = with_nulls(spark, 100).withColumn(
        "deaths", null_where("deaths", fifth() >= 3)
    )
    assert as_dicts(ft.dropped_rows(rows)) == [
        {"row_count": 100, "invalid_features": 40, "missing_labels": 40}
    ]
    result = run_learning(rows, LearningConfig(split="hash"))
    assert result.predictions.where("label IS NULL").count() == 0
    result.predictions.unpersist()


def test_nan_features_are_invalid(spark):
    rows = valid_rows(spark, 3).withColumn("tests", F.lit(float("nan")))
    assert ft.prepare(rows).count() == 0
    assert ft.usable_rows(rows).count() == 0
    assert ft.dropped_rows(rows).first()["invalid_features"] == 3


def test_strict_assembly(spark):
    rows = valid_rows(spark, 5)
    vector = vector_to_array(F.col("features"))
    first = ft.prepare_strict(rows.orderBy("population")).select(vector.alias("v")).first()["v"]
    given = rows.orderBy("population").first().asDict()
    assert first == [float(given[c]) for c in STRICT_FEATURES]
    with pytest.raises(Exception, match="(?i)null"):
        ft.prepare_strict(with_nulls(spark, 20)).collect()


def test_minimal_forest(spark):
    model = fit_forest_on_vectors(ft.prepare_strict(valid_rows(spark, 60)))
    assert model.getNumTrees == 100
    assert model.getOrDefault("maxDepth") == 10


def test_saved_model_takes_case_rows(two_hundred, spark, shared):
    from epitally.sinks import models

    version = models.save_model(two_hundred.model, shared, "forest", metrics={"rmse": 1.0})
    loaded = models.load_model(spark, shared, "forest", version)
    rows = valid_rows(spark, 20)
    mine = two_hundred.model.transform(rows).select("population", "prediction")
    assert sorted(mine.collect()) == sorted(
        loaded.transform(rows).select("population", "prediction").collect()
    )


def test_registry(two_hundred, spark, shared):
    from epitally.sinks import models

    assert models.registry(spark, shared).count() == 0
    with pytest.raises(LookupError):
        models.load_model(spark, shared, "forest")
    models.save_model(two_hundred.model, shared, "forest", "1", metrics={"rmse": 5.0, "r2": None})
    models.save_model(two_hundred.model, shared, "forest", "2")
    rows = models.registry(spark, shared).orderBy("version").collect()
    assert [r["version"] for r in rows] == ["1", "2"]
    assert rows[0]["metrics"] == {"rmse": 5.0, "r2": None}
    assert rows[0]["path"] == f"{shared}/forest_v1"
    assert models.load_model(spark, shared, "forest") is not None
    with pytest.raises(Exception, match="already exists"):
        models.save_model(two_hundred.model, shared, "forest", "2", overwrite=False)


def test_version_format():
    from datetime import datetime

    from epitally.sinks import models

    assert models.new_version(datetime(2024, 6, 1, 9, 8, 7)) == "20240601_090807"


def test_cross_validation(spark):
    grid = GridParams(num_trees=(3, 5), max_depth=(2, 3), min_instances_per_node=(1,), folds=2)
    config = LearningConfig(cross_validation=True, grid=grid)
    result = run_learning(valid_rows(spark, 100), config)
    forest = result.model.stages[-1]
    assert forest.getNumTrees in (3, 5)
    assert forest.getOrDefault("maxDepth") in (2, 3)
    result.predictions.unpersist()


def test_a_seeded_fit_depends_on_the_rows_alone(spark, shared):
    valid_rows(spark, 120).coalesce(1).write.parquet(shared)
    config = LearningConfig(split="hash", keys=("population",), forest=ForestParams(20, 5))
    found = []
    for parts in (1, 3, 16):
        result = run_learning(spark.read.parquet(shared).repartition(parts), config)
        rows = result.predictions.select("population", "prediction").orderBy("population")
        found.append([tuple(r) for r in rows.collect()])
        result.close()
    for other in found[1:]:
        assert [k for k, _ in other] == [k for k, _ in found[0]]
        assert [p for _, p in other] == pytest.approx([p for _, p in found[0]], abs=1e-9)


def test_close_releases_everything(spark):
    result = run_learning(valid_rows(spark, 30), LearningConfig(forest=ForestParams(3, 2)))
    result.metrics.collect()
    assert result.predictions.is_cached and len(result.scratch) == 1
    result.close()
    assert not result.predictions.is_cached
    with pytest.raises(Exception, match="(?i)does not exist|not found"):
        result.scratch[0].collect()


def test_versions_do_not_collide(two_hundred, spark, shared):
    from epitally.sinks import models

    a, b = (models.save_model(two_hundred.model, shared, "forest") for _ in range(2))
    assert a != b and models.registry(spark, shared).count() == 2
    models.save_model(two_hundred.model, shared, "forest", a, metrics={"rmse": 2.0})
    rows = {r["version"]: r["metrics"] for r in models.registry(spark, shared).collect()}
    assert rows == {a: {"rmse": 2.0}, b: {}}


def test_default_grid():
    grid = GridParams()
    assert len(grid.num_trees) * len(grid.max_depth) * len(grid.min_instances_per_node) == 27
    assert (grid.folds, grid.parallelism, grid.seed) == (3, 4, 42)


def test_hash_split_ignores_partitioning(spark):
    rows = spark.range(1500).withColumnRenamed("id", "k")
    halves = [
        [sorted(r["k"] for r in part.collect()) for part in hash_split(rows.repartition(n), ["k"])]
        for n in (1, 7)
    ]
    assert halves[0] == halves[1]
    train, test = halves[0]
    assert sorted(train + test) == list(range(1500))
    assert 1100 < len(train) < 1300


def test_random_split_is_whole(spark):
    rows = written(spark.range(1000), "rows")
    train, test = random_split(rows)
    assert sorted(r[0] for r in train.union(test).collect()) == list(range(1000))
    assert 700 < train.count() < 900
    assert sorted(train.collect()) == sorted(random_split(rows)[0].collect())


def test_evaluation_of_nothing_is_null(spark):
    empty = spark.createDataFrame([], "label bigint, prediction double")
    for measure in (ev.evaluate, ev.error_stats, ev.correlation):
        row = measure(empty).first()
        assert all(v is None for v in row)
    assert not ev.accept_model(ev.evaluate(empty).first().asDict())


def test_r2_of_constant_labels_is_null(spark):
    same = spark.createDataFrame([(3, 1.0), (3, 2.0)], "label bigint, prediction double")
    row = ev.regression_metrics(same).first()
    assert row["r2"] is None and row["mae"] == 1.5


def test_acceptance():
    assert ev.accept_model({"rmse": 10_000.0})
    assert not ev.accept_model({"rmse": 10_000.1})
    assert not ev.accept_model({"rmse": 6.0}, 5.0)
    assert not ev.accept_model({"rmse": None})


def test_evaluation_is_one_scan(spark, shared):
    spark.range(10).selectExpr("id AS label", "id * 1.5D AS prediction").write.parquet(shared)
    plan = ev.evaluate(spark.read.parquet(shared))._jdf.queryExecution().executedPlan()
    assert plan.toString().count("FileScan") == 1


def test_error_stats_and_sample(spark):
    frame = spark.createDataFrame(
        [(1, 1.005), (5, 2.5), (9, -1.239)], "label bigint, prediction double"
    )
    assert as_dicts(ev.error_stats(frame)) == [
        {"mean_absolute_error": 4.25, "min_prediction": -1.24, "max_prediction": 2.5}
    ]
    assert as_dicts(ev.sample_predictions(frame, 2, "label")) == [
        {"actual_deaths": 1, "predicted_deaths": 1.005},
        {"actual_deaths": 5, "predicted_deaths": 2.5},
    ]
    assert ev.sample_predictions(frame).count() == 3
    assert ev.negative_predictions(frame).count() == 1


def test_unknown_split():
    with pytest.raises(ValueError, match="Unsupported split=alphabetic"):
        LearningConfig(split="alphabetic")


@pytest.mark.parametrize("cell_bits", [1, 4, 16])
def test_a_stratified_split_meets_every_quota(spark, cell_bits):
    """A hot stratum, small ones, one row alone and a null stratum."""
    rows = spark.range(3000).select(
        F.col("id").alias("k"),
        F.when(F.col("id") < 2000, "hot").when(F.col("id") < 2990, F.col("id").cast("string").substr(3, 1))
        .when(F.col("id") < 2999, None).otherwise("alone").alias("s"),
    )
    rows = written(rows, "rows")
    train, test = stratified_split(rows, ["s"], ["k"], 0.7, cell_bits=cell_bits)
    assert train.columns == rows.columns
    whole = {r.s: r["count"] for r in rows.groupBy("s").count().collect()}
    part = {r.s: r["count"] for r in train.groupBy("s").count().collect()}
    assert {s: part.get(s, 0) for s in whole} == {s: int(n * 0.7 + 0.5) for s, n in whole.items()}
    assert sorted(r.k for r in train.union(test).collect()) == list(range(3000))
    other, _ = stratified_split(rows.repartition(5), ["s"], ["k"], 0.7, cell_bits=12)
    assert sorted(r.k for r in train.collect()) == sorted(r.k for r in other.collect())


def test_a_stratified_split_orders_one_cell_of_a_stratum(spark):
    """Of a stratum with all rows only the cell that the quota ends in reaches the window."""
    rows = written(spark.range(20_000).selectExpr("id AS k", "'all' AS s"), "rows")
    cuts = stratum_cuts(rows, ["s"], ["k"], 0.8, cell_bits=8)
    row = cuts.first()
    assert (row.s0, row["rows"], row.quota) == ("all", 20_000, 16_000)
    place = hash_place(["k"], 42)
    cell = row.cut.place >> (60 - 8)
    assert rows.where(F.shiftright(place, 60 - 8) == cell).count() < 200
    assert rows.where(place <= row.cut.place).count() == 16_000


def test_stratified_learning(spark):
    with pytest.raises(ValueError, match="strata"):
        LearningConfig(split="stratified", keys=("population",))
    rows = valid_rows(spark, 60).withColumn("continent", F.when(F.col("population") % 2 == 0, "even").otherwise("odd"))
    config = LearningConfig(split="stratified", keys=("population",), strata=("continent",),
                            train_ratio=0.5, forest=ForestParams(3, 3))
    result = run_learning(rows, config)
    odd = result.predictions.groupBy((F.col("population") % 2).alias("odd")).count().collect()
    assert {r.odd: r["count"] for r in odd} == {0: 15, 1: 15}
    result.close()


def test_folds_go_by_the_key_alone(spark):
    rows = valid_rows(spark, 90)
    folds = [
        {r.population: r.fold for r in with_fold(rows.repartition(n), ["population"], 3, 42).collect()}
        for n in (1, 7)
    ]
    assert folds[0] == folds[1] and set(folds[0].values()) == {0, 1, 2}


def test_a_search_depends_on_the_rows_alone(spark, shared):
    valid_rows(spark, 90).coalesce(1).write.parquet(shared)
    grid = GridParams(num_trees=(3,), max_depth=(2, 4), min_instances_per_node=(1,), folds=3)
    config = LearningConfig(split="hash", keys=("population",), cross_validation=True, grid=grid)
    found = []
    for parts in (1, 5):
        result = run_learning(spark.read.parquet(shared).repartition(parts), config)
        found.append(result.search.avgMetrics)
        result.close()
    assert found[0] == pytest.approx(found[1], abs=1e-9)


def test_a_search_grows_as_many_forests_as_memory_holds(spark, monkeypatch):
    from threading import Lock

    from pyspark.ml.evaluation import RegressionEvaluator

    from epitally.operators import forest

    lock, now, most = Lock(), [0], [0]
    evaluate, fit = RegressionEvaluator.evaluate, forest.Pipeline.fit

    def counted_fit(self, *args):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        return fit(self, *args)

    def counted_evaluate(self, *args):
        try:
            return evaluate(self, *args)
        finally:
            with lock:
                now[0] -= 1

    monkeypatch.setattr(forest.Pipeline, "fit", counted_fit)
    monkeypatch.setattr(RegressionEvaluator, "evaluate", counted_evaluate)
    grid = GridParams((3, 4), (2, 3), (1,), folds=2, parallelism=4)
    train = valid_rows(spark, 90).withColumnRenamed("deaths", "label")
    free = forest.cross_validate(train, grid, keys=("population",)).avgMetrics
    # One such node is more than any driver has.
    monkeypatch.setattr(forest, "NODE_BYTES", 2**50, raising=False)
    now[0] = most[0] = 0
    found = forest.cross_validate(train, grid, keys=("population",))
    assert most[0] == 1
    assert found.avgMetrics == pytest.approx(free) and len(found.getEstimatorParamMaps()) == 4
    assert forest.grid_results(found, spark).where("is_best").count() == 1


def test_the_whole_search_grows_in_tasks(spark, monkeypatch):
    """All 27 settings in 3 folds, and not one fit of MLlib's, which takes many jobs each."""
    from pyspark.ml.regression import RandomForestRegressor

    from epitally.operators import forest

    fits = []
    monkeypatch.setattr(RandomForestRegressor, "_fit_java", lambda self, rows: fits.append(self))
    train = valid_rows(spark, 120).withColumnRenamed("deaths", "label")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup())
    found = forest.cross_validate(train, keys=("population",))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup()) - before
    assert fits == [] and jobs < 40
    assert len(found.avgMetrics) == 27 and forest.grid_results(found, spark).count() == 27
    best = found.getEstimatorParamMaps()[found.avgMetrics.index(min(found.avgMetrics))]
    fitted = found.bestModel.stages[-1]
    assert fitted.getNumTrees == best[found.getEstimator().getStages()[-1].numTrees]


def test_a_search_measures_what_separate_fits_would(spark):
    """Settings share trees; each metric is that of the setting's own forest all the same."""
    from epitally.operators import forest, trees

    grid = GridParams((3, 12), (2, 5), (1, 4), folds=2)
    train = written(valid_rows(spark, 120).withColumnRenamed("deaths", "label"), "train")
    found = forest.cross_validate(train, grid, keys=("population",))
    estimator, names = found.getEstimator(), ("rmse", "mse", "mae", "r2", "var")
    folded = with_fold(train, ("population",), 2, 42)
    settings = [s for s in found.getEstimatorParamMaps() if set(s.values()) in ({3, 5, 1}, {12, 2, 4})]
    measured = {(n, i): [] for n in names for i in range(len(settings))}
    for fold in range(2):
        for i, setting in enumerate(settings):
            model = estimator.fit(folded.where(F.col("fold") != fold), setting)
            rows = model.transform(folded.where(F.col("fold") == fold)).cache()
            for n in names:
                theirs = RegressionEvaluator(metricName=n, labelCol="label").evaluate(rows)
                measured[n, i].append(theirs)
            rows.unpersist()
    values, labels, folds = trees.collected(estimator.getStages()[0].transform(folded), "fold")
    tables = [trees.binned(values, labels, folds != fold, 32) for fold in range(2)]
    asked = [tuple(s.values()) for s in settings]
    for n in names:
        mine = trees.measures(spark, tables, asked, 42, n)
        for i in range(len(settings)):
            assert mine[i] == pytest.approx(measured[n, i], rel=1e-9)
    for i, setting in enumerate(settings):
        at = found.getEstimatorParamMaps().index(setting)
        assert found.avgMetrics[at] == pytest.approx(sum(measured["rmse", i]) / 2, rel=1e-9)


@pytest.mark.parametrize("least", [1, 7])
def test_a_tree_is_the_one_mllib_grows(spark, least):
    """Without weights and with all features at each node nothing is left to chance."""
    import numpy as np
    from pyspark.ml.regression import DecisionTreeRegressor

    from epitally.operators import trees

    rows = spark.range(700).selectExpr(
        "pmod(id * 7919, 701) AS a", "pmod(id * id, 13) AS b", "pow(pmod(id * 31, 97), 2) AS c",
        "IF(id % 9 = 0, id, 0) AS d", "pmod(id * 7919, 701) / 5 + pmod(id * id, 13) * 9 + pmod(hash(id), 997) / 70 AS label",
    )
    ready = written(ft.assembler(("a", "b", "c", "d")).transform(rows).select("features", "label"), "ready")
    theirs = DecisionTreeRegressor(labelCol="label", maxDepth=7, minInstancesPerNode=least).fit(ready)
    values, labels = trees.collected(ready)
    data = trees.binned(values, labels, np.ones(700, bool), 32)
    levels = trees.grow(data, np.ones(700), 0, 42, 7, least, 4)
    mine = trees.predicted(levels, data, np.arange(700), [7])[0]
    wanted = [r.prediction for r in theirs.transform(ready).collect()]
    assert mine.tolist() == pytest.approx(wanted, rel=1e-9)


def test_a_forest_grown_in_tasks_is_saved_as_mllibs(spark, shared):
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import RandomForestRegressionModel

    from epitally.operators.forest import TaskForestRegressor
    from epitally.sinks import models

    train = valid_rows(spark, 150).withColumnRenamed("deaths", "label")
    forest = TaskForestRegressor(labelCol="label", numTrees=12, maxDepth=4, seed=7)
    model = Pipeline(stages=[ft.assembler(), forest]).fit(train)
    loaded = models.load_model(spark, shared, "grown", models.save_model(model, shared, "grown"))
    saved = loaded.stages[-1]
    assert type(saved) is RandomForestRegressionModel
    assert (saved.getNumTrees, saved.getMaxDepth(), saved.getSeed()) == (12, 4, 7)
    assert model.stages[-1].totalNumNodes == saved.totalNumNodes > 12
    assert len(model.stages[-1].trees) == 12
    mine, theirs = (
        [r.prediction for r in m.transform(train).orderBy("population").collect()]
        for m in (model, loaded)
    )
    assert mine == pytest.approx(theirs, rel=1e-12) and len(set(mine)) > 12


def test_a_table_too_large_for_a_task_is_left_to_mllib(spark, monkeypatch):
    from pyspark.ml.regression import RandomForestRegressionModel

    from epitally.operators import forest, trees

    monkeypatch.setattr(trees, "TABLE_BYTES", 1000)
    grid = GridParams((3,), (2, 3), (1,), folds=2)
    train = valid_rows(spark, 90).withColumnRenamed("deaths", "label")
    found = forest.cross_validate(train, grid, keys=("population",))
    assert len(found.avgMetrics) == 2
    assert type(found.bestModel.stages[-1]) is RandomForestRegressionModel


def test_a_search_refuses_a_fold_without_rows(spark):
    from epitally.operators import forest

    train = valid_rows(spark, 1).withColumnRenamed("deaths", "label")
    with pytest.raises(ValueError, match="no rows to fit or to test"):
        forest.cross_validate(train, GridParams((3,), (2,), (1,), folds=2), keys=("population",))
