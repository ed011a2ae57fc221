"""Random-forest regressors of the target on case counters."""

from __future__ import annotations

import weakref
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from statistics import fmean, pstdev

import numpy as np
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.ml.tuning import CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.functions.expressions import hash_bucket
from epitally.operators import trees
from epitally.operators.features import assembler
from epitally.schema import FEATURES
from epitally.workspace import delete, new_path

FOLD = "fold"

# Driver memory of a tree node: while it grows, in the finished model and in the model's broadcast.
NODE_BYTES = 400


@dataclass(frozen=True)
class ForestParams:
    """Hyperparameters; the defaults are fixed values.

    ``max_memory_mb`` bounds the histograms of one pass over the data: with more of it a
    deep forest needs fewer passes. It changes the cost of a fit, not its settings.
    """

    num_trees: int = 100
    max_depth: int = 10
    max_bins: int = 32
    min_instances_per_node: int = 1
    feature_subset_strategy: str = "auto"
    seed: int = 42
    max_memory_mb: int = 256


@dataclass(frozen=True)
class GridParams:
    """Cross-validation grid and folds; the defaults are fixed values."""

    num_trees: Sequence[int] = (50, 100, 200)
    max_depth: Sequence[int] = (5, 10, 15)
    min_instances_per_node: Sequence[int] = (1, 5, 10)
    folds: int = 3
    parallelism: int = 4
    seed: int = 42
    metric: str = field(default="rmse")
    max_memory_mb: int = 256


def fit_forest(
    train: DataFrame,
    params: ForestParams = ForestParams(),
    features: Sequence[str] = FEATURES,
) -> PipelineModel:
    """Fit on plain feature columns and ``label``.

    The assembler is a stage of the model, so a saved model predicts from case rows.
    """
    forest = RandomForestRegressor(
        featuresCol="features",
        labelCol="label",
        numTrees=params.num_trees,
        maxDepth=params.max_depth,
        maxBins=params.max_bins,
        minInstancesPerNode=params.min_instances_per_node,
        featureSubsetStrategy=params.feature_subset_strategy,
        seed=params.seed,
        maxMemoryInMB=params.max_memory_mb,
    )
    return Pipeline(stages=[assembler(features), forest]).fit(train)


def fit_forest_on_vectors(prepared: DataFrame) -> RandomForestRegressionModel:
    """The minimal variant: a bare model from ``features`` and ``label``."""
    # 100 trees of depth 10, all else as MLlib has it.
    return RandomForestRegressor(
        featuresCol="features", labelCol="label", numTrees=100, maxDepth=10
    ).fit(prepared)


def with_fold(
    rows: DataFrame, keys: Sequence[str], folds: int, seed: int, fold: str = FOLD
) -> DataFrame:
    """``rows`` with the fold each is tested in, by a hash of its key.

    It depends on the key alone, so that a repeated search, on other partitions or after a lost
    executor, tests each row with the same model.
    """
    return rows.withColumn(fold, hash_bucket(keys, seed, folds).cast("int"))


def _most_nodes(rows: int, trees: int, depth: int, least: int) -> int:
    """The most nodes a forest can get: by its depth, and by leaves of ``least`` rows."""
    return trees * min(2 ** (depth + 1), 2 * (rows // least) + 1)


def _at_once(spark: SparkSession, nodes: int, most: int) -> int:
    """How many forests of ``nodes`` half of the driver's memory holds, 1 to ``most``."""
    memory = spark.sparkContext._jvm.java.lang.Runtime.getRuntime().maxMemory()
    return max(1, min(most, memory // 2 // (max(1, nodes) * NODE_BYTES)))


def _forget(spark: SparkSession, path: str) -> None:
    if spark.sparkContext._jsc is not None:
        delete(spark, path)


class TaskForestModel(RandomForestRegressionModel):
    """A forest that grew in tasks, and predicts there from compact arrays of its nodes.

    In the driver a large forest takes far less memory so than as MLlib's objects. Whatever else
    is asked of it, saving included, goes to MLlib's model of the same nodes, loaded then. The
    nodes stay in the shared folder for as long as the model is in use.
    """

    def __init__(self, forest: DataFrame, trees_grown: int, features: int) -> None:
        super().__init__()
        self._forest, self._trees_grown, self._features = forest, trees_grown, features
        self._forecaster = self._mllib = None
        forgets = weakref.finalize(forest, _forget, forest.sparkSession, forest._written_path)
        forgets.atexit = False

    @property
    def getNumTrees(self) -> int:
        return self._trees_grown

    @property
    def trees(self) -> list:
        # A property, which PySpark does not read where it lists parameters.
        return self.in_mllib().trees

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self._forecaster is None:
            self._forecaster = trees.forecaster(dataset.sparkSession, self._forest)
        values = vector_to_array(self.getFeaturesCol())
        return dataset.withColumn(self.getPredictionCol(), self._forecaster(values))

    def in_mllib(self) -> RandomForestRegressionModel:
        if self._mllib is None:
            spark = self._forest.sparkSession
            path = new_path(spark, "model")
            # Names, settings and tree headers of a saved forest come from one of single leaves.
            zeros = array_to_vector(F.array_repeat(F.lit(0.0), self._features))
            one = spark.range(0, 1, 1, 1).select(
                F.lit(0.0).alias(self.getLabelCol()), zeros.alias(self.getFeaturesCol())
            )
            leaves = self._copyValues(RandomForestRegressor()).fit(one)
            try:
                leaves.save(path)
                trees.write_nodes(self._forest, f"{path}/data")
                self._mllib = RandomForestRegressionModel.load(path)
            finally:
                delete(spark, path)
        return self._mllib

    def _call_java(self, name: str, *args):
        return self.in_mllib()._call_java(name, *args)

    def _to_java(self):
        return self.in_mllib()._to_java()


class TaskForestRegressor(RandomForestRegressor):
    """MLlib's regressor, whose trees grow whole in tasks if its table fits a task.

    A larger table is left to MLlib.
    """

    def _fit(self, dataset: DataFrame) -> RandomForestRegressionModel:
        features = F.size(vector_to_array(self.getFeaturesCol()))
        rows, width = dataset.agg(F.count(F.lit(1)), F.max(features)).first()
        if not rows or not trees.fits_a_task(rows, width):
            return super()._fit(dataset)
        values, labels = trees.collected(dataset)
        forest = trees.grown(
            dataset.sparkSession,
            trees.binned(values, labels, np.ones(rows, bool), self.getMaxBins()),
            self.getNumTrees(),
            self.getMaxDepth(),
            self.getMinInstancesPerNode(),
            self.getSeed(),
        )
        return self._copyValues(TaskForestModel(forest, self.getNumTrees(), width))


def _measured_in_tasks(
    prepared: DataFrame,
    settings: Sequence[dict],
    forest: RandomForestRegressor,
    grid: GridParams,
) -> list[list[float]]:
    """Each setting's metric on each fold, with trees grown in tasks."""
    values, labels, folds = trees.collected(prepared, FOLD)
    tables = []
    for fold in range(grid.folds):
        tested = folds == fold
        if tested.all() or not tested.any():
            raise ValueError(f"Fold {fold} has no rows to fit or to test")
        tables.append(trees.binned(values, labels, ~tested, forest.getMaxBins()))
    asked = [(s[forest.numTrees], s[forest.maxDepth], s[forest.minInstancesPerNode]) for s in settings]
    return trees.measures(prepared.sparkSession, tables, asked, grid.seed, grid.metric)


def _measured_in_driver(
    spark: SparkSession,
    folded: DataFrame,
    settings: Sequence[dict],
    estimator: Pipeline,
    evaluator: RegressionEvaluator,
    grid: GridParams,
) -> list[list[float]]:
    """Each setting's metric on each fold, with forests that MLlib grows in the driver.

    Of each size only as many are fitted and evaluated at once as its memory can hold, and at
    most ``parallelism``. One forest must fit in any case.
    """
    forest = estimator.getStages()[-1]
    by_setting: list[list[float]] = [[] for _ in settings]
    for fold in range(grid.folds):
        fitted = folded.where(F.col(FOLD) != fold).cache()
        tested = folded.where(F.col(FOLD) == fold).cache()
        try:
            rows = fitted.count()
            if not rows or tested.isEmpty():
                raise ValueError(f"Fold {fold} has no rows to fit or to test")
            sizes = defaultdict(list)
            for i, s in enumerate(settings):
                of = s[forest.numTrees], s[forest.maxDepth], s[forest.minInstancesPerNode]
                sizes[_at_once(spark, _most_nodes(rows, *of), grid.parallelism)].append(i)

            def measured(i: int) -> float:
                return evaluator.evaluate(estimator.fit(fitted, settings[i]).transform(tested))

            for together, members in sorted(sizes.items(), reverse=True):
                with ThreadPool(together) as pool:
                    # One setting at a time for each thread, not a share of them.
                    found = pool.map(inheritable_thread_target(spark)(measured), members, 1)
                for i, metric in zip(members, found):
                    by_setting[i].append(metric)
        finally:
            fitted.unpersist()
            tested.unpersist()
    return by_setting


def cross_validate(
    train: DataFrame,
    grid: GridParams = GridParams(),
    features: Sequence[str] = FEATURES,
    keys: Sequence[str] = (),
) -> CrossValidatorModel:
    """Search the grid with k-fold validation; ``bestModel`` is a ``PipelineModel``.

    Folds go by a hash of ``keys``, or of the whole row without keys.

    Rows that fit a task are sent to every task, and whole trees grow there; MLlib would need a job
    for each group of nodes of each of the forests. With more rows MLlib grows the forests, in the
    driver's memory.
    """
    forest = TaskForestRegressor(
        featuresCol="features",
        labelCol="label",
        seed=grid.seed,
        maxMemoryInMB=grid.max_memory_mb,
        # Sends the nodes being split to the tasks instead of all trees grown so far.
        cacheNodeIds=True,
    )
    settings = (
        ParamGridBuilder()
        .addGrid(forest.numTrees, list(grid.num_trees))
        .addGrid(forest.maxDepth, list(grid.max_depth))
        .addGrid(forest.minInstancesPerNode, list(grid.min_instances_per_node))
        .build()
    )
    folded = with_fold(train, keys or train.columns, grid.folds, grid.seed)
    spark = train.sparkSession
    estimator = Pipeline(stages=[assembler(features), forest])
    evaluator = RegressionEvaluator(
        metricName=grid.metric, labelCol="label", predictionCol="prediction"
    )
    if trees.fits_a_task(folded.count(), len(features)):
        by_setting = _measured_in_tasks(assembler(features).transform(folded), settings, forest, grid)
    else:
        by_setting = _measured_in_driver(spark, folded, settings, estimator, evaluator, grid)
    means = [fmean(m) for m in by_setting]
    best = means.index((max if evaluator.isLargerBetter() else min)(means))
    model = CrossValidatorModel(
        estimator.fit(folded, settings[best]), means, None, [pstdev(m) for m in by_setting]
    )
    for param, value in (
        (model.estimator, estimator),
        (model.estimatorParamMaps, settings),
        (model.evaluator, evaluator),
        (model.numFolds, grid.folds),
        (model.foldCol, FOLD),
        (model.seed, grid.seed),
    ):
        model.set(param, value)
    return model


def grid_results(model: CrossValidatorModel, spark) -> DataFrame:
    """One row per setting: its hyperparameters, mean metric over the folds, best or not.

    As many rows as the grid has settings; they are results of the fit, not data.
    """
    larger_wins = model.getEvaluator().isLargerBetter()
    best = (max if larger_wins else min)(model.avgMetrics)
    best_at = model.avgMetrics.index(best)
    rows = []
    for i, (setting, metric) in enumerate(zip(model.getEstimatorParamMaps(), model.avgMetrics)):
        by_name = {param.name: value for param, value in setting.items()}
        rows.append(
            (
                by_name["numTrees"],
                by_name["maxDepth"],
                by_name["minInstancesPerNode"],
                float(metric),
                i == best_at,
            )
        )
    return spark.createDataFrame(
        rows,
        "num_trees int, max_depth int, min_instances int, avg_metric double, is_best boolean",
    )


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows of ``df`` with ``features`` and ``prediction``; incomplete rows are skipped."""
    return model.transform(df)
