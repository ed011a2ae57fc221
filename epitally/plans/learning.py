"""The learning run: check, clean, split, fit, predict, evaluate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.tuning import CrossValidatorModel
from pyspark.sql import DataFrame

from epitally.operators.evaluate import evaluate
from epitally.operators.features import check_columns, usable_rows
from epitally.operators.forest import (
    ForestParams,
    GridParams,
    cross_validate,
    fit_forest,
    predict,
)
from epitally.operators.split import hash_split, random_split, stratified_split
from epitally.schema import FEATURES, TARGET
from epitally.workspace import dealt, discard, written

SPLITS = ("random", "hash", "stratified")


@dataclass(frozen=True)
class LearningConfig:
    """Settings of a run; ``keys`` identify rows for the hash splits and are kept.

    The stratified split takes the same share of every combination of ``strata``, which are kept as
    well.

    ``materialize`` writes the usable rows once before the split. A fit reads its input
    several times, so turn it off only for input that is a plain scan of files already; the
    random split needs such a table in any case.

    ``train_partitions`` is the number of partitions a fit works on. A forest draws its samples
    by partition, so this number is part of the model's settings, like the seed: the same rows,
    seed and number give the same model on any machine. Raise it for large training data, to
    a few for each core and at most some hundred MB in each.
    """

    features: tuple[str, ...] = FEATURES
    target: str = TARGET
    train_ratio: float = 0.8
    seed: int = 42
    split: str = "random"
    keys: tuple[str, ...] = ()
    strata: tuple[str, ...] = ()
    materialize: bool = True
    train_partitions: int = 16
    forest: ForestParams = field(default_factory=ForestParams)
    cross_validation: bool = False
    grid: GridParams = field(default_factory=GridParams)

    def __post_init__(self) -> None:
        if self.split not in SPLITS:
            raise ValueError(f"Unsupported split={self.split} ({'|'.join(SPLITS)})")
        if self.split == "random" and not self.materialize:
            raise ValueError("the random split needs a written table")
        if self.split == "stratified" and not (self.strata and self.keys):
            raise ValueError("the stratified split needs strata and keys")


@dataclass(frozen=True)
class LearningResult:
    model: PipelineModel
    predictions: DataFrame
    metrics: DataFrame
    scratch: tuple[DataFrame, ...] = ()
    search: CrossValidatorModel | None = None

    def close(self) -> None:
        """Release the cached predictions and delete the written rows."""
        self.predictions.unpersist()
        discard(self.predictions.sparkSession, *self.scratch)


def dealt_rows(train: DataFrame, config: LearningConfig) -> DataFrame:
    """Training rows where and in what order the fit finds them."""
    return dealt(train, config.keys or train.columns, config.train_partitions)


def _usable(df: DataFrame, config: LearningConfig) -> tuple[DataFrame, tuple[DataFrame, ...]]:
    kept = [*config.keys, *[c for c in config.strata if c not in (*config.keys, *config.features)]]
    rows = usable_rows(df, config.features, config.target, kept)
    if not config.materialize:
        return rows, ()
    rows = written(rows, "usable")
    return rows, (rows,)


def _split(rows: DataFrame, config: LearningConfig) -> tuple[DataFrame, DataFrame]:
    if config.split == "hash":
        keys: Sequence[str] = config.keys or rows.columns
        return hash_split(rows, keys, config.train_ratio, config.seed)
    if config.split == "stratified":
        return stratified_split(rows, config.strata, config.keys, config.train_ratio, config.seed)
    return random_split(rows, config.train_ratio, config.seed)


def train_and_test(
    df: DataFrame, config: LearningConfig = LearningConfig()
) -> tuple[DataFrame, DataFrame]:
    """Usable rows in two parts: keys, feature columns and ``label``."""
    return _split(_usable(df, config)[0], config)


def run_learning(df: DataFrame, config: LearningConfig = LearningConfig()) -> LearningResult:
    """Fit on one part of the rows and predict the other.

    Predictions have the keys, ``features``, ``label`` and ``prediction``. They are
    persisted; ``close()`` of the result releases them and deletes what was written. If the
    run fails, it cleans up itself. Training rows are not persisted: they are a narrow columnar
    scan, and the forest keeps its own binned copy for the tree levels.
    """
    check_columns(df, config.features, config.target)
    rows, scratch = _usable(df, config)
    try:
        train, test = _split(rows, config)
        train = dealt_rows(train, config)
        search = None
        if config.cross_validation:
            search = cross_validate(train, config.grid, config.features, config.keys)
            model = search.bestModel
        else:
            model = fit_forest(train, config.forest, config.features)
        predictions = (
            predict(model, test)
            .select(*config.keys, "features", "label", "prediction")
            .persist(StorageLevel.MEMORY_AND_DISK)
        )
    except BaseException:
        discard(df.sparkSession, *scratch)
        raise
    return LearningResult(model, predictions, evaluate(predictions), scratch, search)
