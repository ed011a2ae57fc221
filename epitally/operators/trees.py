"""Regression forests grown tree by tree in tasks, for training tables that fit a task.

MLlib grows all trees of a forest level by level in the driver, with a job for each group of
nodes. For a table of bounded size it is far cheaper to send the table, binned, to every task
once and to grow whole trees there. The method is MLlib's: bins from quantiles of the values,
Poisson weights of the rows for each tree, a random third of the features for each node, the split
that lowers the variance most, each side of a split with a least number of rows.

What is drawn depends on the seed, the number of the tree and the place of a node in it alone. So
a forest of fewer trees is the first part of a larger one, and one of less depth is the top of a
deeper one, split by split; :func:`measures` gives what separate fits of all of them give.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.workspace import ship_code, written

# Bytes of a training table that the driver sends to every task: 940,000 rows of seven features.
TABLE_BYTES = 64 * 2**20
# Trees that one task grows.
TREES_PER_TASK = 10
# MLlib takes a variance below this for none.
NO_VARIANCE = 2.0**-52
# A tree in a row: by node its feature or -1, its left child, its threshold or prediction, and sums.
FOREST_COLUMNS = ["tree", "feature", "left", "value", "count", "total", "squares", "gain"]
FOREST = "tree int" + "".join(f", {name} binary" for name in FOREST_COLUMNS[1:])
# MLlib's own table of the nodes of a saved forest.
NODES = (
    "treeID int, nodeData struct<id int, prediction double, impurity double, "
    "impurityStats array<double>, rawCount long, gain double, leftChild int, rightChild int, "
    "split struct<featureIndex int, leftCategoriesOrThreshold array<double>, numCategories int>>"
)


@dataclass(frozen=True)
class Binned:
    """A training table by bins: ``bins`` has a run of all rows for each feature, ``cuts`` the
    thresholds between the bins of each; a row is learned from where ``learned``."""

    bins: np.ndarray
    cuts: list[np.ndarray]
    labels: np.ndarray
    learned: np.ndarray


@dataclass(frozen=True)
class Level:
    """The nodes of a tree at one depth. ``feature`` is -1 for a leaf; a split sends bins up to
    ``bin`` to node ``left`` of the next level and the others to the node after it."""

    count: np.ndarray
    total: np.ndarray
    squares: np.ndarray
    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    gain: np.ndarray

    @property
    def mean(self) -> np.ndarray:
        return self.total / np.maximum(self.count, 1)

    @property
    def variance(self) -> np.ndarray:
        return (self.squares - self.total * self.mean) / np.maximum(self.count, 1)


def fits_a_task(rows: int, features: int) -> bool:
    return rows * (features + 2) * 8 <= TABLE_BYTES


def collected(prepared: DataFrame, *others: str) -> list[np.ndarray]:
    """Features as a matrix, labels and other columns of ``prepared``, in the order of its rows."""
    table = prepared.select(
        vector_to_array("features").alias("features"), F.col("label").cast("double"), *others
    ).toArrow()
    labels = table["label"].to_numpy()
    if not np.isfinite(labels).all():
        raise ValueError("Labels must be finite numbers")
    values = table["features"].combine_chunks().flatten().to_numpy()
    if not np.isfinite(values).all():
        raise ValueError("Features must be finite")
    shape = (len(labels), -1) if len(labels) else (0, 0)
    return [values.reshape(shape), labels, *(table[c].to_numpy() for c in others)]


def cuts(values: np.ndarray, most: int) -> np.ndarray:
    """Thresholds that part ``values`` into at most ``most`` bins: halfway between neighbours."""
    distinct, counts = np.unique(values, return_counts=True)
    between = distinct[:-1] / 2 + distinct[1:] / 2
    if len(between) < most:
        return between
    # A bin ends as near as possible to each multiple of an equal share of the rows.
    up_to = np.cumsum(counts)
    turn = up_to[:-1] / 2 + up_to[1:] / 2
    share = len(values) / most
    places, place = [], 0
    for i in range(1, most):
        place = max(place, int(np.searchsorted(turn, i * share, side="right")))
        if place >= len(between):
            break
        places.append(place)
        place += 1
    return between[places]


def binned(
    values: np.ndarray, labels: np.ndarray, learned: np.ndarray, max_bins: int
) -> Binned:
    most = min(max_bins, int(learned.sum()))
    found = [cuts(column[learned], most) for column in values.T]
    bins = [np.searchsorted(c, column) for c, column in zip(found, values.T)]
    flat = np.concatenate(bins).astype(np.min_scalar_type(max_bins))
    return Binned(flat, found, labels, learned)


def features_per_node(strategy_trees: int, features: int) -> int:
    """MLlib's "auto" for regression: a third of the features, all for a single tree."""
    return features if strategy_trees == 1 else math.ceil(features / 3)


def _source(seed: int, tree: int) -> np.random.SeedSequence:
    return np.random.SeedSequence([seed % 2**64, tree])


def _scrambled(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _drawn(places: np.ndarray, start: np.uint64, features: int, some: int) -> np.ndarray:
    """``some`` different features for each place of a node in its tree."""
    if some >= features:
        return np.broadcast_to(np.arange(features), (len(places), features))
    node = _scrambled(places * np.uint64(0x9E3779B97F4A7C15) + start)
    feature = np.arange(1, features + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)
    return np.argsort(_scrambled(node[:, None] + feature), axis=1, kind="stable")[:, :some]


def bagged(data: Binned, tree: int, seed: int) -> np.ndarray:
    """How often the tree learns from each row."""
    weights = np.zeros(len(data.labels))
    learned = int(data.learned.sum())
    weights[data.learned] = np.random.default_rng(_source(seed, tree)).poisson(1.0, learned)
    return weights


def grow(
    data: Binned, weights: np.ndarray, tree: int, seed: int, depth: int, least: int, some: int
) -> list[Level]:
    """One tree: all nodes of a level are split at once."""
    total, features = len(data.labels), len(data.cuts)
    width = max(map(len, data.cuts), default=0) + 1
    start = np.uint64(_source(seed, tree).generate_state(1, np.uint64)[0])
    rows = np.flatnonzero(weights)
    w = weights[rows]
    wy = w * data.labels[rows]
    wyy = wy * data.labels[rows]
    at = np.zeros(len(rows), np.intp)
    places = np.ones(1, np.uint64)
    levels: list[Level] = []
    while True:
        nodes = len(places)
        count, sums, squares = (np.bincount(at, x, nodes) for x in (w, wy, wyy))
        level = Level(count, sums, squares, np.full(nodes, -1), np.zeros(nodes, np.intp),
                      np.zeros(nodes, np.intp), np.zeros(nodes))
        levels.append(level)
        if len(levels) > depth:
            return levels
        # With fewer rows no split leaves enough on either side.
        tried = (count >= 2 * least) & (np.abs(level.variance) >= NO_VARIANCE)
        number = np.flatnonzero(tried)
        if not len(number):
            return levels
        kept = tried[at]
        rows, w, wy, wyy, at = rows[kept], w[kept], wy[kept], wyy[kept], at[kept]
        at = (np.cumsum(tried) - 1)[at]
        here = np.arange(len(number))
        n, s = count[number], sums[number]
        drawn = _drawn(places[number], start, features, some)
        for j in range(drawn.shape[1]):
            feature = drawn[:, j]
            cell = at * width + data.bins[(feature * total)[at] + rows]
            size = len(number) * width
            left_n = np.bincount(cell, w, size).reshape(-1, width).cumsum(1)[:, :-1]
            left_s = np.bincount(cell, wy, size).reshape(-1, width).cumsum(1)[:, :-1]
            if not left_n.size:
                continue
            right_n, right_s = n[:, None] - left_n, s[:, None] - left_s
            held = (left_n >= least) & (right_n >= least)
            with np.errstate(divide="ignore", invalid="ignore"):
                spread = left_s * left_s / left_n + right_s * right_s / right_n
            spread[~held] = -np.inf
            best = spread.argmax(1)
            gain = (spread[here, best] - s * s / n) / n
            better = np.flatnonzero(gain > level.gain[number])
            node = number[better]
            level.gain[node], level.feature[node] = gain[better], feature[better]
            level.bin[node] = best[better]
        split = level.feature[number] >= 0
        node = number[split]
        if not len(node):
            return levels
        level.left[node] = 2 * np.arange(len(node))
        kept = split[at]
        rows, w, wy, wyy, at = rows[kept], w[kept], wy[kept], wyy[kept], number[at[kept]]
        right = data.bins[level.feature[at] * total + rows] > level.bin[at]
        at = level.left[at] + right
        places = np.repeat(places[node] * np.uint64(2), 2)
        places[1::2] += np.uint64(1)


def predicted(levels: list[Level], data: Binned, rows: np.ndarray, depths: Sequence[int]) -> np.ndarray:
    """What the tree, cut at each of ``depths``, predicts for ``rows``."""
    found = np.empty((len(depths), len(rows)))
    value = np.empty(len(rows))
    live, at = np.arange(len(rows)), np.zeros(len(rows), np.intp)
    for depth, level in enumerate(levels):
        value[live] = level.mean[at]
        for i, asked in enumerate(depths):
            # The deepest level so far; what lies deeper overwrites it.
            if asked >= depth:
                found[i] = value
        inner = level.feature[at] >= 0
        live, at = live[inner], at[inner]
        right = data.bins[level.feature[at] * len(data.labels) + rows[live]] > level.bin[at]
        at = level.left[at] + right
    return found


def _parts(ends: Sequence[int]) -> list[tuple[int, int]]:
    """Runs of trees ``[first, end)``, each inside or outside of every forest of ``ends`` trees."""
    bounds = sorted({0, *ends, *range(0, max(ends), TREES_PER_TASK)})
    return list(zip(bounds, bounds[1:]))


def measures(
    spark: SparkSession,
    tables: Sequence[Binned],
    settings: Sequence[tuple[int, int, int]],
    seed: int,
    metric: str,
) -> list[list[float]]:
    """For each of ``settings`` (trees, depth, least rows of a node) the metric on each table's
    rows that are not learned from.

    Settings that differ in trees and depth alone share the trees that they have in common.
    """
    features = len(tables[0].cuts)
    groups: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for trees, depth, least in settings:
        groups.setdefault((least, features_per_node(trees, features)), []).append((trees, depth))
    # The largest trees first.
    order = sorted(groups)
    depths = sorted({depth for _, depth, _ in settings})
    ends = sorted({trees for trees, _, _ in settings})
    work = [
        (g, fold, part)
        for g, group in enumerate(order)
        for fold in range(len(tables))
        for part in _parts([trees for trees, _ in groups[group]])
    ]
    deepest = [max(depth for _, depth in groups[group]) for group in order]
    ship_code(spark)
    sent = spark.sparkContext.broadcast(list(tables))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                g, fold, (first, end) = work[i]
                data, (least, some) = sent.value[fold], order[g]
                rows = np.flatnonzero(~data.learned)
                sums = np.zeros((len(depths), len(rows)))
                for tree in range(first, end):
                    weights = bagged(data, tree, seed)
                    levels = grow(data, weights, tree, seed, deepest[g], least, some)
                    sums += predicted(levels, data, rows, depths)
                columns = [np.full(len(rows), g), np.full(len(rows), fold), np.full(len(rows), end),
                           rows, data.labels[rows], *sums]
                names = ["g", "fold", "end", "row", "label", *[f"d{d}" for d in depths]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    schema = "g long, fold long, end long, row long, label double"
    schema += "".join(f", d{d} double" for d in depths)
    named = {(t, d): f"t{t}d{d}" for t in ends for d in depths}
    try:
        sums = spark.range(0, len(work), 1, len(work)).mapInArrow(run, schema)
        rows = sums.groupBy("g", "fold", "row").agg(
            F.first("label").alias("label"),
            *[
                (F.sum(F.when(F.col("end") <= t, F.col(f"d{d}"))) / t).alias(name)
                for (t, d), name in named.items()
            ],
        )
        label = F.col("label")
        facts = [F.avg(label).alias("mean"), F.var_pop(label).alias("spread")]
        for name in named.values():
            p = F.col(name)
            facts += [
                F.avg((label - p) * (label - p)).alias(f"{name}_squared"),
                F.avg(F.abs(label - p)).alias(f"{name}_absolute"),
                F.var_pop(p).alias(f"{name}_spread"),
                F.avg(p).alias(f"{name}_mean"),
            ]
        found = {(r["g"], r["fold"]): r for r in rows.groupBy("g", "fold").agg(*facts).collect()}
    finally:
        sent.destroy()
    return [
        [
            _metric(metric, found[order.index((least, features_per_node(trees, features))), fold],
                    named[trees, depth])
            for fold in range(len(tables))
        ]
        for trees, depth, least in settings
    ]


def _metric(metric: str, facts, name: str) -> float:
    squared = facts[f"{name}_squared"]
    if metric == "rmse":
        return math.sqrt(squared)
    if metric == "mse":
        return squared
    if metric == "mae":
        return facts[f"{name}_absolute"]
    if metric == "var":
        return facts[f"{name}_spread"] + (facts[f"{name}_mean"] - facts["mean"]) ** 2
    if metric == "r2":
        return float(1 - np.float64(squared) / np.float64(facts["spread"]))
    raise ValueError(f"Unsupported metric={metric}")


def _packed(tree: int, levels: list[Level], cuts: list[np.ndarray]) -> pa.RecordBatch:
    """One row of :data:`FOREST`: the nodes of a tree, by level."""
    found = {
        name: np.concatenate([getattr(level, name) for level in levels])
        for name in ("feature", "bin", "count", "total", "squares", "gain", "mean")
    }
    after = np.cumsum([len(level.count) for level in levels])
    left = np.concatenate([level.left + end for level, end in zip(levels, after)])
    thresholds = np.full((len(cuts), max(map(len, cuts), default=0) + 1), np.nan)
    for feature, places in enumerate(cuts):
        thresholds[feature, : len(places)] = places
    inner = found["feature"] >= 0
    value = np.where(inner, thresholds[found["feature"], found["bin"]], found["mean"])
    columns = [found["feature"].astype("<i4"), left.astype("<i4"), value.astype("<f8")]
    columns += [found[name].astype("<f8") for name in ("count", "total", "squares", "gain")]
    packed = [pa.array([tree], pa.int32()), *(pa.array([c.tobytes()], pa.binary()) for c in columns)]
    return pa.RecordBatch.from_arrays(packed, FOREST_COLUMNS)


def grown(
    spark: SparkSession, data: Binned, trees: int, depth: int, least: int, seed: int
) -> DataFrame:
    """The trees of a forest, written."""
    parts, some = _parts([trees]), features_per_node(trees, len(data.cuts))
    ship_code(spark)
    sent = spark.sparkContext.broadcast(data)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in batch.column(0).to_pylist():
                for tree in range(*parts[i]):
                    weights = bagged(sent.value, tree, seed)
                    levels = grow(sent.value, weights, tree, seed, depth, least, some)
                    yield _packed(tree, levels, sent.value.cuts)

    try:
        return written(spark.range(0, len(parts), 1, len(parts)).mapInArrow(run, FOREST), "forest")
    finally:
        sent.destroy()


def shapes(forest: DataFrame) -> list[tuple[np.ndarray, ...]]:
    """What predicting needs of each tree: 16 bytes a node."""
    rows = forest.select("tree", "feature", "left", "value").collect()
    return [
        tuple(np.frombuffer(x, kind) for x, kind in zip(r[1:], ("<i4", "<i4", "<f8")))
        for r in sorted(rows, key=lambda r: r["tree"])
    ]


def forecast(forest: list[tuple[np.ndarray, ...]], values: np.ndarray) -> np.ndarray:
    """The mean of the trees' predictions for each row of ``values``."""
    sums = np.zeros(len(values))
    for feature, left, value in forest:
        at, live = np.zeros(len(values), np.intp), np.arange(len(values))
        while len(live):
            asked = feature[at[live]]
            live, asked = live[asked >= 0], asked[asked >= 0]
            here = at[live]
            at[live] = left[here] + (values[live, asked] > value[here])
        sums += value[at]
    return sums / len(forest)


def forecaster(spark: SparkSession, forest: DataFrame):
    """A function of a column of arrays, the features."""
    ship_code(spark)
    sent = spark.sparkContext.broadcast(shapes(forest))

    @F.arrow_udf("double")
    def run(features: pa.Array) -> pa.Array:
        values = features.flatten().to_numpy(zero_copy_only=False)
        return pa.array(forecast(sent.value, values.reshape(len(features), -1)))

    return run


def _as_nodes(row: dict) -> pa.RecordBatch:
    """Rows of :data:`NODES` from one of :data:`FOREST`."""
    feature, left = (np.frombuffer(row[name], "<i4") for name in ("feature", "left"))
    value, count, total, squares, gain = (
        np.frombuffer(row[name], "<f8") for name in ("value", "count", "total", "squares", "gain")
    )
    inner, nodes = feature >= 0, len(feature)
    held = np.maximum(count, 1)
    offsets = np.concatenate([[0], np.cumsum(inner)])
    split = {
        "featureIndex": pa.array(feature, pa.int32()),
        "leftCategoriesOrThreshold": pa.ListArray.from_arrays(
            pa.array(offsets, pa.int32()), pa.array(value[inner])
        ),
        "numCategories": pa.array(np.full(nodes, -1), pa.int32()),
    }
    data = {
        "id": pa.array(np.arange(nodes), pa.int32()),
        "prediction": pa.array(total / held),
        "impurity": pa.array((squares - total * (total / held)) / held),
        "impurityStats": pa.ListArray.from_arrays(
            pa.array(np.arange(0, 3 * nodes + 1, 3), pa.int32()),
            pa.array(np.stack([count, total, squares], 1).ravel()),
        ),
        "rawCount": pa.array(count.astype(np.int64)),
        "gain": pa.array(np.where(inner, gain, -1.0)),
        "leftChild": pa.array(np.where(inner, left, -1), pa.int32()),
        "rightChild": pa.array(np.where(inner, left + 1, -1), pa.int32()),
        "split": pa.StructArray.from_arrays(list(split.values()), list(split)),
    }
    trees = pa.array(np.full(nodes, row["tree"]), pa.int32())
    found = pa.StructArray.from_arrays(list(data.values()), list(data))
    return pa.RecordBatch.from_arrays([trees, found], ["treeID", "nodeData"])


def write_nodes(forest: DataFrame, path: str) -> None:
    """Write a forest's nodes as MLlib does when it saves one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield _as_nodes(row)

    forest.mapInArrow(run, NODES).write.mode("overwrite").parquet(path)
