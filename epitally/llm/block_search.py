"""Exact nearest neighbours by a block matrix join with int8 tiles.

Every vector ``v`` is quantised once to ``s * q + r`` with whole numbers ``q`` of -127 to 127.
The product of two vectors differs from ``s_u * s_v * (q_u . q_v)`` by at most
``a_u * |r_v| + |r_u| * (a_v + |r_v|)`` with ``a = s * |q|``. A tile multiplies a block of queries
with a block of candidates in these small numbers, which is exact, and gives a lower and an
upper bound for each pair. Pairs whose upper bound reaches the query's bar, the greater of its
last kept score and of the tile's own k-th greatest lower bound, are recomputed in double
precision from the vectors, and the best are merged into the query's heap. No neighbour is lost,
so recall is one.

The join is a grid. Queries are dealt to blocks of a bounded number of rows and candidates to
lanes; a strip of the grid is one block of queries against one lane, which streams past it in
Arrow batches, so a task holds its queries with their heaps and one batch. Rows are dealt by
their number, hence equal or close vectors do not meet in one place. There are about as many
strips as shuffle partitions, or one for each block of queries if those are more; a strip
gives at most k rows a query, and a window over these picks the result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.workspace import written

NEAREST = 20
# Queries a block holds, about: their vectors, codes and heaps take some 100 MB at 64 dimensions.
BLOCK = 1 << 17
# Candidates a lane has at least, about.
LANE = 1 << 12
# Queries of one product tile; its other side is an Arrow batch.
TILE = 1 << 10
# Pairs recomputed at once.
PAIRS = 1 << 15
LARGEST = 127
# More than what rounding in double precision can add to a score, as a share of both lengths.
SLACK = 1e-12


def usable(vector: Column) -> Column:
    """Whether a vector takes part: it is not null, all its components are finite, not all zero."""
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(vector, lambda c: c != 0), F.lit(False))


def by_dimension(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and matrix of the vectors of each length."""
    lengths = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    values = column.flatten().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        yield at, values[(offsets[at][:, None] + np.arange(d))]


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, ``a`` and length of the rest for every row of ``x``."""
    x = x.astype(np.float64)
    with np.errstate(all="ignore"):
        scale = np.abs(x).max(1) / LARGEST
        code = np.nan_to_num(np.rint(x / scale[:, None]))
        code = np.clip(code, -LARGEST, LARGEST)
        own = np.sqrt((code * code).sum(1)) * scale
        rest = x - code * scale[:, None]
        return code.astype(np.int8), scale, own, np.sqrt((rest * rest).sum(1))


def coded(rows: DataFrame) -> DataFrame:
    """``rows`` (``vector`` among their columns) with ``dim``, ``code``, ``scale``, ``own``, ``rest``."""
    added = "dim int, code binary, scale double, own double, rest double"
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL(added).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, x in by_dimension(batch.column("vector")):
                code, scale, own, rest = quantise(x)
                part = batch.take(pa.array(at))
                columns = [
                    pa.array(np.full(len(at), x.shape[1], np.int32)),
                    pa.array([c.tobytes() for c in code], pa.binary()),
                    *[pa.array(c) for c in (scale, own, rest)],
                ]
                yield pa.RecordBatch.from_arrays([*part.columns, *columns], names=schema.names)

    return rows.mapInArrow(run, schema)


class _Side:
    """Vectors of one length, from an Arrow batch."""

    def __init__(self, batch: pa.RecordBatch, at: np.ndarray, vectors: np.ndarray):
        part = batch.take(pa.array(at))
        self.vectors = vectors
        self.number = part.column("no").to_numpy()
        self.known = np.asarray(part.column("id").is_valid())
        self.id = pc.fill_null(part.column("id"), 0).to_numpy()
        codes = b"".join(part.column("code").to_pylist())
        self.codes = np.frombuffer(codes, np.int8).reshape(vectors.shape)
        self.scale, self.own, self.rest = (
            part.column(c).to_numpy() for c in ("scale", "own", "rest")
        )


class _Block:
    """A block of queries with the best candidates met so far."""

    def __init__(self, sides: list[_Side], nearest: int):
        for name in vars(sides[0]):
            setattr(self, name, np.concatenate([getattr(s, name) for s in sides]))
        order = np.argsort(self.number)
        for name in vars(sides[0]):
            setattr(self, name, getattr(self, name)[order])
        shape = len(self.number), nearest
        # Heaps in order, the best first; an empty place has a candidate number of -1.
        self.best = np.full(shape, -np.inf)
        self.score = np.zeros(shape)
        self.best_id = np.zeros(shape, np.int64)
        self.best_known = np.zeros(shape, bool)
        self.best_number = np.full(shape, -1, np.int64)

    def offer(self, side: _Side) -> None:
        for begin in range(0, len(self.number), TILE):
            self._tile(begin, min(begin + TILE, len(self.number)), side)

    def _tile(self, begin: int, end: int, side: _Side) -> None:
        nearest = self.best.shape[1]
        d = side.codes.shape[1]
        # Sums of products of codes are whole numbers below 2^24, or 2^53: exact either way.
        kind = np.float32 if d * LARGEST * LARGEST < 1 << 24 else np.float64
        with np.errstate(all="ignore"):
            tile = self.codes[begin:end].astype(kind) @ side.codes.astype(kind).T
            near = tile * self.scale[begin:end, None] * side.scale
            whole = side.own + side.rest
            own, rest = self.own[begin:end, None], self.rest[begin:end, None]
            error = own * side.rest + rest * whole + SLACK * (own + rest) * whole
            lower, upper = near - error, near + error
        lower = np.where(np.isnan(lower), -np.inf, lower)
        # A row is not its own neighbour.
        at = np.searchsorted(self.number[begin:end], side.number)
        same = np.flatnonzero(at < end - begin)
        same = same[self.number[begin:end][at[same]] == side.number[same]]
        lower[at[same], same] = -np.inf
        bar = np.where(self.best_number[begin:end, -1] >= 0, self.best[begin:end, -1], -np.inf)
        if tile.shape[1] > nearest:
            place = tile.shape[1] - nearest
            bar = np.maximum(bar, np.partition(lower, place, axis=1)[:, place])
        alive = ~(upper < bar[:, None])
        alive[at[same], same] = False
        row, column = np.nonzero(alive)
        for a in range(0, len(row), PAIRS):
            self._merge(begin + row[a : a + PAIRS], column[a : a + PAIRS], side)

    def _merge(self, row: np.ndarray, column: np.ndarray, side: _Side) -> None:
        """Recompute pairs in double precision and keep the best of them and of the heaps."""
        nearest = self.best.shape[1]
        u, v = self.vectors[row].astype(np.float64), side.vectors[column].astype(np.float64)
        with np.errstate(all="ignore"):
            score = np.einsum("ij,ij->i", u, v)
        key = np.where(np.isnan(score), -np.inf, score)
        full = self.best_number[row, -1] >= 0
        good = ~full | (key >= self.best[row, -1])
        row, column, score, key = row[good], column[good], score[good], key[good]
        if not len(row):
            return
        touched = np.unique(row)
        there, place = np.nonzero(self.best_number[touched] >= 0)
        old = touched[there], place
        owner = np.concatenate([old[0], row])
        columns = [
            np.concatenate([have[old], new])
            for have, new in (
                (self.best, key),
                (self.score, score),
                (self.best_id, side.id[column]),
                (self.best_known, side.known[column]),
                (self.best_number, side.number[column]),
            )
        ]
        key, score, ids, known, number = columns
        order = np.lexsort((number, ids, ~known, -key, owner))
        owner = owner[order]
        first = np.searchsorted(owner, owner, side="left")
        rank = np.arange(len(owner)) - first
        kept = rank < nearest
        target = owner[kept], rank[kept]
        heaps = self.best, self.score, self.best_id, self.best_known, self.best_number
        for heap, values in zip(heaps, columns):
            heap[target] = values[order][kept]

    def rows(self) -> Iterator[pa.RecordBatch]:
        row, place = np.nonzero(self.best_number >= 0)
        for a in range(0, len(row), 1 << 16):
            at = row[a : a + (1 << 16)], place[a : a + (1 << 16)]
            ids = pa.array(self.best_id[at], mask=~self.best_known[at])
            columns = [
                pa.array(self.number[at[0]]),
                pa.array(self.id[at[0]], mask=~self.known[at[0]]),
                pa.array(self.best_number[at]),
                ids,
                pa.array(self.best[at]),
                pa.array(self.score[at]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in FOUND.split(", ")])


FOUND = "query_no long, query_id long, no long, vec_id long, best double, score double"


def _strips(nearest: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strip, waiting, blocks = None, {}, None
        for batch in batches:
            strips = batch.column("strip").to_numpy()
            roles = batch.column("role").to_numpy()
            edges = np.flatnonzero((np.diff(strips) != 0) | (np.diff(roles) != 0)) + 1
            edges = [0, *edges, batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if b == a:
                    continue
                if strips[a] != strip:
                    for block in (blocks or {}).values():
                        yield from block.rows()
                    strip, waiting, blocks = strips[a], {}, None
                part = batch.slice(a, b - a)
                for at, x in by_dimension(part.column("vector")):
                    side = _Side(part, at, x)
                    if roles[a] == 0:
                        waiting.setdefault(x.shape[1], []).append(side)
                        continue
                    if blocks is None:
                        blocks = {d: _Block(s, nearest) for d, s in waiting.items()}
                        waiting = {}
                    if x.shape[1] in blocks:
                        blocks[x.shape[1]].offer(side)
        for block in (blocks or {}).values():
            yield from block.rows()

    return run


def nearest_neighbours(
    vectors: DataFrame,
    queries: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    nearest: int = NEAREST,
    block: int = BLOCK,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the nearest rows of every row that meets ``queries``.

    Candidates are all rows but the query's own; nearness is the inner product in double
    precision of the vectors as given. Ties go to the smaller key, null keys last, and among
    rows with equal keys to any, each at most once. With fewer candidates all of them come back;
    a query without one has no row. Vectors that are null, zero or hold a null or a component
    that is not finite take no part; vectors of unlike lengths are not compared. A product that
    overflows to no number ranks last. Repeated rows are each other's neighbours, and a repeated
    query is answered once a row. ``queries`` is an expression over ``vectors``, where null means
    no. Further columns are ignored.

    Rows are coded and numbered once, in a written table. Queries are sent to every lane and
    candidates to every block of queries: with n rows and q queries, n * ceil(q / block) and
    q * lanes rows are shuffled.
    """
    spark = vectors.sparkSession
    element = vectors.schema[vector].dataType.elementType
    kind = "array<float>" if isinstance(element, T.FloatType) else "array<double>"
    rows = vectors.select(
        F.col(key).cast("long").alias("id"),
        F.col(vector).cast(kind).alias("vector"),
        F.coalesce(queries, F.lit(False)).alias("asks"),
    ).where(usable(F.col("vector")))
    rows = written(coded(rows.withColumn("no", F.monotonically_increasing_id())), "codes")
    size = rows.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks = max(1, math.ceil(size.q / block))
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lanes = max(1, min(math.ceil(partitions / blocks), math.ceil(size.n / LANE)))

    number, other = F.xxhash64("no"), F.xxhash64(F.lit(1), "no")
    sides = [
        rows.where("asks").select(
            "*",
            F.lit(0).alias("role"),
            (F.pmod(number, F.lit(blocks)) * lanes).alias("base"),
            F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("step"),
        ),
        rows.select(
            "*",
            F.lit(1).alias("role"),
            F.pmod(other, F.lit(lanes)).alias("base"),
            F.explode(F.sequence(F.lit(0), F.lit((blocks - 1) * lanes), F.lit(lanes))).alias("step"),
        ),
    ]
    strips = sides[0].unionByName(sides[1]).withColumn("strip", (F.col("base") + F.col("step")).cast("int"))
    strips = strips.drop("base", "step", "asks", "dim")
    strips = strips.repartitionById(blocks * lanes, F.col("strip")).sortWithinPartitions("strip", "role")
    found = strips.mapInArrow(_strips(nearest), FOUND)
    order = [F.col("best").desc(), F.col("vec_id").asc_nulls_last(), F.col("no")]
    ranked = found.withColumn("rank", F.row_number().over(W.partitionBy("query_no").orderBy(*order)))
    return ranked.where(F.col("rank") <= nearest).select("query_id", "rank", "vec_id", "score")


def oracle_sql() -> str:
    """The query's rows for DuckDB, from all pairs."""
    return """
WITH rows AS (
  SELECT row_number() OVER () AS id, vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
pairs AS (
  SELECT q.id, q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score
  FROM rows q JOIN rows c ON q.id <> c.id AND len(q.v) = len(c.v) WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20"""
