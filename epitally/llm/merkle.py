"""Merkle manifest of a dataset: lag and lead windows hash trees of three children a node.

Leaves are digests of rows. Inside a group they stand in the order of their key; every three
consecutive nodes of a level become one of the next (the last run may be shorter, even one),
until one is left, the group's root. Groups in order are the leaves of one more such tree.

A band of six levels is computed on the rows of its lowest level. Rows are cut into pieces of
3^6 consecutive ones, which no run crosses, and windows go over a piece, so a hot group spreads
over as many tasks as it has pieces. At level ``l`` a node's digest stands in the row of its
first leaf; lag and lead by 3^l and 2 * 3^l rows then are its siblings, masked by its slot in
the run and the run's length. Rows of first children hash their parent, and every row takes
over what the first row of its node found. One row a piece goes on to the next band, so that
the tables shrink 729-fold, and each band comes back to the one below by one join with even keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epitally.llm.common import ranked
from epitally.workspace import discard, written

RUN = 3
LEVELS = 6
PIECE = RUN**LEVELS
LEAF = ("doc_id", "source", "lang", "n_chars", "text")
STEPS = "array<struct<before:string,after:string>>"


def leaf_digest(values: Sequence[Column]) -> Column:
    """Lowercase hex SHA-256 of the values in a row, each told apart from its neighbours.

    A value is its number of UTF-8 bytes, a colon and itself, numbers in decimals; null is ``-``.
    """
    texts = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(s, F.lit("-")) for s in sized]), 256)


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its siblings, level by level, lead to."""
    return F.aggregate(
        steps, leaf, lambda d, s: F.sha2(F.concat(s["before"], d, s["after"]), 256)
    )


def proof_digest(steps: Column) -> Column:
    """SHA-256 of all siblings, lowest level first and left to right; of nothing without any."""
    siblings = F.transform(steps, lambda s: F.concat(s["before"], s["after"]))
    return F.sha2(F.array_join(siblings, ""), 256)


def _band(nodes: DataFrame) -> DataFrame:
    """``(gid, pos, n, digest, ...)`` with ``piece``, ``steps`` of six levels and ``up``.

    ``up`` is the piece's digest at the band's top, in the row that begins the piece.
    """
    nodes = nodes.withColumn("piece", F.expr(f"pos div {PIECE}"))
    kept = [F.col(c) for c in nodes.columns]
    w = W.partitionBy("gid", "piece").orderBy("pos")
    so_far = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    rows, digest, steps = nodes.withColumn("d", F.col("digest")), "d", []
    for level in range(LEVELS):
        wide = RUN**level
        rows = rows.select(
            *kept,
            "d",
            # What the first row of a node found goes to all rows of the node.
            *[F.last(s, ignorenulls=True).over(so_far).alias(s) if s == f"s{level - 1}" else F.col(s)
              for s in steps],
            F.lag(digest, wide).over(w).alias("b1"),
            F.lag(digest, 2 * wide).over(w).alias("b2"),
            F.lead(digest, wide).over(w).alias("a1"),
            F.lead(digest, 2 * wide).over(w).alias("a2"),
        )
        many = F.expr(f"(n + {wide - 1}) div {wide}")
        at = F.expr(f"pos div {wide}")
        slot = at % RUN
        run = F.least(F.lit(RUN), many - (at - slot))
        before = F.when(slot == 1, F.col("b1")).when(slot == 2, F.concat("b2", "b1")).otherwise("")
        after = (
            F.when((slot == 0) & (run == 3), F.concat("a1", "a2"))
            .when((run == 2) & (slot == 0) | (run == 3) & (slot == 1), F.col("a1"))
            .otherwise("")
        )
        first = (F.col("pos") % wide == 0) & (many > 1)
        step = F.when(first, F.struct(before.alias("before"), after.alias("after")))
        parent = F.when(many > 1, F.sha2(F.concat("d", after), 256)).otherwise(F.col("d"))
        parent = F.when(F.col("pos") % (RUN * wide) == 0, parent)
        rows = rows.select(*kept, *steps, step.alias(f"s{level}"), parent.alias("d"))
        steps.append(f"s{level}")
    last = F.last(steps[-1], ignorenulls=True).over(so_far).alias(steps[-1])
    rows = rows.select(*kept, "d", *steps[:-1], last)
    return rows.select(
        *kept, F.array_compact(F.array(*steps)).cast(STEPS).alias("steps"), F.col("d").alias("up")
    )


def _pieces(band: DataFrame) -> DataFrame:
    """The nodes of the next band, one for each piece."""
    return band.where(F.col("pos") % PIECE == 0).select(
        "gid",
        F.col("piece").alias("pos"),
        F.expr(f"(n + {PIECE - 1}) div {PIECE}").alias("n"),
        F.col("up").alias("digest"),
    )


def _climb(nodes: DataFrame, most: int) -> DataFrame:
    """``(gid, pos, steps, top)``: each node's way to its group's root, and that root.

    ``most`` is the greatest number of nodes of a group.
    """
    if most <= 1:
        none = F.array().cast(STEPS)
        return nodes.select("gid", "pos", none.alias("steps"), F.col("digest").alias("top"))
    band = written(_band(nodes), "band")
    above = _climb(_pieces(band), -(-most // PIECE)).select(
        "gid", F.col("pos").alias("piece"), F.col("steps").alias("more"), "top"
    )
    return band.join(above, ["gid", "piece"]).select(
        "gid", "pos", F.concat("steps", "more").alias("steps"), "top"
    )


def manifest(
    docs: DataFrame,
    key: str = "doc_id",
    group: str = "source",
    columns: Sequence[str] = LEAF,
    also: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``(key, leaf, subroot, root, steps)`` and the columns ``also``: one row for each of ``docs``.

    ``leaf`` is :func:`leaf_digest` of ``columns``, ``subroot`` the root of the row's group and
    ``root`` that of all groups in ascending order; ``steps`` are the siblings before and after
    the row's node at every level with more than one node, through the group's tree to the root.
    ``also`` are expressions over ``docs`` taken in the same scan.

    A null group is a group, the first; null keys come first in a group. Rows with equal keys
    stand in the order of their leaves; rows equal in all columns take consecutive places in any
    order. Empty and null texts are different leaves. An empty table gives no rows. Columns not
    named are ignored, whatever their names.

    Texts are read once and never shuffled. Rows are numbered by ranges of (group, key), so a hot
    group is sorted by many tasks; windows hold at most 729 rows.
    """
    also = dict(also or {})
    leaves = docs.select(
        F.col(key).alias("k"),
        F.col(group).alias("g"),
        leaf_digest([F.col(c) for c in columns]).alias("digest"),
        *[c.alias(f"also_{i}") for i, c in enumerate(also.values())],
    )
    order = [F.col(c) for c in ("g", "k", "digest")]
    placed = ranked(leaves, order, "rank", "leaves")
    sizes = placed.groupBy("g").agg(F.min("rank").alias("begin"), F.count("*").alias("n"))
    groups = written(ranked(sizes, [F.col("g").asc_nulls_first()], "gid", "groups"), "groups")
    size = groups.agg(F.max("n").alias("most"), F.count("*").alias("groups")).first()
    nodes = placed.join(groups.withColumnRenamed("g", "own"), F.col("g").eqNullSafe(F.col("own")))
    nodes = nodes.withColumn("pos", F.col("rank") - F.col("begin")).drop("g", "own", "rank", "begin")
    band = written(_band(nodes), "band")
    pieces = written(_climb(_pieces(band), -(-(size.most or 0) // PIECE)), "pieces")
    discard(docs.sparkSession, groups)

    tops = pieces.where("pos = 0").select(
        F.lit(0).cast("long").alias("gid"),
        F.col("gid").alias("pos"),
        F.lit(size.groups).cast("long").alias("n"),
        F.col("top").alias("digest"),
    )
    tree = _climb(tops, size.groups).select(
        F.col("pos").alias("gid"), F.col("steps").alias("last"), F.col("top").alias("root")
    )
    ways = pieces.join(tree, "gid").select(
        "gid", F.col("pos").alias("piece"), F.concat("steps", "last").alias("more"), "top", "root"
    )
    return band.join(ways, ["gid", "piece"]).select(
        F.col("k").alias(key),
        F.col("digest").alias("leaf"),
        F.col("top").alias("subroot"),
        "root",
        F.concat("steps", "more").alias("steps"),
        *[F.col(f"also_{i}").alias(c) for i, c in enumerate(also)],
    )


def oracle_sql(levels: int = 20) -> str:
    """The query's rows for DuckDB: trees of up to 3^``levels`` nodes, a level at a time."""

    def part(c: str) -> str:
        return f"coalesce(CAST(octet_length(encode(CAST({c} AS VARCHAR))) AS VARCHAR) || ':' || CAST({c} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    step = "list_reduce(range(8), lambda s, i: CASE WHEN s % 2 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END, xor(c, b))"
    crc = f"""xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
        lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: {step}, 4294967295), 4294967295)"""
    parts = [
        f"""docs AS (
  SELECT row_number() OVER () AS id, doc_id, source, {leaf("text")} AS leaf,
    CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf("text")} END AS shown
  FROM documents)""",
        """a0 AS MATERIALIZED (
  SELECT id, source AS g, leaf AS d, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM docs)""",
        "w0 AS MATERIALIZED (SELECT id, g, pos, '' AS proof, shown AS cur FROM a0 JOIN docs USING (id))",
    ]

    def tree(a: str, way: str) -> None:
        for i in range(levels):
            parts.append(
                f"""{a}{i}s AS MATERIALIZED (SELECT g, pos, n,
  coalesce(string_agg(d, '') OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
  coalesce(string_agg(d, '') OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM {a}{i} WHERE n > 1 WINDOW r AS (PARTITION BY g, pos // 3 ORDER BY pos))"""
            )
            parts.append(
                f"""{a}{i + 1} AS MATERIALIZED (SELECT g, pos // 3 AS pos, (n + 2) // 3 AS n,
  CASE WHEN n > 1 THEN sha256(string_agg(d, '' ORDER BY pos)) ELSE min(d) END AS d
  FROM {a}{i} GROUP BY g, pos // 3, n)"""
            )
            parts.append(
                f"""{way}{i + 1} AS MATERIALIZED (SELECT w.id, w.g, w.pos // 3 AS pos,
  CASE WHEN s.n IS NULL THEN proof ELSE proof || l || r END AS proof,
  CASE WHEN s.n IS NULL THEN cur ELSE sha256(l || cur || r) END AS cur
  FROM {way}{i} w LEFT JOIN {a}{i}s s ON w.g IS NOT DISTINCT FROM s.g AND w.pos = s.pos)"""
            )

    tree("a", "w")
    parts.append(
        f"""b0 AS MATERIALIZED (SELECT g AS source, d, 0 AS g, count(*) OVER () AS n,
  row_number() OVER (ORDER BY encode(g) NULLS FIRST) - 1 AS pos FROM a{levels})"""
    )
    parts.append(
        f"""v0 AS MATERIALIZED (SELECT w.id, b.g, b.pos, proof, cur FROM w{levels} w
  JOIN b0 b ON w.g IS NOT DISTINCT FROM b.source)"""
    )
    tree("b", "v")
    return f"""WITH {", ".join(parts)}
SELECT doc_id, leaf, b0.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256,
  cur AS folded_root, cur = top.d AS verified
FROM docs JOIN v{levels} v USING (id) JOIN b0 ON docs.source IS NOT DISTINCT FROM b0.source
CROSS JOIN b{levels} top"""
