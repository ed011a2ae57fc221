"""Mixing sources to target weights by temperature.

A source's weight is its share of all tokens raised to an exponent, normalised. The exponent
is the largest multiple of 2^-20 up to one at which the weights' entropy reaches a target
share of its maximum; if some source would then be repeated more often than the limit, it is
the smallest at which none is. It is found by bisection: each round tries a ladder of
exponents in one aggregate over the sources' totals, which stay in Spark.

The weights are realised with a budget of tokens. Every source's documents are dealt to
blocks by hash, its blocks are permuted by hash, and inside a block documents are in order of
their own hash. Full passes take all documents; the last pass takes the longest prefix of this
order that stays within what is left of the source's budget. That prefix has one end for each
source, found by totals over blocks, then over pieces of the end block, then over documents in
one small piece: no source is ever sorted as a whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from epitally.workspace import written

STEPS = 1 << 20
RUNGS = 32
BLOCKS = 1024
# A block's pieces go by the leading digits of the documents' hashes; blocks take the last ones
# of the first eight, so a block has up to 16^4 pieces, of few documents each.
PIECE_DIGITS = 4
SPACE_RUN = "[\\x20\\x09-\\x0D]+"


@dataclass(frozen=True)
class Mixture:
    """What is asked of a mixture.

    ``entropy``: least entropy of the weights as a share of the logarithm of the number of
    sources. ``repeats``: most passes over a source. ``budget``: tokens in all; by default the
    least budget at which every source is taken whole at least once, so nothing is left out.
    """

    entropy: float = 0.9
    repeats: float = 4.0
    budget: int | None = None
    seed: int = 42


def token_count(text: Column) -> Column:
    """Words between ASCII white space; a null text has none."""
    words = F.split(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), SPACE_RUN)
    return F.when(F.length(F.btrim(text, F.lit(" \t\n\x0b\x0c\r"))) > 0, F.size(words)).otherwise(
        F.lit(0)
    ).cast("long")


def order_keys(source: Column, key: Column, count: Column, seed: int) -> dict[str, Column]:
    """The places of a document in the permutation of its source: block, then own hash."""
    own = F.md5(F.concat_ws("|", F.lit(str(seed)), key.cast("string"), count.cast("string")))
    block = F.conv(F.substring(own, 1, 8), 16, 10).cast("long") % BLOCKS
    turn = F.md5(F.concat_ws("|", F.lit(f"block {seed}"), source, block.cast("string")))
    return {"block": block, "turn": turn, "own": own}


def exponent(totals: DataFrame, wanted: Mixture) -> float:
    """The exponent for ``totals`` (one row a source: ``share``, ``log_share``, ``tokens``).

    Entropy falls and the largest repetition falls as the exponent grows to one. Without a
    budget the largest source has one pass, so repeats are the ratio of the shares to the
    power of one less the exponent.
    """

    def ladder(tries: list[int]) -> list[tuple[float, float]]:
        columns = []
        for i, k in enumerate(tries):
            a = k / STEPS
            p = F.exp(F.lit(a) * F.col("log_share"))
            columns += [
                F.sum(p).alias(f"s{i}"),
                F.sum(p * F.lit(a) * F.col("log_share")).alias(f"l{i}"),
                F.max(p / F.col("tokens")).alias(f"hi{i}"),
                F.min(p / F.col("tokens")).alias(f"lo{i}"),
            ]
        r = totals.agg(F.count("*").alias("n"), *columns).first()
        out = []
        for i in range(len(tries)):
            s, n = r[f"s{i}"], r["n"]
            entropy = math.log(s) - r[f"l{i}"] / s
            reached = n < 2 or entropy >= wanted.entropy * math.log(n) - 1e-9
            if wanted.budget is None:
                most = r[f"hi{i}"] / r[f"lo{i}"]
            else:
                most = wanted.budget * r[f"hi{i}"] / s
            out.append((reached, most <= wanted.repeats + 1e-9))
        return out

    def search(at: int, largest: bool) -> int:
        """The largest step where test ``at`` holds from 0 on, or the smallest from the top."""
        low, high = 0, STEPS
        while low < high:
            width = high - low
            tries = sorted({low + width * i // RUNGS for i in range(1, RUNGS)} | {low, high})
            held = [x[at] for x in ladder(tries)]
            if largest:
                good = [t for t, h in zip(tries, held) if h]
                if not good:
                    return low
                low = max(good)
                later = [t for t in tries if t > low]
                if not later:
                    return low
                high = later[0] - 1
            else:
                good = [t for t, h in zip(tries, held) if h]
                if not good:
                    return high
                high = min(good)
                earlier = [t for t in tries if t < high]
                if not earlier:
                    return high
                low = earlier[-1] + 1
        return low

    flat, limited = search(0, True), search(1, False)
    return max(flat, limited) / STEPS


def _cut(rows: DataFrame, left: DataFrame, by: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Follow each source's order one level down.

    ``rows`` has ``source``, the order column ``by`` and ``tokens``; ``left`` the source's
    ``room``. Groups that fit whole come before the group in which the room ends; returned
    are that group with the room left for it, and the last group that fits whole.
    """
    groups = rows.groupBy("source", by).agg(F.sum("tokens").alias("sum"))
    upto = W.partitionBy("source").orderBy(by).rowsBetween(W.unboundedPreceding, 0)
    running = (
        groups.withColumn("upto", F.sum("sum").over(upto))
        .join(left, F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
    )
    running = written(running, label)
    end = running.where(F.col("upto") > F.col("room")).groupBy("source").agg(
        F.min(by).alias(by), F.min("upto").alias("u"), F.min_by("sum", by).alias("s"),
        F.first("room").alias("room"),
    )
    within = running.where(F.col("upto") <= F.col("room")).groupBy("source").agg(F.max(by).alias(by))
    room = F.col("room") - (F.col("u") - F.col("s"))
    return end.select(F.col("source").alias("of"), F.col(by).alias(f"end_{by}"), room.alias("room")), (
        within.select(F.col("source").alias("of"), F.col(by).alias(f"last_{by}"))
    )


def plan(
    docs: DataFrame,
    wanted: Mixture = Mixture(),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> tuple[DataFrame, float]:
    """``(of, weight, passes, cut)`` for every source, and the exponent.

    ``cut`` is the last place, ``turn`` and own hash in one string, that the extra pass takes;
    null if it takes nothing. Sources without a token get one pass. A null source is a source.
    """
    narrow = docs.select(
        F.col(source).alias("source"), F.col(key).alias("key"), token_count(F.col(text)).alias("tokens")
    )
    places = order_keys(F.col("source"), F.col("key"), F.col("tokens"), wanted.seed)
    narrow = written(
        narrow.withColumns({"turn": places["turn"], "own": places["own"]}).drop("key"), "mix"
    )
    totals = narrow.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    totals = written(totals.where("tokens > 0"), "totals")
    everything = totals.agg(F.sum("tokens")).first()[0] or 0
    share = F.col("tokens") / F.lit(float(everything or 1))
    totals = totals.withColumns({"share": share, "log_share": F.log(share)})
    alpha = exponent(totals, wanted) if everything else 1.0
    powers = totals.withColumn("p", F.exp(F.lit(alpha) * F.col("log_share")))
    s, low = powers.agg(F.sum("p"), F.min(F.col("p") / F.col("tokens"))).first()
    budget = wanted.budget if wanted.budget is not None else (s / low if low else 0.0)
    weight = F.col("p") / F.lit(s or 1.0)
    quota = F.round(weight * F.lit(float(budget))).cast("long")
    shares = powers.select(
        F.col("source").alias("of"),
        weight.alias("weight"),
        F.floor(quota / F.col("tokens")).cast("long").alias("passes"),
        (quota % F.col("tokens")).alias("room"),
    )
    shares = written(shares, "shares")

    left = shares.select("of", "room")
    end, blocks = _cut(narrow, left, "turn", "turns")
    inside = narrow.join(
        end.select("of", "end_turn"),
        F.col("source").eqNullSafe(F.col("of")) & (F.col("turn") == F.col("end_turn")),
    ).select("source", "turn", "own", F.substring("own", 1, PIECE_DIGITS).alias("piece"), "tokens")
    inside = written(inside, "inside")
    piece_end, pieces = _cut(inside, end.select("of", "room"), "piece", "pieces")
    last = inside.join(
        piece_end.select("of", "end_piece"),
        F.col("source").eqNullSafe(F.col("of")) & (F.col("piece") == F.col("end_piece")),
    )
    _, owns = _cut(last.drop("of"), piece_end.select("of", "room"), "own", "owns")

    def joined(a: DataFrame, b: DataFrame, name: str) -> DataFrame:
        b = b.withColumnRenamed("of", name)
        return a.join(b, F.col("of").eqNullSafe(F.col(name)), "left").drop(name)

    cuts = joined(joined(joined(joined(shares, end.drop("room"), "o1"), blocks, "o2"), pieces, "o3"), owns, "o4")
    # "~" sorts after every hexadecimal digit: the whole of the block or piece named before it.
    cut = F.coalesce(
        F.concat("end_turn", "last_own"),
        F.concat("end_turn", "last_piece", F.lit("~")),
        F.concat("last_turn", F.lit("~")),
    )
    return written(cuts.select("of", "weight", "passes", cut.alias("cut")), "plan"), alpha


def mix(
    docs: DataFrame,
    wanted: Mixture = Mixture(),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """``docs`` with ``mix_tokens``, ``mix_weight``, ``mix_copies``, ``mix_block``, ``mix_place``.

    ``mix_copies`` says how often the document is taken; sorted by pass, then ``mix_place``, a
    source is a sequence of permuted blocks. Rows with equal key, source and number of tokens
    have one place and are taken alike. Columns of those names are replaced. The source table
    is joined by size: Spark broadcasts a small one and else splits a source that holds very
    many rows. No text is shuffled for a small one.
    """
    added = ["mix_tokens", "mix_weight", "mix_copies", "mix_block", "mix_place"]
    docs = docs.drop(*added)
    shares, _ = plan(docs, wanted, key, text, source)
    rows = docs.select(
        F.struct(*docs.columns).alias("row"),
        F.col(source).alias("source"),
        F.col(key).alias("key"),
        token_count(F.col(text)).alias("mix_tokens"),
    )
    places = order_keys(F.col("source"), F.col("key"), F.col("mix_tokens"), wanted.seed)
    rows = rows.withColumns(
        {"mix_block": places["block"], "mix_place": F.concat(places["turn"], places["own"])}
    )
    found = rows.join(shares, F.col("source").eqNullSafe(F.col("of")), "left")
    extra = F.coalesce(F.col("mix_place") <= F.col("cut"), F.lit(False)).cast("long")
    return found.select(
        "row.*",
        "mix_tokens",
        F.coalesce("weight", F.lit(0.0)).alias("mix_weight"),
        F.coalesce(F.col("passes") + extra, F.lit(1)).alias("mix_copies"),
        "mix_block",
        "mix_place",
    )


def realise(
    docs: DataFrame,
    wanted: Mixture = Mixture(),
    key: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """The rows of ``docs``, each as often as the mixture takes it."""
    mixed = mix(docs, wanted, key, text, source).where("mix_copies > 0")
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix_copies")))
    return mixed.select(F.struct(*docs.columns).alias("row"), times.alias("time")).select("row.*")


def oracle_sql(wanted: Mixture = Mixture()) -> str:
    """The same by trying every exponent and by a running total over each whole source.

    For the default budget.
    """
    blank = " || ".join(["' '", *[f"chr({c})" for c in range(9, 14)]])
    return f"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN trim(coalesce(text, ''), {blank}) = '' THEN 0 ELSE
    len(regexp_split_to_array(trim(text, {blank}), '{SPACE_RUN}')) END AS n_tokens
  FROM documents),
o AS (
  SELECT *, md5('{wanted.seed}|' || CAST(doc_id AS VARCHAR) || '|' || CAST(n_tokens AS VARCHAR)) AS own
  FROM d),
b AS (SELECT *, CAST('0x' || substr(own, 1, 8) AS BIGINT) % {BLOCKS} AS block FROM o),
t AS (SELECT *, md5('block {wanted.seed}|' || source || '|' || CAST(block AS VARCHAR)) AS turn FROM b),
s AS (SELECT source, sum(n_tokens) AS tokens FROM d GROUP BY source HAVING sum(n_tokens) > 0),
p AS (SELECT *, ln(tokens / CAST((SELECT sum(tokens) FROM s) AS DOUBLE)) AS lp FROM s),
a AS (
  SELECT k, count(*) AS n, sum(exp(k / {STEPS}.0E0 * lp)) AS z,
    sum(exp(k / {STEPS}.0E0 * lp) * (k / {STEPS}.0E0) * lp) AS l,
    max(exp(k / {STEPS}.0E0 * lp) / tokens) AS hi, min(exp(k / {STEPS}.0E0 * lp) / tokens) AS lo
  FROM p, range({STEPS + 1}) AS r(k) GROUP BY k),
x AS (
  SELECT greatest(
    coalesce(max(k) FILTER (n < 2 OR ln(z) - l / z >= {wanted.entropy} * ln(n) - 1e-9), 0),
    coalesce(min(k) FILTER (hi / lo <= {wanted.repeats} + 1e-9), {STEPS})) / {STEPS}.0E0 AS alpha
  FROM a),
w AS (SELECT source, tokens, exp(alpha * lp) AS p FROM p, x),
q AS (
  SELECT source, tokens, p / (SELECT sum(p) FROM w) AS weight, CAST(round(p / (SELECT sum(p) FROM w)
    * ((SELECT sum(p) FROM w) / (SELECT min(p / tokens) FROM w))) AS BIGINT) AS quota
  FROM w),
u AS (
  SELECT *, sum(n_tokens) OVER (PARTITION BY source ORDER BY turn, own
    RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM t)
SELECT doc_id, u.source, CAST(n_tokens AS BIGINT) AS n_tokens, round(coalesce(weight, 0.0E0), 9) AS weight,
  CAST(coalesce(quota // tokens + CASE WHEN upto <= quota % tokens THEN 1 ELSE 0 END, 1) AS BIGINT) AS copies,
  block
FROM u LEFT JOIN q ON q.source IS NOT DISTINCT FROM u.source"""
