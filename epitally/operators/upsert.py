"""Keyed merge of a batch of changes into a table."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.schema import CASES, KEYS


@dataclass(frozen=True)
class MergeRule:
    """Which columns a new key brings and which of them a known key updates."""

    insert: tuple[str, ...]
    update: tuple[str, ...]
    keys: tuple[str, ...] = KEYS

    def __post_init__(self) -> None:
        clash = [c for c in self.update if c in self.keys]
        if clash:
            raise ValueError(f"Key columns cannot be updated: {', '.join(clash)}")
        lacking = [c for c in (*self.keys, *self.update) if c not in self.insert]
        if lacking:
            raise ValueError(f"Columns not inserted: {', '.join(lacking)}")


# The column lists of the merge rules.
MYSQL = MergeRule(
    insert=(
        "country",
        "updated",
        "iso2",
        "iso3",
        "continent",
        "population",
        "cases",
        "deaths",
        "recovered",
        "active",
        "critical",
    ),
    update=(
        "iso2",
        "iso3",
        "continent",
        "population",
        "cases",
        "deaths",
        "recovered",
        "active",
        "critical",
    ),
)
POSTGRES = MergeRule(
    insert=MYSQL.insert,
    update=("cases", "deaths", "recovered", "active", "critical"),
)
WITH_DAY_COUNTERS = MergeRule(
    insert=(
        "country",
        "updated",
        "iso2",
        "iso3",
        "continent",
        "population",
        "cases",
        "today_cases",
        "deaths",
        "today_deaths",
        "recovered",
        "active",
        "critical",
    ),
    update=("cases", "deaths", "recovered", "active", "critical"),
)


def all_columns_rule(columns: Sequence[str] = CASES.fieldNames(), keys: Sequence[str] = KEYS):
    """Insert every column and update every column outside the key."""
    return MergeRule(tuple(columns), tuple(c for c in columns if c not in keys), tuple(keys))


ALL_COLUMNS = all_columns_rule()

ON_DUPLICATE = ("error", "latest")

STRATEGIES = ("join", "broadcast")

# Parts of a key's copies when they are reduced in dealt tasks.
COPY_PARTS = 16

# Largest batch that may be sent whole to every task.
BROADCAST_BYTES = 64 * 1024 * 1024


def _no_null_keys(rule: MergeRule) -> Column:
    null_key = F.lit(False)
    for k in rule.keys:
        null_key = null_key | F.col(k).isNull()
    return F.when(null_key, F.raise_error("Staged row with a null key").cast("boolean"))


def one_per_key(
    staging: DataFrame,
    rule: MergeRule = MYSQL,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """The staged columns with one row per key; null keys fail.

    ``error`` fails on a repeated key. It numbers the rows of a key in the partitioning and
    order that the merge join needs anyway, so the check costs no shuffle or sort.

    ``latest`` keeps the row greatest by ``order_by``; rows equal in that are told apart by
    their other values, so the choice never depends on partitioning. Copies of a key are
    reduced before the shuffle, which the join reuses.

    ``partitions`` deals the rows by key to so many tasks instead of the session's number. For
    ``latest`` the copies of a key are first reduced in parts, so that a key with very many of
    them is not sorted by one task.

    The checks are filters, which leave the key columns and their partitioning alone.
    """
    if on_duplicate not in ON_DUPLICATE:
        raise ValueError(f"Unsupported on_duplicate={on_duplicate} ({'|'.join(ON_DUPLICATE)})")
    values = [c for c in rule.insert if c not in rule.keys]
    # A filter of its own below the window and the shuffle: rows without a key fail where they
    # are read instead of being hashed to one task first.
    valid = staging.where(_no_null_keys(rule).otherwise(F.lit(True)))
    if on_duplicate == "error":
        if partitions:
            valid = valid.repartition(partitions, *rule.keys)
        within_key = W.partitionBy(*rule.keys).orderBy(*rule.keys)
        repeated = F.raise_error("Staged key occurs more than once").cast("boolean")
        return (
            valid.select(*rule.keys, *values)
            .withColumn("_copy", F.row_number().over(within_key))
            .where(F.when(F.col("_copy") > 1, repeated).otherwise(F.lit(True)))
            .drop("_copy")
        )
    if not order_by:
        raise ValueError("on_duplicate=latest needs order_by columns")
    # A row number kept at 1 limits the rows of a key before the shuffle too. At 586,000 rows it
    # took three quarters of the time of a greatest struct for each key, which is aggregated by
    # sorting on either side of the shuffle.
    order = [F.desc(c) for c in (*order_by, *values)]
    latest = W.partitionBy(*rule.keys).orderBy(*order)
    if partitions:
        part = F.pmod(F.xxhash64(*order_by, *values), F.lit(COPY_PARTS))
        valid = (
            valid.withColumn("_part", part)
            .repartition(partitions, *rule.keys, "_part")
            .withColumn("_copy", F.row_number().over(W.partitionBy(*rule.keys, "_part").orderBy(*order)))
            .where("_copy = 1")
            .repartition(partitions, *rule.keys)
        )
    return (
        valid.withColumn("_copy", F.row_number().over(latest))
        .where("_copy = 1")
        .select(*rule.keys, *values)
    )


def _staged_columns(staging: DataFrame, rule: MergeRule) -> DataFrame:
    return staging.select(*[F.col(c).alias(f"s_{c}") for c in rule.insert])


def _same_key(rule: MergeRule) -> list[Column]:
    return [F.col(k) == F.col(f"s_{k}") for k in rule.keys]


def _check_target(target: DataFrame, rule: MergeRule) -> None:
    absent = [c for c in rule.insert if c not in target.columns]
    if absent:
        raise ValueError(f"Target lacks merge columns: {', '.join(absent)}")


def _typed(target: DataFrame, picked: dict[str, Column]) -> list[Column]:
    return [picked[f.name].cast(f.dataType).alias(f.name) for f in target.schema]


def merge(
    target: DataFrame,
    staging: DataFrame,
    rule: MergeRule = MYSQL,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    partitions: int | None = None,
) -> DataFrame:
    """``target`` with the staged rows merged in, in the target's columns.

    Known key: the rule's update columns take the staged value, null included; the others
    keep theirs. New key: the insert columns are taken and the others are null. Keys only
    in the target stay as they are.

    A single full outer join on the whole key. The key is unique on both sides, so a
    country with very many rows spreads over all join tasks.

    ``partitions`` deals both sides to so many tasks instead of the session's number;
    :func:`epitally.workspace.tasks_for` has one that keeps a task's memory as rows grow.
    """
    _check_target(target, rule)
    staged = _staged_columns(one_per_key(staging, rule, on_duplicate, order_by, partitions), rule)
    if partitions:
        target = target.repartition(partitions, *rule.keys)
    joined = target.withColumn("_known", F.lit(True)).join(
        staged.withColumn("_staged", F.lit(True)), _same_key(rule), "full_outer"
    )
    is_staged, is_new = F.col("_staged").isNotNull(), F.col("_known").isNull()
    picked = {}
    for name in target.columns:
        take = is_staged if name in rule.update else is_new
        kept = F.col(name)
        staged_value = F.col(f"s_{name}") if name in rule.insert else kept
        picked[name] = F.when(take, staged_value).otherwise(kept)
    return joined.select(*_typed(target, picked))


def _merge_broadcast(
    target: DataFrame,
    staging: DataFrame,
    rule: MergeRule,
    on_duplicate: str,
    order_by: Sequence[str],
) -> DataFrame:
    """The result of :func:`merge` without a shuffle of the target, for a small batch.

    The batch goes to every task of the target, which updates its rows in place; the staged
    keys it meets are found by a second scan of the target's keys, and the rest of the batch
    is inserted.
    """
    _check_target(target, rule)
    staged = _staged_columns(one_per_key(staging, rule, on_duplicate, order_by), rule)
    staged_keys = [f"s_{k}" for k in rule.keys]

    changes = F.broadcast(staged.withColumn("_staged", F.lit(True)))
    is_staged = F.col("_staged").isNotNull()
    updated = target.join(changes, _same_key(rule), "left").select(
        *_typed(
            target,
            {
                c: F.when(is_staged, F.col(f"s_{c}")).otherwise(F.col(c))
                if c in rule.update
                else F.col(c)
                for c in target.columns
            },
        )
    )
    met = target.select(*rule.keys).join(
        F.broadcast(staged.select(*staged_keys)), _same_key(rule), "left_semi"
    )
    fresh = staged.join(met, _same_key(rule), "left_anti").select(
        *_typed(
            target,
            {
                c: F.col(f"s_{c}") if c in rule.insert else F.lit(None)
                for c in target.columns
            },
        )
    )
    return updated.unionByName(fresh)


def fits_broadcast(
    staging: DataFrame, rule: MergeRule = MYSQL, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the merge columns of a batch, uncompressed, stay within ``max_bytes``."""
    fixed = texts = 0
    for field in staging.select(*rule.insert).schema:
        if isinstance(field.dataType, T.StringType):
            texts = texts + F.coalesce(F.octet_length(field.name), F.lit(0)).cast("long")
        fixed += 16
    row_bytes = F.lit(fixed) + texts
    total = staging.agg(F.sum(row_bytes)).first()[0] or 0
    return total <= max_bytes


def merge_batch(
    target: DataFrame,
    staging: DataFrame,
    rule: MergeRule = MYSQL,
    on_duplicate: str = "error",
    order_by: Sequence[str] = (),
    strategy: str = "join",
    max_bytes: int = BROADCAST_BYTES,
    partitions: int | None = None,
) -> DataFrame:
    """The result of :func:`merge` by the strategy asked for; both give the same rows.

    ``join`` shuffles both sides by key, to ``partitions`` if given. ``broadcast`` sends the batch to every task and leaves
    the target where it is, which pays for a batch far smaller than the target; the batch is
    measured first, and one of more than ``max_bytes`` is refused. For a broadcast ``staging``
    should be a written table, since it is read three times more.
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"Unsupported strategy={strategy} ({'|'.join(STRATEGIES)})")
    if strategy == "join":
        return merge(target, staging, rule, on_duplicate, order_by, partitions)
    if not fits_broadcast(staging, rule, max_bytes):
        raise ValueError(f"The batch is larger than the {max_bytes} bytes that may be broadcast")
    return _merge_broadcast(target, staging, rule, on_duplicate, order_by)


# The day counters as a landed feed names them, and as the merge rule does.
DAY_COUNTER_NAMES = {"todayCases": "today_cases", "todayDeaths": "today_deaths"}


def rename_day_counters(landed: DataFrame) -> DataFrame:
    """Landed rows with day counters under the names that ``WITH_DAY_COUNTERS`` uses."""
    return landed.withColumnsRenamed(DAY_COUNTER_NAMES)
