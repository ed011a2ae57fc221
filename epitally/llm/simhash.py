"""SimHash near-duplicates with Golay-code fuzzy keys.

A fingerprint has 64 bits in four segments of 16. Two fingerprints with at most three
differing bits have a segment that is equal whose next one (in a ring) differs in at most one
bit: if no segment differs in two bits or more, any equal segment will do, and there is one;
else that one bad segment leaves at most one bit for the other three, so two of them are
equal, and only one of these can have the bad segment as its next.

Equal is a plain key. For "at most one bit" a segment, padded to 23 bits, is decoded by the
perfect binary Golay code: every 23-bit word lies within three bits of exactly one codeword.
A fingerprint takes the codewords of its segment and of all words one bit away, one to six
different ones. If two segments differ in one bit, either one's own codeword is among the
other's, so they share a key. Each key has 16 + 12 + 2 bits, about twenty for a fingerprint.

Only different fingerprints are joined, and links inside a key are kept few: first every
member is compared with the key's smallest, then only members of different components are
compared, those outside the key's largest component with all others. So a group of thousands
of near copies costs about its size, and no link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import slices
from epitally.llm.components import components
from epitally.workspace import written

# Words of a shingle and differing bits, as the contract has them.
SHINGLE = 3
MOST_DIFFERING = 3

# Fixed value: generator polynomial of the binary Golay code of length 23,
# x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1.
GOLAY = 0b110001110101
LENGTH, CHECKS = 23, 11


def _remainder(words: np.ndarray) -> np.ndarray:
    words = words.copy()
    for bit in range(LENGTH - 1, CHECKS - 1, -1):
        words ^= ((words >> bit) & 1) * (GOLAY << (bit - CHECKS))
    return words


@cache
def codeword_index() -> np.ndarray:
    """For each 16-bit segment, padded: the index (top 12 bits) of the nearest codeword."""
    errors = [0]
    for a in range(LENGTH):
        errors.append(1 << a)
        for b in range(a):
            errors.append(1 << a | 1 << b)
            for c in range(b):
                errors.append(1 << a | 1 << b | 1 << c)
    patterns = np.array(errors, np.int64)
    pattern_of = np.zeros(1 << CHECKS, np.int64)
    pattern_of[_remainder(patterns)] = patterns
    # The segment sits in the high bits, so that all of it takes part in the index.
    words = np.arange(1 << 16, dtype=np.int64) << (LENGTH - 16)
    return (words ^ pattern_of[_remainder(words)]) >> CHECKS


@cache
def near_codewords() -> np.ndarray:
    """For each 16-bit segment: indices of its own codeword and of those one bit away."""
    own = codeword_index()
    segments = np.arange(1 << 16)
    return np.stack([own] + [own[segments ^ (1 << b)] for b in range(16)], axis=1)


def fingerprint_of(text: bytes, shingle: int) -> int:
    """One bit for each column set in over half of the shingles' XXH64 (seed 42)."""
    words = text.lower().split()
    if len(words) < shingle:
        runs = [b" ".join(words)] if words else []
    else:
        runs = [b" ".join(x) for x in zip(*(words[i:] for i in range(shingle)))]
    if not runs:
        return 0
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in runs), ">u8", len(runs))
    counts = np.zeros(64, np.int64)
    for at in range(0, len(runs), 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts * 2 > len(runs)).tobytes(), "big")


def fingerprints(docs: DataFrame, text: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``docs`` with ``fingerprint`` (BIGINT) in place of the text.

    A-Z are lower-cased, ASCII white space parts words, shingles count with repeats. Fewer
    words than a shingle: the whole sequence is one. A null text or one without words has
    fingerprint zero. Whole texts, no shuffle.
    """
    kept = [f for f in docs.schema if f.name not in (text, "fingerprint")]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("fingerprint", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                column = part.column(text).cast(pa.binary()).to_pylist()
                found = [fingerprint_of(t or b"", shingle) for t in column]
                signed = pa.array(np.array(found, np.uint64).astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], signed], names=[*names, "fingerprint"]
                )

    return docs.mapInArrow(run, schema)


def fuzzy_keys(distinct: DataFrame) -> DataFrame:
    """``(key, fingerprint)``: the keys of every fingerprint, each once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = near_codewords()
        for batch in batches:
            for at in range(0, batch.num_rows, 1 << 15):
                values = batch.column("fingerprint").slice(at, 1 << 15).to_numpy()
                bits = values.astype(np.uint64)
                parts = [(bits >> np.uint64(16 * i)).astype(np.int64) & 0xFFFF for i in range(4)]
                keys, rows = [], []
                for i in range(4):
                    found = np.sort(near[parts[(i + 1) % 4]], axis=1)
                    fresh = np.ones(found.shape, bool)
                    fresh[:, 1:] = found[:, 1:] != found[:, :-1]
                    row, column = np.nonzero(fresh)
                    keys.append(i << 28 | parts[i][row] << 12 | found[row, column])
                    rows.append(row)
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys)), pa.array(values[row])],
                    names=["key", "fingerprint"],
                )

    return distinct.select("fingerprint").mapInArrow(run, "key long, fingerprint long")


def _close(a: str, b: str, most: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= most


def linked_groups(distinct: DataFrame, most: int = MOST_DIFFERING) -> DataFrame:
    """``(node, root)`` of all fingerprints linked to another one, over any chain of links.

    ``distinct`` has each fingerprint once. ``most`` may not exceed three, what the keys
    promise.
    """
    if not 0 <= most <= MOST_DIFFERING:
        raise ValueError(f"most must be 0 to {MOST_DIFFERING}")
    keys = written(fuzzy_keys(distinct), "keys")
    first = keys.groupBy("key").agg(F.min("fingerprint").alias("a"), F.count("*").alias("n"))
    # What very many rows are joined with is a table of its own here and below: the join then has
    # an exchange on either side, and Spark can split a hot key over tasks.
    shared = written(first.where("n > 1").select("key", "a"), "shared")
    stars = (
        keys.join(shared, "key")
        .where((F.col("a") != F.col("fingerprint")) & _close("a", "fingerprint", most))
        .select("a", F.col("fingerprint").alias("b"))
    )
    stars = written(stars.distinct(), "stars")
    groups = components(stars)

    # Members of shared keys with their component so far; alone, a fingerprint is its own.
    members = (
        keys.join(shared.select("key"), "key")
        .join(groups.withColumnRenamed("node", "fingerprint"), "fingerprint", "left")
        .withColumn("root", F.coalesce("root", "fingerprint"))
    )
    members = written(members, "members")
    sizes = members.groupBy("key", "root").agg(F.count("*").alias("n"))
    main = (
        sizes.groupBy("key")
        .agg(F.max_by("root", F.struct("n", "root")).alias("main"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select("key", "main")
    )
    main = written(main, "main")
    mixed_keys = written(members.join(main, "key"), "mixed")
    outside = mixed_keys.where("root != main").select(
        "key", F.col("root").alias("root_a"), F.col("fingerprint").alias("a")
    )
    inside = mixed_keys.select("key", F.col("root").alias("root_b"), F.col("fingerprint").alias("b"))
    across = (
        outside.join(inside, "key")
        .where((F.col("root_a") != F.col("root_b")) & _close("a", "b", most))
        .select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
        .distinct()
    )
    return components(
        groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(across)
    )


def _grouped(prints: DataFrame, key: str, most: int) -> DataFrame:
    """``prints`` with ``root``, the fingerprint that names the component, and its smallest key."""
    own = written(prints.groupBy("fingerprint").agg(F.min(key).alias("least")), "distinct")
    groups = linked_groups(own, most)
    rooted = own.join(groups, own["fingerprint"] == groups["node"], "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = written(rooted, "rooted")
    named = written(rooted.groupBy("root").agg(F.min("least").alias("component_id")), "named")
    of = rooted.select("fingerprint", "root").join(named, "root")
    return prints.join(of, "fingerprint")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    most: int = MOST_DIFFERING,
) -> DataFrame:
    """``(key, fingerprint, component_id)``: one row for each row of ``docs``.

    ``component_id`` is the smallest key reachable over fingerprints that differ in at most
    ``most`` bits, the row's own included; a component whose keys are all null has a null one.
    Empty and null texts have fingerprint zero and are linked like any other. Equal rows are
    in one component; an empty table gives no rows. Further columns are ignored.

    Fingerprints and keys are written to the shared folder; all else is joins and aggregates
    of narrow rows, with exact copies already one row.
    """
    prints = fingerprints(docs.select(F.col(key), F.col(text)), text, shingle)
    found = _grouped(written(prints, "fingerprints"), key, most)
    return found.select(key, "fingerprint", "component_id")


def one_of_each(rows: DataFrame, found: DataFrame) -> DataFrame:
    """The rows ``(k, t, h, row)`` that stay, one for each root of ``found`` (``k, h, root``)."""
    first = F.min(F.struct(F.col("k").isNull().alias("last"), "k", "h"))
    chosen = found.groupBy("root").agg(first.alias("first"))
    chosen = chosen.select(F.col("first.k").alias("kept_k"), F.col("first.h").alias("kept_h"))
    same = F.col("k").eqNullSafe(F.col("kept_k")) & (F.col("h") == F.col("kept_h"))
    kept = rows.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["k", "h"]).select("row.*")


def keep_one(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
    most: int = MOST_DIFFERING,
) -> DataFrame:
    """One row of ``docs``, with all its columns, for each group of near-duplicates.

    The row with the group's smallest key stays (a null key comes last); among rows with
    that key, the one with the smallest text hash; of rows that agree in key and text, any one.
    Texts without a word form one group. An empty table stays empty.
    """
    rows = docs.select(
        F.col(key).alias("k"), F.col(text).alias("t"), F.xxhash64(text).alias("h"),
        F.struct(*docs.columns).alias("row"),
    )
    prints = fingerprints(rows.select("k", "t", "h"), "t", shingle)
    found = _grouped(written(prints, "fingerprints"), "k", most)
    return one_of_each(rows, found)
