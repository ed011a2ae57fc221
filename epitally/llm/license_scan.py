"""License scan: phrases at their places, and an exact set-similarity join with templates.

A block is the set of words in 64 consecutive ones, starting at every 32nd word of a document,
so any span of up to 33 words lies whole in some block. A block meets a template if it
contains at least ``THRESHOLD`` of the template's different words.

The join finds all such pairs. Words that occur in templates are ordered by the number of
blocks that have them, rarest first. A block meeting a template of n words shares at least
``need = ceil(THRESHOLD * n)`` of them, hence at least one of the template's first
``n - need + 1`` in that order (prefix filter); it has at least ``need`` different words
(length filter); and from a shared word on, neither side may have too few words left to reach
``need``, counting those before it (positional filter). Pairs that pass are verified.

Templates are a parameter of bounded size: their prefixes are sent to all tasks. Counts cover
all documents. Blocks are never shuffled; only matches are, which are few.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import slices
from epitally.workspace import written

BLOCK_WORDS = 64
STRIDE = 32
THRESHOLD = 0.85

# Phrases and their labels.
PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

# Wording of public license notices. At most 33 words each, so that a block can hold one.
TEMPLATES = (
    ("mit", "released under the mit license"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this"
        " software and associated documentation files",
    ),
    ("apache", "licensed under the apache license version 2 0"),
    (
        "gpl",
        "this work is licensed under the gnu general public license version 3",
    ),
    (
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms"
        " of the gnu general public license as published by the free software foundation",
    ),
    ("lgpl", "licensed under the gnu lesser general public license version 2 1"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "bsd",
        "redistribution and use in source and binary forms with or without modification are"
        " permitted provided that the following conditions are met",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or"
        " without fee is hereby granted",
    ),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    (
        "cc-by",
        "this work is licensed under a creative commons attribution 4 0 international license",
    ),
    ("all-rights-reserved", "all rights reserved"),
)

_WORD = bytes(
    ord(chr(b).lower()) if chr(b).isalnum() or b >= 0x80 else 0x20 for b in range(128)
) + bytes(range(128, 256))


@dataclass(frozen=True)
class Template:
    """A label, different words, and how many of them a block must have."""

    label: str
    words: tuple[str, ...]
    need: int


def templates(
    given: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD
) -> list[Template]:
    out = []
    for label, text in given:
        words = tuple(sorted(set(w.decode() for w in words_of(text.encode()))))
        if not words:
            raise ValueError(f"Template without words: {label}")
        out.append(Template(label, words, max(1, math.ceil(threshold * len(words) - 1e-9))))
    return out


def words_of(text: bytes) -> list[bytes]:
    """Runs of ASCII digits, letters (in lower case) and bytes of other characters."""
    return text.translate(_WORD).split()


def places(words: list[bytes], phrases: dict[tuple[bytes, ...], str]) -> list[tuple[int, str]]:
    """Where a phrase's words stand one after the other, with its label."""
    found = []
    for phrase, label in phrases.items():
        at, n = -1, len(phrase)
        for _ in range(words.count(phrase[0])):
            at = words.index(phrase[0], at + 1)
            if tuple(words[at : at + n]) == phrase:
                found.append((at, label))
    return sorted(found)


def stride_for(given: Sequence[tuple[str, str]]) -> int:
    """``STRIDE``, or more if a template is too long for it: two strides are a block, and any
    run of up to ``stride + 1`` words lies inside one."""
    longest = max((len(words_of(text.encode())) for _, text in given), default=0)
    return max(STRIDE, longest - 1)


def _scanned(
    docs: DataFrame, key: str, text: str, code: dict[bytes, int], least: int, stride: int = STRIDE
) -> DataFrame:
    """For each row: its phrases' places, and the blocks with at least ``least`` coded words."""
    block_words = stride * BLOCK_WORDS // STRIDE
    phrases = {tuple(p.encode().split()): label for p, label in PHRASES}
    whole = [T.StructField(c, T.LongType()) for c in ("n_words", "n_base", "first_word", "last_word")]
    block = T.StructType(
        [
            T.StructField("block", T.IntegerType()),
            T.StructField("n_distinct", T.IntegerType()),
            T.StructField("codes", T.ArrayType(T.IntegerType())),
        ]
    )
    schema = T.StructType(
        [
            docs.schema[key],
            *whole,
            T.StructField("base", T.ArrayType(T.StringType())),
            T.StructField("blocks", T.ArrayType(block)),
        ]
    )

    def blocks_of(words: list[bytes]) -> Iterator[dict]:
        found = [code.get(w, -1) for w in words]
        for i, at in enumerate(range(0, len(words), stride)):
            own = set(found[at : at + block_words])
            own.discard(-1)
            if len(own) >= least:
                distinct = len(set(words[at : at + block_words]))
                yield {"block": i, "n_distinct": distinct, "codes": sorted(own)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                rows = []
                for t in part.column(text).cast(pa.binary()).to_pylist():
                    words = words_of(t or b"")
                    at = places(words, phrases)
                    rows.append(
                        {
                            "n_words": len(words),
                            "n_base": len(at),
                            "first_word": at[0][0] if at else None,
                            "last_word": at[-1][0] if at else None,
                            "base": sorted({label for _, label in at}),
                            "blocks": list(blocks_of(words)),
                        }
                    )
                columns = {key: part.column(key)}
                for f in schema.fields[1:]:
                    arrow = _ARROW[f.name]
                    columns[f.name] = pa.array([r[f.name] for r in rows], arrow)
                yield pa.RecordBatch.from_pydict(columns)

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, schema)


_ARROW = {
    **{c: pa.int64() for c in ("n_words", "n_base", "first_word", "last_word")},
    "base": pa.list_(pa.string()),
    "blocks": pa.list_(
        pa.struct(
            [("block", pa.int32()), ("n_distinct", pa.int32()), ("codes", pa.list_(pa.int32()))]
        )
    ),
}


def matches(blocks: DataFrame, given: list[Template], code: dict[bytes, int]) -> DataFrame:
    """``(row, block, template, overlap)`` for every block that meets a template.

    ``blocks`` has ``row``, ``block``, ``n_distinct`` and ``codes``, the block's template words.
    """
    spark = blocks.sparkSession
    # As many rows as templates have different words.
    counts = Counter(
        dict(
            blocks.select(F.explode("codes").alias("code")).groupBy("code").count().collect()
        )
    )
    order = sorted(code.values(), key=lambda c: (counts[c], c))
    rank = {c: i for i, c in enumerate(order)}
    rows = []
    for i, t in enumerate(given):
        ranks = sorted(rank[code[w.encode()]] for w in t.words)
        for at in range(len(ranks) - t.need + 1):
            rows.append((ranks[at], at, i, ranks, len(ranks), t.need))
    prefixes = spark.createDataFrame(
        rows, "word int, t_at int, template int, words array<int>, n int, need int"
    )
    ranks = F.array(*[F.lit(rank[c]) for c in range(len(rank))])
    ordered = F.array_sort(F.transform("codes", lambda c: F.get(ranks, c)))
    each = blocks.select("row", "block", "n_distinct", ordered.alias("own"))
    each = each.select("*", F.posexplode("own").alias("b_at", "word"))
    # Shared words up to this one are at most the smaller place on either side, plus itself.
    before = F.least("t_at", "b_at")
    after = F.least(F.col("n") - F.col("t_at") - 1, F.size("own") - F.col("b_at") - 1)
    pairs = each.join(F.broadcast(prefixes), "word").where(
        (F.col("n_distinct") >= F.col("need")) & (before + after + 1 >= F.col("need"))
    )
    # A pair is met once for each shared prefix word; the first of them speaks for it.
    shared = F.array_intersect("own", "words")
    return (
        pairs.withColumn("shared", shared)
        .where((F.size("shared") >= F.col("need")) & (F.get("shared", F.lit(0)) == F.col("word")))
        .select("row", "block", "template", F.size("shared").alias("overlap"), "n")
    )


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    given: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row for each row of ``docs``: counts, places, labels, and the matches themselves.

    Columns: the key, ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels``, ``score``, ``found`` (block, label and containment of every match). ``score``
    is the largest containment found, 1 where a base phrase stands, else 0. A null or empty
    text has no words and no labels; equal rows are scanned each; further columns are ignored.
    """
    wanted = templates(given, threshold)
    vocabulary = sorted({w for t in wanted for w in t.words})
    code = {w.encode(): i for i, w in enumerate(vocabulary)}
    least = min((t.need for t in wanted), default=1)
    scanned = _scanned(docs, key, text, code, least, stride_for(given))
    scanned = written(scanned.withColumn("row", F.monotonically_increasing_id()), "scan")
    blocks = scanned.select("row", F.inline("blocks"))
    labels = F.array(*[F.lit(t.label) for t in wanted])
    met = matches(blocks, wanted, code).select(
        "row",
        F.struct(
            F.col("block"),
            F.get(labels, F.col("template")).alias("label"),
            (F.col("overlap") / F.col("n")).alias("containment"),
        ).alias("m"),
    )
    found = met.groupBy("row").agg(
        F.array_sort(F.collect_list("m")).alias("found"), F.max("m.containment").alias("best")
    )
    joined = scanned.drop("blocks").join(found, "row", "left")
    none = F.array().cast("array<string>")
    method = F.when(F.col("found").isNull(), none).otherwise(F.col("found.label"))
    both = F.array_sort(F.array_distinct(F.concat("base", method)))
    score = F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0)))
    return joined.select(
        key,
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join("base", ",").alias("base_labels"),
        F.array_join(both, ",").alias("labels"),
        score.alias("score"),
        "found",
    )


def oracle_sql() -> str:
    """The same by brute force: every block against every template."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    values = ",\n    ".join(
        f"('{t.label}', [{', '.join(repr(w) for w in t.words)}], {t.need})" for t in templates()
    )
    tests = []
    for phrase, label in PHRASES:
        words = phrase.split()
        same = " AND ".join(f"ws[p + {i + 1}] = '{w}'" for i, w in enumerate(words))
        tests.append((label, f"list_filter(range(len(ws)), lambda p: {same})"))
    at = ", ".join(f"{test} AS at_{label}" for label, test in tests)
    every = " || ".join(f"at_{label}" for label, _ in tests)
    names = " || ".join(
        f"CASE WHEN len(at_{label}) > 0 THEN ['{label}'] ELSE [] END" for label, _ in tests
    )
    return f"""
WITH t(label, words, need) AS (VALUES
    {values}),
w AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), '{upper}', '{lower}'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT r, list_distinct(ws[k * {STRIDE} + 1 : k * {STRIDE} + {BLOCK_WORDS}]) AS bw
  FROM w, LATERAL (SELECT unnest(range(CAST(ceil(len(ws) / {STRIDE}.0) AS BIGINT))) AS k)),
m AS (
  SELECT r, label, need, len(words) AS n, len(list_intersect(bw, words)) AS hits FROM b, t),
f AS (
  SELECT r, list(DISTINCT label) AS labels, max(hits / n) AS best
  FROM m WHERE hits >= need GROUP BY r),
p AS (SELECT r, doc_id, len(ws) AS n_words, {at} FROM w),
q AS (SELECT *, {every} AS every, {names} AS base FROM p)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(len(every) AS BIGINT) AS n_base,
  list_min(every) AS first_word, list_max(every) AS last_word,
  array_to_string(list_sort(base), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(base || coalesce(labels, []))), ',') AS labels,
  CASE WHEN len(every) > 0 THEN 1.0E0 ELSE coalesce(best, 0.0E0) END AS score
FROM q LEFT JOIN f USING (r)"""
