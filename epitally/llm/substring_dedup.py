"""Substring deduplication by repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. Words covered by a window whose words
also start anywhere else are removed.

Candidates. Every window has an anchor: the run of ``GRAM`` words in it with the smallest hash,
the first of equals. Equal windows have equal anchors at the same place, and neighbouring
windows mostly share one, so a document has an anchor for about every fifteenth word. Only
windows whose anchor occurs twice can repeat. Texts that several rows share take part once;
their windows all repeat.

Confirming and locating. A repeated anchor's segment is the words of the windows it is the
anchor of. Segments go to shards by anchor, a few thousand to a shard. In a shard the windows
found twice are confirmed by their words and compiled into an Aho-Corasick automaton over word
numbers, through which all of the shard's segments are streamed to find every occurrence. All
segments of a repeated anchor reach its shard, so every document is streamed through all the
automata that can match it and through no others.

The segments of an anchor meet in one shard. An anchor with more than ``HOT`` occurrences would
make that shard large, so each of its windows is a segment of its own and goes to a shard by its
own hash: equal windows still meet, and the rest spreads. Both ways find the same, by automata.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import hash_pair, run_hashes, slices, span_hashes, text_bytes, word_spans
from epitally.workspace import written

WINDOW = 35
GRAM = 8
HOT = 20_000
SHARD_SEGMENTS = 4_096
# Segments a task remembers to send the words of each but once.
REMEMBERED = 100_000


def anchor_runs(
    data: np.ndarray, offsets: np.ndarray, window: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, first and last window start and text of every anchor, in order; words from 0 in the
    slice."""
    none = np.empty(0, np.int64)
    starts, ends, first = word_spans(data, offsets)
    gram = min(GRAM, window)
    if len(starts) < window:
        return np.empty(0, np.uint64), none, none, none
    grams = run_hashes(span_hashes(data, starts, ends), gram)
    text_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(text_of[: len(text_of) - window + 1] == text_of[window - 1 :])
    if not len(at):
        return np.empty(0, np.uint64), none, none, none
    views = np.lib.stride_tricks.sliding_window_view(grams, window - gram + 1)
    place = np.concatenate(
        [at[i : i + 65536] + views[at[i : i + 65536]].argmin(1) for i in range(0, len(at), 65536)]
    )
    change = np.flatnonzero(place[1:] != place[:-1]) + 1
    begin = np.concatenate([[0], change])
    stop = np.concatenate([change, [len(place)]]) - 1
    return grams[place[begin]], at[begin], at[stop], text_of[at[begin]]


def _anchors(named: DataFrame, text: str, window: int) -> DataFrame:
    """Each row's hashes and anchors; the text goes."""
    kept = [f for f in named.schema if f.name != text]
    names = [f.name for f in kept]
    schema = T.StructType([*kept, T.StructField("anchors", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                hashes, _, _, text_of = anchor_runs(*text_bytes(part.column(text)), window)
                edges = np.searchsorted(text_of, np.arange(part.num_rows + 1)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(edges), pa.array(hashes.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in names], lists], names=[*names, "anchors"]
                )

    return named.mapInArrow(run, schema)


def _occurrences(
    found: DataFrame, text: str, window: int, shards: int, whole: bool
) -> DataFrame:
    """Segments of the wanted anchors of each row, and the windows of the hot ones: hash, row,
    start, and for some the words.

    With ``whole``, rows for the shards: a task sends the words of a segment when it first meets
    it and a bare row when it meets it again, and no more. Without, one row for each occurrence.
    """
    fields = "s1 long, s2 long, shard int, words binary" if whole else "s1 long, s2 long, d1 long, d2 long, start int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for part in slices(batch, text):
                data, offsets = text_bytes(part.column(text))
                wanted, hot = part.column("wanted").to_pylist(), part.column("hot").to_pylist()
                hashes, low, high, text_of = anchor_runs(data, offsets, window)
                edges = np.searchsorted(text_of, np.arange(part.num_rows + 1))
                view = data.tobytes()
                d1, d2 = part.column("d1").to_pylist(), part.column("d2").to_pylist()
                rows = []
                for i in range(part.num_rows):
                    if not wanted[i] and not hot[i]:
                        continue
                    words = view[offsets[i] : offsets[i + 1]].split()
                    base = low[edges[i]]
                    pieces = []
                    for place in wanted[i] or ():
                        j = edges[i] + place
                        shard = int(hashes[j] % np.uint64(shards))
                        pieces.append((int(low[j] - base), int(high[j] - base) + window, shard))
                    for place in hot[i] or ():
                        j = edges[i] + place
                        for start in range(int(low[j] - base), int(high[j] - base) + 1):
                            pieces.append((start, start + window, None))
                    for start, stop, shard in pieces:
                        segment = b" ".join(words[start:stop])
                        digest = xxhash.xxh3_128_digest(segment)
                        s1 = int.from_bytes(digest[:8], "little", signed=True)
                        s2 = int.from_bytes(digest[8:], "little", signed=True)
                        if not whole:
                            rows.append((s1, s2, d1[i], d2[i], start))
                            continue
                        seen[digest] += 1
                        if seen[digest] <= 2:
                            shard = s1 % shards if shard is None else shard
                            rows.append((s1, s2, shard, segment if seen[digest] == 1 else None))
                        if len(seen) > REMEMBERED:
                            seen.clear()
                if rows:
                    columns = list(zip(*rows))
                    kinds = (
                        [pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                        if whole
                        else [pa.int64()] * 4 + [pa.int32()]
                    )
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, k) for c, k in zip(columns, kinds)],
                        names=[f.split()[0] for f in fields.split(", ")],
                    )

    return found.mapInArrow(run, fields)


def covered_spans(segments: dict[tuple[int, int], tuple[list[bytes], bool]], window: int) -> list[tuple]:
    """``(s1, s2, start, stop)`` of what repeated windows cover in the segments of a shard.

    ``segments`` has each segment's words and whether it occurs more than once.
    """
    number: dict[bytes, int] = {}
    coded = {
        key: (tuple(number.setdefault(w, len(number)) for w in words), twice)
        for key, (words, twice) in segments.items()
    }
    counts: Counter = Counter()
    for codes, twice in coded.values():
        for i in range(len(codes) - window + 1):
            counts[codes[i : i + window]] += 1 + twice
    automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
    for phrase, n in counts.items():
        if n > 1:
            automaton.add_word(phrase)
    if not len(automaton):
        return []
    automaton.make_automaton()
    out = []
    for (s1, s2), (codes, _) in coded.items():
        begin = stop = -1
        for last, n in automaton.iter(codes):
            at = last - n + 1
            if at > stop:
                if stop > 0:
                    out.append((s1, s2, begin, stop))
                begin = at
            stop = last + 1
        if stop > 0:
            out.append((s1, s2, begin, stop))
    return out


def _in_shard(window: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        times: Counter = Counter(zip(rows["s1"], rows["s2"]))
        known = {
            (a, b): w.split() for a, b, w in zip(rows["s1"], rows["s2"], rows["words"]) if w is not None
        }
        segments = {k: (w, times[k] > 1) for k, w in known.items()}
        spans = covered_spans(segments, window)
        return pd.DataFrame(spans, columns=["s1", "s2", "a", "b"]).astype(
            {"s1": "int64", "s2": "int64", "a": "int32", "b": "int32"}
        )

    return run


def repeated_spans(
    named: DataFrame, text: str, window: int = WINDOW, hot: int = HOT
) -> DataFrame:
    """``(d1, d2, copied, spans)`` of the rows that lose words.

    ``named`` has ``d1``, ``d2`` (hashes of the whole row), ``t1``, ``t2`` (of its text) and the
    text. ``copied`` says that another row has the same text; ``spans`` are word ranges, each
    ``(a, b)`` from word ``a`` up to but not with ``b``.
    """
    hashes = named.select("d1", "d2", "t1", "t2", text)
    anchored = _anchors(hashes, text, window).withColumn("rid", F.monotonically_increasing_id())
    anchored = written(anchored, "anchors")
    texts = anchored.groupBy("t1", "t2").agg(F.min("rid").alias("rid"), F.count("*").alias("n"))
    texts = written(texts, "texts")
    copied = (
        anchored.select("d1", "d2", "t1", "t2")
        .join(texts.where("n > 1").select("t1", "t2"), ["t1", "t2"], "left_semi")
        .select("d1", "d2")
        .distinct()
    )
    # Written, since it is read twice and joining it moves all anchors.
    single = written(anchored.join(texts.select("rid"), "rid", "left_semi"), "single")
    places = single.select("rid", F.posexplode("anchors").alias("place", "anchor"))
    counts = single.select(F.explode("anchors").alias("anchor")).groupBy("anchor").count()
    repeated = written(counts.where("count > 1"), "repeated")
    is_hot = F.col("count") > hot
    by_row = (
        places.join(repeated, "anchor")
        .groupBy("rid")
        .agg(
            F.collect_list(F.when(~is_hot, F.col("place"))).alias("wanted"),
            F.collect_list(F.when(is_hot, F.col("place"))).alias("hot"),
        )
        .join(single.select("rid", "d1", "d2"), "rid")
        .select(F.col("d1").alias("w1"), F.col("d2").alias("w2"), "wanted", "hot")
    )
    by_row = written(by_row, "wanted")
    total, windows = by_row.agg(
        F.sum(F.size("wanted").cast("long")), F.sum(F.size("hot").cast("long") * window)
    ).first()
    shards = max(1, -(-((total or 0) + (windows or 0)) // SHARD_SEGMENTS))
    shards = min(shards, (1 << 31) - 1)

    same = [named["d1"] == by_row["w1"], named["d2"] == by_row["w2"]]
    found = named.join(by_row, same, "left").drop("w1", "w2", "t1", "t2")
    marked = (
        _occurrences(found, text, window, shards, True)
        .groupBy("shard")
        .applyInPandas(_in_shard(window), "s1 long, s2 long, a int, b int")
    )
    spans = (
        _occurrences(found, text, window, shards, False)
        .join(marked, ["s1", "s2"])
        .select("d1", "d2", (F.col("start") + F.col("a")).alias("a"), (F.col("start") + F.col("b")).alias("b"))
    )
    each = spans.select("d1", "d2", F.struct("a", "b").alias("span"), F.lit(False).alias("copy"))
    copies = copied.select("d1", "d2", F.lit(None).cast("struct<a:int,b:int>").alias("span"), F.lit(True).alias("copy"))
    return (
        each.unionByName(copies)
        .groupBy(F.col("d1").alias("r1"), F.col("d2").alias("r2"))
        .agg(F.collect_list("span").alias("spans"), F.max("copy").alias("copied"))
    )


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, hot: int = HOT
) -> DataFrame:
    """``docs`` with the repeated words gone, and ``n_words``, ``n_removed``, ``removed``.

    The text left has its words joined by one space; a row that loses none is rewritten so too.
    ``removed`` lists the word ranges taken out. A null text is empty with no words; rows equal
    in all columns are copies of each other, so their words go if there are enough for a
    window. Every occurrence goes, none is kept as the first. An empty table stays empty; other
    columns are kept, those named like the added ones replaced.
    """
    docs = docs.drop("n_words", "n_removed", "removed")
    whole = F.coalesce(F.col(text), F.lit(""))
    t1, t2 = hash_pair(whole)
    d1, d2 = hash_pair(F.col(key), whole)
    named = docs.select(
        d1.alias("d1"), d2.alias("d2"), t1.alias("t1"), t2.alias("t2"),
        F.struct(*[c for c in docs.columns if c != text]).alias("row"), whole.alias("text_"),
    )
    spans = repeated_spans(named, "text_", window, hot)
    joined = named.join(spans, [named["d1"] == spans["r1"], named["d2"] == spans["r2"]], "left")
    joined = joined.select("row", "text_", "spans", "copied")
    schema = T.StructType(
        [
            joined.schema["row"],
            T.StructField("kept", T.StringType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("removed", T.ArrayType(T.ArrayType(T.IntegerType()))),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_"):
                out = [
                    _without(t, s, bool(c), window)
                    for t, s, c in zip(
                        part.column("text_").cast(pa.binary()).to_pylist(),
                        part.column("spans").to_pylist(),
                        part.column("copied").to_pylist(),
                    )
                ]
                kept, n, removed, spans = zip(*out)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(kept, pa.string()),
                        pa.array(n, pa.int64()),
                        pa.array(removed, pa.int64()),
                        pa.array(spans, pa.list_(pa.list_(pa.int32()))),
                    ],
                    names=["row", "kept", "n_words", "n_removed", "removed"],
                )

    done = joined.mapInArrow(run, schema)
    return done.select(
        *[(F.col("kept") if c == text else F.col("row")[c]).alias(c) for c in docs.columns],
        "n_words", "n_removed", "removed",
    )


def _without(
    text: bytes, spans: list[dict] | None, copied: bool, window: int
) -> tuple[str, int, int, list[list[int]]]:
    words = text.split()
    if copied and len(words) >= window:
        return "", len(words), len(words), [[0, len(words)]]
    merged: list[list[int]] = []
    for a, b in sorted((s["a"], s["b"]) for s in spans or []):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    kept, at = [], 0
    for a, b in merged:
        kept += words[at:a]
        at = b
    kept += words[at:]
    return b" ".join(kept).decode(), len(words), len(words) - len(kept), merged
