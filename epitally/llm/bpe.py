"""Byte-level BPE: encoding in two tiers, and decoding.

A text is split by the tokenizer's pattern. A pre-token that is itself in the vocabulary is
found by a minimal perfect hash over the vocabulary: one displacement for each bucket, as many
slots as tokens, and one comparison of bytes, since the hash also maps strangers to a slot.
Every other pre-token starts as a linked list of its bytes; a heap hands out the adjacent pair
of lowest rank, leftmost first, until none can be merged, in O(n log n) however long it is.

Each task keeps a bounded memo of the pre-tokens met so far. Rows are independent: no shuffle,
and a lost executor costs only its tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from struct import pack

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from epitally.llm.common import slices

VOCABULARY = "byte_bpe_50k.tiktoken"
# Pre-tokens that a task remembers, twice: the memo and the one before it.
MEMO = 200_000
# Ids decoded at once.
DECODE_IDS = 500_000

_MASK = (1 << 64) - 1
_STEP = 0x9E3779B97F4A7C15


def _slot(low: int, displacement: int, n: int) -> int:
    x = (low + displacement * _STEP) & _MASK
    x ^= x >> 29
    x = (x * 0xBF58476D1CE4E5B9) & _MASK
    return (x >> 32) % n


class MinimalPerfectHash:
    """Keys to slots 0 .. n-1, one key to a slot.

    Keys fall into buckets of two on average. The fuller buckets come first and look for a
    displacement that puts all their keys into free slots; a bucket of one key is simply
    given one of the slots that are left, noted as a negative displacement.
    """

    def __init__(self, keys: Sequence[bytes]):
        self.n = n = len(keys)
        self.buckets = max(1, n // 2)
        members: dict[int, list[tuple[int, int]]] = {}
        for i, key in enumerate(keys):
            h = xxhash.xxh3_128_intdigest(key)
            members.setdefault((h >> 64) % self.buckets, []).append((h & _MASK, i))
        displacements, owner = np.zeros(self.buckets, np.int64), np.full(n, -1, np.int64)
        for bucket, own in sorted(members.items(), key=lambda x: (-len(x[1]), x[0])):
            if len(own) == 1:
                continue
            d = 0
            while True:
                taken = [_slot(low, d, n) for low, _ in own]
                if len(set(taken)) == len(taken) and all(owner[s] < 0 for s in taken):
                    break
                d += 1
            displacements[bucket] = d
            for s, (_, i) in zip(taken, own):
                owner[s] = i
        free = iter(np.flatnonzero(owner < 0).tolist())
        for bucket, own in sorted(members.items()):
            if len(own) == 1:
                s = next(free)
                displacements[bucket] = -s - 1
                owner[s] = own[0][1]
        self.displacements, self.owner = displacements.tolist(), owner.tolist()

    def index(self, key: bytes) -> int:
        """The place in ``keys`` of the only key that can equal this one."""
        h = xxhash.xxh3_128_intdigest(key)
        d = self.displacements[(h >> 64) % self.buckets]
        return self.owner[-d - 1 if d < 0 else _slot(h & _MASK, d, self.n)]


class Encoder:
    """The two tiers over one vocabulary."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as lines:
            pairs = [line.split() for line in lines if line.strip()]
        self.tokens = [base64.b64decode(token) for token, _ in pairs]
        self.ids = [int(rank) for _, rank in pairs]
        self.ranks = dict(zip(self.tokens, self.ids))
        self.bytes_of = dict(zip(self.ids, self.tokens))
        self.whole = MinimalPerfectHash(self.tokens)
        self.split = regex.compile(pattern).findall
        # Ids are kept as bytes of 32-bit numbers, so a text's ids are one join of them.
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.packed = [pack("<i", i) for i in self.ids]
        self.packed_of = dict(zip(self.tokens, self.packed))
        lengths = np.zeros(max(self.ids, default=0) + 2, np.int64)
        lengths[np.array(self.ids, np.int64) + 1] = [len(t) for t in self.tokens]
        self.ends = np.cumsum(lengths)
        by_id = sorted(zip(self.ids, self.tokens))
        self.letters = np.frombuffer(b"".join(t for _, t in by_id), np.uint8)

    def pretoken(self, text: str) -> bytes:
        piece = text.encode()
        i = self.whole.index(piece)
        return self.packed[i] if self.tokens[i] == piece else self.merged(piece)

    def looked_up(self, text: str) -> bytes:
        """Ids of a pre-token that the memo does not have.

        A full memo becomes the older one, which is asked once more before it goes; so what
        occurs often stays.
        """
        ids = self.memo.get(text) or self.older.get(text) or self.pretoken(text)
        if len(self.memo) >= MEMO:
            self.older, self.memo = self.memo, {}
        if len(text) <= 64:
            self.memo[text] = ids
        return ids

    def merged(self, piece: bytes) -> bytes:
        n, rank_of = len(piece), self.ranks.get
        # A part is known by its start; end[start] is where the next one starts, 0 once the
        # part has become the tail of another.
        end = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        # A heap entry is one number: rank, start and stop of the pair, in this order.
        width = n.bit_length()
        mask = (1 << width) - 1
        heap = [
            (rank << width | i) << width | i + 2
            for i in range(n - 1)
            if (rank := rank_of(piece[i : i + 2])) is not None
        ]
        heapify(heap)
        while heap:
            entry = heappop(heap)
            stop, i = entry & mask, entry >> width & mask
            j = end[i]
            # Gone, or no longer the pair that was entered.
            if not j or j >= n or end[j] != stop:
                continue
            end[j] = 0
            end[i] = stop
            if stop < n:
                before[stop] = i
                far = end[stop]
                if (rank := rank_of(piece[i:far])) is not None:
                    heappush(heap, (rank << width | i) << width | far)
            if (h := before[i]) >= 0 and (rank := rank_of(piece[h:stop])) is not None:
                heappush(heap, (rank << width | h) << width | stop)
        out, i, packed = [], 0, self.packed_of
        while i < n:
            j = end[i]
            out.append(packed[piece[i:j]])
            i = j
        return b"".join(out)

    def packed_ids(self, text: str) -> bytes:
        known, looked_up = self.memo.get, self.looked_up
        return b"".join([known(t) or looked_up(t) for t in self.split(text)])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed_ids(text), np.int32).tolist()

    def decode(self, ids: Sequence[int]) -> bytes:
        return self.decoded(np.asarray(ids, np.int64)).tobytes()

    def decoded(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of all ids in a row."""
        lengths = self.lengths_of(ids)
        if not len(ids):
            return np.empty(0, np.uint8)
        before = np.cumsum(lengths) - lengths
        at = np.repeat(self.ends[ids] - before, lengths)
        return self.letters[at + np.arange(len(at))]

    def lengths_of(self, ids: np.ndarray) -> np.ndarray:
        if len(ids) and (ids.min() < 0 or ids.max() + 1 >= len(self.ends)):
            raise ValueError("An id that the vocabulary does not have")
        lengths = self.ends[ids + 1] - self.ends[ids]
        if len(ids) and not lengths.all():
            raise ValueError("An id that the vocabulary does not have")
        return lengths


_encoders: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One encoder for each vocabulary and process; it holds the vocabulary only."""
    if (path, pattern) not in _encoders:
        _encoders[path, pattern] = Encoder(path, pattern)
    return _encoders[path, pattern]


def default_vocabulary() -> tuple[str, str]:
    """Path of the rank file and the pattern that splits text, from the installed package."""
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN


def encode(
    docs: DataFrame,
    text: str = "text",
    ids: str = "token_ids",
    vocabulary: tuple[str, str] | None = None,
) -> DataFrame:
    """Add ``ids``, the token ids of every whole text, to all columns of ``docs``.

    A null or empty text has no ids. Equal rows give equal rows; an empty table stays empty.
    A column already named like ``ids`` is replaced. The rank file must be at the same path on
    every executor, as an installed package is.
    """
    path, pattern = vocabulary or default_vocabulary()
    docs = docs.drop(ids)
    schema = T.StructType([*docs.schema.fields, T.StructField(ids, T.ArrayType(T.IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            for part in slices(batch, text):
                packed = [own.packed_ids(t or "") for t in part.column(text).to_pylist()]
                offsets = np.zeros(len(packed) + 1, np.int32)
                np.cumsum([len(x) // 4 for x in packed], out=offsets[1:])
                flat = np.frombuffer(b"".join(packed), np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, column], names=[*part.schema.names, ids]
                )

    return docs.mapInArrow(run, schema)


def decode(
    tokens: DataFrame,
    ids: str = "token_ids",
    decoded: str = "decoded",
    vocabulary: tuple[str, str] | None = None,
) -> DataFrame:
    """Add ``decoded``, the bytes of the ids; null ids give null, an unknown id fails."""
    path, pattern = vocabulary or default_vocabulary()
    tokens = tokens.drop(decoded)
    schema = T.StructType([*tokens.schema.fields, T.StructField(decoded, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path, pattern)
        for batch in batches:
            column = batch.column(ids)
            sizes = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            group = np.cumsum(sizes) // DECODE_IDS
            edges = [0, *(np.flatnonzero(np.diff(group)) + 1), batch.num_rows]
            for a, b in zip(edges, edges[1:]):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                lists = part.column(ids)
                flat = lists.flatten().to_numpy().astype(np.int64)
                ends = np.zeros(len(flat) + 1, np.int64)
                np.cumsum(own.lengths_of(flat), out=ends[1:])
                rows = np.zeros(len(lists) + 1, np.int64)
                np.cumsum(sizes[a:b], out=rows[1:])
                texts = pa.BinaryArray.from_buffers(
                    pa.binary(),
                    len(lists),
                    [None, pa.py_buffer(ends[rows].astype(np.int32)), pa.py_buffer(own.decoded(flat))],
                )
                texts = pc.if_else(lists.is_valid(), texts, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, texts], names=[*part.schema.names, decoded]
                )

    return tokens.mapInArrow(run, schema)


def round_trip_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep_ids: bool = False
) -> DataFrame:
    """For each row: number of ids, digest of the ids, digest of the bytes decoded from them.

    With ``keep_ids`` the ids themselves too, as ``token_ids``.
    """
    coded = decode(encode(docs.select(key, text), text).select(key, "token_ids"))
    return coded.select(
        key,
        F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("token_ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *(["token_ids"] if keep_ids else []),
    )
