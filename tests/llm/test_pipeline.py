"""The pipeline against a plain reading of its five stages, on the smallest tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SMALL

import corpus_pipeline
from epitally.llm import bpe, line_dedup, mixing, quality, simhash
from epitally.llm.common import documents, table

SPACE = " \t\x0b\x0c\r"


def masked(line: str) -> str:
    tokens = [t for t in re.split(r"[\x20\x09-\x0D]+", line) if t]
    return " ".join(line_dedup.WILD if re.search("[0-9]", t) else t for t in tokens)


def forms(line: str) -> list[tuple]:
    """The masked line and its templates that count: two ranges generalised, or one where no two do."""
    tokens, out = line.split(" "), [(line,)]
    n, depth, ranges = len(tokens), line_dedup.DEPTH, line_dedup.RANGES
    if n < line_dedup.LEAST_TOKENS:
        return out
    edges = [depth + (n - depth) * i // ranges for i in range(ranges + 1)]
    size = [b - a for a, b in zip(edges, edges[1:])]
    least = min(s for s in size if s)

    def counts(length: int) -> bool:
        return (n - length - tokens.count(line_dedup.WILD)) * 10 >= n * line_dedup.CONSTANT_TENTHS

    def template(*gone: int) -> tuple:
        own = [t for g in gone for t in range(edges[g], edges[g + 1])]
        return n, gone, *[None if i in own else t for i, t in enumerate(tokens)]

    for i in range(ranges):
        if size[i] and counts(size[i]) and not counts(size[i] + least):
            out.append(template(i))
        for j in range(i):
            if size[i] and size[j] and counts(size[i] + size[j]):
                out.append(template(j, i))
    return out


def without_lines(docs: dict[int, str]) -> dict[int, str]:
    holders = defaultdict(set)
    for key, text in docs.items():
        for line in text.split("\n"):
            if m := masked(line):
                for f in forms(m):
                    holders[f].add(key)
    first = {f: min(keys) for f, keys in holders.items() if len(keys) > 1}

    def stays(key: int, line: str) -> bool:
        m = masked(line)
        return not m or all(first.get(f, key) == key for f in forms(m))

    return {
        k: "\n".join(x for x in t.split("\n") if stays(k, x)) for k, t in docs.items()
    }


def one_of_each(docs: dict[int, str]) -> dict[int, str]:
    prints = {k: simhash.fingerprint_of(t.encode(), simhash.SHINGLE) for k, t in docs.items()}
    parent = {k: k for k in docs}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(docs)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (prints[a] ^ prints[b]).bit_count() <= simhash.MOST_DIFFERING:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {k: t for k, t in docs.items() if find(k) == k}


def copies(docs: dict[int, str], source: dict[int, str]) -> dict[int, int]:
    wanted = mixing.Mixture()
    n_of = {k: len(re.findall(r"[^\x20\x09-\x0D]+", t)) for k, t in docs.items()}
    tokens = Counter()
    for k, n in n_of.items():
        tokens[source[k]] += n
    tokens = {s: n for s, n in tokens.items() if n}
    total = sum(tokens.values())
    share = {s: n / total for s, n in tokens.items()}

    def entropy(a):
        z = sum(p**a for p in share.values())
        return -sum(p**a / z * math.log(p**a / z) for p in share.values())

    low, high = 0, mixing.STEPS
    while low < high:
        mid = (low + high + 1) // 2
        if entropy(mid / mixing.STEPS) >= wanted.entropy * math.log(len(share)) - 1e-9:
            low = mid
        else:
            high = mid - 1
    a = low / mixing.STEPS
    z = sum(p**a for p in share.values())
    budget = z / min(share[s] ** a / tokens[s] for s in share)
    most = max(share[s] ** a / z * budget / tokens[s] for s in share)
    assert most <= wanted.repeats, "the limit of repeats does not bind in these tables"
    out = {}
    for s, whole in tokens.items():
        quota = round(share[s] ** a / z * budget)
        places = {}
        for k in (k for k in docs if source[k] == s):
            own = hashlib.md5(f"{wanted.seed}|{k}|{n_of[k]}".encode()).hexdigest()
            block = int(own[:8], 16) % mixing.BLOCKS
            turn = hashlib.md5(f"block {wanted.seed}|{s}|{block}".encode()).hexdigest()
            places[k] = turn + own
        run = 0
        for k in sorted(places, key=places.get):
            run += n_of[k]
            out[k] = quota // whole + (run <= quota % whole)
    return {k: out.get(k, 1) for k in docs}


@pytest.fixture(scope="module")
def expected(spark):
    docs = documents(spark, SMALL)
    model = quality.train(docs, table(spark, SMALL, "labels"))
    rows = {r.doc_id: r for r in docs.collect()}
    texts = {}
    for k, r in rows.items():
        column = pa.array([r.text])
        n, _, _, _, repeated = (int(c[0]) for c in quality.rule_counts(column))
        p = quality.probabilities(quality.raw_scores(*quality.text_bytes(column), model), model)
        if n >= 50 and 2 * repeated <= n and p[0] >= quality.LEAST_PROBABILITY:
            texts[k] = r.text
    lines = without_lines(texts)
    single = one_of_each(lines)
    times = copies(single, {k: r.source for k, r in rows.items()})
    return texts, lines, single, times


def test_each_stage_and_the_whole(spark, expected):
    texts, lines, single, times = expected
    docs = documents(spark, SMALL)
    found = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SMALL)
        found.append(sorted((r.doc_id, r.text, r.n_chars) for r in docs.collect()))
    assert [(k, t) for k, t, _ in found[0]] == sorted(texts.items())
    assert [(k, t) for k, t, _ in found[1]] == sorted(lines.items())
    assert all(n == len(t) for _, t, n in found[1])
    assert [(k, t) for k, t, _ in found[2]] == sorted(single.items())
    assert Counter(k for k, _, _ in found[3]) == Counter(times)

    path, pattern = bpe.default_vocabulary()
    library = tiktoken.Encoding(
        "own", pat_str=pattern, mergeable_ranks=bpe.encoder(path, pattern).ranks, special_tokens={}
    )
    assert path == public_tokenizers.path(bpe.VOCABULARY)
    want = []
    for k, n in times.items():
        ids = library.encode_ordinary(single[k])
        digest = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(single[k].encode()).hexdigest()
        want += [(k, len(ids), digest, decoded)] * n
    got = [
        (r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)
        for r in corpus_pipeline.run(spark, SMALL).collect()
    ]
    assert sorted(got) == sorted(want)


def test_clean_documents_stay(spark):
    """Good, long documents without a copy come through whole."""
    base = "/root/testdata/sf0.01"
    docs = documents(spark, base)
    good = table(spark, base, "labels").where("quality = 1").select("doc_id")
    kept = corpus_pipeline.quality_rules(spark, docs, base).select("doc_id")
    long_good = docs.join(good, "doc_id").where("size(split(text, ' ')) >= 60").select("doc_id")
    lost = long_good.join(kept, "doc_id", "left_anti").count()
    assert lost <= 0.01 * long_good.count()
