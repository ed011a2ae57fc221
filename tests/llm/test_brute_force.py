"""Each text operator against a plain reading of what it should give, on small tables."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import regex
import xxhash
from conftest import SMALL
from pyspark.sql import functions as F

from epitally.llm import (
    bpe,
    catalog,
    components,
    hilbert,
    imatch,
    language,
    license_scan,
    line_dedup,
    mixing,
    quality,
    simhash,
    substring_dedup,
)
from epitally.llm.common import documents, ranked

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def frame(spark, texts, **columns):
    rows = [
        (i, t, *[v[i] for v in columns.values()]) for i, t in enumerate(texts)
    ]
    kinds = "".join(f", {c} string" for c in columns)
    return spark.createDataFrame(rows, f"doc_id long, text string{kinds}")


def lower(text: str) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


@pytest.fixture(scope="module")
def texts(spark):
    rows = documents(spark, SMALL).orderBy("doc_id").collect()
    return [(r.doc_id, r.text) for r in rows]


# 1, line dedup


def test_templates_recur_across_documents(spark):
    tail = "from the central server at noon today"
    docs = [
        f"Job 17 ended in 3 s\nalpha beta gamma\nUser alice logged in {tail}",
        f"Job 4 ended in 99 s\nonly here\nUser alice logged in {tail}",
        f"\nalpha beta gamma\nUser alice logged out {tail}\nonly twice\nonly twice",
        "alpha beta delta",
    ]
    found = {r.doc_id: r for r in line_dedup.drop_lines(frame(spark, docs)).collect()}
    assert found[0].text == docs[0] and found[0].n_dropped == 0
    assert found[1].text == "only here" and (found[1].n_lines, found[1].n_dropped) == (3, 2)
    # One token of eleven differs: the same template. A line repeated in one document stays.
    assert found[2].text == "\nonly twice\nonly twice"
    assert found[3].text == docs[3]


def test_lines_that_differ_in_two_fields_share_a_template(spark):
    lines = [
        f"posted to the {board} board on {day}"
        for board, day in (("travel", "monday"), ("music", "friday"), ("food", "sunday"))
    ]
    found = {r.doc_id: r for r in line_dedup.drop_lines(frame(spark, lines)).collect()}
    assert found[0].text == lines[0] and found[1].text == found[2].text == ""
    # Three fields of seven: less than seven tenths are constant.
    apart = ["posted to the travel board on monday", "posted to the music stage on friday"]
    assert all(r.n_dropped == 0 for r in line_dedup.drop_lines(frame(spark, apart)).collect())


def test_short_lines_do_not_share_a_template(spark):
    docs = ["one two three four", "one two three five"]
    assert all(r.n_dropped == 0 for r in line_dedup.drop_lines(frame(spark, docs)).collect())


# 2, license scan


def test_license_pairs_are_all_found(spark):
    rng = random.Random(4)
    given = license_scan.templates()
    words = sorted({w for t in given for w in t.words} | {f"x{i}" for i in range(40)})
    docs = []
    for i in range(120):
        body = [rng.choice(words) for _ in range(rng.randrange(0, 150))]
        if i % 2:
            t = rng.choice(given)
            own = list(t.words)
            rng.shuffle(own)
            body[20:20] = own[: len(own) - rng.randrange(0, 3)]
        docs.append(" ".join(body))
    got = {r.doc_id: r for r in license_scan.scan(frame(spark, docs)).collect()}
    hits = 0
    for i, text in enumerate(docs):
        ws = TERM.findall(lower(text))
        want = []
        for k in range(math.ceil(len(ws) / 32)):
            block = set(ws[k * 32 : k * 32 + 64])
            for t in given:
                n = len(block & set(t.words))
                if n >= t.need:
                    want.append((k, t.label, n / len(t.words)))
        assert sorted((m.block, m.label, m.containment) for m in got[i].found or []) == sorted(want)
        hits += len(want)
    assert hits > 30


def test_base_phrases(spark):
    docs = ["The MIT-License; mit  license! mit x license", "GNU General\nPublic License, apache license"]
    a, b = license_scan.scan(frame(spark, docs)).orderBy("doc_id").collect()
    assert (a.n_words, a.n_base, a.first_word, a.last_word, a.base_labels) == (8, 2, 1, 3, "mit")
    assert (b.n_base, b.first_word, b.last_word, b.base_labels) == (2, 1, 4, "apache,gpl")
    assert a.score == b.score == 1.0


# 3, mixing


def test_exponent_meets_entropy_and_repeats(spark):
    docs = [("a b c d " * 40, "big")] * 40 + [("a b c d", s) for s in "pqrs"]
    df = frame(spark, [d for d, _ in docs], source=[s for _, s in docs])
    shares, alpha = mixing.plan(df, mixing.Mixture(entropy=0.5, repeats=1e9))
    w = [r.weight for r in shares.collect()]
    assert sum(w) == pytest.approx(1)
    assert -sum(x * math.log(x) for x in w) == pytest.approx(0.5 * math.log(5), abs=1e-4)
    total = {r.source: r.copies for r in mixing.mix(df, mixing.Mixture(entropy=0.5, repeats=3.0))
             .groupBy("source").agg(F.max("mix_copies").alias("copies")).collect()}
    assert total["big"] == 1 and all(total[s] <= 3 for s in "pqrs")
    _, flat = mixing.plan(df, mixing.Mixture(entropy=0.0))
    assert flat == 1.0


def test_budget_is_met_by_a_prefix_of_each_permutation(spark):
    rng = random.Random(2)
    docs = [(" ".join(["w"] * rng.randrange(0, 9)), rng.choice("aab")) for _ in range(400)]
    df = frame(spark, [d for d, _ in docs], source=[s for _, s in docs])
    whole = sum(len(d.split()) for d, _ in docs)
    wanted = mixing.Mixture(entropy=0.999, repeats=9.0, budget=whole // 2)
    shares = {r.of: r for r in mixing.plan(df, wanted)[0].collect()}
    rows = mixing.mix(df, wanted).collect()
    for name, share in shares.items():
        own = sorted((r for r in rows if r.source == name), key=lambda r: r.mix_place)
        tokens = sum(r.mix_tokens for r in own)
        quota = round(share.weight * wanted.budget)
        taken = sum(r.mix_tokens * r.mix_copies for r in own)
        assert quota - 9 < taken <= quota
        copies = [r.mix_copies for r in own]
        assert copies == sorted(copies, reverse=True) and share.passes == quota // tokens
    n = sum(r.mix_copies for r in rows)
    assert mixing.realise(df, wanted).count() == n


# 4, SimHash


def test_golay_keys_meet_within_three_bits():
    own, near = simhash.codeword_index(), simhash.near_codewords()
    assert 0 <= own.min() and own.max() < 4096
    rng = np.random.default_rng(0)
    for _ in range(2000):
        a = int(rng.integers(1 << 63))
        b = a
        for bit in rng.choice(64, int(rng.integers(0, 4)), replace=False):
            b ^= 1 << int(bit)
        pa_, pb = [[(x >> 16 * i) & 0xFFFF for i in range(4)] for x in (a, b)]
        assert any(
            pa_[i] == pb[i] and set(near[pa_[(i + 1) % 4]]) & set(near[pb[(i + 1) % 4]])
            for i in range(4)
        )


def test_components_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 12)
    values = set()
    for x in base:
        values.add(int(x))
        at = int(x)
        for _ in range(30):
            at ^= 1 << int(rng.integers(63))
            values.add(at)
    values = sorted(values)
    df = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    root = {r.node: r.root for r in simhash.linked_groups(df).collect()}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    for v in values:
        assert root.get(v, v) == find(v)


def test_fingerprints_equal_their_definition(spark, texts):
    got = {
        r.doc_id: r.fingerprint for r in catalog.op4_simhash(spark, SMALL).collect()
    }
    for doc_id, text in texts:
        words = WORD.findall(lower(text))
        runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or (
            [" ".join(words)] if words else []
        )
        counts = [0] * 64
        for run in runs:
            h = xxhash.xxh64_intdigest(run.encode(), 42)
            for bit in range(64):
                counts[bit] += h >> bit & 1
        want = sum(1 << bit for bit in range(64) if counts[bit] * 2 > len(runs))
        assert got[doc_id] == f"{want:016x}"


def test_one_of_each_group_stays(spark, texts):
    docs = documents(spark, SMALL)
    kept = [r.doc_id for r in simhash.keep_one(docs).select("doc_id").collect()]
    groups = simhash.near_duplicates(docs).collect()
    assert sorted(kept) == sorted({r.component_id for r in groups})


def test_star_contraction(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(200, 300)] + [
        (rng.randrange(100), rng.randrange(100)) for _ in range(60)
    ]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    seen = defaultdict(set)
    for a, b in links:
        seen[a].add(b)
        seen[b].add(a)
    for node in {x for a, b in links for x in (a, b) if a != b}:
        group, todo = {node}, [node]
        while todo:
            for x in seen[todo.pop()] - group:
                group.add(x)
                todo.append(x)
        assert got.get(node, node) == min(group)


# 5, language


def test_network_gradients():
    w = {k: v.astype(np.float64) for k, v in language.new_weights(3, 4).items()}
    rng = np.random.default_rng(0)
    data = rng.integers(97, 110, 60).astype(np.uint8)
    x, valid = language.padded(data, np.array([0, 5, 9]), np.array([4, 8, 20]))
    label = np.array([0, 2, 1])
    _, g = language.gradients(w, x, valid, label)
    for k in w:
        at = (int(x[1, 0]), 5) if k[0] == "x" else tuple(s // 2 for s in w[k].shape)
        losses = []
        for e in (1e-3, -1e-3):
            w[k][at] += e
            losses.append(language.gradients(w, x, valid, label)[0])
            w[k][at] -= e
        assert g[k][at] == pytest.approx((losses[0] - losses[1]) / 2e-3, abs=3e-4, rel=2e-2)


def test_memo_changes_nothing(texts):
    model = language.fit({"a": [t for _, t in texts[:20]], "b": [t for _, t in texts[20:40]]}, 1)
    column = pa.array([t for _, t in texts[:60]])
    data, offsets = language.text_bytes(column)
    first = language._Labeller(model)
    once = first.pooled(data, offsets)
    assert np.allclose(once, first.pooled(data, offsets), atol=1e-6)
    for i in (0, 7, 31):
        d, o = language.text_bytes(column[i : i + 1])
        assert np.allclose(language._Labeller(model).pooled(d, o)[0], once[i], atol=1e-5)


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    found = catalog.op5_language(spark, base).join(
        documents(spark, base).select("doc_id", "lang"), "doc_id"
    )
    rows = found.collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_languages_come_from_rows_not_held_out(spark):
    held = [i for i in range(200) if zlib.crc32(str(i).encode()) % 4 == 2]
    rows = [(i, "abc def ghi", "xx" if i in held else "yy") for i in range(200)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == ("yy",)


def test_copies_do_not_cost_a_language(spark):
    """Eight French texts, each very often, beside more German and English ones, once each."""
    made = {"en": "the weather of {} was fine", "de": "das Wetter von {} war gut"}
    rows = [(10 * i, t.format(f"w{i}"), k) for i in range(60) for k, t in made.items()]
    held = [i for i in range(9) if zlib.crc32(str(i).encode()) % 4 != 2]
    french = [(i, f"le temps de {i} etait beau", "fr") for i in held]
    schema = "doc_id long, text string, lang string"
    once = spark.createDataFrame(rows, schema)
    copies = spark.createDataFrame(french, schema).crossJoin(spark.range(5_000)).drop("id")
    docs = once.union(copies)
    assert language.train(docs).languages == ("de", "en", "fr")
    # Copies change nothing: the same model as from one copy each.
    a, b = language.train(docs), language.train(once.union(spark.createDataFrame(french, schema)))
    assert all(np.array_equal(a.weights[k], b.weights[k]) for k in a.weights)


def test_every_language_is_learned(spark, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_WINDOWS", 8)
    monkeypatch.setattr(language, "EPOCHS", 1)
    rows = [(4 * i, f"word{i} of language {i}", f"l{i:03}") for i in range(260)]
    rows = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 != 2]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert list(model.languages) == sorted(r[2] for r in rows) and len(model.languages) > 150


def test_windows_are_drawn_from_the_whole_text():
    text = " ".join(f"w{i}" for i in range(5_000))
    (rows,) = language.drawn_windows(*language.text_bytes(pa.array([text])))
    assert len(rows) == language.TEXT_WINDOWS
    words = [bytes(r[1 : 1 + r[0]]).decode() for r in rows]
    assert words[0] == "w0" and int(words[-1][1:]) > 4_900 and len(set(words)) == len(words)


# 6, I-Match: the catalogue test compares the whole query with SQL


def test_next_follows_ascending_keys(spark):
    rng = random.Random(5)
    keys = rng.sample(range(-1000, 1 << 40), 300) + [None]
    rows = [(k, f"t{k}") for k in keys]
    found = imatch.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = [None, *sorted(k for k in keys if k is not None)]
    want = {a: b for a, b in zip(order, order[1:] + order[:1])}
    assert len(found) == len(rows)
    assert all(r.next_key == want[r.key] and r.next_text == f"t{want[r.key]}" for r in found)


def test_next_follows_keys_of_any_type(spark):
    keys = ["b", "a", None, "aa", "", "Z", "ä"]
    found = imatch.with_next(spark.createDataFrame([(k, f"t{k}") for k in keys], "doc_id string, text string"))
    order = sorted(keys, key=lambda k: (k is not None, (k or "").encode()))
    assert {r.key: r.next_key for r in found.collect()} == dict(zip(order, order[1:] + order[:1]))


def test_a_hot_key_takes_several_pieces(spark):
    rows = [(7, f"copy {i}") for i in range(400)] + [(i, "x") for i in range(20)]
    found = imatch.with_next(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # One cycle through all rows.
    follows = {(r.key, r.text): (r.next_key, r.next_text) for r in found}
    at, seen = (0, "x"), []
    for _ in range(len(rows)):
        seen.append(at)
        at = follows[at]
    assert at == (0, "x") and len(set(seen)) == len(rows)
    assert [k for k, _ in seen] == sorted(k for k, _ in rows)


# 7, substring dedup


def brute_repeats(docs, window):
    words = [t.encode().split() for t in docs]
    counts = Counter(
        tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1)
    )
    out = []
    for w in words:
        covered = [False] * len(w)
        for i in range(len(w) - window + 1):
            if counts[tuple(w[i : i + window])] > 1:
                covered[i : i + window] = [True] * window
        out.append((len(w), sum(covered), b" ".join(x for x, c in zip(w, covered) if not c)))
    return out


@pytest.mark.parametrize("hot", [20_000, 1, 3])
@pytest.mark.parametrize("vocabulary", [2, 40])
def test_repeats_equal_brute_force(spark, hot, vocabulary):
    rng = random.Random(hot + vocabulary)
    docs = []
    for _ in range(60):
        body = [f"w{rng.randrange(vocabulary)}" for _ in range(rng.randrange(0, 60))]
        if docs and rng.random() < 0.6:
            other = rng.choice(docs).split()
            at = rng.randrange(len(other) + 1)
            body[5:5] = other[at : at + rng.randrange(40)]
        docs.append(rng.choice([" ", "\n", " \t"]).join(body))
    docs += docs[:5] + ["", " \n", "a " * 100]
    got = substring_dedup.remove_repeats(frame(spark, docs), window=12, hot=hot)
    for r in got.collect():
        n, removed, kept = brute_repeats(docs, 12)[r.doc_id]
        assert (r.n_words, r.n_removed, r.text.encode()) == (n, removed, kept)


def test_substring_query(spark, texts):
    want = brute_repeats([t for _, t in texts], substring_dedup.WINDOW)
    got = {r.doc_id: r for r in catalog.op7_substring_dedup(spark, SMALL).collect()}
    assert sum(w[1] for w in want) > 0
    for (doc_id, _), (n, removed, kept) in zip(texts, want):
        r = got[doc_id]
        assert (r.n_words, r.n_removed) == (n, removed)
        assert r.kept_sha256 == hashlib.sha256(kept).hexdigest()


# 8, BPE


def test_ids_equal_the_library_and_decode_back():
    import public_tokenizers
    import tiktoken

    own = bpe.Encoder(*bpe.default_vocabulary())
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=own.ranks, special_tokens={}
    )
    rng = random.Random(9)
    letters = "abcdeé ü\n\t\r\x1c\x85\xa0   'st've漢字🙂ⅷ٣½\x00<|endoftext|>ABC"
    for n in [*range(40)] * 20 + [5000]:
        text = "".join(rng.choice(letters) for _ in range(n))
        ids = own.encode(text)
        assert ids == library.encode_ordinary(text)
        assert own.decode(ids) == text.encode()
    assert own.encode("a" * 30_000) == library.encode_ordinary("a" * 30_000)


def test_minimal_perfect_hash():
    keys = [f"key {i}".encode() for i in range(5000)]
    found = bpe.MinimalPerfectHash(keys)
    assert sorted(found.owner) == list(range(5000))
    assert all(found.index(k) == i for i, k in enumerate(keys))
    assert bpe.MinimalPerfectHash([b"one"]).index(b"one") == 0


def test_bpe_query(spark, texts):
    got = {r.doc_id: r for r in catalog.op8_bpe(spark, SMALL).collect()}
    own = bpe.encoder(*bpe.default_vocabulary())
    for doc_id, text in texts:
        ids = own.encode(text)
        r = got[doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


# 9, quality


def brute_counts(text):
    words = WORD.findall(text)
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = set()
    for i in range(len(words) - 2):
        if windows[tuple(words[i : i + 3])] > 1:
            repeated |= {i, i + 1, i + 2}
    seen, again = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            again += line in seen
            seen.add(line)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text)),
        again,
        len(repeated),
    )


def test_rule_counts(texts):
    cases = [t for _, t in texts] + [
        "", " ", "a", "\n\n", "a b c a b c", "x\x0by\x0bz", "\x1cab\x85 c\xa0d 漢🙂", "a\n\na\n \n \na"
    ]
    got = np.stack(quality.rule_counts(pa.array([*cases, None])), 1)
    for row, text in zip(got, [*cases, ""]):
        assert tuple(row) == brute_counts(text)


def test_scores_do_not_depend_on_the_batch(texts):
    some = [t for _, t in texts]
    model = quality.fit([quality.features(t) for t in some[:60]], np.arange(60) % 2)
    together = quality.raw_scores(*quality.text_bytes(pa.array(some)), model)
    alone = [quality.raw_scores(*quality.text_bytes(pa.array([t])), model)[0] for t in some]
    assert np.allclose(together, alone)


def test_classifier_on_labels_it_has_not_seen(spark):
    base = "/root/testdata/sf0.1"
    docs = documents(spark, base).select("doc_id", "text")
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    odd = labels.where("doc_id % 2 = 1")
    model = quality.train(docs, labels.where("doc_id % 2 = 0"))
    rows = quality.assess(docs.join(odd, "doc_id"), model.__class__(**model.__dict__)).collect()
    good = [r for r in rows if not r.base_failed]
    # `assess` replaces the label's column, so labels are read again.
    label = {r.doc_id: r.quality for r in odd.collect()}
    right = [(r.quality >= 0.5) == (label[r.doc_id] == 1) for r in good]
    clean = [r.kept for r in good if label[r.doc_id] == 1]
    assert sum(right) / len(right) > 0.97 and sum(clean) / len(clean) > 0.98
    # Calibrated: the mean probability is near the share of good rows.
    assert abs(sum(r.quality for r in rows) / len(rows) - sum(label.values()) / len(label)) < 0.05


LABELLED = "doc_id long, quality int"


def _judged(spark, docs, labels):
    schema = "doc_id long, text string"
    return quality.train(spark.createDataFrame(docs, schema) if isinstance(docs, list) else docs,
                         spark.createDataFrame(labels, LABELLED) if isinstance(labels, list) else labels)


def _labelled(n):
    docs = [(i, ("fine prose about rivers " if i % 2 else "buy now !!! $$$ ") * 3 + str(i)) for i in range(n)]
    return docs, [(i, i % 2) for i in range(n)]


def test_copies_do_not_cost_the_classifier_its_labels(spark):
    docs, labels = _labelled(200)
    single = _judged(spark, docs, labels)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    copies = frame.where("doc_id = 7").crossJoin(spark.range(4_000)).drop("id")
    model = _judged(spark, frame.union(copies), labels)
    assert np.count_nonzero(model.weights) > 100
    assert np.array_equal(model.weights, single.weights) and model.slope == single.slope


def test_labels_without_documents_take_no_place(spark):
    docs, labels = _labelled(100)
    alone = spark.range(1_000, 61_000).selectExpr("id AS doc_id", "CAST(id % 2 AS INT) AS quality")
    model = _judged(spark, docs, spark.createDataFrame(labels, LABELLED).union(alone))
    assert np.array_equal(model.weights, _judged(spark, docs, labels).weights)


def test_the_classifier_learns_from_the_end_of_a_text(spark):
    """Bad texts differ from good ones only behind 8,000 characters."""
    start = "an ordinary sentence about nothing much at all " * 180
    docs = [(i, start + ("more of the same" if i % 2 else "qzx jjk vvw ") * 40 + f" {i}") for i in range(60)]
    model = _judged(spark, docs, [(i, i % 2) for i in range(60)])
    column = pa.array([start + "more of the same" * 40, start + "qzx jjk vvw " * 40])
    good, bad = quality.raw_scores(*quality.text_bytes(column), model)
    assert good > bad and good - bad > 1


def test_character_runs_are_of_characters():
    texts = ["abc", "", "漢字かな", "é🙂x", "Привет мир"]
    data, offsets = quality.text_bytes(pa.array(texts))
    points, begins = quality.code_points(data, offsets)
    assert points.tolist() == [ord(c) for c in "".join(texts)]
    assert np.diff(begins).tolist() == [len(t) for t in texts]
    # Each text's runs, as counted from its own characters.
    for n in quality.CHARACTER_RUNS:
        hashed, inside = quality._run_features(points, begins, n)
        assert inside.sum() == sum(max(0, len(t) - n + 1) for t in texts)
        seen = {}
        whole = "".join(texts)
        for i in np.flatnonzero(inside):
            assert seen.setdefault(whole[i : i + n], hashed[i]) == hashed[i]


# 10, Hilbert sharding


@pytest.mark.parametrize("dimensions, bits", [(2, 3), (3, 2), (3, 4)])
def test_neighbours_on_the_curve_are_neighbours(dimensions, bits):
    places = hilbert.curve(dimensions, bits)
    assert sorted(places) == list(range(1 << dimensions * bits))
    cell_of = {p: c for c, p in enumerate(places)}
    mask = (1 << bits) - 1

    def coordinates(cell):
        return [cell >> bits * d & mask for d in range(dimensions)]

    for p in range(len(places) - 1):
        a, b = coordinates(cell_of[p]), coordinates(cell_of[p + 1])
        assert sum(abs(x - y) for x, y in zip(a, b)) == 1


def test_shards_are_equal_runs_of_the_curve(spark, texts):
    rows = catalog.op10_hilbert_shards(spark, SMALL).collect()
    by_shard = defaultdict(list)
    for r in rows:
        by_shard[r.shard].append(r)
    sizes = [len(by_shard[s]) for s in range(8)]
    assert sum(sizes) == len(texts) and max(sizes) - min(sizes) <= 1
    last = -1
    for s in range(8):
        own = sorted(by_shard[s], key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
        assert own[0].hilbert >= last and [r.hilbert for r in own] == sorted(r.hilbert for r in own)
        last = own[-1].hilbert
    text = dict(texts)
    for r in rows:
        data = text[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "rows")


def test_ranks_have_no_gap(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"), (F.col("id") % 3).alias("k"))
    got = ranked(df, [F.col("k"), F.col("v")], "rank", "test").orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1000))
    assert [(r.k, r.v) for r in got] == sorted((r.k, r.v) for r in got)


def test_files_of_a_shard(spark, shared):
    docs = documents(spark, SMALL)
    placed = hilbert.shard(docs, {"size": F.octet_length("text")})
    hilbert.write_shards(docs, placed, shared)
    back = spark.read.parquet(shared)
    assert back.count() == docs.count() and back.select("shard").distinct().count() == 8
    assert regex.search(r"\p{L}", back.first()["text"])


def test_texts_with_a_common_start_have_places_of_their_own(spark):
    """Twenty sites that differ only behind many equal letters."""
    rows = [(i, "t", f"https://example.org/a/very/long/path/site{i % 20:02}/") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    placed = hilbert.shard(docs, {"source": F.col("source")}, shards=4)
    found = {r.doc_id: r for r in placed.collect()}
    cells = {}
    for i, _, s in rows:
        cells.setdefault(s, set()).add(found[i].hilbert)
    assert all(len(c) == 1 for c in cells.values()) and len(set.union(*cells.values())) >= 14
    # Each shard holds few of the sites.
    sites = {}
    for i, _, s in rows:
        sites.setdefault(found[i].shard, set()).add(s)
    assert all(len(s) <= 6 for s in sites.values())


def _skew_can_be_split(df) -> list[bool]:
    """For every sort-merge join of the plan: whether each side is an exchange, sorted."""
    plan, out = df._jdf.queryExecution().executedPlan().toString().splitlines(), []

    def depth(line: str) -> int:
        return len(line) - len(line.lstrip(" :+-"))

    for at, line in enumerate(plan):
        if "SortMergeJoin" in line:
            below = [x for x in plan[at + 1 :]]
            sides, i = [], 0
            while i < len(below) and depth(below[i]) > depth(line):
                if depth(below[i]) == depth(line) + 3:
                    sides.append(" ".join(x.strip(" :+-")[:20] for x in below[i : i + 2]))
                i += 1
            out.append(all(s.startswith("Sort ") and "Exchange" in s for s in sides) and len(sides) == 2)
    return out


def test_joins_with_what_many_rows_share_can_be_split(spark, monkeypatch):
    """The plans that write tables, with broadcast off: a hot key must not be one task."""
    seen = {}

    def spy(module):
        real = module.written

        def caught(df, label):
            seen.setdefault(label, []).extend(_skew_can_be_split(df))
            return real(df, label)

        monkeypatch.setattr(module, "written", caught)

    for module in (components, line_dedup, simhash):
        spy(module)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        links = spark.createDataFrame([(0, i) for i in range(1, 50)] + [(100, 101)], "a long, b long")
        assert components.components(links).count() == 50
        docs = documents(spark, SMALL).limit(120)
        line_dedup.drop_lines(docs).count()
        simhash.near_duplicates(docs).count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    for label in ("large", "small", "templates", "stars", "mixed"):
        assert seen[label] and all(seen[label]), (label, seen[label])
