"""Nulls, empty and very long texts, repeats, empty tables and clashing columns, for all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epitally.llm import (
    bpe,
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
from epitally.llm.catalog import QUERIES

CLASHING = (
    "key", "h", "row", "words", "n", "block", "fingerprint", "root", "component_id", "_text", "_key",
    "_gone", "kept", "n_words", "spans", "token_ids", "decoded", "piece", "term", "code", "place",
    "of", "weight", "mix_copies", "d1", "t1", "shard", "slot", "score", "lang_pred", "quality",
)
LONG = "Lorem ipsum dolor sit amet, " * 20_000
WHOLE = "one two three four five six seven eight nine ten " * 8
ROWS = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t\n ", "en", "a"),
    (4, LONG, "en", "b"),
    (5, WHOLE, "fr", None),
    (5, WHOLE, "fr", None),
    (6, WHOLE, None, "a"),
    (None, WHOLE, "fr", "a"),
    (None, None, None, None),
    (7, "\x00\x1c 漢字 🙂 12 %%%", "en", ""),
    (8, "x" * 300_000, "en", "b"),
    (9, "line 1\nline 2\nline 3", "en", "b"),
    (10, "line 4\nline 5\nline 6", "en", "b"),
]


def table(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    docs = docs.withColumn("n_chars", F.char_length("text").cast("long"))
    extra = {c: F.lit("own value") for c in CLASHING}
    return docs.withColumns(extra)


MODEL = quality.QualityModel(quality.np.zeros(quality.DIMENSIONS, "float32"), 1.0)
OPERATORS = {
    "line_dedup": line_dedup.drop_lines,
    "license_scan": license_scan.scan,
    "mixing": mixing.mix,
    "simhash": simhash.near_duplicates,
    "simhash_keep_one": simhash.keep_one,
    "language": lambda d: language.identify(d, language.train(d)),
    "imatch": imatch.fingerprints,
    "substring_dedup": substring_dedup.remove_repeats,
    "bpe": lambda d: bpe.decode(bpe.encode(d)),
    "quality": lambda d: quality.assess(d, MODEL),
    "hilbert": lambda d: hilbert.shard(
        d, {"size": F.octet_length("text"), "source": F.col("source")}
    ),
}


@pytest.mark.parametrize("name", [n for n in OPERATORS if n != "simhash_keep_one"])
def test_every_row_comes_back(spark, name):
    found = OPERATORS[name](table(spark, ROWS)).collect()
    keys = sorted((r.doc_id for r in found), key=lambda k: (k is None, k))
    assert keys == sorted((r[0] for r in ROWS), key=lambda k: (k is None, k))


@pytest.mark.parametrize("name", OPERATORS)
def test_an_empty_table_stays_empty(spark, name):
    assert OPERATORS[name](table(spark, [])).collect() == []


@pytest.mark.parametrize(
    "name", ["line_dedup", "substring_dedup", "bpe", "quality", "mixing", "language", "simhash_keep_one"]
)
def test_other_columns_are_kept(spark, name):
    for r in OPERATORS[name](table(spark, ROWS)).select("h", "piece", "_gone", "key").collect():
        assert set(r) == {"own value"}


def test_values_of_special_texts(spark):
    docs = table(spark, ROWS)
    lines = {r.doc_id: r for r in line_dedup.drop_lines(docs).collect()}
    assert lines[1].text is None and (lines[1].n_lines, lines[1].n_dropped) == (0, 0)
    assert lines[2].text == "" and lines[3].text == " \n\t\n " and lines[3].n_dropped == 0
    assert lines[9].n_dropped == 0 and lines[10].text == ""
    # The first of the rows with this line keeps it; those without a key come last.
    assert lines[5].text == WHOLE and lines[6].text == "" and lines[None].text in ("", None)

    same = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    assert {same[k].component_id for k in (1, 2, 3)} == {1} and same[1].fingerprint == 0
    assert same[6].component_id == 5

    spoken = {r.doc_id: r for r in OPERATORS["language"](docs).collect()}
    assert [spoken[k].lang_pred for k in (1, 2, 3)] == ["und"] * 3 and spoken[1].score == 0
    assert spoken[4].lang_pred in ("en", "fr")

    cut = {r.doc_id: r for r in substring_dedup.remove_repeats(docs).collect()}
    assert (cut[1].n_words, cut[1].n_removed, cut[1].text) == (0, 0, "")
    assert cut[6].n_removed == cut[6].n_words == 80 and cut[4].n_removed == cut[4].n_words

    ids = {r.doc_id: r for r in bpe.decode(bpe.encode(docs)).collect()}
    assert ids[1].token_ids == [] and ids[1].decoded == b"" and bytes(ids[4].decoded) == LONG.encode()

    judged = {r.doc_id: r for r in quality.assess(docs, MODEL).collect()}
    assert judged[1].base_failed and not judged[1].kept and judged[5].n_words == 80

    near = {r.doc_id: r for r in imatch.fingerprints(docs).collect()}
    assert near[1].n_chars == 0 and near[5].fingerprint == near[6].fingerprint

    scanned = {r.doc_id: r for r in license_scan.scan(docs).collect()}
    assert (scanned[1].n_words, scanned[1].n_base, scanned[1].labels, scanned[1].score) == (0, 0, "", 0)


def test_one_document(spark):
    docs = table(spark, [(3, "alone in the table", "en", "a")])
    only = imatch.fingerprints(docs).first()
    assert only.near_next == 1.0
    assert mixing.mix(docs).first().mix_copies == 1
    assert simhash.keep_one(docs).count() == 1


def test_keep_one_of_repeated_rows(spark):
    kept = [r.doc_id for r in simhash.keep_one(table(spark, ROWS)).collect()]
    assert len(kept) == len(set(kept)) and 5 in kept and 6 not in kept and 1 in kept and 2 not in kept


@pytest.fixture
def folder(spark, tmp_path):
    def write(rows, labels):
        base = str(tmp_path / "tables")
        table(spark, rows).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(
            f"{base}/labels.parquet"
        )
        vectors = [] if not rows else [(0, [1.0, 0.0]), (20, [0.5, 1.0]), (None, [-1.0, 3.0]), (3, None)]
        spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(
            f"{base}/embeddings.parquet"
        )
        return base

    return write


LABELS = [(4, 0, 0), (5, 1, 0), (5, 1, 1), (6, 1, 0), (8, None, 0), (None, 1, 0), (99, 1, 0)]


@pytest.mark.parametrize("empty", [False, True])
def test_queries_and_pipeline(spark, folder, empty):
    base = folder([] if empty else ROWS, [] if empty else LABELS)
    # Two queries with two neighbours each; three vectors with two components each.
    other = {"op11_nearest": 4, "op13_whitening": 6}
    for name, query in QUERIES.items():
        assert len(query(spark, base).collect()) == (0 if empty else other.get(name, len(ROWS))), name
    assert len(corpus_pipeline.run(spark, base).collect()) <= len(ROWS)


def test_stages_return_the_columns_of_documents(spark, folder):
    base = folder(ROWS, LABELS)
    docs = spark.read.parquet(f"{base}/documents.parquet")
    assert [s[0] for s in corpus_pipeline.STAGES] == [
        "quality rules", "line dedup", "SimHash near-dedup", "mixing sources", "byte-level BPE"
    ]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, base).columns == docs.columns
