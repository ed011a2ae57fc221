"""The pipeline ends with encoded text, not only with digests of it."""

from __future__ import annotations

import hashlib

from conftest import SMALL

import corpus_pipeline
from epitally.llm import bpe
from epitally.llm.common import documents


def test_the_last_stage_keeps_the_ids(spark):
    docs = documents(spark, SMALL).limit(20).unionByName(
        documents(spark, SMALL).limit(1).selectExpr("-1L AS doc_id", "'' AS text", "lang", "source", "n_chars")
    )
    coded = bpe.decode(corpus_pipeline.token_ids(spark, docs, SMALL))
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = coded.collect()
    assert len(rows) == 21
    for r in rows:
        assert bytes(r.decoded).decode() == texts[r.doc_id]
        assert r.n_tokens == len(r.token_ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, r.token_ids)).encode()).hexdigest()
