"""One query for each operator, over its whole table with production settings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.llm import (
    block_search,
    bpe,
    hilbert,
    imatch,
    language,
    license_scan,
    line_dedup,
    merkle,
    mixing,
    quality,
    simhash,
    substring_dedup,
    whiten,
)
from epitally.llm.common import documents, table


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines and dropped lines of every document, digest of the text that is left."""
    kept = line_dedup.drop_lines(documents(spark, sf_dir).select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256)
    return kept.select("doc_id", "n_lines", "n_dropped", digest.alias("kept_sha256"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir)).drop("found")


def op3_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weight of each document's source and how often the mixture takes the document."""
    docs = documents(spark, sf_dir).select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id",
        "source",
        F.col("mix_tokens").alias("n_tokens"),
        F.round("mix_weight", 9).alias("weight"),
        F.col("mix_copies").alias("copies"),
        F.col("mix_block").alias("block"),
    )


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(documents(spark, sf_dir), shingle=3)
    digits = F.lpad(F.lower(F.hex("fingerprint")), 16, "0")
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = language.train(docs)
    found = language.identify(docs.select("doc_id", "text"), model)
    held_out = language.held_out(F.col("doc_id"))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(documents(spark, sf_dir))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    kept = substring_dedup.remove_repeats(docs)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(documents(spark, sf_dir))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    judged = quality.assess(docs, model)
    return judged.select("doc_id", *quality.COUNTS, "base_failed", "kept", "quality")


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards by equal numbers of rows along the curve of size, source and language."""
    docs = documents(spark, sf_dir)
    dimensions = {
        "size": F.octet_length("text"),
        "source": F.col("source"),
        "lang": F.col("lang"),
    }
    placed = hilbert.shard(docs, dimensions)
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "hilbert",
    )


def op11_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest rows of every twentieth vector, by inner product."""
    queries = F.col("vec_id") % 20 == 0
    return block_search.nearest_neighbours(table(spark, sf_dir, "embeddings"), queries)


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Roots and proofs of all documents; every second one is folded from a text without breaks."""
    shown = [F.replace("text", F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in merkle.LEAF]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    altered = F.when(tampered, merkle.leaf_digest(shown))
    made = merkle.manifest(documents(spark, sf_dir), also={"altered": altered})
    folded = merkle.fold(F.coalesce("altered", "leaf"), F.col("steps"))
    proof = merkle.proof_digest(F.col("steps"))
    made = made.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"), folded.alias("folded_root")
    )
    return made.withColumn("verified", F.col("folded_root") == F.col("root"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_mixture": op3_mixture,
    "op4_simhash": op4_simhash,
    "op5_language": op5_language,
    "op6_imatch": op6_imatch,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_hilbert_shards": op10_hilbert_shards,
    "op11_nearest": op11_nearest,
    "op12_merkle": op12_merkle,
    "op13_whitening": op13_whitening,
}

ORACLE: dict[str, str] = {
    "op1_line_dedup": line_dedup.oracle_sql(),
    "op2_license_scan": license_scan.oracle_sql(),
    "op3_mixture": mixing.oracle_sql(),
    "op6_imatch": imatch.oracle_sql(),
    "op11_nearest": block_search.oracle_sql(),
    "op12_merkle": merkle.oracle_sql(),
}
