"""From documents to token ids in five stages, each one operator of ``epitally.llm``.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it as
Parquet to the shared folder and gives the reread table to the next. All but the last return
the columns of ``documents``; where a text changes, its ``n_chars`` follows.

Null ids, texts, languages and sources, empty tables, repeated rows and further columns are
handled as the operators say; further columns are passed on by all stages but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epitally.llm import bpe, line_dedup, mixing, quality, simhash
from epitally.llm.common import documents, ship, table
from epitally.workspace import written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go. The classifier learns from the labelled rows of this stage."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.assess(docs, model).where("kept").select(*docs.columns)


def drop_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Recurring lines go from all documents but the first that has them; all documents stay."""
    kept = line_dedup.drop_lines(docs).select(*docs.columns)
    if "n_chars" in docs.columns:
        length = F.char_length("text").cast(docs.schema["n_chars"].dataType)
        kept = kept.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), length))
    return kept


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, linked by fingerprints of three-word shingles that
    differ in three bits or fewer, as the operator's contract has them."""
    ship(spark)
    return simhash.keep_one(docs, shingle=3, most=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them; by default each at least once."""
    return mixing.realise(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, their number and digest, and that of the bytes decoded from them."""
    ship(spark)
    return bpe.round_trip_digests(docs, keep_ids=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", drop_recurring_lines),
    ("SimHash near-dedup", near_duplicates),
    ("mixing sources", mix_sources),
    ("byte-level BPE", token_ids),
]

# A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
