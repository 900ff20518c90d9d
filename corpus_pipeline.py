"""Documents to training data: five stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sightlake.llm import (
    decontaminate, line_templates, quality_rules, sentencepiece_codec, simhash,
)
from sightlake.llm.frames import kept_rows
from sightlake.session import stage

PIECES = "piece_bpe_32k.model"
#: Chunks of text the last stage keeps in a worker, which holds what other stages left there, too.
CACHED = 40_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the strict policy of the quality rules."""
    return kept_rows(docs, "text", quality_rules.ledger, quality_rules.passes(quality_rules.STRICT))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of templates that recur; the first document keeps them."""
    left = line_templates.drop_recurring(docs, n_chars="n_chars")
    return left.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, the one with the least id."""
    return simhash.one_of_each(docs, shingle=3, distance=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage to speak of."""
    return decontaminate.remove_contaminated(
        docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with a digest of what they decode to."""
    model = public_tokenizers.path(PIECES)
    coded = sentencepiece_codec.round_trip(docs.select("doc_id", "text"), model, cached=CACHED)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("near-duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents table; every result but the last is written and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), "documents")
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL can state neither the fingerprints' hash nor the encoder. tests/llm tests the operators, but
#: compares no run of all stages with anything.
ORACLE_SQL = None
