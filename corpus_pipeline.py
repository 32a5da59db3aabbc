"""Documents to training tokens: quality, near-duplicates, personal data, mixture, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next
stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.llm import bpe, gam, mixing, near, pii
from lingspan.llm.queries import MIX_WEIGHTS, QUALITY_THRESHOLD, mix_domain
from lingspan.llm.shared import documents, free_names, held_out, materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the additive model scores at the threshold or above; null and empty texts are scored like others. Equal
    rows stay or go together. Without labels of both kinds all scores are equal. An empty table stays empty."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id")).select("doc_id", F.col("quality").alias("label"))
    model = gam.fit(docs.select("doc_id", "text"), labels)
    (aside,) = free_names([*docs.columns, "score"], "kept_score")  # a column of the documents called score stays
    scored = gam.score(docs.withColumnRenamed("score", aside), model).where(F.col("score") >= QUALITY_THRESHOLD)
    return scored.select(*[F.col(aside if c == "score" else c).alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates. Texts without words, null ones too, are copies of each other; of repeated
    rows one stays; rows without a key go before others. An empty table stays empty."""
    return near.drop_near_duplicates(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with spans of personal data replaced by their kinds; a null text stays null, n_chars follows the text."""
    return pii.redact(docs, pii.fit(docs.select("doc_id", "text")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Four fifths of the tokens there are, by the target weights; leaves short of documents repeat them, up to twice.
    A null lang or source is a name of its own; texts without a token are taken with their leaf's whole epochs only."""
    return mixing.mixture(docs, mix_domain(), MIX_WEIGHTS, share=(4, 5), max_epochs=2)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every chosen copy, with whether they decode to the text's bytes; a null text has none and is its empty self."""
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(docs, vocabulary, public_tokenizers.PATTERN, check="round_trip")
    return ids.select(*[c for c in docs.columns if c not in ("text", "n_tokens", "token_ids", "round_trip")], "n_tokens", "token_ids", "round_trip")


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("PII", personal_data),
    ("mixing sources to target weights", mixture),
    ("byte-level BPE encoding and decoding", tokens),
]

#: SQL has no expression for trained models, SimHash groups and BPE; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "stage")
    return docs
