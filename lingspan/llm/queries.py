"""The registered queries over the training-data operators: opN_<name>(spark, sf_dir)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, flac, gam, langid, pii, secret_scan, spelling
from .mixing import mix
from .oracles import mixing_sql, secrets_sql, spelling_sql
from .repetition import repetition
from .ring import shard_by_ring
from .runs import periodic_runs
from .shared import documents, held_out
from .simhash import simhash_components
from .suffix_dedup import repeated_spans

#: op10 and the pipeline: weights by level; names without one weigh 1.
MIX_WEIGHTS = {"domain": {"d0": 4, "d1": 2}, "lang": {"en": 3, "de": 2, "fr": 2}, "source": {"src1": 2}}


def mix_domain():
    """The synthetic tables have no domain; the last digit of the source stands for it."""
    return F.concat(F.lit("d"), F.expr("right(source, 1)"))


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = repeated_spans(documents(spark, sf_dir).select("doc_id", "text"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s[1] - s[0])
    return rows.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.col("passages").alias("n_passages"))


def op2_simhash_golay(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash_components(documents(spark, sf_dir).select("doc_id", "text"), n=3)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows = pii.find(docs, pii.fit(docs.select("doc_id", "text")), ["doc_id"])
    said = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    counts = [F.expr(f"CAST(size(filter(base_spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in pii.BASE]
    return rows.select("doc_id", *counts, F.sha2(said("base_spans").cast("binary"), 256).alias("base_sha256"), said(F.concat("base_spans", "added_spans")).alias("spans"), F.size(F.concat("base_spans", "added_spans")).cast("long").alias("n_spans"))


def op4_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_by_ring(documents(spark, sf_dir), columns=["doc_id"])
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = bpe.encode(documents(spark, sf_dir), vocabulary, public_tokenizers.PATTERN, ["doc_id"])
    rows = bpe.decode(ids, vocabulary, public_tokenizers.PATTERN)
    return rows.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition(documents(spark, sf_dir), ["doc_id"])


def op7_flac(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    media = flac.to_flac(docs, ["doc_id", "n_bytes"])
    media = media.withColumns({"media_bytes": F.octet_length("media").cast("long"), "media_sha256": F.sha2("media", 256)})
    rows = flac.read_back(media, ["doc_id", "n_bytes", "media_bytes", "media_sha256"])
    size = F.octet_length("payload")
    return rows.select(
        "doc_id", "n_bytes", size.cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_sha256"),
        F.crc32(F.substring("payload", -64, 64)).alias("tail_crc32"), "media_bytes", "media_sha256", "feature", F.size("offsets").cast("long").alias("n_blocks"),
    )


def quality_model(spark: SparkSession, sf_dir: str) -> gam.Additive:
    """Learned from the quality labels outside the held-out fold."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out("doc_id")).select("doc_id", F.col("quality").alias("label"))
    return gam.fit(documents(spark, sf_dir).select("doc_id", "text"), labels)


#: Scores from here on are the better class.
QUALITY_THRESHOLD = 0.3


def op8_quality_gam(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = gam.score(documents(spark, sf_dir), quality_model(spark, sf_dir), ["doc_id"])
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = langid.fit(docs.where(~held_out("doc_id")).select("doc_id", "text", "lang"))
    rows = langid.identify(docs, model, ["doc_id"])
    return rows.select("doc_id", held_out("doc_id").alias("held_out"), "lang_pred", "score")


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mix(documents(spark, sf_dir).select("doc_id", "text", "lang", "source"), mix_domain(), MIX_WEIGHTS)
    return rows.select("doc_id", "mix_domain", "mix_lang", "mix_source", "mix_tokens", "mix_budget", "mix_copies")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.vocabulary(spelling.misspelt(spelling.runs(documents(spark, sf_dir), 7))))


def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = secret_scan.scan(documents(spark, sf_dir), ["doc_id"])
    base, added = F.col("base_spans"), F.col("added_spans")
    counts = [F.expr(f"CAST(size(filter(base_spans, s -> s.kind = '{k}')) AS BIGINT)").alias(f"n_{k}") for k in secret_scan.BASE]
    said = secret_scan.text_of
    return rows.select("doc_id", *counts, F.sha2(said(base).cast("binary"), 256).alias("base_sha256"), said(secret_scan.by_start(base, added)).alias("spans"), F.size(added).cast("long").alias("n_added"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(documents(spark, sf_dir).withColumn("seed", F.crc32(F.col("doc_id").cast("string").cast("binary"))), ["doc_id"], loop_by="seed")
    return rows.select("doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "n_words")


_ALL = (
    op1_suffix_dedup, op2_simhash_golay, op3_pii, op4_ring_sharding, op5_byte_bpe, op6_repetition, op7_flac, op8_quality_gam, op9_language_id, op10_mixing,
    op11_spelling_variants, op12_secret_scan, op13_periodic_runs,
)
QUERIES = {f.__name__: f for f in _ALL}
ORACLES = {"op10_mixing": mixing_sql(MIX_WEIGHTS), "op11_spelling_variants": spelling_sql(), "op12_secret_scan": secrets_sql()}
