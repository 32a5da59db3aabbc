"""A corpus derived from the documents table, in SQL that Spark and DuckDB read alike.

Four documents in a row are a key's translations, with their whole texts; their languages go round five, so every key
lacks one language and each fifth key its source. Some key names break the grammar of names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lingspan.schema import Corpus

TRANSLATIONS_SQL = """
WITH base AS (
 SELECT CAST(floor(doc_id/4) AS BIGINT) AS key_id, doc_id,
   CASE doc_id%5 WHEN 0 THEN 'en' WHEN 1 THEN 'de' WHEN 2 THEN 'fr' WHEN 3 THEN 'es' ELSE 'it' END AS lang,
   text AS v
 FROM documents)
SELECT key_id, lang,
  CASE WHEN doc_id%31=5 THEN '' ELSE
   concat(v,
     CASE WHEN key_id%3=0 AND doc_id%19<>7 THEN CASE WHEN doc_id%23=3 THEN ' [%s] [%i]' ELSE ' [%1$s] [%2$i]' END ELSE '' END,
     CASE WHEN key_id%5=0 THEN CASE WHEN doc_id%29=4 THEN concat(' https://x.example/',CAST(key_id AS VARCHAR(20)),'/alt.') ELSE concat(' https://x.example/',CAST(key_id AS VARCHAR(20)),'.') END ELSE '' END,
     CASE WHEN doc_id%11=2 THEN ' — z' ELSE '' END,
     CASE WHEN doc_id%13=6 THEN '  z' ELSE '' END,
     CASE WHEN doc_id%17=9 THEN concat(chr(160),'z') ELSE '' END,
     CASE WHEN doc_id%27=8 THEN ' %d' ELSE '' END,
     CASE WHEN doc_id%37=10 THEN ' (z' ELSE '' END,
     CASE WHEN doc_id%43=11 THEN ' ' ELSE '' END) END AS value,
  doc_id%41=1 AND doc_id%5<>0 AS unverified, doc_id%47=3 AS dirty
FROM base
"""

KEYS_SQL = """
SELECT DISTINCT CAST(floor(doc_id/4) AS BIGINT) AS key_id,
  concat('fam', CAST(floor(doc_id/4) % 20 AS INT), '_', CAST(floor(doc_id/4) AS INT),
         CASE CAST(floor(doc_id/4) AS BIGINT) % 4 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE '' END,
         CASE WHEN CAST(floor(doc_id/4) AS BIGINT) % 45 = 7 THEN '-x' ELSE '' END) AS key_name,
  CASE CAST(floor(doc_id/4) AS BIGINT) % 5 WHEN 0 THEN 'ios' WHEN 1 THEN 'ios,android'
       WHEN 2 THEN 'web' WHEN 3 THEN 'other' ELSE '' END AS platforms_csv,
  CAST(floor(doc_id/4) AS BIGINT) % 97 = 13 AS archived,
  concat('Surface: screen ', CAST(floor(doc_id/4) % 7 AS INT), ' of the sample application', chr(10),
         CASE WHEN CAST(floor(doc_id/4) AS BIGINT) % 6 = 1 THEN concat('Register: casual', chr(10)) ELSE '' END,
         'Constraints: ', CASE WHEN CAST(floor(doc_id/4) AS BIGINT) % 8 = 2 THEN '' ELSE 'at most 60 chars' END) AS context
FROM documents
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    return spark.sql(sql.replace("FROM documents", "FROM {documents}"), documents=table(spark, sf_dir, "documents"))


def derived_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    rec_id = F.concat(F.lit("id:"), F.col("key_id").cast("string")).alias("rec_id")
    keys = from_sql(spark, sf_dir, KEYS_SQL).select(
        rec_id, "key_id", F.col("key_id").alias("ord"), "key_name", F.lit(None).cast("map<string,string>").alias("key_by_platform"),
        F.when(F.col("platforms_csv") == "", F.array().cast("array<string>")).otherwise(F.split("platforms_csv", ",")).alias("platforms"),
        F.lit(False).alias("plural"), "archived", "context", F.lit(None).cast("int").alias("char_limit"),
        F.lit(None).cast("map<string,string>").alias("filenames"), F.array().cast("array<string>").alias("dirty_meta"),
    )
    translations = from_sql(spark, sf_dir, TRANSLATIONS_SQL).select(rec_id, "lang", F.lit("").alias("form"), "value", F.col("unverified").alias("is_unverified"), F.col("dirty").alias("is_dirty"))
    return Corpus(keys, translations)
