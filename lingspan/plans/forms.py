"""A second corpus derived from the documents table, with what the first lacks: plural keys, names by platform, file names,
limits, typed contexts, and languages that rules of style are about. The SQL is read by Spark and DuckDB alike."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lingspan.plans.derived import from_sql
from lingspan.schema import Corpus

FORM_VALUES_SQL = """
WITH base AS (
 SELECT CAST(floor(doc_id/4) AS BIGINT) AS key_id, doc_id,
   CASE doc_id%5 WHEN 0 THEN 'en' WHEN 1 THEN 'ru' WHEN 2 THEN 'ja' WHEN 3 THEN 'pl' ELSE 'id' END AS lang,
   coalesce(text,'') AS v
 FROM documents WHERE doc_id IS NOT NULL),
one AS (
 SELECT key_id, doc_id, lang,
   CASE WHEN doc_id%31=5 THEN '' WHEN lang IN ('ru','id') AND key_id%6<2 THEN concat('tied ',lang) ELSE
    concat(v,
     CASE WHEN key_id%3=0 THEN ' [%1$s]' ELSE '' END,
     CASE WHEN doc_id%15=5 THEN ' My favourite Colour' ELSE '' END,
     CASE WHEN doc_id%20=10 THEN ' вода' ELSE '' END,
     CASE WHEN doc_id%15=6 THEN ' пишем Вам' ELSE '' END,
     CASE WHEN doc_id%15=7 THEN ' 水!' ELSE '' END,
     CASE WHEN doc_id%3=0 THEN ' end.' WHEN doc_id%3=1 THEN ' so...' ELSE '' END) END AS value,
   doc_id%4=1 AND doc_id%5<>0 AS unverified, doc_id%9=3 AS dirty, key_id%7=3 AS plural
 FROM base)
SELECT key_id, lang, CASE WHEN plural THEN 'other' ELSE '' END AS form, value, unverified, dirty FROM one
UNION ALL SELECT key_id, lang, 'one', concat('1 ',value), unverified, dirty FROM one WHERE plural AND lang<>'id'
UNION ALL SELECT key_id, lang, 'few', concat('2 ',value), unverified, dirty FROM one WHERE plural AND (lang='pl' OR doc_id%8=1)
"""

FORM_KEYS_SQL = """
WITH ids AS (SELECT DISTINCT CAST(floor(doc_id/4) AS BIGINT) AS key_id FROM documents WHERE doc_id IS NOT NULL)
SELECT key_id,
  CASE WHEN key_id%11=4 THEN NULL ELSE concat('pair', CAST(floor(key_id/2) AS BIGINT), CASE WHEN key_id%2=0 THEN 'M' ELSE 'F' END) END AS key_name,
  CASE WHEN key_id%11=4 THEN concat('ios_', key_id) END AS name_ios, CASE WHEN key_id%11=4 THEN concat('and_', key_id) END AS name_android,
  CASE key_id%5 WHEN 0 THEN 'ios' WHEN 1 THEN 'ios,android' WHEN 2 THEN 'web' WHEN 3 THEN 'android' ELSE '' END AS platforms_csv,
  key_id%7=3 AS plural, key_id%97=13 AS archived,
  CASE WHEN key_id%17=9 THEN '' ELSE concat('Surface: screen', chr(10),
    CASE WHEN key_id%10=9 THEN '' ELSE concat('Type: ', CASE key_id%5 WHEN 0 THEN 'Button label (main) / title' WHEN 1 THEN 'Notification body' WHEN 2 THEN 'Gadget' WHEN 3 THEN 'Tip headline' ELSE 'Section header' END, chr(10)) END,
    CASE WHEN key_id%8=5 THEN '' ELSE concat('Context: said in place ', key_id, chr(10)) END,
    CASE key_id%4 WHEN 1 THEN concat('Register: formal', chr(10)) WHEN 2 THEN concat('Register: informal', chr(10)) ELSE '' END,
    'Constraints: at most 60 chars') END AS context,
  CASE WHEN key_id%13=2 THEN 'Extra.strings' END AS file_ios, CASE WHEN key_id%6=5 THEN 40 END AS char_limit
FROM ids
"""


def forms_corpus(spark: SparkSession, sf_dir: str) -> Corpus:
    rec_id = F.concat(F.lit("id:"), F.col("key_id").cast("string")).alias("rec_id")
    by_platform = F.create_map(F.lit("ios"), F.col("name_ios"), F.lit("android"), F.col("name_android"))
    keys = from_sql(spark, sf_dir, FORM_KEYS_SQL).select(
        rec_id, "key_id", F.col("key_id").alias("ord"), "key_name", F.when(F.col("name_ios").isNotNull(), by_platform).alias("key_by_platform"),
        F.when(F.col("platforms_csv") == "", F.array().cast("array<string>")).otherwise(F.split("platforms_csv", ",")).alias("platforms"), "plural", "archived", "context", "char_limit",
        F.when(F.col("file_ios").isNotNull(), F.create_map(F.lit("ios"), F.col("file_ios"))).alias("filenames"), F.array().cast("array<string>").alias("dirty_meta"),
    )
    texts = from_sql(spark, sf_dir, FORM_VALUES_SQL).select(rec_id, "lang", "form", "value", F.col("unverified").alias("is_unverified"), F.col("dirty").alias("is_dirty"))
    return Corpus(keys, texts)


