"""Lints on streams. Those that look at one value or one context only are stateless expressions, the same that batches use, and
run as they are; whether a key owns a plural companion, which one check of placeholders needs, comes from a table beside
the stream. Checks that compare the languages of a key need all of them, and stay with batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lingspan.functions import text as X
from lingspan.operators import lint
from lingspan.operators.lint import value_items


def stream_lint_values(values: DataFrame) -> DataFrame:
    """values (rec_id, lang, value), streaming or not -> findings."""
    found = values.select("rec_id", "lang", "value", F.explode(value_items("value")).alias("f"))
    return found.select("rec_id", "lang", "f.severity", "f.code", "f.token", X.snippet("value").alias("snippet"))


def stream_lints(values: DataFrame, owners: DataFrame | None = None) -> DataFrame:
    """values (rec_id, key, lang, value, platforms), streaming or not, and owners (rec_id), a table of the keys with a plural
    companion -> findings of hygiene, scripts and placeholders."""
    paired = F.lit(None).cast("boolean")
    rows = values.withColumn("paired", paired) if owners is None else values.join(owners.select("rec_id").distinct().withColumn("paired", F.lit(True)), "rec_id", "left")
    parts = [lint.values_found(values), lint.script_found(values), lint.placeholders_found(rows.where(F.col("value").contains("%")))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def stream_lint_contexts(keys: DataFrame) -> DataFrame:
    """keys (rec_id, key, context), streaming or not -> findings."""
    return lint.contexts_found(keys)


def append_findings(findings: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Starts a query that appends the findings of what there is to Parquet under path, and ends. Started again with the same
    checkpoint it goes on where it stopped: each input is judged once, also after a failure."""
    return findings.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
