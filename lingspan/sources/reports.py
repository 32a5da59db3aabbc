"""Reports as ordered tables and files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def context_report(results: DataFrame, boilerplate: DataFrame, top: int = 40, orphans: int = 100) -> dict[str, DataFrame]:
    """Lists over results of lint_context_against_code, the worst first."""
    return {
        "dead": results.where(F.size("dead_citations") > 0).select("key", F.array_join("dead_citations", ", ").alias("symbols")).orderBy("key"),
        "mismatch": results.where(F.size("surface_mismatch") > 0).select("key", F.array_join("surface_mismatch", ", ").alias("symbols")).orderBy("key"),
        "caps": results.where("margin IS NOT NULL").select("key", "cap", "longest", "margin").orderBy(F.desc("margin"), "key"),
        "boilerplate": boilerplate.select("family", "line", "n").distinct().orderBy(F.desc("n"), "family", "line").limit(top),
        "orphans": results.where("referenced = 'none'").select("key").orderBy("key").limit(orphans),
    }


def write_context_report(results: DataFrame, path: str) -> None:
    """A JSON object a key."""
    results.write.json(path)


def write_usage_report(pool_status: DataFrame, pool_counts: DataFrame, android_unused: DataFrame, base: str) -> None:
    """Tab-separated candidates, keys whose pools disagree, counts as JSON, and names of unused Android keys."""
    flat = pool_status.select("key", F.array_join("pools", ",").alias("pools"), F.array_join("unused_pools", ",").alias("unused_pools"), "status")
    flat.where("status = 'all_unused'").orderBy(F.lower("key"), "key").write.option("sep", "\t").option("header", True).csv(f"{base}/candidates")
    flat.where("status = 'mixed'").orderBy(F.lower("key"), "key").write.option("sep", "\t").option("header", True).csv(f"{base}/mixed")
    pool_counts.write.json(f"{base}/counts")
    android_unused.select(F.col("name").alias("value")).write.text(f"{base}/android_unused")
