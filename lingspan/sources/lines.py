"""Numbers of lines in text files that are read in splits.

A split knows its file and where it begins, but not how many lines are before it. The lines of every split are counted, the
counts of a file's splits are summed up in their order, and a line's number is that sum and its place in its split. Only the
counts, a row a split, are grouped; lines keep their place, and only lines that are to be numbered meet the counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def placed_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, split, at, line): `at` grows along the lines of a split."""
    meta = F.col("_metadata")
    return spark.read.text(path).select(meta["file_path"].alias("path"), meta["file_block_start"].alias("split"), F.monotonically_increasing_id().alias("at"), F.col("value").alias("line"))


def split_offsets(lines: DataFrame) -> DataFrame:
    """placed_lines -> (path, split, first, before): the first `at` of a split and the number of lines before it."""
    counts = lines.groupBy("path", "split").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    upto = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row a split
    return counts.select("path", "split", "first", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))


def with_line_numbers(chosen: DataFrame, lines: DataFrame) -> DataFrame:
    """Rows chosen from `lines` (placed_lines of the same files) with lineno, from 1, in place of split and at."""
    rows = chosen.join(split_offsets(lines), ["path", "split"])
    kept = [c for c in chosen.columns if c not in ("split", "at")]
    return rows.select(*kept, (F.col("before") + F.col("at") - F.col("first") + 1).alias("lineno"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line, lineno) of every line."""
    lines = placed_lines(spark, path)
    return with_line_numbers(lines, lines)
