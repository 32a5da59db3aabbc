"""Source trees: which files of a tree are read, by the rule set of the reader.

A file is chosen by its path alone, with expressions over `_metadata.file_path`. Spark applies these to the listing of the
tree, before it plans splits, so a file that the rules leave out is never opened.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TreeRules:
    """suffixes and names (whole ones) that are read; folders, folder suffixes and file names (a pattern) that are not."""

    suffixes: tuple[str, ...]
    skipped: tuple[str, ...]
    names: tuple[str, ...] = ()
    skipped_suffixes: tuple[str, ...] = ()
    left_out: str = ""


# The files that the scan for unused keys, the check of contexts and the Android scan read.
UNUSED_KEYS = TreeRules(
    suffixes=(".entitlements", ".h", ".intentdefinition", ".json", ".m", ".mm", ".pbxproj", ".plist", ".storyboard", ".swift", ".xib", ".xcconfig", ".yaml", ".yml"),
    skipped=(".build", ".git", "build", "Carthage", "DerivedData", "Pods"), names=("Podfile",), skipped_suffixes=(".xcassets",), left_out=r"\.strings(dict)?$|^R\..*\.generated\.swift$",
)
CONTEXTS = TreeRules(suffixes=(".swift",), skipped=(".git", ".build", "DerivedData", "Pods", "Carthage", "build", "fastlane", "node_modules"))
ANDROID_TREE = TreeRules(suffixes=(".java", ".kt", ".kts", ".xml"), skipped=(".git", ".gradle", ".idea", "build"))


def relative(spark: SparkSession, path: Column, root: str) -> Column:
    """The path below root; paths of files are written as URIs, whatever the store."""
    bare = spark._jvm.org.apache.hadoop.fs.Path(root).toUri().getRawPath().strip("/")
    below = F.regexp_replace(path, r"^.*?/\Q" + bare + r"\E/+", "")
    return F.url_decode(F.replace(below, F.lit("+"), F.lit("%2B")))


def chosen(path: Column, rules: TreeRules) -> Column:
    """Whether the rules read the file at the relative path."""
    parts = F.split(path, "/")
    folders, name = F.slice(parts, 1, F.size(parts) - 1), F.element_at(parts, -1)
    out = F.exists(folders, lambda p: p.isin(*rules.skipped))
    for suffix in rules.skipped_suffixes:
        out = out | F.exists(parts, _ends(suffix))
    if rules.left_out:
        out = out | name.rlike(rules.left_out)
    suffix = F.regexp_extract(name, r"[^.](\.[^.]+)$", 1)  # of a name that starts with a dot, that dot begins no suffix
    return ~out & (suffix.isin(*rules.suffixes) | name.isin(*rules.names))


def _ends(suffix: str):
    return lambda p: p.endswith(suffix)


def tree(spark: SparkSession, root: str, rules: TreeRules) -> DataFrame:
    """(path, text) of the files that the rules choose, path relative to root."""
    path = relative(spark, F.col("_metadata.file_path"), root)
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).where(chosen(path, rules))
    return files.select(path.alias("path"), F.col("value").alias("text"))
