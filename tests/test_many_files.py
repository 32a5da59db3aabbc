"""Files that the queries write for readers: as many as the pages need, not one a page."""

from __future__ import annotations

import glob
import hashlib

import pytest

from lingspan.plans import queries_files
from lingspan.tables import shared_dir

MD5 = lambda text: hashlib.md5(text.encode()).hexdigest()


@pytest.fixture
def pages(spark, tmp_path):
    rows = [(i, f"a{i}\tx\n\n  b\n" if i % 2 else f"one {i}") for i in range(500)] + [(3, "a page_id twice\nend"), (501, "")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(2).write.parquet(f"{tmp_path}/pages.parquet")
    return str(tmp_path), rows


def _made(spark, name, run):
    before = set(glob.glob(f"{shared_dir(spark)}/{name}-*"))
    rows = sorted(map(tuple, run().collect()))
    (folder,) = set(glob.glob(f"{shared_dir(spark)}/{name}-*")) - before
    return rows, len(glob.glob(f"{folder}/**/part-*", recursive=True))


def test_line_numbers_of_pages_that_share_files(spark, pages):
    rows, files = _made(spark, "pages", lambda: queries_files.file_line_numbers(spark, pages[0]))
    assert rows == sorted((k, n, MD5(line)) for k, html in pages[1] for n, line in enumerate(html.split("\n"), 1)) and files <= 4


def test_trees_hold_many_pages_in_a_file(spark, pages):
    rows, files = _made(spark, "tree", lambda: queries_files.tree_android(spark, pages[0]))
    kept = {i: name for i, name in enumerate(queries_files.FOLDERS) if name not in queries_files.trees.ANDROID_TREE.skipped}
    assert rows == sorted((kept[k % 8], k, MD5(html)) for k, html in pages[1] if k % 8 in kept) and files <= 24


def test_lines_of_a_tree_of_many_pages(spark, pages):
    rows, files = _made(spark, "tree", lambda: queries_files.source_tree_lines(spark, pages[0]))
    lines = [MD5(line) for k, html in pages[1] if k % 5 != 3 for line in html.split("\n")]
    assert rows == sorted((h, lines.count(h)) for h in set(lines)) and files <= 16
