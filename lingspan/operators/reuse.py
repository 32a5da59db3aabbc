"""Source texts that are alike: candidates by MinHash over character n-grams, decided on whole sets.

A text, folded and stripped, is the set of its character n-grams. Two texts are near if their sets have a Jaccard
similarity of SIMILAR or more. Each text has BANDS keys of ROWS minima, and a sketch of one bit of each of BITS minima. Texts
with a key in common whose sketches lie within reach are compared on their whole sets, so what is reported is right. Texts of
similarity s share no key with a chance of (1 - s ** ROWS) ** BANDS, 6e-5 at 0.8; sketches miss 1e-7 of such pairs. Long texts of
one language often share a key and nothing more: their sketches decide inside the join, so no set or text travels for them and
only the pairs left after that are written, and a text travels once to each of its bands, however many pairs it has there. Equal texts are one text here, whatever the number of their keys, and come back as members at the end: no
group is collected, and a text in a third of all keys costs its rows only.

Texts shorter than an n-gram are one n-gram. A key without a source text, or with an empty one, is in no group.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lingspan.functions import text as X
from lingspan.operators.graph import components
from lingspan.operators.lint import live_keys
from lingspan.operators.review import flat_text
from lingspan.schema import SOURCE_LANG, Corpus
from lingspan.tables import few_rows_a_batch, materialize

GRAM = 4
SIMILAR = (4, 5)
BANDS, ROWS = 24, 5
#: Texts of a band that are compared in one group.
BLOCK = 256
#: Bits of a text's sketch, whole longs; grams hashed at a time.
BITS, PART = 448, 2_000

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def source_texts(corpus: Corpus) -> DataFrame:
    """(rec_id, key, platforms, text) of keys that aren't archived, with the folded and stripped source text."""
    source = flat_text(corpus).where((F.col("lang") == SOURCE_LANG) & (F.col("text") != "")).select("rec_id", X.casefold(X.strip("text")).alias("text"))
    return source.join(live_keys(corpus).select("rec_id", "key", "platforms"), "rec_id")


def gram_set(text: str, n: int = GRAM) -> np.ndarray:
    """The 64-bit hashes of a text's character n-grams, each once."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.concatenate((points, np.full(max(n - len(points), 0), 0x110000, np.uint32))).astype(np.uint64)
    k = len(points) - n + 1
    grams = np.zeros(k, np.uint64)
    for i in range(n):
        grams = grams * _P1 ^ points[i : i + k]
    grams = (grams ^ (grams >> np.uint64(32))) * _P2
    return np.unique(grams ^ (grams >> np.uint64(29)))


def _minima(grams: np.ndarray, seeds: np.ndarray, odd: np.ndarray) -> np.ndarray:
    """The minimum of each seeded hash over the grams, a part of them at a time."""
    least = np.full(len(seeds), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(grams), PART):
        np.minimum(least, ((grams[at : at + PART] ^ seeds[:, None]) * odd[:, None]).min(axis=1), out=least)
    return least


def signatures(texts: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """texts (id, text) -> (id, size, bands, bits): the size of a text's set, a key of each band, and a bit of each of BITS minima."""
    r = np.random.default_rng(7)
    seeds, odd = (r.integers(0, 2**64, max(BITS, bands * rows), np.uint64) for _ in range(2))
    odd |= np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, keys, bits = [], [], []
            for text in batch.column("text"):
                grams = gram_set(text.as_py(), n)
                least = _minima(grams, seeds, odd)
                key = np.arange(1, bands + 1, dtype=np.uint64)
                for value in least[: bands * rows].reshape(bands, rows).T:
                    key = (key ^ value) * _P1
                    key ^= key >> np.uint64(32)
                sizes.append(len(grams))
                keys.append(key.view(np.int64))
                bits.append(np.packbits((least[:BITS] >> np.uint64(31)).astype(np.uint8) & 1).view(np.int64))
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.int32()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.list_(pa.int64()))], names=["id", "size", "bands", "bits"])

    return texts.select("id", "text").mapInArrow(run, "id string, size int, bands array<bigint>, bits array<bigint>")


def _apart(similar: tuple[int, int]) -> int:
    """The most bits in which texts of this similarity differ: six standard deviations above the mean, more in 1 of 10^7 pairs."""
    p = (1 - similar[0] / similar[1]) / 2
    return math.ceil(BITS * p + 6 * math.sqrt(BITS * p * (1 - p)))


def _counted(n: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Pairs (a, b) of a group and its texts (id, text) -> (a, b, shared, united) of whole sets."""

    def run(pairs: pa.Table, texts: pa.Table) -> pa.Table:
        sets = {i.as_py(): gram_set(t.as_py(), n) for i, t in zip(texts.column("id"), texts.column("text"))}
        out = []
        for a, b in zip(pairs.column("a").to_pylist(), pairs.column("b").to_pylist()):
            shared = len(np.intersect1d(sets[a], sets[b], assume_unique=True))
            out.append((a, b, shared, len(sets[a]) + len(sets[b]) - shared))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*out) if out else [()] * 4, (pa.string(), pa.string(), pa.int32(), pa.int32()))], names=["a", "b", "shared", "united"])

    return run


def _compared(pairs: DataFrame, whole: DataFrame, n: int) -> DataFrame:
    """(a, b, band) -> (a, b, shared, united). A text travels to its bands, not to its pairs; of a band with more than BLOCK
    texts to pairs of blocks of about so many."""
    ends = pairs.select("band", F.explode(F.array("a", "b")).alias("id")).distinct()
    blocks = ends.groupBy("band").agg(F.ceil(F.count("*") / BLOCK).alias("k"))
    dealt = materialize(pairs.join(blocks, "band").select("a", "b", "band", *[F.pmod(F.xxhash64(c), "k").alias(f"at_{c}") for c in ("a", "b")]), "dealt")
    group = ["band", "at_a", "at_b"]
    of = [f"of_{c}" for c in group]
    wanted = dealt.select(*[F.col(c).alias(o) for c, o in zip(group, of)], F.explode(F.array("a", "b")).alias("id")).distinct().join(whole, "id")
    return dealt.groupBy(*group).cogroup(wanted.groupBy(*of)).applyInArrow(_counted(n), "a string, b string, shared int, united int")


def near_texts(texts: DataFrame, similar: tuple[int, int] = SIMILAR, n: int = GRAM, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """texts (text) -> (a, b, shared, united): MD5 sums a < b of near texts, with the sizes that decided."""
    few_rows_a_batch(texts.sparkSession)
    whole = materialize(texts.select("text").distinct().select(F.md5(F.col("text").cast("binary")).alias("id"), "text"), "texts")
    keys = materialize(signatures(whole, n, bands, rows), "signatures").select("id", "size", "bits", F.explode("bands").alias("band"))
    a, b = keys.alias("a"), keys.alias("b")
    up, down = similar
    close = (F.col("a.id") < F.col("b.id")) & (F.least("a.size", "b.size") * down >= F.greatest("a.size", "b.size") * up)
    apart = reduce(add, (F.bit_count(F.col("a.bits")[i].bitwiseXOR(F.col("b.bits")[i])) for i in range(BITS // 64)))
    pairs = a.join(b, (F.col("a.band") == F.col("b.band")) & close & (apart <= _apart(similar))).groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(F.min("a.band").alias("band"))
    found = _compared(materialize(pairs, "pairs"), whole, n)
    return found.where(F.col("shared") * down >= F.col("united") * up)


def near_reuse(corpus: Corpus, similar: tuple[int, int] = SIMILAR) -> DataFrame:
    """(group, rec_id, key, text_id, n_keys, n_texts): members of groups of two keys or more whose source texts are equal or
    hang together by near ones. A group is named by the smallest MD5 sum of its texts."""
    keys = materialize(source_texts(corpus).select("rec_id", "key", "text", F.md5(F.col("text").cast("binary")).alias("text_id")), "sources")
    links = near_texts(keys.select("text"), similar)
    groups = components(links.select("a", "b")).select(F.col("node").alias("text_id"), F.col("component").alias("group"))
    members = keys.select("rec_id", "key", "text_id").join(groups, "text_id", "left").withColumn("group", F.coalesce("group", "text_id"))
    by_text = members.groupBy("group", "text_id").agg(F.count("*").alias("n"))
    sizes = by_text.groupBy("group").agg(F.sum("n").alias("n_keys"), F.count("*").alias("n_texts")).where("n_keys > 1")
    return members.join(sizes, "group").select("group", "rec_id", "key", "text_id", "n_keys", "n_texts")
