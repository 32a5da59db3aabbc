"""Near-duplicate groups of texts: SimHash with Golay keys first, whole shingle sets to decide, an exact join for the rest.

Two texts are near-duplicates if their sets of WORDS-word shingles (A-Z lower-cased, 64-bit hashes) have a Jaccard
similarity of THRESHOLD or more. Texts of equal words are one node.

1. Golay. Nodes whose fingerprints over the shingles lie within two bits, found by `simhash.link_within_two`, are
   candidates.
2. Prefixes. Fingerprints of sets at THRESHOLD can lie further apart than any key reaches, so nothing is decided by
   their distance. Each set has a prefix: its first shingles in an order that puts common ones last. Sets at THRESHOLD
   share a shingle of their prefixes. All nodes of such a key are candidates with a few pivots of that key.
3. Links. Candidates are compared as whole sets; links make components. This goes on for TURNS turns with other and more
   pivots, only between components.
4. Rest. Nodes of different components that share a key and have not been compared are, unless their sizes and the key's
   places rule THRESHOLD out. So the groups are the components of the exact graph.

Pivots keep a crowd of copies from being compared with each other: most members are linked by a pivot, and 4 compares
only those left. A key that many unlike texts have in their prefixes would cost the square of their number, so such
keys are looked for in a part of the prefixes that grows with the table, and come last with the common ones. What is seen of
the texts sets orders and places, never results.

Null and empty texts and texts without words are copies of each other. Repeated rows are copies. Rows without a key take
part; of a group with keys another row is kept. An empty table gives an empty one; other columns stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import few_rows_a_batch, free_names, map_texts, materialize, scratch, utf8
from .simhash import link_within_two, simhash

WORDS = 5
THRESHOLD = (4, 5)
#: Texts of the sample that finds common shingles, and the most of these that are kept.
SAMPLE = 5_000
COMMON = 200_000
#: Of one text in CROWD_SAMPLE, those that make a shingle of the prefixes crowded; the most crowded ones kept; turns of looking.
CROWD_SAMPLE = 4
CROWD = 3
CROWDED = 1_000_000
LOOKS = 2
#: Tasks that share the rows of a common shingle.
SALTS = 64
#: Nodes of a key that all are pivots; a larger key has about as many in the first turn. Turns of pivots before all pairs.
PIVOTS = 8
TURNS = 3
#: Words whose hashes a task keeps.
MEMO = 200_000

_P1, _P2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    return utf8(text).lower().split()  # bytes: ASCII letters and spaces only


def shingle_run(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """A 64-bit hash of each run of WORDS words; of all words if they are fewer; none without words."""
    one = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    out = np.full(max(1, len(one) - WORDS + 1) if words else 0, len(words[:WORDS]), np.uint64)
    for i in range(min(WORDS, len(one))):
        out = (out + one[i : i + len(out)]) * _P1
        out ^= out >> np.uint64(32)
    out *= _P2
    return out ^ (out >> np.uint64(29))


def shingle_set(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    return np.unique(shingle_run(words, hashes))


def least_shared(size):
    """Shingles that a set of this size shares with any set at THRESHOLD or above."""
    return -(-THRESHOLD[0] * size // THRESHOLD[1])


def _enough(shared, sizes):
    """shared / (sizes - shared) >= THRESHOLD."""
    return sum(THRESHOLD) * shared >= THRESHOLD[0] * sizes


def common_shingles(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Shingles that two texts or more of a sample have, the rarest first, at most COMMON of them."""
    every = max(1, docs.count() // SAMPLE)
    some = docs.select(F.col(text).alias("text")).where(F.pmod(F.xxhash64("text"), F.lit(every)) == 0).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for t in batch.column("text"):
                yield pa.RecordBatch.from_arrays([pa.array(shingle_set(words_of(t.as_py()), hashes).view(np.int64))], names=["shingle"])

    seen = some.mapInArrow(run, "shingle long").groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    top = seen.orderBy(F.desc("n"), "shingle").limit(COMMON).select("shingle").toArrow().column("shingle")
    return top.to_numpy()[::-1].astype(np.int64).view(np.uint64)


def prefix(s: np.ndarray, by_hash: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, int]:
    """The first shingles of a set, rare ones before common ones, and how many of them are rare. Two sets at THRESHOLD or
    above have one of them in common, because fewer than least_shared are left out."""
    place = np.full(len(s), -1)
    if len(table) and len(s):
        i = np.minimum(np.searchsorted(table, s), len(table) - 1)
        place = np.where(table[i] == s, by_hash[i], -1)
        s = s[np.argsort(place, kind="stable")]
    n = len(s) - least_shared(len(s)) + 1 if len(s) else 0
    return s[:n], min(n, int((place < 0).sum()))


def describe(docs: DataFrame, columns: list[str], common: np.ndarray, text: str = "text") -> DataFrame:
    """The columns, then node and check, together a 128-bit hash of the words; fp, the SimHash; size, the number of
    distinct shingles; keys, the prefix, and rare, how many of it are rare. A task gives a node's keys once."""
    sent = docs.sparkSession.sparkContext.broadcast(common)  # at most COMMON

    def make():
        by_hash = np.argsort(sent.value)
        table, hashes, seen = sent.value[by_hash], WordHashes(), set()

        def values(texts):
            out = []
            for t in texts:
                words = words_of(t)
                whole = xxhash.xxh3_128_digest(b" ".join(words))
                run = shingle_run(words, hashes)
                s, rare = np.unique(run), 0
                size = len(s)
                if whole in seen:
                    s = s[:0]
                else:
                    seen.add(whole)
                    s, rare = prefix(s, by_hash, table)
                out.append((int.from_bytes(whole[:8], "big", signed=True), int.from_bytes(whole[8:], "big", signed=True), simhash(run), size, s.view(np.int64), rare))
            return [*map(list, zip(*out))]

        return values

    fields = [("node", T.LongType()), ("check", T.LongType()), ("fp", T.LongType()), ("size", T.IntegerType()), ("keys", T.ArrayType(T.LongType())), ("rare", T.IntegerType())]
    return map_texts(docs, columns, text, [T.StructField(*f) for f in fields], make)


def _told_apart(rows: DataFrame) -> DataFrame:
    """rows with the other half of the hash as node where different words have equal halves: about n * n / 2 ** 65 of n texts.
    Such nodes are written, and rows meet them only if there are any."""
    twice = rows.groupBy("node").agg((F.min("check") < F.max("check")).alias("clash")).where("clash").select("node")
    twice = materialize(twice.withColumn("twice", F.lit(True)), "clashes")
    if twice.isEmpty():
        return rows
    met = rows.join(twice, "node", "left")
    return met.withColumn("node", F.when(F.col("twice"), F.col("check")).otherwise(F.col("node"))).select(rows.columns)


def _shared_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, node, size, at, common) sorted by key and node -> the rows, once each, of keys that are common or that two nodes
    have. One row is held between batches, so a key may have any number of them."""
    last, waits = None, False  # the last row; whether it is the first of its key and has not been passed on
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("key", "node", "size", "at", "common")], axis=1)
        fresh = np.ones(len(rows), bool)
        fresh[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
        fresh[0] = last is None or bool((rows[0, :2] != last[:2]).any())
        rows = rows[fresh]
        if len(rows) == 0:
            continue
        start = np.ones(len(rows), bool)
        start[1:] = rows[1:, 0] != rows[:-1, 0]
        start[0] = last is None or rows[0, 0] != last[0]
        if waits and not start[0]:
            rows, start = np.concatenate((last[None], rows)), np.concatenate(([True], start))
        alone = start & np.append(start[1:], True) & (rows[:, 4] == 0)
        last, waits = rows[-1], bool(alone[-1])
        out = rows[~alone]
        yield pa.RecordBatch.from_arrays([pa.array(out[:, i].copy()) for i in range(4)], names=["key", "node", "size", "at"])


def _key_rows(rows: DataFrame) -> DataFrame:
    """(key, node, size, at), at: the place in the node's prefix, of all keys that two nodes or more have. A common key's rows are dealt over SALTS places."""
    each = rows.select("node", "size", "rare", F.posexplode("keys").alias("at", "key")).select("key", "node", "size", "at", (F.col("at") >= F.col("rare")).alias("common"))
    dealt = each.withColumn("salt", F.when(F.col("common"), F.pmod("node", F.lit(SALTS))).otherwise(F.lit(0)))
    return dealt.repartition("key", "salt").sortWithinPartitions("key", "node").mapInArrow(_shared_keys, "key long, node long, size long, at long")


def crowded_shingles(texts: DataFrame, common: np.ndarray) -> np.ndarray:
    """common, and before it the shingles that crowd the prefixes which common gives, the least crowded first. The texts looked
    at grow with the table, so a crowd is seen at the same number of texts at any size; it sets the order, never the result."""
    some = texts.where(F.pmod(F.xxhash64("text"), F.lit(CROWD_SAMPLE)) == 0)
    for _ in range(LOOKS):
        rows = _key_rows(describe(some, [], common)).groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") >= CROWD)
        top = rows.orderBy(F.desc("n"), "key").limit(CROWDED).select("key").toArrow().column("key").to_numpy()[::-1].astype(np.int64).view(np.uint64)
        fresh = top[~np.isin(top, common)]
        if len(fresh) == 0:
            break
        common = np.concatenate((fresh, common))
    return common


def _mixed(of: DataFrame, linked: DataFrame | None) -> DataFrame:
    """(key, node, size, at, component), components as linked has them, of keys whose nodes are not all in one component.
    A row whose key lies too late in its prefix to be the first that the set shares with any other of that key is left
    out."""
    if linked is not None:
        of = of.drop("component").join(linked, "node", "left").select("key", "node", "size", "at", F.coalesce("component", "node").alias("component"))
    mixed = of.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.min("size").alias("least")).where("low < high").select("key", "least")
    partner = F.greatest("least", F.ceil(F.col("size") * THRESHOLD[0] / THRESHOLD[1]))
    rows = of.join(mixed, "key").where(_enough(F.col("size") - F.col("at"), F.col("size") + partner))
    return materialize(rows.select("key", "node", "size", "at", "component"), "mixed")


def _side(of: DataFrame, node: str, *more: str) -> DataFrame:
    """of with the names of one side of a pair: node, and size_, at_ and of_ it."""
    return of.select("key", F.col("node").alias(node), F.col("size").alias(f"size_{node}"), F.col("at").alias(f"at_{node}"), F.col("component").alias(f"of_{node}"), *more)


def _possible(pairs: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b, of pairs of sides that can reach THRESHOLD. If their key is the first that both sets have,
    they share no more than what follows it in either; the pair's first key is among its rows."""
    left = F.least(F.col("size_a") - F.col("at_a"), F.col("size_b") - F.col("at_b"))
    pairs = pairs.where(_enough(left, F.col("size_a") + F.col("size_b")))
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _pivot_pairs(of: DataFrame, turn: int) -> DataFrame:
    """Pairs of different components: nodes with the pivots of a key that both have. Nodes are pivots by a seeded hash, so
    keys of one crowd choose the same: PIVOTS to twice as many in a large key's mean, twice as many each turn, all in a
    small key."""
    n = of.groupBy("key").agg(F.count("*").alias("n"))
    one_in = F.pow(F.lit(2), F.floor(F.log2(F.greatest(F.col("n") / (PIVOTS << turn), F.lit(1))))).cast("long")
    pivots = of.join(n, "key").withColumn("one_in", one_in).where("pmod(xxhash64(node, %d), one_in) = 0" % turn)
    return _possible(_side(pivots, "a", "one_in").join(_side(of, "b"), "key").where("of_a <> of_b AND (a < b OR one_in > 1)"))


def _pairs_across(of: DataFrame) -> DataFrame:
    """All pairs of different components. Components of a key meet before their nodes do, the one of fewer nodes first, unless
    no two of their nodes can reach THRESHOLD: none shares more than the most that follows the key, nor is smaller than the least."""
    there = of.groupBy("key", F.col("component").alias("of_a")).agg(F.count("*").alias("n"), F.min("size").alias("least"), F.max(F.col("size") - F.col("at")).alias("most"))
    other = there.select("key", F.col("of_a").alias("of_b"), F.col("n").alias("n_b"), F.col("least").alias("least_b"), F.col("most").alias("most_b"))
    reach = _enough(F.least("most", "most_b"), F.col("least") + F.col("least_b"))
    sides = there.join(other, "key").where("n < n_b OR n = n_b AND of_a < of_b").where(reach).select("key", "of_a", "of_b")
    return _possible(sides.join(_side(of, "a"), ["key", "of_a"]).join(_side(of, "b"), ["key", "of_b"]))


def _golay_pairs(nodes: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: the least node of a fingerprint with its others, and those of fingerprints within two bits."""
    least = nodes.groupBy("fp").agg(F.min("node").alias("a"))
    same = nodes.join(least, "fp").select("a", F.col("node").alias("b")).where("a <> b")
    links = link_within_two(least.select("fp")).withColumnsRenamed({"a": "x", "b": "y"})
    near = links.join(least.withColumnRenamed("fp", "x"), "x").join(least.select(F.col("fp").alias("y"), F.col("a").alias("b")), "y")
    return same.unionAll(near.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()


def jaccard_reached(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether the whole sets have a Jaccard similarity of THRESHOLD or more, in whole numbers."""
    return bool(_enough(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)))


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, x, y), x and y their texts -> (a, b) at THRESHOLD or above. The last set of either side is kept."""
    hashes = WordHashes()
    last: list[tuple[str | None, np.ndarray | None]] = [(None, None), (None, None)]
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y")):
            for side, t in enumerate((x.as_py(), y.as_py())):
                if last[side][1] is None or t != last[side][0]:
                    last[side] = t, shingle_set(words_of(t), hashes)
            keep.append(jaccard_reached(last[0][1], last[1][1]))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _verified(found: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) that reach THRESHOLD, perhaps repeated. nodes: (node, r1, r2) of one row each; texts:
    (r1, r2, text). Texts travel, not sets: they take less room."""
    wanted = found.select(F.col("a").alias("node")).unionAll(found.select(F.col("b").alias("node"))).distinct()
    wanted = materialize(nodes.join(wanted, "node").select("r1", "r2", "node"), "wanted")
    some = materialize(texts.join(wanted, ["r1", "r2"]).select("node", "text"), "texts")
    checked = found.join(some.select(F.col("node").alias("a"), F.col("text").alias("x")), "a")
    checked = checked.join(some.select(F.col("node").alias("b"), F.col("text").alias("y")), "b").select("a", "b", "x", "y")
    few_rows_a_batch(texts.sparkSession)
    return materialize(checked.mapInArrow(_similar, "a long, b long"), "links")


def _groups(texts: DataFrame) -> DataFrame:
    """texts: (key, r1, r2, text), r1 and r2 a hash of key and text -> a row (key, r1, r2, node, component) for each
    distinct (key, text)."""
    found = materialize(describe(texts, ["key", "r1", "r2"], crowded_shingles(texts, common_shingles(texts))), "described")
    rows = _told_apart(found)
    first = F.struct(F.col("key").isNull().alias("no_key"), "key", "r1", "r2")
    nodes = materialize(rows.groupBy("node").agg(F.min("fp").alias("fp"), F.min(first).alias("of")).select("node", "fp", "of.r1", "of.r2"), "nodes")
    shared = materialize(_key_rows(rows), "keys")
    of, tried, linked = shared.withColumn("component", F.col("node")), None, None
    for turn in range(TURNS + 1):
        of = _mixed(of, linked)
        pairs = _pivot_pairs(of, turn) if turn < TURNS else _pairs_across(of)
        if tried is None:
            pairs = pairs.unionAll(_golay_pairs(nodes)).distinct()
        else:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialize(pairs, "pairs")
        links = _verified(pairs, nodes, texts)
        linked = components(links if linked is None else links.unionAll(linked.select(F.col("node").alias("a"), F.col("component").alias("b"))))
        tried = pairs if tried is None else tried.unionAll(pairs)
    return rows.select("key", "r1", "r2", "node").distinct().join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    row = (F.col(key).cast("string"), F.col(text))
    return docs.select(F.col(key).alias("key"), F.xxhash64(*row).alias("r1"), F.xxhash64(F.lit(1), *row).alias("r2"), F.col(text).alias("text"))


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, node, component) of each distinct key and text: rows of one component are near-duplicates of each other,
    directly or by others between; rows of one node are copies."""
    return _groups(_texts(docs, key, text)).select(F.col("key").alias(key), "node", "component")


def drop_near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without all but one row of each near_groups component: the one of the smallest key, rows without a key last;
    of different texts under one key the one of the smallest hash; of repeated rows one."""
    first = F.min(F.struct(F.col("key").isNull().alias("no_key"), "key", "r1", "r2")).alias("of")
    with scratch(docs.sparkSession) as keep:  # the steps' tables go before the next stage runs
        kept = keep(_groups(_texts(docs, key, text)).groupBy("component").agg(first).select("of.r1", "of.r2"), "kept")
    r1, r2, nth = free_names(docs.columns, "r1", "r2", "nth")
    rows = docs.withColumns({r1: F.xxhash64(F.col(key).cast("string"), text), r2: F.xxhash64(F.lit(1), F.col(key).cast("string"), text)})
    rows = rows.join(kept.select(F.col("r1").alias(r1), F.col("r2").alias(r2)), [r1, r2], "left_semi")
    one = Window.partitionBy(r1, r2).orderBy(r1)
    return rows.withColumn(nth, F.row_number().over(one)).where(F.col(nth) == 1).select(docs.columns)
