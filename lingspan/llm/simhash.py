"""SimHash near-duplicate detection with Golay-code fuzzy hashing.

The perfect binary Golay code [23, 12, 7] maps each 23-bit vector to the index of the one codeword within 3 bits. A
segment of a fingerprint gets the indices of itself and of all its one-bit neighbours: one or six keys. Two segments up
to two bits apart share a key, because a vector between them is a neighbour of both.

Fingerprints of 64 bits are cut into segments of 22, 21 and 21 bits.
* `link_within_two` finds all pairs at most 2 bits apart: by the pigeonhole principle one segment is equal, and the
  other two are at most 2 bits apart each, so (equal segment, a Golay key of the next one) is shared. Fingerprints of
  a bucket of at most BUCKET are compared; those of larger ones are linked exactly by their one-bit neighbourhoods
  (two fingerprints within 2 bits have a common one), whose groups hold at most 65 and need no comparison.

Equal fingerprints are one node, however many there are. near.py builds near-duplicate groups of texts on these links.

Null and empty texts, and texts without words, have the fingerprint 0 and are linked like any other. Repeated rows of
one doc_id are copies. A null doc_id takes part but is never a component's name unless all are null. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .components import components
from .shared import map_texts, materialize, utf8

SEED = 42
BUCKET = 64
SEGMENTS = ((0, 22), (22, 21), (43, 21))  # first bit, width
GENERATOR = 0xAE3  # x^11 + x^9 + x^7 + x^6 + x^5 + x + 1


def _bit_table() -> np.ndarray:
    return ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


_BITS = _bit_table()


def shingle_hashes(words: list[bytes], n: int) -> np.ndarray:
    """XXH64 of each run of n words joined by spaces; of all words if they are fewer."""
    text = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))
    k = max(1, len(words) - n + 1)
    spans = zip(starts[:k].tolist(), (ends[len(words) - k :] - 1).tolist())
    h = xxhash.xxh64_intdigest
    return np.fromiter((h(text[i:j], SEED) for i, j in spans), np.uint64, k)


def simhash(hashes: np.ndarray) -> int:
    """Bit i is set if it is in over half of the hashes; as a signed 64-bit integer."""
    if len(hashes) == 0:
        return 0
    by = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(by[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, n: int, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns) plus fp: the SimHash of n-word shingles, repeats included, A-Z lower-cased."""
    columns = [c for c in (docs.columns if columns is None else columns) if c != "fp"]

    def values(texts):
        words = (utf8(t).lower().split() for t in texts)  # bytes: ASCII letters and spaces only
        return [[simhash(shingle_hashes(w, n)) if w else 0 for w in words]]

    return map_texts(docs, columns, text, [T.StructField("fp", T.LongType())], lambda: values)


class Golay:
    """Decoding by syndromes: 2 ** 11 of them, one for each error of weight 0 to 3."""

    def __init__(self):
        one = [self._syndrome(1 << i) for i in range(23)]
        self.low, self.high = (np.array([self._xor(one[at : at + 12], v) for v in range(1 << min(12, 23 - at))], np.int64) for at in (0, 12))
        self.error = np.zeros(1 << 11, np.int64)
        for i in range(23):
            for j in range(i + 1):
                for k in range(j + 1):
                    e = {1 << i} ^ {1 << j} ^ {1 << k}
                    self.error[self._xor(one, sum(e))] = sum(e)
        for i in range(23):
            for j in range(i):
                self.error[one[i] ^ one[j]] = 1 << i | 1 << j
        self.error[0] = 0

    @staticmethod
    def _syndrome(v: int) -> int:
        for i in range(22, 10, -1):
            if v >> i & 1:
                v ^= GENERATOR << (i - 11)
        return v

    @staticmethod
    def _xor(one: list[int], v: int) -> int:
        out = 0
        for i, s in enumerate(one):
            if v >> i & 1:
                out ^= s
        return out

    def index(self, v: np.ndarray) -> np.ndarray:
        """The 12 message bits of the nearest codeword."""
        return (v ^ self.error[self.low[v & 0xFFF] ^ self.high[v >> 12]]) >> 11

    def keys(self, v: np.ndarray, width: int) -> np.ndarray:
        """A row for each vector: the indices of it and its one-bit neighbours, -1 for repeats."""
        near = self.index(v[:, None] ^ np.concatenate(([0], 1 << np.arange(width))))
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        return near


def _segments(fp: np.ndarray) -> list[np.ndarray]:
    u = fp.view(np.uint64)
    return [((u >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64) for at, width in SEGMENTS]


def exact_and_golay(golay: Golay, fp: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row, key): an equal segment with a Golay key of the next one."""
    parts = _segments(fp)
    for t, part in enumerate(parts):
        after = (t + 1) % 3
        near = golay.keys(parts[after], SEGMENTS[after][1])
        row, col = np.nonzero(near >= 0)
        yield row, (np.int64(t) << 40) | (part[row] << 12) | near[row, col]


def _keyed(nodes: DataFrame, columns: list[str], make) -> DataFrame:
    """A row (key, *columns) for each key of each node's fp."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        golay = Golay()
        for whole in batches:
            for at in range(0, whole.num_rows, 4000):
                batch = whole.slice(at, 4000)
                for row, key in make(golay, batch.column("fp").to_numpy()):
                    yield pa.RecordBatch.from_arrays([pa.array(key), *(batch.column(c).take(pa.array(row)) for c in columns)], names=["key", *columns])

    schema = T.StructType([T.StructField("key", T.LongType()), *(nodes.schema[c] for c in columns)])
    return nodes.select("fp", *[c for c in columns if c != "fp"]).mapInArrow(run, schema)


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str], most: int) -> Iterator[list[np.ndarray]]:
    """Arrays of rows sorted by their first column, cut between keys; a key of over `most` rows comes in several."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        now = [batch.column(c).to_numpy(zero_copy_only=False) for c in columns]
        held = now if held is None else [np.concatenate(x) for x in zip(held, now)]
        cut = int(np.searchsorted(held[0], held[0][-1]))
        cut = cut or (len(held[0]) if len(held[0]) > most else 0)
        if cut:
            yield [x[:cut] for x in held]
            held = [x[cut:] for x in held] if cut < len(held[0]) else None
    if held is not None:
        yield held


def _pairs_of_equal_fp_neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, fp) sorted by key -> (a, b) at most 2 bits apart from buckets up to BUCKET; (fp, null) of larger ones."""
    last = None
    for key, fp in _groups(batches, ["key", "fp"], 100_000):
        edges = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1], [True])))
        size = np.repeat(np.diff(edges), np.diff(edges))
        size[key == last] = BUCKET + 1  # the rest of a key that was cut, and so is large
        last = key[-1] if len(key) > 100_000 else None
        large = np.unique(fp[size > BUCKET])
        key, fp = key[size <= BUCKET], fp[size <= BUCKET]
        yield pa.RecordBatch.from_arrays([pa.array(large), pa.nulls(len(large), pa.int64())], names=["a", "b"])
        at = np.arange(len(key))
        for d in range(1, BUCKET):
            at = at[at + d < len(key)]
            at = at[key[at] == key[at + d]]
            if at.size == 0:
                break
            near = at[np.bitwise_count((fp[at] ^ fp[at + d]).view(np.uint64)) <= 2]
            if near.size:
                yield pa.RecordBatch.from_arrays([pa.array(fp[near]), pa.array(fp[near + d])], names=["a", "b"])


def link_within_two(fps: DataFrame) -> DataFrame:
    """Distinct fp -> links (a, b) that connect all fingerprints at most 2 bits apart."""
    spread = _keyed(fps, ["fp"], exact_and_golay).repartition("key").sortWithinPartitions("key")
    found = materialize(spread.mapInArrow(_pairs_of_equal_fp_neighbours, "a long, b long").distinct(), "links")
    crowded = found.where("b IS NULL").select(F.col("a").alias("fp"))
    around = crowded.select("fp", F.explode(F.expr("transform(sequence(-1, 63), i -> CASE WHEN i < 0 THEN fp ELSE fp ^ shiftleft(1L, i) END)")).alias("near"))
    stars = around.groupBy("near").agg(F.collect_list("fp").alias("of")).where("size(of) > 1")  # at most 65 each
    stars = stars.select(F.array_min("of").alias("a"), F.explode("of").alias("b")).where("a <> b").distinct()
    return found.where("b IS NOT NULL").unionAll(stars)


def simhash_components(docs: DataFrame, n: int = 3, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, fp, component_id): links at 2 bits or fewer; the component's name is its smallest key."""
    rows = materialize(fingerprints(docs, n, [key], text), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min(key).alias("least"))
    found = components(link_within_two(nodes.select("fp"))).withColumnRenamed("node", "fp")
    named = nodes.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    of = named.select("fp", "component").join(names, "component").select("fp", "component_id")
    return rows.join(of, "fp").select(key, "fp", "component_id")
