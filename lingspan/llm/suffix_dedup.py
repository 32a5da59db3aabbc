"""Exact removal of long repeated substrings by a distributed merge sort of suffixes.

Every byte inside a string of LENGTH bytes that also starts elsewhere, in the same text or another, is removed.

1. Anchors. Of the GRAM-byte strings inside each window of LENGTH bytes, the one with the least rolling hash is an
   anchor. Equal windows have their anchors at the same place, so only suffixes that start at anchors are looked at:
   about one in (LENGTH - GRAM) / 2. An anchor's context is the LENGTH - GRAM bytes before it and LENGTH bytes from it
   on, within the text. Anchors with equal contexts are a class; a class of two or more is repeated over its whole
   context. Classes that share their GRAM bytes with another class go on, one member each.
2. Runs. Tasks sort what they have of these classes twice, by the suffix from the anchor on and by the reversed prefix
   before it, behind the hash of the GRAM bytes; cut the sorted run at the ranges' bounds; and front-code the pieces:
   each string without the prefix it shares with the one before.
3. Merge. A range's runs meet in a loser tree whose players know their common prefix with the last winner. Of two
   players the one with the longer common prefix wins unseen; only equal ones are compared, from that prefix on. The
   winners come out with the common prefixes between neighbours, and only these are kept.
4. Depths. Two anchors agree over L bytes leftward and R rightward, and repeat each other's windows if L + R >= LENGTH.
   The window that begins d bytes before its anchor is repeated if another class of the gram agrees over d bytes leftward
   and LENGTH - d rightward: if both lie in one block of either order, cut where neighbours share less. So for each depth
   d the pairs of blocks that two classes have are looked for; all windows of an anchor hold its gram, so the least and
   the greatest such d say what of a class is repeated. No text and no hash of a window is needed.
5. A gram of over SPLIT classes is dealt out: the windows that begin PART neighbouring depths before the anchor share all
   but PART - 1 bytes at either end, their core. For each such part a class goes, with these end bytes alone, to the classes
   that have its core, by 128 bits of the core. So a crowd meets in parts, by what surrounds the gram. What is left
   in one task are the classes with one core: 200 bytes each at most in the runs, 44 beside them, and under 300 while depths
   are looked for.
6. Repeated stretches of a class hold for all its members; their union is cut out of each text. Classes and rows are told
   apart by 128 bits: of n of them two are taken for one with odds of about n * n / 2 ** 129.

Bounds are drawn from a sample of SAMPLED classes a range; they decide where work is done, not results. Text travels
through one shuffle by row for the contexts and one for the results.

Passages of over 50 words are reported beside this, not removed: in bytes many are shorter than LENGTH. Of the WORD_GRAM-word
strings inside each PASSAGE words of a text the one with the least hash is a fingerprint, and `passages` counts a text's
distinct fingerprints that are also one of another text. Where two texts share PASSAGE words in a row it is at least 1 for both;
where they share no WORD_GRAM words it is 0, but for equal 64-bit hashes; in between it depends on the words beside. Words are
`[^\x20\x09-\x0D]+`. These fingerprints decide nothing about the bytes removed.

A null text is empty. Texts shorter than LENGTH lose nothing. Repeated rows are texts of their own, each other's
copies. An empty table gives an empty result; other columns don't matter.
"""

from __future__ import annotations

import struct
from array import array
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_texts, materialize, utf8

LENGTH = 400
GRAM = 64
BEFORE = LENGTH - GRAM
#: Bytes of sorted strings a task holds before it writes a run.
RUN_BYTES = 16_000_000
#: Sampled classes a range, for the ranges' bounds, and ranges a shuffle partition.
SAMPLED = 16
RANGES = 4
#: A gram of more classes than this is dealt out by the cores of its windows, PART depths together.
SPLIT = 100_000
PART = 49
#: Classes whose depths are looked for at a time; a gram's are taken together.
CLASSES = 20_000
#: Windows that `repeated` sorts at once; more are sorted in 16 parts.
SORTED = 500_000
#: Words of a passage that is always reported, and of a fingerprint.
PASSAGE = 51
WORD_GRAM = 34
#: Bytes of texts that are fingerprinted at a time; a longer text is taken alone.
PIECE_BYTES = 500_000
_SPACE = np.isin(np.arange(256), [*range(9, 14), 32])

_BASE = 0x9E3779B97F4A7C15
_tables: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_tables[0]) < n:
        m = 1 << (n - 1).bit_length()
        for k, b in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            _tables[k] = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(m - 1, b, np.uint64))), dtype=np.uint64)
    return _tables


def _sums(data: np.ndarray) -> np.ndarray:
    """Running sums of the values, each times its place's power of the base."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def _mix(h: np.ndarray) -> np.ndarray:
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """A mixed 64-bit rolling hash of each run of `size` bytes, or of other numbers."""
    sums = _sums(data)
    return _mix((sums[size:] - sums[:-size]) * _powers(len(data) + 1)[1][: len(data) - size + 1])


def sliding(values: np.ndarray, width: int, fold: np.ufunc, fill: int) -> np.ndarray:
    """fold over each `width` neighbours, from block-wise running folds in both directions."""
    n = len(values)
    blocks = np.full(-(-n // width) * width, fill, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, width)
    ahead = fold.accumulate(blocks, axis=1).ravel()
    back = fold.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return fold(back[: n - width + 1], ahead[width - 1 : n])


def winnow(h: np.ndarray, width: int, usable: np.ndarray | None = None) -> np.ndarray:
    """Places of the least of each `width` neighbours, all of equal ones; usable: of these windows, those that count."""
    least = sliding(h, width, np.minimum, (1 << 64) - 1)
    if usable is not None:
        least[~usable] = 0
    best = np.zeros(len(least) + 2 * (width - 1), np.uint64)
    best[width - 1 : width - 1 + len(least)] = least
    return np.flatnonzero(sliding(best, width, np.maximum, 0) == h)


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of a text's anchors; places with equal least hashes are all anchors."""
    if len(data) < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(data)
    at = winnow(h, BEFORE + 1)
    return at, h[at]


def fingerprints(texts: list[bytes]) -> list[np.ndarray]:
    """The distinct fingerprints of each text, as signed numbers."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    space = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts) < PASSAGE:
        return [np.zeros(0, np.int64)] * len(texts)
    sums = _sums(data)
    words = _mix((sums[ends] - sums[starts]) * _powers(len(data) + 1)[1][starts])
    of = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
    h = gram_hashes(words, WORD_GRAM)
    at = winnow(h, PASSAGE - WORD_GRAM + 1, of[: 1 - PASSAGE] == of[PASSAGE - 1 :])
    of, h = of[at], h[at].view(np.int64)
    order = np.lexsort((h, of))
    of, h = of[order], h[order]
    fresh = np.concatenate(([True], (of[1:] != of[:-1]) | (h[1:] != h[:-1]))) if len(h) else np.zeros(0, bool)
    of, h = of[fresh], h[fresh]
    return np.split(h, np.searchsorted(of, np.arange(1, len(texts))))


def _contexts(raw: bytes, at: int) -> tuple[bytes, bytes]:
    return raw[max(0, at - BEFORE) : at], raw[at : at + LENGTH]


def _class_of(before: bytes, after: bytes) -> int:
    """With the gram's own hash, 128 bits that tell contexts apart."""
    return xxhash.xxh3_64_intdigest(before + after, len(before)) - (1 << 63)


def find_anchors(docs: DataFrame, keys: list[str], text: str) -> DataFrame:
    """A row (keys, places, grams, classes) for each text that has anchors; the arrays are as long as its anchors."""

    def values(texts):
        out = []
        for t in texts:
            raw = utf8(t)
            at, h = anchors(np.frombuffer(raw, np.uint8))
            out.append((at.tolist(), h.view(np.int64).tolist(), [_class_of(*_contexts(raw, i)) for i in at.tolist()]))
        return [*map(list, zip(*out))]

    fields = [T.StructField("places", T.ArrayType(T.IntegerType())), T.StructField("grams", T.ArrayType(T.LongType())), T.StructField("classes", T.ArrayType(T.LongType()))]
    return map_texts(docs, keys, text, fields, lambda: values).where("size(places) > 0")


def shared_passages(rows: DataFrame) -> DataFrame:
    """(rid, passages) of the rows (rid, text) that share fingerprints with other rows. Equal rows have one rid."""

    def values(texts):
        out, piece, size = [], [], 0
        for raw in map(utf8, texts):
            if piece and size + len(raw) > PIECE_BYTES:
                out += fingerprints(piece)
                piece, size = [], 0
            piece.append(raw)
            size += len(raw)
        return [out + fingerprints(piece) if piece else out]

    printed = map_texts(rows, ["rid"], "text", [T.StructField("prints", T.ArrayType(T.LongType()))], lambda: values).where("size(prints) > 0")
    each = materialize(printed, "prints").select("rid.*", F.explode("prints").alias("print"))
    # A table, so that the join can split a passage that a great many texts have.
    twice = materialize(each.groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print"), "passages")
    names = each.columns[:-1]
    return each.join(twice, "print").groupBy(F.struct(*names).alias("rid")).agg(F.size(F.collect_set("print")).cast("long").alias("passages"))


def common(a: bytes, b: bytes, start: int = 0) -> int:
    """Length of the common prefix, known to be `start` at least."""
    n = min(len(a), len(b))
    while start < n:
        x, y = a[start : start + 48], b[start : start + 48]
        if x != y:
            m = min(len(x), len(y))
            differs = int.from_bytes(x[:m], "big") ^ int.from_bytes(y[:m], "big")
            return start + m - (differs.bit_length() + 7) // 8
        start += len(x)
    return n


_HEAD = struct.Struct("<HHHq")


def front_code(records: list[tuple[bytes, bytes, int]]) -> bytes:
    """Sorted (string, other side, class) records; each string without what it shares with the one before."""
    out, last = [], b""
    for key, other, cls in records:
        shared = common(last, key)
        out += [_HEAD.pack(shared, len(key) - shared, len(other), cls), key[shared:], other]
        last = key
    return b"".join(out)


def front_decode(run: bytes | memoryview) -> Iterator[tuple[int, bytes, bytes, int]]:
    """(prefix shared with the one before, string, other side, class)"""
    at, key = 0, b""
    while at < len(run):
        shared, rest, other, cls = _HEAD.unpack_from(run, at)
        at += _HEAD.size
        key = key[:shared] + run[at : at + rest]
        at += rest
        yield shared, key, bytes(run[at : at + other]), cls
        at += other


def merge(runs: list[bytes | memoryview]) -> Iterator[tuple[int, bytes, bytes, int]]:
    """The records of all runs in order, with the prefix each shares with the one before it."""
    streams = [front_decode(r) for r in runs]
    n = 1 << max(0, (len(streams) - 1).bit_length())
    heads: list = [next(s, None) for s in streams] + [None] * (n - len(streams))
    known = [0] * n  # common prefix with the last winner
    losers = [-1] * n

    def beats(p: int, q: int) -> bool:
        """Whether p comes before q; the loser's known prefix is then that with the winner."""
        if heads[p] is None or heads[q] is None:
            return heads[p] is not None
        if known[p] != known[q]:
            return known[p] > known[q]
        a, b = heads[p][1], heads[q][1]
        shared = common(a, b, known[p])
        first = shared == len(a) or (shared < len(b) and a[shared] < b[shared])
        known[q if first else p] = shared
        return first

    def play(node: int) -> int:
        if node >= n:
            return node - n
        p, q = play(2 * node), play(2 * node + 1)
        if not beats(p, q):
            p, q = q, p
        losers[node] = q
        return p

    winner = play(1)
    while heads[winner] is not None:
        _, key, other, cls = heads[winner]
        yield known[winner], key, other, cls
        heads[winner] = following = next(streams[winner], None)
        if following is not None:
            known[winner] = following[0]
        node = (winner + n) >> 1
        while node:
            if not beats(winner, losers[node]):
                winner, losers[node] = losers[node], winner
            node >>= 1


_GRAM, _PREFIX, _CORE = 8, 9, 17


def _records(raw: bytes, at: int, gram: int, cls: int, split: bool) -> list[tuple[bytes, bytes, int]]:
    """The anchor's string in either order: the hash of its gram, a byte for the order, then the suffix or the reversed
    prefix. So both orders of a gram lie together. Split, for each part: 64 bits of the core's hash, a byte for the part and
    the order, the other 64 bits, then what follows the core or precedes it; beside the first of the two, the gram's hash."""
    if not split:
        before, after = _contexts(raw, at)
        hashed = struct.pack(">q", gram)
        return [(hashed + b"\0" + after, b"", cls), (hashed + b"\1" + before[::-1], b"", cls)]
    out = []
    for k, least in enumerate(range(0, BEFORE + 1, PART)):
        most = min(least + PART - 1, BEFORE)
        low, high = at - least, at + LENGTH - most
        if low < 0 or high > len(raw):  # no window of the part lies in the text
            continue
        core = xxhash.xxh3_128_digest(raw[low:high], least)
        for order, rest in enumerate((raw[high : at + LENGTH - least], raw[max(0, at - most) : low][::-1])):
            out.append((core[:8] + bytes([2 * k + 2 + order]) + core[8:] + rest, b"" if order else struct.pack(">q", gram), cls))
    return out


class Depths:
    """The merged records of some groups, in either order: the class, the group's number and the common length with the
    record before, from the anchor on; -1 where none counts."""

    def __init__(self):
        self.classes, self.groups, self.shared = ((array(kind), array(kind)) for kind in "qqh")
        self.grams = array("q")
        self.number = self.code = -1

    def add(self, known: int, key: bytes, other: bytes, cls: int) -> None:
        code = key[_GRAM]
        order, part = code & 1, (code >> 1) - 1
        if known < _GRAM or code >> 1 != self.code:
            self.number += 1
            self.code = code >> 1
        if part < 0:
            shared = known - _PREFIX if known >= _PREFIX else -1
        else:
            most = min(part * PART + PART - 1, BEFORE)
            shared = known - _CORE + (part * PART if order else LENGTH - most) if known >= _CORE else -1
        self.classes[order].append(cls)
        self.groups[order].append(self.number)
        self.shared[order].append(shared)
        if not order:
            self.grams.append(struct.unpack(">q", other or key[:_GRAM])[0])

    def __len__(self) -> int:
        return len(self.grams)

    def stretches(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(gram, class, from, to), relative to the anchor, of the classes with repeated windows."""
        classes, groups, shared = ([np.array(x) for x in both] for both in (self.classes, self.groups, self.shared))
        grams = np.array(self.grams)
        for again in (False, True):
            # places[k][i]: of class i in order k; most[k][i]: its greatest common length with another.
            places = [np.lexsort((c, g)) for c, g in zip(classes, groups)]
            most = [np.maximum(s, np.append(s[1:], -1))[at].astype(int) if len(s) else s.astype(int) for s, at in zip(shared, places)]
            may = (most[0] >= 0) & (most[1] >= 0) & (most[0] + most[1] >= LENGTH)
            if again:
                break
            # Groups without such classes go; others lose none, since blocks are cut by all.
            kept = np.zeros(self.number + 1, bool)
            kept[groups[0][places[0]][may]] = True
            grams = grams[kept[groups[0]]]
            classes, shared, groups = ([x[kept[g]] for x, g in zip(both, groups)] for both in (classes, shared, groups))
        least, greatest = np.full(len(may), -1), np.full(len(may), -1)
        depths = np.unique(np.concatenate((shared[1], LENGTH - shared[0])))
        may = np.flatnonzero(may)
        for d in depths[(depths >= 0) & (depths <= BEFORE)].tolist():
            some = may[(most[1][may] >= d) & (most[0][may] >= LENGTH - d)]
            right, left = (np.cumsum(s < least_)[at[some]] for s, at, least_ in zip(shared, places, (LENGTH - d, d)))
            pair = right * (len(grams) + 1) + left
            order = np.argsort(pair)
            same = np.diff(pair[order]) == 0
            hit = some[order[np.concatenate((same, [False])) | np.concatenate(([False], same))]] if len(some) else some
            greatest[hit] = d
            least[hit[least[hit] < 0]] = d
        hit = np.flatnonzero(least >= 0)
        at = places[0][hit]
        return grams[at], classes[0][at], -greatest[hit], LENGTH - least[hit]


def repeated(found: Iterator[tuple[int, int, bytes]]) -> Iterator[tuple[int, int, int]]:
    """Of a gram's windows (class, start, bytes) those that two classes have at one start, joined to (class, from, to)
    stretches: what `Depths` finds, by hashes of all windows. Tests hold one against the other."""
    hashes, classes, starts = array("Q"), array("q"), array("h")
    for cls, start, window in found:
        hashes.append(xxhash.xxh3_64_intdigest(window, -start))
        classes.append(cls)
        starts.append(start)
    if len(hashes) < 2:
        return
    h, c, s = np.frombuffer(hashes, np.uint64), np.frombuffer(classes, np.int64), np.frombuffer(starts, np.int16)

    def twice(h: np.ndarray, c: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((c, h))
        h, c, s = h[order], c[order], s[order]
        edge = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1])))
        size = np.diff(np.concatenate((edge, [len(h)])))
        hit = np.repeat(c[edge] != c[edge + size - 1], size)
        return c[hit], s[hit]

    if len(h) <= SORTED:
        c, s = twice(h, c, s)
    else:  # by the hashes' first bits, so that a part is sorted at a time
        part = (h >> np.uint64(60)).astype(np.uint8)
        hits = [twice(h[at], c[at], s[at]) for at in (np.flatnonzero(part == k) for k in range(16)) if len(at)]
        c, s = (np.concatenate(x) for x in zip(*hits))
        del part, hits
    del h, hashes, classes, starts
    order = np.lexsort((s, c))
    c, s = c[order], s[order]
    fresh = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (s[1:] > s[:-1] + LENGTH)))) if len(c) else np.zeros(0, int)
    ends = np.concatenate((fresh[1:], [len(c)])) - 1 if len(c) else fresh
    yield from zip(c[fresh].tolist(), s[fresh].tolist(), (s[ends] + LENGTH).tolist())


def _runs(bounds: list[bytes]):
    """rows (text, wanted) -> (range, run): sorted, cut and front-coded."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, int]] = []
        size = 0

        def flush() -> pa.RecordBatch:
            held.sort()
            cuts: dict[int, list] = {}
            for r in held:
                cuts.setdefault(bisect_right(bounds, r[0]), []).append(r)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(list(cuts), pa.int32()), pa.array([front_code(x) for x in cuts.values()], pa.binary())], names=["range", "run"])

        for batch in batches:
            for text, wanted in zip(batch.column("text"), batch.column("wanted")):
                raw = utf8(text.as_py())
                for w in wanted.as_py():
                    made = _records(raw, w["place"], w["gram"], w["class"], w["split"])
                    held += made
                    size += sum(len(k) + len(o) + 200 for k, o, _ in made)
                if size > RUN_BYTES:
                    yield flush()
                    size = 0
        if held:
            yield flush()

    return run


def _tests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(range, run) sorted by range -> (gram, class, low, high): a repeated stretch of the class relative to its anchor."""

    def ranges() -> Iterator[list[memoryview]]:
        now, runs = None, []
        for batch in batches:
            for r, run in zip(batch.column("range").to_pylist(), batch.column("run")):
                if r != now and runs:
                    yield runs
                    runs = []
                now = r
                runs.append(memoryview(run.as_buffer()))  # no copy beside the batch
        if runs:
            yield runs

    def found() -> pa.RecordBatch:
        gram, cls, low, high = depths.stretches()
        return pa.RecordBatch.from_arrays([pa.array(gram), pa.array(cls), pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32))], names=["gram", "class", "low", "high"])

    depths = Depths()
    for runs in ranges():
        for known, key, other, cls in merge(runs):
            if known < _GRAM and len(depths) >= CLASSES:
                yield found()
                depths = Depths()
            depths.add(known, key, other, cls)
    yield found()


def cut_out(raw: bytes, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Maximal removed runs (n, 2) and the remaining bytes, for stretches that may overlap and run over the ends."""
    n = len(raw)
    steps = np.bincount(np.maximum(low, 0), minlength=n + 1) - np.bincount(np.minimum(high, n), minlength=n + 1)
    gone = np.cumsum(steps[:n]) > 0
    edge = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False])).view(np.int8)))
    return edge.reshape(-1, 2), np.frombuffer(raw, np.uint8)[~gone].tobytes()


def repeated_spans(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_bytes, removed array of (start, end), kept binary, passages), a row for each row of docs."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).withColumn("rid", F.struct(F.xxhash64("key", "text"), F.xxhash64(F.lit(1), "key", "text")))
    arrays = find_anchors(rows, ["rid"], "text")
    found = arrays.select("rid", F.explode(F.arrays_zip("places", "grams", "classes")).alias("a"))
    found = materialize(found.select("rid", F.col("a.places").alias("place"), F.col("a.grams").alias("gram"), F.col("a.classes").alias("class")), "anchors")
    classes = found.groupBy("gram", "class").agg(F.count("*").alias("n"), F.min(F.struct("rid", "place")).alias("of"))
    kinds = classes.groupBy("gram").agg(F.count("*").alias("kinds"), F.sum("n").alias("all")).where("all > 1").select("gram", "kinds")
    classes = materialize(classes.join(kinds, "gram").select("gram", "class", (F.col("n") > 1).alias("whole"), "kinds", "of.rid", "of.place"), "classes")
    sorted_ = classes.where("kinds > 1").select("rid", "place", "gram", "class", (F.col("kinds") > SPLIT).alias("split"))

    def with_text(some: DataFrame) -> DataFrame:
        wanted = some.groupBy("rid").agg(F.collect_list(F.struct("place", "gram", "class", "split")).alias("wanted"))  # of one text
        return rows.select("rid", "text").join(wanted, "rid").select("text", "wanted")

    n_ranges = RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))
    every = max(1, sorted_.count() // (SAMPLED * n_ranges))
    # Cores are spread evenly, by their hash: for each part of a split class any number stands for its core's.
    keys = F.expr(f"IF(split, transform(sequence(1, {-(-(BEFORE + 1) // PART)}), k -> xxhash64(k, gram, class)), array(gram))")
    sample = sorted_.where(F.pmod(F.xxhash64("gram", "class"), F.lit(every)) == 0).select(F.explode(keys))
    keys = sorted(struct.pack(">q", r[0]) for r in sample.toLocalIterator())
    bounds = sorted({keys[i * len(keys) // n_ranges] for i in range(1, n_ranges)}) if keys else []

    runs = with_text(sorted_).mapInArrow(_runs(bounds), "range int, run binary").repartition("range").sortWithinPartitions("range")
    tests = materialize(runs.mapInArrow(_tests, "gram long, class long, low int, high int"), "stretches")
    whole = classes.where("whole").select("gram", "class", F.lit(-BEFORE).alias("low"), F.lit(LENGTH).alias("high"))  # cut at the text's ends
    # A table, so that the join can split a class that a great many places have. All stretches hold the gram, so a class has one.
    by_class = materialize(tests.unionAll(whole).groupBy("gram", "class").agg(F.min("low").alias("low"), F.max("high").alias("high")), "repeated")
    per_text = found.join(by_class, ["gram", "class"]).groupBy("rid").agg(F.collect_list(F.struct((F.col("place") + F.col("low")).alias("low"), (F.col("place") + F.col("high")).alias("high"))).alias("found"))
    joined = rows.join(per_text, "rid", "left").join(shared_passages(rows), "rid", "left").select("key", "text", "found", F.coalesce("passages", F.lit(0).cast("long")).alias("passages"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 500):
                batch = whole.slice(at, 500)
                sizes, spans, kept = [], [], []
                lists = pc.fill_null(pc.list_value_length(batch.column("found")), 0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(lists)
                parts = batch.column("found").flatten()
                low, high = (pc.struct_field(parts, i).to_numpy(zero_copy_only=False).astype(np.int64) for i in (0, 1))
                for t, i, j in zip(batch.column("text"), (ends - lists).tolist(), ends.tolist()):
                    raw = utf8(t.as_py())
                    removed, rest = cut_out(raw, low[i:j], high[i:j])
                    sizes.append(len(raw))
                    spans.append(removed.tolist())
                    kept.append(rest)
                yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int64()))), pa.array(kept, pa.binary()), batch.column("passages")], names=[key, "n_bytes", "removed", "kept", "passages"])

    return joined.mapInArrow(run, T.StructType([T.StructField(key, docs.schema[key].dataType), T.StructField("n_bytes", T.LongType()), T.StructField("removed", T.ArrayType(T.ArrayType(T.LongType()))), T.StructField("kept", T.BinaryType()), T.StructField("passages", T.LongType())]))
