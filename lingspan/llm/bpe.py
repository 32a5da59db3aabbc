"""Byte-level BPE encoding and decoding with a rank queue under a hierarchical bitmap.

A pre-token is a doubly linked list of byte positions; those of many pre-tokens lie in one list with barriers between.
Every adjacent pair that is a token waits in the bucket of its rank; three levels of 64-bit bitmap words say which
buckets hold anything, so the next rank is three find-first-set steps away however long the pre-tokens are. A popped
bucket is merged in numpy; an entry whose pair has changed since it was queued is stale and skipped, and of entries
that touch each other every second one from the left counts. Where a merge could make a pair of a lower rank, a bucket
gives one merge a pre-token and the rest goes back, so that the lower one comes first. The work is O(n) queue entries
for n bytes, also for a pre-token of megabytes.

Texts are cut in front of every single space that a non-space follows, where the pre-token pattern always cuts as
well; the pieces recur, so a bounded per-worker memo keeps their ids. Null is the empty text: no tokens. Any text,
whatever its length, is encoded whole; equal texts give equal ids. The vocabulary file is read once on the driver and
is at most a few MB, which is what goes to the workers.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .shared import map_texts, utf8

#: A worker's memo of pieces is emptied before a batch once it holds more than this.
MEMO_PIECES = 200_000


def read_ranks(spark, path: str) -> dict[bytes, int]:
    """Ranks by token from a .tiktoken file: base64 of the bytes, a space, the rank."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in f if line.strip())}


class RankQueue:
    """Buckets of positions by rank under three levels of bitmap words of 64 bits."""

    def __init__(self, n_ranks: int):
        self.low = [0] * ((n_ranks >> 6) + 1)
        self.mid = [0] * ((n_ranks >> 12) + 1)
        self.top = 0
        self.buckets: dict[int, list] = {}

    def push(self, rank: int, at) -> None:
        bucket = self.buckets.get(rank)
        if bucket is None:
            self.buckets[rank] = [at]
            self.low[rank >> 6] |= 1 << (rank & 63)
            self.mid[rank >> 12] |= 1 << (rank >> 6 & 63)
            self.top |= 1 << (rank >> 12)
        else:
            bucket.append(at)

    def pop(self) -> tuple[int, list]:
        """The lowest rank that has a bucket, and the bucket; it leaves the queue."""
        i = (self.top & -self.top).bit_length() - 1
        word = self.mid[i]
        j = i << 6 | (word & -word).bit_length() - 1
        word = self.low[j]
        rank = j << 6 | (word & -word).bit_length() - 1
        word &= word - 1
        self.low[j] = word
        if not word:
            self.mid[i] &= ~(1 << (j & 63))
            if not self.mid[i]:
                self.top &= ~(1 << i)
        return rank, self.buckets.pop(rank)


def _known_pattern() -> str | None:
    """The pattern for which a word with one space before it is a pre-token, and texts may be cut at single spaces."""
    try:
        import public_tokenizers
    except ImportError:
        return None
    return public_tokenizers.PATTERN


class Codec:
    """Encoder and decoder for one vocabulary of ids below 65,534; `pattern` cuts a text into pre-tokens."""

    BARRIER, GONE = 65535, 65534  # ids of the nodes between pre-tokens and of merged ones

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import regex

        if max(ranks.values(), default=0) >= self.GONE:
            raise ValueError(f"token ids must be below {self.GONE}")
        self.ranks = ranks
        self.own_pattern = pattern == _known_pattern()
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.find = regex.compile(pattern).findall
        self.odd_space = re.compile(r" (?=\s|\Z)").search
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left << 16 | right] = rank
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_ranks = np.array([pairs[k] for k in self.pair_keys.tolist()], np.int64)
        #: Ranks whose token is part of a pair of a lower rank: their buckets go one merge a pre-token at a time.
        left, right = self.pair_keys >> 16, self.pair_keys & 0xFFFF
        self.dips = {*left[self.pair_ranks < left].tolist(), *right[self.pair_ranks < right].tolist()}
        self.queue = RankQueue(max(ranks.values()) + 1)
        self.plain: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left << 16 | right
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == keys, self.pair_ranks[at], -1)

    def _push(self, ranks: np.ndarray, at: np.ndarray) -> None:
        if ranks.size == 0:
            return
        order = np.argsort(ranks, kind="stable")
        ranks, at = ranks[order], at[order]
        cuts = [0, *(np.flatnonzero(ranks[1:] != ranks[:-1]) + 1).tolist(), len(ranks)]
        for i, j in zip(cuts, cuts[1:]):
            self.queue.push(int(ranks[i]), at[i:j])

    def merge(self, words: list[bytes]) -> list[bytes]:
        """The ids of each pre-token. All of them lie in one linked list with barriers between, so that a bucket's
        merges, which don't touch each other, are made at once."""
        data = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        barriers = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        ids = self.byte_ids[data]
        ids[barriers] = self.BARRIER
        n = len(ids)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        word_of = np.repeat(np.arange(len(words)), np.diff(barriers, prepend=-1)) if self.dips else None
        two = self.pair_rank(np.repeat(self.byte_ids, 256), np.tile(self.byte_ids, 256))
        waits = np.full(n, -1)
        waits[:-1] = two[data[:-1].astype(np.int64) << 8 | data[1:]]
        waits[barriers] = -1
        waits[barriers - 1] = -1  # no pre-token is empty
        start = np.flatnonzero(waits >= 0)
        self._push(waits[start], start)
        while self.queue.top:
            rank, bucket = self.queue.pop()
            at = bucket[0] if len(bucket) == 1 else np.sort(np.concatenate(bucket))
            at = at[waits[at] == rank]  # the others are stale
            if at.size == 0:
                continue
            if at.size > 1:
                touch = after[at[:-1]] == at[1:]
                if touch.any():  # as in 'aaaa': from the left, every second one
                    i = np.arange(at.size)
                    head = np.maximum.accumulate(np.where(np.concatenate(([True], ~touch)), i, 0))
                    at = at[(i - head) % 2 == 0]
                if rank in self.dips and at.size > 1:
                    first = np.concatenate(([True], word_of[at[1:]] != word_of[at[:-1]]))
                    if not first.all():
                        self.queue.push(rank, at[~first])
                        at = at[first]
            gone = after[at]
            right = after[gone]
            ids[at], ids[gone], waits[gone] = rank, self.GONE, -1
            after[at], before[right] = right, at
            new = self.pair_rank(ids[at], ids[right])
            waits[at] = new
            left = before[at]
            over = self.pair_rank(ids[left], ids[at])
            fresh = (over >= 0) & (waits[left] != over)
            waits[left] = over
            self._push(np.concatenate((new[new >= 0], over[fresh])), np.concatenate((at[new >= 0], left[fresh])))
        alive = ids < self.GONE
        ends = np.cumsum(alive)[barriers] * 4
        flat = ids[alive].astype("<u4").tobytes()
        return [flat[i:j] for i, j in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def _learn(self, memo: dict[str, bytes], pieces: set[str], space: str) -> None:
        """Adds the ids of the pieces that memo lacks."""
        cut = {p: [space + p] if p.isalpha() or not self.own_pattern else self.find(space + p) for p in pieces if p not in memo}
        words = {w: None for ws in cut.values() for w in ws}
        coded = {w: w.encode() for w in words}
        known = {w: self.ranks[b].to_bytes(4, "little") for w, b in coded.items() if b in self.ranks}
        hard = [w for w in words if w not in known]
        if hard:
            known.update(zip(hard, self.merge([coded[w] for w in hard])))
        for p, ws in cut.items():
            memo[p] = known[ws[0]] if len(ws) == 1 else b"".join(map(known.__getitem__, ws))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        texts = [t or "" for t in texts]
        for memo in (self.plain, self.spaced):
            if len(memo) > MEMO_PIECES:
                memo.clear()
        odd = [not self.own_pattern or bool(self.odd_space(t)) for t in texts]  # cut by the pattern itself
        pieces = [self.find(t) if o else t.split(" ") for t, o in zip(texts, odd)]
        plain: set[str] = set()
        spaced: set[str] = set()
        for ps, o in zip(pieces, odd):
            if o:
                plain.update(ps)
            else:
                plain.add(ps[0])
                spaced.update(ps[1:])
        self._learn(self.plain, plain, "")
        self._learn(self.spaced, spaced, " ")
        of, with_space = self.plain.__getitem__, self.spaced.__getitem__
        return [b"".join(map(of, ps)) if o else of(ps[0]) + b"".join(map(with_space, ps[1:])) for ps, o in zip(pieces, odd)]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I")))


_codecs: dict[str, Codec] = {}


def codec_of(spec) -> Codec:
    """The worker's codec for a broadcast (name, ranks, pattern); kept between tasks."""
    name, ranks, pattern = spec
    if name not in _codecs:
        _codecs.clear()
        _codecs[name] = Codec(ranks, pattern)
    return _codecs[name]


def _spec(spark, path: str, pattern: str):
    ranks = read_ranks(spark, path)
    name = hashlib.sha256(repr((pattern, sorted(ranks.items()))).encode()).hexdigest()
    return spark.sparkContext.broadcast((name, ranks, pattern))  # the vocabulary: a fixed file


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str] | None = None, text: str = "text", check: str | None = None) -> DataFrame:
    """docs (or the given columns of it) plus token_ids (binary: little-endian unsigned 32-bit) and n_tokens; such
    names in docs are replaced. `check` names a column that says whether the ids, decoded, are the text's bytes."""
    spec = _spec(docs.sparkSession, path, pattern)
    fields = [T.StructField("token_ids", T.BinaryType()), T.StructField("n_tokens", T.LongType()), *([T.StructField(check, T.BooleanType())] if check else [])]
    columns = [c for c in (docs.columns if columns is None else columns) if c not in [f.name for f in fields]]

    def make():
        codec = codec_of(spec.value)

        def values(texts):
            ids = codec.encode(texts)
            return [ids, [len(x) // 4 for x in ids], *([[codec.decode(x) == utf8(t) for x, t in zip(ids, texts)]] if check else [])]

        return values

    return map_texts(docs, columns, text, fields, make)


def decode(docs: DataFrame, path: str, pattern: str, columns: list[str] | None = None) -> DataFrame:
    """docs with token_ids (or the given columns of it) plus decoded, the text's bytes; a column of that name is replaced."""
    spec = _spec(docs.sparkSession, path, pattern)
    columns = [c for c in (docs.columns if columns is None else columns) if c != "decoded"]

    def make():
        codec = codec_of(spec.value)
        return lambda ids: [[codec.decode(x or b"") for x in ids]]

    return map_texts(docs, columns, "token_ids", [T.StructField("decoded", T.BinaryType())], make)
