"""FLAC: 8-bit mono streams from texts, and seekable PCM blocks back from streams.

The decoder reads frames side by side. A stream's seek table says where frames start; those between its points, or all
without a table, are found by their headers: sync code, next frame or sample number, CRC-8, and the CRC-16 of the frame
before. So the frames of many streams are lanes of one numpy loop over the
sample index: each step takes a Rice code from every lane's bit position (leading zeros from a float's exponent, then
the low bits), adds the linear predictor's forecast from the lane's last samples, and moves on. Both Rice methods,
escaped partitions, quotients of any length, blocks of any sizes and wasted bits are read. CRC-8 of every frame header and CRC-16 of every frame are
verified the same way, as is the MD5 of all samples. Fixed predictors are linear predictors with given coefficients. The
encoder takes, for each frame, the best of fixed predictors of order 0 to 2 and a linear one of order LPC_ORDER.

A text is its UTF-8 bytes, padded with bytes 0 to a positive multiple of 64; a sample is a byte minus 128. Null is the
empty text, one block of 64 zero bytes; repeated rows have equal streams; an empty table gives an empty one. Streams are
cut into frames of BLOCK samples and worked on FRAMES frames at a time, so beside a few copies of the longest text memory
is constant. Streams of other than 8-bit mono samples are refused. A stream that isn't valid raises an error rather than
give other samples. Columns that are called like a result are replaced; all others stay.
"""

from __future__ import annotations

import hashlib
import struct

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import map_texts, utf8

BLOCK = 1024
#: Frames that are encoded or decoded at a time.
FRAMES = 1024
LPC_ORDER = 4
PRECISION = 8
RATE = 8000
FIXED = ((), (1,), (2, -1), (3, -3, 1), (4, -6, 4, -1))


def _crc_table(poly: int, bits: int) -> np.ndarray:
    table = np.arange(256, dtype=np.int64) << (bits - 8)
    for _ in range(8):
        table = np.where(table >> (bits - 1) & 1, table << 1 ^ poly, table << 1) & ((1 << bits) - 1)
    return table


_CRC8 = _crc_table(0x07, 8).tolist()
_CRC16 = _crc_table(0x8005, 16)


def crc8(data: bytes) -> int:
    crc = 0
    for b in data:
        crc = _CRC8[crc ^ b]
    return crc


def crc16(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Of data[start:end] for each lane."""
    order = np.argsort(start - end, kind="stable")  # longest first
    at, size = start[order], (end - start)[order]
    crc = np.zeros(len(at), np.int64)
    alive = np.searchsorted(-size, -np.arange(size[0]) if len(size) else np.zeros(0), side="left")
    for i, m in enumerate(alive.tolist()):
        c = crc[:m]
        crc[:m] = (c << 8 & 0xFFFF) ^ _CRC16[(c >> 8) ^ data[at[:m] + i]]
    out = np.empty_like(crc)
    out[order] = crc
    return out


def _number(n: int) -> bytes:
    """A frame number in the extended UTF-8 form of frame headers."""
    if n < 0x80:
        return bytes([n])
    more = 1
    while n >= 1 << (6 * more + 6 - more):
        more += 1
    return bytes([(0xFF << (7 - more) & 0xFF) | n >> 6 * more, *(0x80 | n >> 6 * i & 0x3F for i in reversed(range(more)))])


def _header(number: int, size: int) -> bytes:
    """Fixed block size, mono, 8 bits, the sample rate of the stream."""
    plain = size == BLOCK
    head = bytes([0xFF, 0xF8, (0xA0 if plain else 0x70), 0x02]) + _number(number) + (b"" if plain else struct.pack(">H", size - 1))
    return head + bytes([crc8(head)])


def _lpc(x: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Quantised coefficients (frames, LPC_ORDER) and shifts, by the Levinson recursion on each frame."""
    f = x.astype(np.float32)
    lags = np.stack([np.einsum("ij,ij->i", f[:, : f.shape[1] - k], f[:, k:]) for k in range(LPC_ORDER + 1)], axis=1)
    lags = lags.astype(float)
    error, a = lags[:, 0] + 1e-9, np.zeros((len(x), LPC_ORDER))
    for i in range(LPC_ORDER):
        k = (lags[:, i + 1] - (a[:, :i] * lags[:, i:0:-1]).sum(axis=1)) / error
        a[:, :i] -= k[:, None] * a[:, :i][:, ::-1].copy()
        a[:, i] = k
        error = np.maximum(error * (1 - k * k), 1e-9)
    top = np.maximum(np.abs(a).max(axis=1), 1e-9)
    shift = np.clip(PRECISION - 2 - np.floor(np.log2(top)).astype(int), 0, 14)
    limit = (1 << (PRECISION - 1)) - 1
    return np.clip(np.rint(a * (1 << shift)[:, None]), -limit, limit).astype(np.int32), shift.astype(np.int32)


def _residual(x: np.ndarray, coefs: np.ndarray, shift: np.ndarray) -> np.ndarray:
    order = coefs.shape[1]
    if order == 0:
        return x
    guess = coefs[:, :1] * x[:, order - 1 : -1]
    for j in range(1, order):
        guess += coefs[:, j : j + 1] * x[:, order - 1 - j : x.shape[1] - 1 - j]
    return x[:, order:] - (guess >> shift[:, None])


def _encoded(payloads: list[bytes], frames: list[tuple[int, int]]) -> list[bytes]:
    """The frames, each given by its payload and first sample."""
    size = np.array([min(BLOCK, len(payloads[p]) - i) for p, i in frames])
    x = np.zeros((len(frames), BLOCK), np.int32)
    for row, (p, i) in enumerate(frames):
        x[row, : size[row]] = np.frombuffer(payloads[p], np.uint8, size[row], i)
        x[row, : size[row]] -= 128
    inside = np.arange(BLOCK) < size[:, None]
    n = len(frames)
    options = [(o, np.tile(np.array(FIXED[o], np.int32).reshape(1, o), (n, 1)), np.zeros(n, np.int32)) for o in range(3)]
    options.append((LPC_ORDER, *_lpc(x, size)))
    zigzags, costs = [], []
    for o, coefs, shift in options:
        e = _residual(x, coefs, shift)
        z = (e << 1 ^ e >> 31) * inside[:, o:]
        zigzags.append(z)
        mean = z.sum(axis=1, dtype=np.int64) / np.maximum(size - o, 1)
        costs.append((size - o) * (1 + np.log2(1 + mean)) + 8 * o + (9 + PRECISION * o) * (o == LPC_ORDER))
    pick = np.argmin(np.stack(costs), axis=0)
    order = np.array([o for o, _, _ in options])[pick]
    z = np.zeros((n, BLOCK), np.int32)
    for k, (o, _, _) in enumerate(options):
        z[pick == k, o:] = zigzags[k][pick == k]
    count = size - order
    k0 = np.maximum(np.floor(np.log2(np.maximum(z.sum(axis=1) / np.maximum(count, 1), 1))).astype(int), np.floor(np.log2(np.maximum(z.max(axis=1), 1))).astype(int) - 3)
    rice = np.clip(k0, 0, 14).astype(np.int32)  # quotients stay below 16

    # Tokens (value, bits) of each frame: the subframe header, warm-up samples, coefficients, then the Rice codes.
    lead = 8 + 8 * order + np.where(pick == 3, 9 + PRECISION * LPC_ORDER, 0) + 10
    coded = inside & (np.arange(BLOCK) >= order[:, None])
    bits = ((z >> rice[:, None]) + (1 + rice)[:, None]) * coded
    total = lead + bits.sum(axis=1, dtype=np.int64)
    start = np.concatenate(([0], np.cumsum((total + 7) // 8)))
    at = (start[:-1] * 8 + lead)[:, None] + np.cumsum(bits, axis=1, dtype=np.int64) - bits
    values = (1 << rice)[:, None] | (z & ((1 << rice) - 1)[:, None])
    tokens = [(at[coded], values[coded].astype(np.int64), bits[coded])]
    place = start[:-1] * 8

    def put(rows: np.ndarray, value: np.ndarray, width: int) -> None:
        tokens.append((place[rows].copy(), value, np.full(len(rows), width)))
        place[rows] += width

    every = np.arange(n)
    put(every, np.where(pick == 3, 0x20 | LPC_ORDER - 1, 0x08 | order) << 1, 8)
    for j in range(max(2, LPC_ORDER)):
        rows = np.flatnonzero(order > j)
        put(rows, x[rows, j] & 0xFF, 8)
    rows = np.flatnonzero(pick == 3)
    put(rows, np.full(len(rows), PRECISION - 1) << 5 | options[3][2][rows], 9)
    for j in range(LPC_ORDER):
        put(rows, options[3][1][rows, j] & (1 << PRECISION) - 1, PRECISION)
    put(every, rice, 10)  # method 0, one partition, the parameter
    where, value, width = (np.concatenate(c) for c in zip(*tokens))
    value = value << (40 - (where & 7) - width)
    body = sum(np.bincount((where >> 3) + j, value >> 32 - 8 * j & 0xFF, start[-1] + 5) for j in range(5)).astype(np.uint8)

    heads = [_header(i // BLOCK, s) for (_, i), s in zip(frames, size.tolist())]
    raw = body.tobytes()
    whole = [h + raw[i:j] for h, i, j in zip(heads, start[:-1].tolist(), start[1:].tolist())]
    ends = np.cumsum([len(w) for w in whole])
    sums = crc16(np.frombuffer(b"".join(whole), np.uint8), np.concatenate(([0], ends[:-1])), ends)
    return [w + struct.pack(">H", c) for w, c in zip(whole, sums.tolist())]


def encode(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload; a payload has 16 bytes or more."""
    frames = [(p, i) for p, data in enumerate(payloads) for i in range(0, len(data), BLOCK)]
    whole: list[bytes] = []
    for at in range(0, len(frames), FRAMES):
        whole += _encoded(payloads, frames[at : at + FRAMES])
    out, row = [], 0
    for data in payloads:
        mine = whole[row : row + -(-len(data) // BLOCK)]
        row += len(mine)
        points, offset = [], 0
        for i, w in enumerate(mine):
            points.append(struct.pack(">QQH", i * BLOCK, offset, min(BLOCK, len(data) - i * BLOCK)))
            offset += len(w)
        sizes = [len(w) for w in mine]
        digest = hashlib.md5((np.frombuffer(data, np.uint8) ^ 0x80).tobytes()).digest()
        info = struct.pack(">HH", BLOCK, BLOCK) + min(sizes).to_bytes(3, "big") + max(sizes).to_bytes(3, "big") + (RATE << 44 | 0 << 41 | 7 << 36 | len(data)).to_bytes(8, "big") + digest
        table = b"".join(points)
        out.append(b"".join([b"fLaC", b"\x00", len(info).to_bytes(3, "big"), info, b"\x83", len(table).to_bytes(3, "big"), table, *mine]))
    return out


def _frame_at(raw: bytes, i: int) -> tuple[bool, int, int, int] | None:
    """Of the frame that starts at i, if a whole mono header with the right CRC-8 does: whether it is numbered by samples, its
    number, samples and header length."""
    if len(raw) < i + 6 or raw[i] != 0xFF or raw[i + 1] & 0xFE != 0xF8 or raw[i + 3] not in (0x00, 0x02):  # sizes of 8 bits: as the stream says, or said again
        return None
    lead = raw[i + 4]
    more = 0 if lead < 0x80 else 8 - (lead ^ 0xFF).bit_length()  # ones at the front, the first byte among them
    more = max(0, more - 1)
    code, rate = raw[i + 2] >> 4, raw[i + 2] & 15
    sized = i + 5 + more + (code == 7) * 2 + (code == 6)
    h = sized + (rate == 12) + (rate in (13, 14)) * 2
    if code == 0 or rate == 15 or len(raw) <= h or crc8(raw[i:h]) != raw[h]:
        return None
    number = lead if lead < 0x80 else lead & (1 << (6 - more)) - 1
    for b in raw[i + 5 : i + 5 + more]:
        number = number << 6 | b & 0x3F
    size = struct.unpack(">H", raw[sized - 2 : sized])[0] + 1 if code == 7 else raw[sized - 1] + 1 if code == 6 else 256 << (code - 8) if code >= 8 else 192 if code == 1 else 576 << (code - 2)
    return bool(raw[i + 1] & 1), number, size, h + 1 - i


def _sound(raw: bytes, begin: int, end: int) -> bool:
    """Whether a frame from begin to end has the right CRC-16."""
    return end - begin > 8 and int(crc16(np.frombuffer(raw, np.uint8), np.array([begin]), np.array([end - 2]))[0]) == int.from_bytes(raw[end - 2 : end], "big")


def _found(raw: bytes, at: int, upto: int, first: int) -> list[tuple[int, int]]:
    """(place, first sample) of the frames from `at`, whose first sample is `first`, to before `upto`: a header counts if its
    number is the next and the frame before it, ending there, has the right CRC-16. Numbers count samples, or frames
    of as many samples as the first in this range."""
    head = _frame_at(raw, at)
    if head is None:
        raise ValueError("a frame header is damaged")
    out, each, base = [(at, first)], head[2], head[1]
    expected, place = first + head[2], raw.find(b"\xff", at + 1, upto)
    while place >= 0:
        head = _frame_at(raw, place)
        if head and (head[1] == expected if head[0] else head[1] == base + len(out) and expected == first + len(out) * each) and _sound(raw, out[-1][0], place):
            out.append((place, expected))
            expected += head[2]
        place = raw.find(b"\xff", place + 1, upto)
    return out


class Frames:
    """The frames of many streams: stream, first sample, size, place of the start, the subframe and the end of each."""

    def __init__(self, streams: list[bytes]):
        self.stream, self.first, self.size, self.begin, self.sub, self.end, self.digests, self.totals = [], [], [], [], [], [], [], []
        self.data = b"".join(streams)
        base = 0
        for s, raw in enumerate(streams):
            self._index(s, raw, base)
            base += len(raw)

    def _index(self, s: int, raw: bytes, base: int) -> None:
        if raw[:4] != b"fLaC":
            raise ValueError("no FLAC stream")
        at, table, last, total = 4, b"", False, 0
        while not last:
            last, kind, size = bool(raw[at] & 0x80), raw[at] & 0x7F, int.from_bytes(raw[at + 1 : at + 4], "big")
            part = raw[at + 4 : at + 4 + size]
            if kind == 0:
                self.digests.append(part[18:34])
                fields = int.from_bytes(part[10:18], "big")
                total = fields & (1 << 36) - 1
                self.totals.append(total)
                if fields >> 36 & 31 != 7 or fields >> 41 & 7:
                    raise ValueError("only 8-bit mono streams")
            elif kind == 3:
                table = part
            at += 4 + size
        known = sorted({(at + p[1], p[0]) for p in struct.iter_unpack(">QQH", table) if p[0] < 1 << 63 and p[0] < (total or 1 << 36)} | {(at, 0)}) if at < len(raw) else []
        points: list[tuple[int, int]] = []
        for (i, first), (j, after) in zip(known, [*known[1:], (len(raw), total)]):  # a table may name some frames only
            head = _frame_at(raw, i)
            if head is None:
                raise ValueError("a frame header is damaged")
            points += [(i, first)] if first + head[2] == after else _found(raw, i, j, first)
        for (i, first), j in zip(points, [*(p[0] for p in points[1:]), len(raw)]):
            _, _, counted, length = _frame_at(raw, i)
            self.stream.append(s)
            self.first.append(first)
            self.size.append(counted)
            self.begin.append(base + i)
            self.sub.append(base + i + length)
            self.end.append(base + j)

    def blocks(self):
        """(stream, first sample, samples) of every frame, in order."""
        for at in range(0, len(self.size), FRAMES):
            some = slice(at, at + FRAMES)
            base = self.begin[at]
            data = self.data[base : self.end[some][-1]] + b"\0" * 16
            rows = _decoded(data, *(np.array(x[some]) - y for x, y in ((self.begin, base), (self.sub, base), (self.end, base), (self.size, 0))))
            for row, s, first, size in zip((rows + 128).astype(np.uint8), self.stream[some], self.first[some], self.size[some]):
                yield s, first, row[:size].tobytes()


def _long_quotients(raw: bytes, at: np.ndarray) -> np.ndarray:
    """Zero bits from each bit position on."""
    out = []
    for p in at.tolist():
        n = 0
        while p + n < 8 * len(raw) and not raw[p + n >> 3] >> (7 - (p + n & 7)) & 1:
            n += 1
        out.append(n)
    return np.array(out, np.int64)


def _decoded(raw: bytes, begin: np.ndarray, sub: np.ndarray, end: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Samples (frames, longest frame)."""
    data = np.frombuffer(raw, np.uint8)
    if (crc16(data, begin, end - 2) != (data[end - 2].astype(np.int64) << 8 | data[end - 1])).any():
        raise ValueError("a frame is damaged")
    word = np.ndarray(len(data) - 8, ">u8", raw, strides=(1,)).astype(np.uint64)
    order_of = np.argsort(-sizes, kind="stable")  # lanes that end first come last
    size = sizes[order_of]
    at = sub[order_of] * 8

    def take(lanes, width) -> np.ndarray:
        """The next `width` (1 to 25) bits of the lanes."""
        w = word[at[lanes] >> 3] << (at[lanes] & 7).astype(np.uint64)
        at[lanes] += width
        return (w >> np.uint64(1) >> (np.asarray(63 - width)).astype(np.uint64)).astype(np.int64)

    def signed(v: np.ndarray, width) -> np.ndarray:
        return v - (v >> (width - 1) << width)

    n = len(size)
    every = np.arange(n)
    kind = take(every, 8)
    wasted = np.zeros(n, np.int64)
    lanes = np.flatnonzero(kind & 1)
    if lanes.size:  # low bits that are 0 in all samples, counted by zeros and a one
        ahead = take(lanes, 8)
        if (ahead < 2).any():
            raise ValueError("a subframe without a bit")
        wasted[lanes] = 8 - np.floor(np.log2(ahead)).astype(np.int64)
        at[lanes] += wasted[lanes] - 8
    depth = 8 - wasted
    kind >>= 1
    constant, verbatim, fixed, linear = kind == 0, kind == 1, (kind >> 3) == 1, kind >= 32
    if not (constant | verbatim | fixed | linear).all() or (fixed & (kind > 12)).any():
        raise ValueError("a subframe of an unknown kind")
    order = np.where(fixed, kind & 7, np.where(linear, (kind & 31) + 1, np.where(verbatim, size, 0)))
    deepest = int(order[fixed | linear].max(initial=0))
    out = np.zeros((int(size[0]) if n else 0, n), np.int64)
    for i in range(int(order.max(initial=0))):
        lanes = np.flatnonzero(order > i)
        out[i, lanes] = signed(take(lanes, depth[lanes]), depth[lanes])
    lanes = np.flatnonzero(constant)
    out[:, lanes] = signed(take(lanes, depth[lanes]), depth[lanes])
    coefs, shift = np.zeros((deepest, n), np.int64), np.zeros(n, np.int64)
    for o, c in enumerate(FIXED):
        if o and o <= deepest:
            coefs[:o, fixed & (order == o)] = np.array(c)[:, None]
    lanes = np.flatnonzero(linear)
    precision = take(lanes, 4) + 1
    shift[lanes] = take(lanes, 5)
    for j in range(deepest):
        some = order[lanes] > j
        coefs[j, lanes[some]] = signed(take(lanes[some], precision[some]), precision[some])
    lanes = np.flatnonzero(fixed | linear)
    method, parts = take(lanes, 2), take(lanes, 4)
    if (method > 1).any():
        raise ValueError("a residual of an unknown kind")
    rice, per_part, escaped, wide = np.zeros(n, np.int64), np.ones(n, np.int64), np.full(n, -1, np.int64), np.zeros(n, np.int64)
    per_part[lanes] = size[lanes] >> parts
    wide[lanes] = method

    def start_part(lanes: np.ndarray) -> None:
        """The Rice parameter of a partition, or the width of its plain numbers."""
        for m in (0, 1):
            some = lanes[wide[lanes] == m]
            rice[some] = take(some, 4 + m)
        plain = lanes[rice[lanes] == 15 + 16 * wide[lanes]]
        escaped[lanes] = -1
        escaped[plain] = take(plain, 5)

    start_part(lanes)
    split = bool(parts.any())
    coded = fixed | linear
    for i in range(int(order[coded].min(initial=0)), len(out)):
        m = int(np.searchsorted(-size, -i, side="left"))  # lanes still going
        if i < deepest or not coded.all():
            lanes = np.flatnonzero(coded[:m] & (order[:m] <= i))
        else:
            lanes = slice(0, m)
        if split:
            fresh = np.arange(n)[lanes]
            start_part(fresh[(i % per_part[fresh] == 0) & (i > 0)])
        p = at[lanes].copy()
        w = word[p >> 3] << (p & 7).astype(np.uint64)
        zeros = 1054 - ((w >> np.uint64(32)).astype(np.float64).view(np.int64) >> 52)  # 1023 + 31 minus the exponent
        if ((w >> np.uint64(32)) == 0).any():
            far = np.flatnonzero((w >> np.uint64(32)) == 0)
            zeros[far] = _long_quotients(raw, p[far])
            q = p + zeros
            w = word[np.minimum(q >> 3, len(word) - 1)] << (q & 7).astype(np.uint64)  # from the quotient's end on
            ahead = np.zeros(len(zeros), np.int64)
        else:
            ahead = zeros
        k = rice[lanes]
        low = (w << (ahead + 1).astype(np.uint64)) >> np.uint64(1) >> (63 - k).astype(np.uint64)
        z = zeros << k | low.astype(np.int64)
        at[lanes] = p + zeros + 1 + k
        e = z >> 1 ^ -(z & 1)
        if (escaped >= 0).any():
            plain = np.arange(n)[lanes]
            here = escaped[plain] >= 0
            at[plain[here]] = p[here]
            width = escaped[plain[here]]
            e[here] = np.where(width > 0, signed(take(plain[here], np.maximum(width, 1)), np.maximum(width, 1)), 0)
            at[plain[here]] = p[here] + width
        guess = 0
        for j in range(min(deepest, i)):
            guess = guess + coefs[j, lanes] * out[i - 1 - j, lanes]
        out[i, lanes] = e + (guess >> shift[lanes])
    if ((at + 7) // 8 != end[order_of] - 2).any():
        raise ValueError("a frame has another length")
    samples = np.empty((n, len(out)), np.int64)
    samples[order_of] = (out << wasted).T if wasted.any() else out.T
    return samples


def decode(streams: list[bytes]) -> list[list[tuple[int, bytes]]]:
    """For each stream its blocks: first sample, and samples as unsigned bytes (sample + 128)."""
    if not streams:
        return []
    frames = Frames(streams)
    blocks: list[list[tuple[int, bytes]]] = [[] for _ in streams]
    for s, first, pcm in frames.blocks():
        blocks[s].append((first, pcm))
    for mine, digest, total in zip(blocks, frames.digests, frames.totals):
        whole = b"".join(b for _, b in mine)
        if len(whole) != total or hashlib.md5((np.frombuffer(whole, np.uint8) ^ 0x80).tobytes()).digest() != digest:
            raise ValueError("samples differ from the stream's digest")
    return blocks


def payload_of(text: str | None) -> bytes:
    raw = utf8(text)
    return raw + b"\0" * (-len(raw) % 64 or (0 if raw else 64))


def to_flac(docs: DataFrame, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns of it) plus media, the stream; a column of that name is replaced."""
    columns = [c for c in (docs.columns if columns is None else columns) if c != "media"]
    return map_texts(docs, columns, text, [T.StructField("media", T.BinaryType())], lambda: lambda texts: [encode([payload_of(t) for t in texts])])


def feature(pcm: bytes) -> str:
    """Level, loudness, crossings and mean step of the signal."""
    n, total, squares, crossings, steps, peak = len(pcm), 0, 0, 0, 0, 0
    for at in range(0, n, 1 << 20):  # each part with the first sample of the next
        x = np.frombuffer(pcm, np.uint8, min((1 << 20) + 1, n - at), at).astype(np.int64) - 128
        own = x[: 1 << 20]
        total, squares, peak = total + int(own.sum()), squares + int((own * own).sum()), max(peak, int(np.abs(own).max()))
        crossings, steps = crossings + int(((x[1:] < 0) != (x[:-1] < 0)).sum()), steps + int(np.abs(np.diff(x)).sum())
    return f"mean={total / n:.4f};rms={(squares / n) ** 0.5:.4f};zcr={crossings / n:.5f};step={steps / (n - 1):.4f};peak={peak}"


def read_back(media: DataFrame, columns: list[str]) -> DataFrame:
    """The given columns plus payload, the samples of all blocks in order; offsets, the first sample of each block, which
    is its place in the payload; and feature."""

    def values(streams):
        both = [decode([s])[0] for s in streams] if sum(map(len, streams)) > 1 << 22 else decode(streams)
        whole = [b"".join(b for _, b in mine) for mine in both]
        return [whole, [[i for i, _ in mine] for mine in both], [feature(w) for w in whole]]

    fields = [T.StructField("payload", T.BinaryType()), T.StructField("offsets", T.ArrayType(T.LongType())), T.StructField("feature", T.StringType())]
    return map_texts(media, [c for c in columns if c not in ("payload", "offsets", "feature")], "media", fields, lambda: values)


def to_blocks(decoded: DataFrame, columns: list[str]) -> DataFrame:
    """Of rows that read_back gave, the columns, first_sample and pcm: a row for each PCM block, which seeks by sample."""
    each = decoded.select(*columns, "payload", F.explode(F.arrays_zip("offsets", F.expr("concat(slice(offsets, 2, size(offsets) - 1), array(octet_length(payload)))").alias("ends"))).alias("b"))
    return each.select(*columns, F.col("b.offsets").alias("first_sample"), F.expr("substring(payload, CAST(b.offsets AS INT) + 1, CAST(b.ends - b.offsets AS INT))").alias("pcm"))
