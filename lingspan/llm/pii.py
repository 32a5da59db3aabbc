"""Personal data by rules and by gradient-boosted candidates.

Rules give e-mail addresses, IPv4 addresses, payment card numbers and international phone numbers; they are certain
and stay. Beside them, generators with high recall propose overlapping spans: groups of digits, long keys, account
numbers that start with letters, mixed words of letters and digits, spelled-out addresses, names behind a title, postal
addresses. Boosted trees look at a candidate's format and context; their margin is calibrated on texts they were not fitted
on, by pooling adjacent violators. Each kind has its threshold, the least calibrated probability from which PRECISION of
its calibration rows are positive; candidates from it on are added, the likeliest first, unless they overlap something
already there.

Fitting takes a bounded sample, SAMPLE documents by a hash of doc_id and at most CANDIDATES of their candidates. Nobody
labels the tables' spans, so each sampled text gets a made piece of personal data of some kind and a harmless look-alike,
such as a date, a version or a path, at places of its own; what the generators propose there is positive or negative.
Candidates that overlap a rule's span teach nothing that could be added and are left out. Of the others, the text's own, one
behind a cue word such as 'token' or 'password' is positive, one without a digit is negative, and one with digits and
without a cue is unknown and left out; features do not hold cue words. Texts are dealt to fitting and calibration by a
hash, so copies are on one side. With too few candidates, or of one label only, only the rules work.

Spans are in code points, end exclusive. Null is the empty text: no spans. Texts of any length are read whole in time
linear in their length but for sorting candidates; rows are judged alone, so repeated rows have equal spans. An empty
table gives an empty one. Columns that are called like a result are replaced; all others stay.
"""

from __future__ import annotations

import random
import re
from math import log2

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .shared import free_names, map_texts, utf8

BASE = ("email", "ip", "card", "phone")
ADDED = ("number", "key", "spelled", "account", "mixed", "name", "address")
SAMPLE = 8_000
CANDIDATES = 60_000
PRECISION = 0.9
TREES, DEPTH, RATE, BINS = 60, 3, 0.2, 16

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_domain = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+").match
_ip = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}").finditer
_card = re.compile(r"[0-9](?:[\x20-]?[0-9])+").finditer
_phone = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]").finditer
_digit = re.compile(r"[0-9]").search
_number = re.compile(r"(?<![A-Za-z0-9_])[+(]?[0-9](?:[\x20().-]{0,2}[0-9])+(?![A-Za-z0-9_])").finditer
_digits = re.compile(r"(?<![0-9])[0-9]{7,24}(?![0-9])").finditer  # single ones of a list
_key = re.compile(r"(?<![A-Za-z0-9_+/-])[A-Za-z0-9_+/-]++={0,2}").finditer
_long = re.compile(r"[A-Za-z0-9_+/-]{20}").search
_spelled = re.compile(r"(?<!\S)[A-Za-z0-9._-]{1,64} ?(?:\(at\)|\[at\]| at ) ?[A-Za-z0-9-]{1,63}(?: ?(?:\(dot\)|\[dot\]| dot ) ?[A-Za-z]{2,24})+").finditer
_account = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])").finditer
_mixed = re.compile(r"(?<![^\s\"'`=:(])(?=[^\s0-9]{0,18}[0-9])(?=[^\sA-Za-z]{0,18}[A-Za-z])[A-Za-z0-9_!#$%^&*-]{8,19}(?![A-Za-z0-9_!#$%^&*-])").finditer
_UPPER, _LOWER = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ"
TITLES = ("Mr", "Mrs", "Ms", "Dr", "Prof", "Herr", "Frau", "Señor", "Señora", "Madame", "Monsieur")
_name = re.compile(rf"(?<!\w)(?:{'|'.join(TITLES)})\.? [{_UPPER}][{_LOWER}]{{1,30}}(?:[ -][{_UPPER}][{_LOWER}]{{1,30}}){{0,2}}(?!\w)").finditer
STREETS = ("Street", "Road", "Avenue", "Lane", "Drive", "Square", "straße", "strasse", "platz", "allee", "rue ", "avenue ", "boulevard ", "Calle ", "Avenida ", "Plaza ")
_address = re.compile(
    rf"(?<!\w)(?:[0-9]{{1,5}} (?:[{_UPPER}][{_LOWER}]{{1,30}} ){{1,3}}(?:Street|Road|Avenue|Lane|Drive|Square)|[{_UPPER}][{_LOWER}]{{1,30}}(?:straße|strasse|platz|allee) [0-9]{{1,4}}[a-z]?"
    rf"|[0-9]{{1,4}},? (?:rue|avenue|boulevard) (?:de la |des |du |de |d')?[{_UPPER}][{_LOWER}]{{1,30}}|(?:Calle|Avenida|Plaza) [{_UPPER}][{_LOWER}]{{1,30}},? [0-9]{{1,4}})(?!\w)"
).finditer
_cue = re.compile(r"(?i)(?:token|secret|password|passwd|api.?key|key|iban|account|ssn|tel|phone|fax|mobile|card|e.?mail|contact)\W{0,6}$").search


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """The rules' spans by kind, in order."""
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in BASE}
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _domain(text, at + 1)):
            found["email"].append((start, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if not _digit(text):
        return found
    for m in _ip(text):
        if all(len(p := x.lstrip("0")) <= 3 and int(p or 0) <= 255 for x in m[0].split(".")):
            found["ip"].append(m.span())
    for m in _card(text):
        if m.end() - m.start() >= 16 and 16 <= len(d := m[0].replace(" ", "").replace("-", "")) <= 19 and _luhn(d):
            found["card"].append(m.span())
    if "+" in text:
        for m in _phone(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                found["phone"].append(m.span())
    return found


def candidates(text: str) -> list[tuple[str, int, int]]:
    """What the generators propose; spans may overlap each other and the rules'."""
    found = []
    if _digit(text):
        for m in _number(text):
            if (n := sum(c.isdigit() for c in m[0])) >= 7:
                found += [("number", *m.span())] if n <= 24 else [("number", *d.span()) for d in _digits(text, *m.span())]
    if _long(text):
        found += [("key", *m.span()) for m in _key(text) if m.end() - m.start() >= 20]
    if _digit(text):
        found += [("account", *m.span()) for m in _account(text)]
        found += [("mixed", *m.span()) for m in _mixed(text)]
    if "at" in text and "dot" in text:
        found += [("spelled", *m.span()) for m in _spelled(text)]
    if any(t in text for t in TITLES):
        found += [("name", *m.span()) for m in _name(text)]
    if any(t in text for t in STREETS) and _digit(text):
        found += [("address", *m.span()) for m in _address(text)]
    return found


FEATURES = ("kind", "length", "digits", "groups", "digit_share", "upper_share", "hex_share", "changes", "plus", "paren", "dash", "dot", "space", "before", "after", "quoted", "equals", "entropy")


def describe(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    n = len(span)
    digits = sum(c.isdigit() for c in span)
    classes = [0 if c.isdigit() else 1 if c.isupper() else 2 if c.isalpha() else 3 for c in span[:64]]
    before, after = text[max(0, start - 4) : start], text[end : end + 2]
    first = span[:256]
    shares = [first.count(c) / len(first) for c in set(first)]
    group = lambda s, i: 0.0 if not s else 1.0 if s[i].isalpha() else 2.0 if s[i].isdigit() else 3.0 if s[i].isspace() else 4.0
    return [
        float(ADDED.index(kind)), float(n), float(digits), float(len(re.findall(r"[0-9]+", span))), digits / n,
        sum(c.isupper() for c in span) / n, sum(c in "0123456789abcdefABCDEF" for c in span) / n,
        float(sum(a != b for a, b in zip(classes, classes[1:]))), float(span[0] == "+"), float("(" in span), float(span.count("-")),
        float(span.count(".")), float(span.count(" ")), group(before, -1), group(after, 0), float(any(c in "\"'`" for c in before)), float("=" in before or ":" in before),
        -sum(s * log2(s) for s in shares),
    ]


def covered(text: str, spans: list[tuple[int, int]]) -> bytearray:
    """A byte for each place of the text: 1 inside a span."""
    out = bytearray(len(text))
    for i, j in spans:
        out[i:j] = b"\1" * (j - i)
    return out


def _some(r: random.Random, letters: str, n: int) -> str:
    return "".join(r.choice(letters) for _ in range(n))


_DIGITS, _HEX, _BIG, _SMALL = "0123456789", "0123456789abcdef", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word(r: random.Random) -> str:
    return _some(r, _SMALL, r.randint(3, 9))


def _cap(r: random.Random) -> str:
    return _word(r).capitalize()


def made_personal(r: random.Random) -> tuple[str, str]:
    """What stands before a made piece of personal data, and the piece."""
    d = lambda n: _some(r, _DIGITS, n)
    kind = r.choice(ADDED)
    if kind == "number":
        return r.choice(("", "", "tel. ", "call ")), r.choice((f"({d(3)}) {d(3)}-{d(4)}", f"{d(3)}-{d(3)}-{d(4)}", f"{d(3)}-{d(2)}-{d(4)}", f"0{d(2)} {d(4)} {d(4)}", f"{d(3)}.{d(3)}.{d(4)}"))
    if kind == "key":
        made = r.choice((f"AKIA{_some(r, _BIG + _DIGITS, 16)}", _some(r, _HEX, r.choice((32, 40, 64))), _some(r, _BIG + _SMALL + _DIGITS, r.randint(24, 44)), f"{_some(r, _SMALL, 3)}_{_some(r, _BIG + _SMALL + _DIGITS, 36)}"))
        return r.choice(("", "", 'token = "', "secret: ", "api_key=")), made
    if kind == "spelled":
        return "", f"{_word(r)}{r.choice((' (at) ', ' at ', '[at]'))}{_word(r)}{r.choice((' dot ', ' (dot) '))}{_some(r, _SMALL, r.randint(2, 3))}"
    if kind == "account":
        groups = [d(4) for _ in range(r.randint(3, 6))]
        return r.choice(("", "IBAN: ", "account ")), f"{_some(r, _BIG, 2)}{d(2)}" + r.choice(("", " ")).join(["", *groups])
    if kind == "mixed":
        made = _some(r, _SMALL + _BIG + _DIGITS, r.randint(7, 17)) if r.random() < 0.5 else _some(r, _HEX, r.randint(7, 17))
        return r.choice(("password=", "passwd: ", "pwd=", "pin: ", 'secret="')), f"{made[:3]}{r.choice(_SMALL)}{made[3:]}{r.choice(_DIGITS)}"
    if kind == "name":
        return "", f"{r.choice(TITLES)}{r.choice(('', '.'))} {_cap(r)}{r.choice(('', ' ' + _cap(r)))}"
    n = r.randint(1, 999)
    return "", r.choice((f"{n} {_cap(r)} {r.choice(STREETS[:6])}", f"{_cap(r)}{r.choice(STREETS[6:10])} {n}", f"{n}, {r.choice(STREETS[10:13])}{r.choice(('de ', 'du ', ''))}{_cap(r)}", f"{r.choice(STREETS[13:])}{_cap(r)}, {n}"))


def made_harmless(r: random.Random) -> str:
    """A look-alike that is no personal data."""
    d = lambda n: _some(r, _DIGITS, n)
    date = f"{r.randint(1900, 2099)}-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}"
    return r.choice((
        lambda: str(r.randrange(10**6, 10**10)), lambda: date, lambda: f"{date} {r.randint(0, 23):02d}.{d(2)}", lambda: f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", lambda: f"{r.randint(1800, 1999)}-{r.randint(1800, 2099)}", lambda: f"{d(1)}.{d(9)}",
        lambda: f"{d(1)} {d(3)} {d(3)}", lambda: f"{d(2)}.{d(3)}.{d(3)}", lambda: "_".join(_word(r) for _ in range(r.randint(3, 6))), lambda: "/".join(_word(r) for _ in range(r.randint(3, 6))), lambda: "-".join([*(_word(r) for _ in range(r.randint(3, 6))), str(r.randint(1990, 2030))]),
        lambda: "".join(_cap(r) for _ in range(r.randint(3, 6))), lambda: r.choice("-_=/aA") * r.randint(20, 60), lambda: f"{_word(r)}{r.choice(('', '-', '_'))}{d(r.randint(1, 4))}", lambda: f"{_some(r, _BIG, 3)}-{d(r.randint(4, 6))}", lambda: f"{_cap(r)}{d(2)}{_cap(r)}",
        lambda: f"{_some(r, _HEX, 8)}-{_some(r, _HEX, 4)}-{_some(r, _HEX, 4)}-{_some(r, _HEX, 4)}-{_some(r, _HEX, 12)}", lambda: f"{_word(r)}={_word(r)}{d(2)}", lambda: f"id: {_word(r)}_{d(4)}",
    ))()


def planted(text: str) -> tuple[str, tuple[int, int], tuple[int, int]]:
    """The text with a made piece and a look-alike at two places between words, and their spans; equal texts get the same."""
    r = random.Random(xxhash.xxh3_64_intdigest(utf8(text)))
    before, piece = made_personal(r)
    other, after = made_harmless(r), '"' if before.endswith('"') else ""
    places = sorted(text.rfind(" ", 0, r.randint(0, len(text))) + 1 for _ in range(2))
    first = r.random() < 0.5
    put = [(f"{before}{piece}{after} ", len(before), len(piece)), (f"{other} ", 0, len(other))]
    (one, skip, size), (two, skip2, size2) = put if first else put[::-1]
    start = places[0] + skip
    start2 = places[1] + len(one) + skip2
    spans = [(start, start + size), (start2, start2 + size2)]
    return f"{text[: places[0]]}{one}{text[places[0] : places[1]]}{two}{text[places[1] :]}", *(spans if first else spans[::-1])


def _alike(i: int, j: int, span: tuple[int, int]) -> float:
    """The part that two spans share of both together."""
    shared = min(j, span[1]) - max(i, span[0])
    return max(shared, 0) / (j - i + span[1] - span[0] - max(shared, 0))


def labelled(text: str) -> list[list[float]]:
    """The label and the features of the candidates of a planted text, without those of unknown label."""
    text, good, bad = planted(text)
    found, out = candidates(text), []
    base = covered(text, [s for spans in base_spans(text).values() for s in spans]) if found else bytearray()
    for kind, i, j in found:
        if base.find(1, i, j) >= 0:
            continue
        if i < good[1] and good[0] < j:
            label = 1 if _alike(i, j, good) >= 0.7 else None
        elif i < bad[1] and bad[0] < j:
            label = 0
        elif _cue(text[max(0, i - 24) : i]):
            label = 1
        else:
            label = None if _digit(text, i, j) else 0
        if label is not None:
            out.append([float(label), *describe(text, kind, i, j)])
    return out


class Boosted:
    """Trees of DEPTH over binned features for the logistic loss, a calibration of their margins, and thresholds."""

    def __init__(self, x: np.ndarray, y: np.ndarray, fit: np.ndarray):
        """Rows of features, the first of them the kind; labels; which rows the trees are fitted on, calibration has the
        others."""
        self.edges: list[np.ndarray] = []
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.steps, self.heights = np.zeros(1), np.zeros(1)
        self.base = 0.0
        self.thresholds = np.full(len(ADDED), 2.0)  # none is added
        if fit.sum() < 25 or (~fit).sum() < 25 or y[fit].min() == y[fit].max():
            return
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x[fit].T]
        bins, target = self._bins(x[fit]), y[fit]
        self.base = float(np.log(target.mean() / (1 - target.mean())))
        margin = np.full(len(target), self.base)
        for _ in range(TREES):
            p = 1 / (1 + np.exp(-margin))
            tree = self._grow(bins, target - p, p * (1 - p))
            self.trees.append(tree)
            margin += self._walk(tree, bins)
        self._calibrate(self.margin(x[~fit]), y[~fit])
        self._choose(x[~fit, 0].astype(int), self.probability(x[~fit]), y[~fit])

    def _bins(self, x: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, c, side="right") for e, c in zip(self.edges, x.T)], axis=1)

    def _grow(self, bins: np.ndarray, g: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Feature and bin bound of each inner node of a full tree, value of each leaf."""
        feature, bound = np.zeros((1 << DEPTH) - 1, int), np.full((1 << DEPTH) - 1, BINS)
        node = np.zeros(len(g), int)
        for k in range(len(feature)):
            rows = node == k
            best = 1e-6
            for j in range(bins.shape[1]) if rows.sum() >= 10 else ():
                gs = np.cumsum(np.bincount(bins[rows, j], g[rows], BINS))
                hs = np.cumsum(np.bincount(bins[rows, j], h[rows], BINS))
                gain = gs**2 / (hs + 1) + (gs[-1] - gs) ** 2 / (hs[-1] - hs + 1) - gs[-1] ** 2 / (hs[-1] + 1)
                if gain.max() > best:
                    best, feature[k], bound[k] = gain.max(), j, int(np.argmax(gain))
            node[rows] = 2 * k + 1 + (bins[rows, feature[k]] > bound[k])
        leaf = node - len(feature)
        gs, hs = np.bincount(leaf, g, 1 << DEPTH), np.bincount(leaf, h, 1 << DEPTH)
        return feature, bound, RATE * gs / (hs + 1)

    @staticmethod
    def _walk(tree: tuple[np.ndarray, np.ndarray, np.ndarray], bins: np.ndarray) -> np.ndarray:
        feature, bound, value = tree
        node = np.zeros(len(bins), int)
        for _ in range(DEPTH):
            node = 2 * node + 1 + (bins[np.arange(len(bins)), feature[node]] > bound[node])
        return value[node - len(feature)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        bins = self._bins(x)
        return self.base + sum(self._walk(t, bins) for t in self.trees)

    def _calibrate(self, margin: np.ndarray, y: np.ndarray) -> None:
        """Rising steps of the positives' share over the margin: adjacent violators are pooled."""
        order = np.argsort(margin, kind="stable")
        pools: list[list[float]] = []  # first margin, positives, rows
        for m, v in zip(margin[order].tolist(), y[order].tolist()):
            pools.append([m, v, 1.0])
            while len(pools) > 1 and (pools[-2][1] / pools[-2][2] >= pools[-1][1] / pools[-1][2] or pools[-2][0] == pools[-1][0]):
                _, v2, n2 = pools.pop()
                pools[-1][1] += v2
                pools[-1][2] += n2
        self.steps = np.array([p[0] for p in pools])
        self.heights = np.array([p[1] / (p[2] + 1) for p in pools])

    def _choose(self, kind: np.ndarray, p: np.ndarray, y: np.ndarray) -> None:
        for k in range(len(ADDED)):
            values, place = np.unique(-p[kind == k], return_inverse=True)
            good = np.cumsum(np.bincount(place, y[kind == k], len(values)))
            right = np.flatnonzero(good >= PRECISION * np.cumsum(np.bincount(place, minlength=len(values))))
            if len(right):
                self.thresholds[k] = -values[right[-1]]

    def probability(self, x: np.ndarray) -> np.ndarray:
        if not self.trees or len(x) == 0:
            return np.zeros(len(x))
        at = np.searchsorted(self.steps, self.margin(x), side="right") - 1
        return np.where(at >= 0, self.heights[np.maximum(at, 0)], 0.0)


def spans_of(text: str | None, model: Boosted | None) -> tuple[dict[str, list[tuple[int, int]]], dict[str, list[tuple[int, int]]]]:
    """The rules' spans, and those that the model adds, by kind."""
    text = text or ""
    base = base_spans(text)
    added: dict[str, list[tuple[int, int]]] = {k: [] for k in ADDED}
    proposed = candidates(text) if model is not None and model.trees else []
    if proposed:
        taken = covered(text, [s for spans in base.values() for s in spans])
        parts = (proposed[i : i + 20_000] for i in range(0, len(proposed), 20_000))
        chance = np.concatenate([model.probability(np.array([describe(text, *c) for c in part])) for part in parts])
        wanted = chance >= model.thresholds[[ADDED.index(kind) for kind, _, _ in proposed]]
        for i in np.argsort(-chance, kind="stable").tolist():
            kind, start, end = proposed[i]
            if wanted[i] and taken.find(1, start, end) < 0:
                added[kind].append((start, end))
                taken[start:end] = b"\1" * (end - start)
    return base, {k: sorted(v) for k, v in added.items()}


def fit(docs: DataFrame, sample: int = SAMPLE) -> Boosted:
    """From doc_id and text of at most `sample` documents; at most CANDIDATES rows of features come to the driver."""
    ids = docs.where("doc_id IS NOT NULL").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = docs.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select("doc_id", (F.pmod(F.xxhash64("text"), F.lit(2)) == 0).alias("fit"), "text")  # at most `sample` ids

    def values(texts):
        return [[labelled(t or "") for t in texts]]

    rows = map_texts(some, ["doc_id", "fit"], "text", [T.StructField("c", T.ArrayType(T.ArrayType(T.DoubleType())))], lambda: values)
    rows = rows.select("doc_id", "fit", F.posexplode("c").alias("at", "c")).orderBy(F.xxhash64("doc_id", "at"), "doc_id", "at").limit(CANDIDATES)
    got = rows.select("fit", "c").collect()
    table = np.array([r["c"] for r in got], float).reshape(-1, 1 + len(FEATURES))
    return Boosted(table[:, 1:], table[:, 0], np.array([r["fit"] for r in got], bool))


_SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def find(docs: DataFrame, model: Boosted | None, columns: list[str] | None = None, text: str = "text") -> DataFrame:
    """docs (or the given columns of it) plus base_spans and added_spans, arrays of (kind, start, end) by kind and start."""
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("base_spans", "added_spans")]
    sent = docs.sparkSession.sparkContext.broadcast(model)  # TREES small trees

    def values(texts):
        both = [spans_of(t, sent.value) for t in texts]
        return [[[{"kind": k, "start": i, "end": j} for k, spans in part.items() for i, j in spans] for part in column] for column in zip(*both)]

    return map_texts(docs, columns, text, [T.StructField("base_spans", _SPAN), T.StructField("added_spans", _SPAN)], lambda: values)


def redact(docs: DataFrame, model: Boosted | None, text: str = "text") -> DataFrame:
    """docs with each span replaced by <KIND>; overlapping spans of the rules are one. n_chars follows if there is one."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # TREES small trees
    columns = [c for c in docs.columns if c != text]

    def clean(t: str | None) -> str | None:
        if t is None:
            return None
        out, at = [], 0
        for i, j, kind in sorted((i, j, k) for part in spans_of(t, sent.value) for k, spans in part.items() for i, j in spans):
            if i >= at:
                out += [t[at:i], f"<{kind.upper()}>"]
            at = max(at, j)
        return "".join([*out, t[at:]]) if out else t

    (inner,) = free_names(docs.columns, "clean")
    rows = map_texts(docs, columns, text, [T.StructField(inner, T.StringType())], lambda: lambda texts: [[clean(t) for t in texts]])
    rows = rows.select(*[F.col(inner).alias(text) if c == text else F.col(c) for c in docs.columns])
    return rows.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else rows
