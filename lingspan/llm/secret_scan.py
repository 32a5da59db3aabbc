"""Secrets in texts, in DataFrame functions only: fixed patterns, then windows of high entropy in candidate strings.

A candidate is a maximal run of base-64 characters, 20 or more, with a letter and a digit. A window of WINDOW characters
slides over it with one count for each distinct character of the candidate: a step takes one character out and one in,
and the sum of c * log2(c) changes by those two counts alone. The Shannon entropy of the window is
log2(WINDOW) - sum / WINDOW; sums are whole millionths, so that every engine decides alike. What entropy is high
depends on the window's character class: `hex` (only hexadecimal digits, not only decimal ones) or `mixed` (anything
else with a digit); windows of decimal digits or of letters alone never count. Overlapping or touching windows of high
entropy form a span. A span is suppressed if the allow-list knows it (identifiers, placeholders, alphabets) or the words
before it (digests, commits, addresses), or if it overlaps a span of the fixed patterns; those always stay.

A row is scanned in place, without a shuffle: m matches of a text cost m ** 1.5 small steps for their positions and
overlaps, a candidate of n characters n steps. Nulls and ties: a null
text is empty; equal rows get equal results; an empty table gives an empty result. Columns of the input that clash with
the result's are replaced; all others stay. Positions are code points, ends are exclusive.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import free_names

# The patterns of the base kinds, in order, with the group whose length counts and the length it needs. The
# runs of `access` and `hex` are maximal and hold no second match that could be longer, so their lengths are in the patterns.
BASE = {
    "assign": (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    "access": (r"AKIA[A-Z0-9]{12,}", 0, 16),
    "hex": (r"[0-9a-f]{32,}", 0, 32),
}
#: Kinds that are added, by the class of their characters.
ADDED = ("hex_entropy", "mixed_entropy")
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
#: Bits that a window of a class needs. A random window of hexadecimal digits has 3.5 on average, one of base-64
#: characters 4.0, one of lower-case letters and digits 3.8; letters of prose have 3.4.
BITS = {"hex": 3.0, "mixed": 3.75}
#: Suppress a span: patterns of its candidate, and of the lower-cased characters before it.
ALLOWED = (r"^[0-9A-Fa-f]{8}(-[0-9A-Fa-f]{4}){3}-[0-9A-Fa-f]{12}$", r"^sha[0-9]+[_-]", r"EXAMPLE|example|PLACEHOLDER|placeholder|xxxx|XXXX", r"0123456789|1234567890|abcdefgh|ABCDEFGH")
ALLOWED_AFTER = (r"(sha-?[0-9]+|md5|crc32|digest|checksum|etag|integrity|fingerprint|commit|revision|uuid|guid)[\"']?[ :=#]*$", r"(://|www\.)[^ ]*$", r"base64,$")
BEFORE = 32
_BLOCK = 64
_MILLION = 1_000_000


def entropy_terms(window: int = WINDOW) -> list[int]:
    """c * log2(c) in millionths for c from 0 to the window's length."""
    return [round(_MILLION * c * math.log2(c)) if c else 0 for c in range(window + 1)]


def largest_sum(bits: float, window: int = WINDOW) -> int:
    """The largest sum of terms at which a window still has so many bits."""
    return math.floor(_MILLION * window * (math.log2(window) - bits))


def _string(value: str) -> str:
    """A SQL literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _let(value: str, body: str) -> str:
    """SQL for body, in which z is value. Without it the optimizer may put a column's expression in the place of its name
    inside a lambda, and compute it again for every element."""
    return f"get(transform(array({value}), z -> {body}), 0)"


def _running(array: str, zero: str, merge: str) -> str:
    """SQL for the running aggregates of an array, each element included: over whole blocks, then within one."""
    block, fold = f"slice(z, {{}} * {_BLOCK} + 1, {_BLOCK})", f"{zero}, (s, x) -> {merge}"
    blocks = f"transform(sequence(0, (size(z) - 1) div {_BLOCK}), b -> aggregate({block.format('b')}, {fold}))"
    before = _let(blocks, f"transform(z, (x, b) -> aggregate(slice(z, 1, b), {fold}))")
    within = f"slice(z.v, i div {_BLOCK} * {_BLOCK} + 1, i % {_BLOCK} + 1)"
    return _let(array, _let(f"named_struct('v', z, 'before', {before})", f"transform(z.v, (x, i) -> aggregate({within}, get(z.before, i div {_BLOCK}), (s, x) -> {merge}))"))


def _matches(df: DataFrame, text: str, pattern: str, group: int, out: str) -> DataFrame:
    """df plus `out`, an array of (start, end, value, before) of the pattern's matches: `value` is the group, `before` the
    end of the text between it and the last match. Ends are running sums of the lengths of gaps and matches."""
    found, gaps, ends, before = free_names(df.columns, "found", "gaps", "ends", "before")
    df = df.withColumn(found, F.regexp_extract_all(text, F.lit(pattern), F.lit(0)))
    df = df.withColumn(gaps, F.when(F.size(found) > 0, F.split(text, pattern, -1)))  # most texts have no match
    df = df.withColumn(ends, F.expr(_running(f"zip_with({found}, slice({gaps}, 1, size({found})), (m, g) -> length(m) + length(g))", "0", "s + x")))
    df = df.withColumn(before, F.expr(f"transform(slice({gaps}, 1, size({found})), g -> right(g, {BEFORE}))"))
    value = f"regexp_extract_all({text}, {_string(pattern)}, {group})" if group else found
    made = F.expr(
        f"zip_with(zip_with({found}, {ends}, (m, e) -> named_struct('start', e - length(m), 'end', e)), zip_with({value}, {before}, (v, b) -> named_struct('value', v, 'before', b)), "
        "(p, q) -> named_struct('start', p.start, 'end', p.end, 'value', q.value, 'before', q.before))"
    )
    none = F.expr("CAST(array() AS array<struct<start: int, end: int, value: string, before: string>>)")
    return df.withColumn(out, F.when(F.size(found) > 0, made).otherwise(none)).drop(found, gaps, ends, before)


def _windows(value: str) -> str:
    """SQL over c, a struct with `codes` (numbers of distinct characters), `digits`, `hexes` (0 or 1 each): the [start, end)
    of unions of windows of high entropy. Step i judges the window before character i, then takes the character in."""
    terms = f"array({', '.join(map(str, entropy_terms()))})"
    out, into = f"get({value}.codes, i - {WINDOW})", f"get({value}.codes, i)"
    less, more = f"get(s.counts, {out})", f"(get(s.counts, {into}) - if({out} <=> {into}, 1, 0))"
    slid = lambda flags: f"coalesce(get({value}.{flags}, i), 0) - coalesce(get({value}.{flags}, i - {WINDOW}), 0)"
    limit = f"CASE WHEN s.digits IN (0, {WINDOW}) THEN -1 WHEN s.hexes = {WINDOW} THEN {largest_sum(BITS['hex'])} ELSE {largest_sum(BITS['mixed'])} END"
    high = f"(i >= {WINDOW} AND s.total <= {limit})"
    opened = "array(named_struct('start', s.start, 'end', s.end))"
    return f"""aggregate(
        sequence(0, size({value}.codes)),
        named_struct('counts', transform({value}.letters, x -> 0), 'total', 0, 'digits', 0, 'hexes', 0, 'start', 0, 'end', -1, 'closed', CAST(array() AS array<struct<start: int, end: int>>)),
        (s, i) -> named_struct(
            'counts', transform(s.counts, (n, k) -> n + if(k <=> {into}, 1, 0) - if(k <=> {out}, 1, 0)),
            'total', s.total - coalesce(get({terms}, {less}) - get({terms}, {less} - 1), 0) + coalesce(get({terms}, {more} + 1) - get({terms}, {more}), 0),
            'digits', s.digits + {slid("digits")}, 'hexes', s.hexes + {slid("hexes")},
            'start', if({high} AND i - {WINDOW} > s.end, i - {WINDOW}, s.start), 'end', if({high}, i, s.end),
            'closed', if({high} AND s.end >= 0 AND i - {WINDOW} > s.end, concat(s.closed, {opened}), s.closed)),
        s -> if(s.end < 0, s.closed, concat(s.closed, {opened})))"""


def _any(column: str, patterns: tuple[str, ...]) -> str:
    return " OR ".join(f"{column} RLIKE {_string(p)}" for p in patterns) or "false"


def scan(docs: DataFrame, columns: list[str] | None = None, text: str = "text", allowed: tuple[str, ...] = ALLOWED, allowed_after: tuple[str, ...] = ALLOWED_AFTER) -> DataFrame:
    """The given columns (default: all) plus `base_spans` and `added_spans`, arrays of (kind, start, end) by start, then kind."""
    columns = [c for c in (docs.columns if columns is None else columns) if c not in ("base_spans", "added_spans")]
    body, hits, base, high, *kinds = free_names([*docs.columns, "base_spans", "added_spans"], "body", "hits", "base", "high", *BASE)
    df = docs.select(*columns, F.coalesce(F.col(text), F.lit("")).alias(body))
    for kind, (name, (pattern, group, least)) in zip(kinds, BASE.items()):
        df = _matches(df, body, pattern, group, kind)
        df = df.withColumn(kind, F.expr(f"transform(filter({kind}, m -> length(m.value) >= {least}), m -> named_struct('start', m.start, 'rank', {list(BASE).index(name)}, 'kind', '{name}', 'end', m.end))"))
    df = _matches(df, body, CANDIDATE, 0, hits)
    df = df.withColumn(base, F.array_sort(F.concat(*kinds))).drop(*kinds, body)
    candidates = f"filter({hits}, m -> m.value RLIKE '[0-9]' AND m.value RLIKE '[A-Za-z]' AND NOT ({_any('m.value', allowed)}) AND NOT ({_any('lower(m.before)', allowed_after)}))"
    df = df.withColumn(hits, F.expr(f"transform({candidates}, m -> named_struct('start', m.start, 'value', m.value, 'chars', filter(split(m.value, ''), x -> x <> '')))"))
    df = df.withColumn(hits, F.expr(f"transform({hits}, m -> named_struct('start', m.start, 'value', m.value, 'chars', m.chars, 'letters', array_distinct(m.chars)))"))
    coded = "'codes', transform(m.chars, x -> CAST(array_position(m.letters, x) - 1 AS int)), 'digits', transform(m.chars, x -> if(x RLIKE '[0-9]', 1, 0)), 'hexes', transform(m.chars, x -> if(x RLIKE '[0-9A-Fa-f]', 1, 0))"
    df = df.withColumn(hits, F.expr(f"transform({hits}, m -> named_struct('start', m.start, 'value', m.value, 'letters', m.letters, {coded}))"))
    df = df.withColumn(high, F.expr(f"flatten(transform({hits}, m -> transform({_windows('m')}, w -> named_struct('start', m.start + w.start, 'end', m.start + w.end, 'value', substring(m.value, w.start + 1, w.end - w.start)))))"))
    both = f"array_sort(concat(transform({base}, b -> named_struct('start', b.start, 'end', b.end, 'fixed', true, 'value', '')), transform({high}, a -> named_struct('start', a.start, 'end', a.end, 'fixed', false, 'value', a.value))))"
    so_far = _running("transform(z, x -> if(x.fixed, x.end, 0))", "0", "greatest(s, x)")
    to_come = f"reverse({_running('transform(reverse(z), x -> if(x.fixed, x.start, 2147483647))', '2147483647', 'least(s, x)')})"
    beside = f"zip_with(z, zip_with({so_far}, {to_come}, (p, q) -> named_struct('p', p, 'q', q)), (a, o) -> named_struct('start', a.start, 'end', a.end, 'value', a.value, 'free', NOT a.fixed AND o.p <= a.start AND o.q >= a.end))"
    alone = f"filter({_let(both, beside)}, a -> a.free)"
    span = "named_struct('kind', {}, 'start', CAST(a.start AS bigint), 'end', CAST(a.end AS bigint))"
    return df.select(
        *columns,
        F.expr(f"transform({base}, a -> {span.format('a.kind')})").alias("base_spans"),
        F.expr(f"""transform({alone}, a -> {span.format(f"if(a.value RLIKE '^[0-9A-Fa-f]+$', '{ADDED[0]}', '{ADDED[1]}')")})""").alias("added_spans"),
    )


def text_of(spans: Column) -> Column:
    """kind:start:end of every span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_start(*spans: Column) -> Column:
    """All spans of the arrays by start; where starts are equal, by kind as listed."""
    kinds = F.array(*map(F.lit, [*BASE, *ADDED]))
    keyed = F.array_sort(F.transform(F.concat(*spans), lambda s: F.struct(s["start"].alias("start"), F.array_position(kinds, s["kind"]).alias("rank"), s.alias("span"))))
    return F.transform(keyed, lambda s: s["span"])
