"""SQL for DuckDB that gives the rows of queries over the training-data operators, where SQL can."""

from __future__ import annotations

from . import secret_scan


def _case(column: str, weights: dict[str, int]) -> str:
    return f"CASE {column} {' '.join(f'WHEN {k!r} THEN {v}' for k, v in weights.items())} ELSE 1 END" if weights else "1"


def _share(name: str, source: str, parent: list[str], names: list[str], weight: str) -> str:
    """The family shares of `source` (names, supply, budget) as CTEs that end in `name` (with given)."""
    by = f"PARTITION BY {', '.join(parent)}" if parent else ""
    up = f"({by} ORDER BY supply / w, {', '.join(names)}"
    return f"""{name}1 AS (SELECT *, {weight} AS w FROM {source}),
{name}2 AS (SELECT *, coalesce(sum(supply) OVER {up} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below, sum(w) OVER {up} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS w_left FROM {name}1),
{name}3 AS (SELECT *, min(CASE WHEN (budget - below) * w >= supply * w_left THEN 1 ELSE 0 END) OVER {up} ROWS UNBOUNDED PRECEDING) = 1 AS filled FROM {name}2),
{name}4 AS (SELECT *, greatest(budget - sum(CASE WHEN filled THEN supply ELSE 0 END) OVER ({by}), 0) AS rest, sum(CASE WHEN filled THEN 0 ELSE w END) OVER ({by}) AS w_rest FROM {name}3),
{name}5 AS (SELECT *, CASE WHEN filled THEN supply ELSE rest * w // greatest(w_rest, 1) END AS g FROM {name}4),
{name}6 AS (SELECT *, rest - sum(CASE WHEN filled THEN 0 ELSE g END) OVER ({by}) AS extra, row_number() OVER ({by} ORDER BY filled, {', '.join(names)}) AS nth FROM {name}5),
{name} AS (SELECT *, CASE WHEN NOT filled AND nth <= extra THEN least(supply, g + 1) ELSE g END AS given FROM {name}6)"""


def mixing_sql(weights: dict[str, dict[str, int]], share: tuple[int, int] = (3, 5), max_epochs: int = 4, seed: int = 7) -> str:
    d, la, s = "mix_domain", "mix_lang", "mix_source"
    return f"""WITH d AS (SELECT doc_id, coalesce('d' || right(source, 1), 'none') AS {d}, coalesce(lang, 'none') AS {la}, coalesce(source, 'none') AS {s}, (coalesce(strlen(text), 0) + 3) // 4 AS mix_tokens, coalesce(CAST(doc_id AS VARCHAR), concat('none', md5(coalesce(text, '')))) AS who FROM documents),
leaves AS (SELECT {d}, {la}, {s}, sum(mix_tokens) AS tokens, sum(mix_tokens) * {max_epochs} AS supply FROM d GROUP BY ALL),
top AS (SELECT {d}, sum(supply) AS supply, least((SELECT sum(tokens) * {share[0]} // {share[1]} FROM leaves), (SELECT sum(supply) FROM leaves)) AS budget FROM leaves GROUP BY {d}),
{_share('a', 'top', [], [d], _case(d, weights.get('domain', {})))},
mid AS (SELECT l.{d}, l.{la}, sum(l.supply) AS supply, any_value(a.given) AS budget FROM leaves l JOIN a ON l.{d} = a.{d} GROUP BY ALL),
{_share('b', 'mid', [d], [d, la], _case(la, weights.get('lang', {})))},
low AS (SELECT l.{d}, l.{la}, l.{s}, l.supply, l.tokens, b.given AS budget FROM leaves l JOIN b ON l.{d} = b.{d} AND l.{la} = b.{la}),
{_share('c', 'low', [d, la], [d, la, s], _case(s, weights.get('source', {})))},
p AS (SELECT {d}, {la}, {s}, given, CASE WHEN tokens > 0 THEN given // tokens ELSE 0 END AS epochs, CASE WHEN tokens > 0 THEN given % tokens ELSE 0 END AS part FROM c),
o AS (SELECT d.*, p.given, p.epochs, p.part, md5(concat('{seed}:', CAST(p.epochs AS BIGINT), ':', who)) AS h FROM d JOIN p USING ({d}, {la}, {s})),
q AS (SELECT *, sum(mix_tokens) OVER (PARTITION BY {d}, {la}, {s} ORDER BY h, mix_tokens ROWS UNBOUNDED PRECEDING) AS upto FROM o)
SELECT doc_id, {d}, {la}, {s}, CAST(mix_tokens AS BIGINT) AS mix_tokens, CAST(given AS BIGINT) AS mix_budget, CAST(epochs + CASE WHEN part > 0 AND upto <= part THEN 1 ELSE 0 END AS BIGINT) AS mix_copies FROM q"""


#: The table of CRC-32 (the reflected polynomial of zlib), computed by SQL.
_CRC_TABLE = "SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t"


def _crc32(value: str, table: str = "t") -> str:
    """The unsigned CRC-32 of a string's UTF-8 bytes."""
    octets = f"list_transform(range(0, strlen({value}) * 2, 2), lambda i: CAST(concat('0x', substr(hex({value}), CAST(i + 1 AS BIGINT), 2)) AS BIGINT))"
    return f"xor(list_reduce({octets}, lambda c, b: xor(c >> 8, {table}[CAST(xor(c, b) & 255 AS BIGINT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295)"


def spelling_sql(least: int = 7, times: int = 2, every: int = 31, factor: int = 10) -> str:
    """Near words share a string that is left when one letter of either (or none of the shorter) is left out."""
    return f"""WITH RECURSIVE crc AS MATERIALIZED ({_CRC_TABLE}),
r AS (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
c AS (SELECT doc_id, w, count(*) AS times FROM r WHERE length(w) >= {least} GROUP BY ALL),
h AS MATERIALIZED (SELECT w, times, CASE WHEN doc_id IS NULL THEN 1 ELSE {_crc32("concat(doc_id, ':', w)")} END AS h FROM c, crc),
m AS (SELECT CASE WHEN h % {every} = 0 THEN concat(substr(w, 1, h % length(w)), substr(w, h % length(w) + 2)) ELSE w END AS word, times FROM h),
v AS MATERIALIZED (SELECT word, CAST(sum(times) AS BIGINT) AS n FROM m WHERE length(word) >= {least} GROUP BY word HAVING sum(times) >= {times}),
d AS (SELECT word, n, 0 AS pos, word AS rest FROM v UNION ALL SELECT word, n, pos, concat(substr(word, 1, pos - 1), substr(word, pos + 1)) FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS pos FROM v)),
near AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.rest = b.rest AND a.word <> b.word AND (a.pos = b.pos OR a.pos = 0 OR b.pos = 0)),
best AS (SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {factor} * n THEN form END AS form, CASE WHEN form_n >= {factor} * n THEN form_n END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (SELECT word, word AS pos FROM f UNION ALL SELECT walk.word, f.form FROM walk JOIN f ON walk.pos = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT walk.word, walk.pos AS root FROM walk JOIN f ON walk.pos = f.word WHERE f.form IS NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM f JOIN ends USING (word)"""


def _spans_sql(pattern: str, group: int) -> str:
    """A list of (start, end, value, before) of the pattern's matches in body; lists are summed up whole."""
    p = "'" + pattern.replace("'", "''") + "'"
    found, gaps = f"regexp_extract_all(body, {p})", f"regexp_split_to_array(body, {p})"
    ends = f"list_sum(list_transform(f[1:i], lambda x: length(x))) + list_sum(list_transform(g[1:i], lambda x: length(x)))"
    made = f"list_transform(range(1, len(f) + 1), lambda i: {{'s': CAST({ends} AS BIGINT) - length(f[i]), 'e': CAST({ends} AS BIGINT), 'v': vs[i], 'b': right(g[i], {secret_scan.BEFORE})}})"
    return f"(SELECT {made} FROM (SELECT {found} AS f, {gaps} AS g, regexp_extract_all(body, {p}, {group}) AS vs))"


def secrets_sql() -> str:
    """The base kinds by patterns; every window of a candidate counted anew."""
    s, width = secret_scan, secret_scan.WINDOW
    terms = f"[{', '.join(map(str, s.entropy_terms()))}]"
    base = [f"list_transform(list_filter({_spans_sql(p, g)}, lambda m: length(m.v) >= {least}), lambda m: {{'s': m.s, 'k': {i}, 'kind': '{name}', 'e': m.e}})" for i, (name, (p, g, least)) in enumerate(s.BASE.items())]
    said = lambda spans: f"coalesce(array_to_string(list_transform({spans}, lambda x: concat(x.kind, ':', x.s, ':', x.e)), ','), '')"
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    known = " OR ".join([*(f"regexp_matches(v, {quoted(p)})" for p in s.ALLOWED), *(f"regexp_matches(lower(b), {quoted(p)})" for p in s.ALLOWED_AFTER)])
    counts = f"list_transform(list_distinct(string_split(w, '')), lambda c: {terms}[length(w) - length(replace(w, c, '')) + 1])"
    digits = "length(regexp_replace(w, '[^0-9]', '', 'g'))"
    return f"""WITH d AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
b AS MATERIALIZED (SELECT row, doc_id, {base[0]} AS k0, {base[1]} AS k1, {base[2]} AS k2, {_spans_sql(s.CANDIDATE, 0)} AS hits FROM d),
c AS (SELECT row, unnest(hits, recursive := true) FROM b),
w AS (SELECT row, s, v, unnest(range(0, length(v) - {width} + 1)) AS pos FROM c WHERE regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND NOT ({known})),
x AS (SELECT row, s AS c, pos, substr(v, CAST(pos + 1 AS BIGINT), {width}) AS w FROM w),
y AS (SELECT row, c, pos FROM x WHERE {digits} NOT IN (0, {width}) AND list_sum({counts}) <= CASE WHEN regexp_full_match(w, '[0-9A-Fa-f]+') THEN {s.largest_sum(s.BITS["hex"])} ELSE {s.largest_sum(s.BITS["mixed"])} END),
z AS (SELECT *, sum(CASE WHEN before IS NULL OR pos > before + {width} THEN 1 ELSE 0 END) OVER (PARTITION BY row, c ORDER BY pos) AS part FROM (SELECT *, lag(pos) OVER (PARTITION BY row, c ORDER BY pos) AS before FROM y)),
u AS (SELECT row, c + min(pos) AS s, c + max(pos) + {width} AS e FROM z GROUP BY row, c, part),
t AS (SELECT u.row, u.s, u.e, CASE WHEN regexp_full_match(substr(d.body, CAST(u.s + 1 AS BIGINT), CAST(u.e - u.s AS BIGINT)), '[0-9A-Fa-f]+') THEN 0 ELSE 1 END AS k FROM u JOIN d USING (row)),
a AS (SELECT row, list({{'s': CAST(t.s AS BIGINT), 'k': t.k + {len(s.BASE)}, 'kind': ['{s.ADDED[0]}', '{s.ADDED[1]}'][t.k + 1], 'e': CAST(t.e AS BIGINT)}}) AS added FROM t JOIN b USING (row)
  WHERE len(list_filter(list_concat(k0, k1, k2), lambda o: o.s < t.e AND t.s < o.e)) = 0 GROUP BY row),
o AS (SELECT b.*, list_sort(list_concat(k0, k1, k2)) AS fixed, coalesce(added, []) AS added FROM b LEFT JOIN a USING (row))
SELECT doc_id, CAST(len(k0) AS BIGINT) AS n_assign, CAST(len(k1) AS BIGINT) AS n_access, CAST(len(k2) AS BIGINT) AS n_hex, sha256({said("fixed")}) AS base_sha256,
  {said("list_sort(list_concat(fixed, added))")} AS spans, CAST(len(added) AS BIGINT) AS n_added FROM o"""
