"""Spelling variants, secrets and periodic runs: the registered queries and their operators against brute force."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from lingspan.llm import oracles, queries, runs, secret_scan, spelling

B64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
HEX = "0123456789abcdef"


def words_of(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]


def folder_of(spark, tmp_path, rows, schema="doc_id long, text string"):
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def by_sql(folder, sql):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    found = con.sql(sql)
    return sorted((dict(zip(found.columns, row)) for row in found.fetchall()), key=repr)


def rows_like(df, sql_rows):
    names = list(sql_rows[0]) if sql_rows else df.columns
    return sorted((dict(zip(names, (r[c] for c in names))) for r in df.collect()), key=repr)


ODD = [(None, None), (1, ""), (1, ""), (2, " \n\t"), (None, "password=abcdefgh1 tokentoken tokentoken"), (3, "é漢🙂 tokentoken, Tokentoken"), (3, "x " * 40_000), (4, "abcdefgh" * 20_000)]


# 11


def near(a, b):
    """One letter replaced, inserted or deleted."""
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def brute_variants(rows):
    seen = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{doc}:{word}".encode()) if doc is not None else 1
            if h % 31 == 0:
                word = word[: h % len(word)] + word[h % len(word) + 1 :]
            seen[word] += 1
    n = {w: c for w, c in seen.items() if len(w) >= 7 and c >= 2}
    others = {w: [v for v in n if near(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(others[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 10 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(others[w]), n[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def variant_texts(r):
    letters = "abcdÀÿÉ"
    words = ["".join(r.choice(letters) for _ in range(r.randint(6, 9))) for _ in range(50)] + ["a" * 10, "a" * 11, "a" * 12, "abababababab", "babababababa", "ababababab"]

    def changed(w):
        i, kind = r.randrange(len(w)), r.randrange(3)
        return w[:i] + (w[i + 1 :] if kind == 0 else r.choice(letters) + w[i + 1 :] if kind == 1 else r.choice(letters) + w[i:])

    pool = words + [changed(w) for w in words for _ in range(5)] + [f"crowded{a}{b}" for a in "abcdefghij" for b in "abcdefghij"] + ["Z" * 300]
    texts = [" ".join(pool[min(int(r.expovariate(1 / 50)), len(pool) - 1)] if r.random() < 0.7 else r.choice(pool) for _ in range(60)) for _ in range(120)]
    chain = ["mountayns"] * 3 + ["mountains"] * 40 + ["mountain " * 20] * 30  # a form of a form
    return [*texts, *chain]


@pytest.mark.parametrize("crowd", [spelling.CROWD, 0])
def test_variants(spark, tmp_path, monkeypatch, crowd):
    monkeypatch.setattr(spelling, "CROWD", crowd)
    rows = ODD + [(i if i % 50 else None, t) for i, t in enumerate(variant_texts(random.Random(11)))]
    got = queries.op11_spelling_variants(spark, folder_of(spark, tmp_path, rows))
    assert got.columns[:6] == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute_variants(rows)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(form and root != form for _, form, root, *_ in want) and sum(w[4] for w in want) > 500
    if crowd == spelling.CROWD:
        sql = by_sql(tmp_path, oracles.spelling_sql())
        assert rows_like(got, sql) == sql


def test_crowded_signatures_do_not_meet_in_squares(spark):
    """Words with one half and one set of letters: the pairs that meet are near."""
    words = spark.createDataFrame([(f"common{''.join(p)}", 2) for p in permutations("abcdef")], "word string, n long")
    again = spelling._places(spelling.signatures(words)).where("kind < 2")
    assert again.groupBy("signature").count().where("count > 1").count() == 0 and spelling.near_pairs(words).count() == 0


def test_variants_of_nothing(spark, tmp_path):
    assert queries.op11_spelling_variants(spark, folder_of(spark, tmp_path, [])).count() == 0


# 12


def brute_secrets(text):
    text, fixed, added = text or "", [], []
    patterns = [
        ("assign", r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8),
        ("access", "(AKIA[A-Z0-9]+)", 16), ("hex", "([0-9a-f]+)", 32),
    ]
    for rank, (kind, pattern, least) in enumerate(patterns):
        fixed += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text) if len(m.group(1)) >= least]
    last = 0
    for m in re.finditer(secret_scan.CANDIDATE, text):
        value, before, last = m.group(), text[last : m.start()][-secret_scan.BEFORE :], m.end()
        known = any(re.search(p, value) for p in secret_scan.ALLOWED) or any(re.search(p, before.lower()) for p in secret_scan.ALLOWED_AFTER)
        if known or not re.search("[0-9]", value) or not re.search("[A-Za-z]", value):
            continue
        spans = []
        for a in range(len(value) - 19):
            w = value[a : a + 20]
            bits = -sum(c / 20 * math.log2(c / 20) for c in Counter(w).values())
            if sum(c.isdigit() for c in w) not in (0, 20) and bits >= (3.0 if re.fullmatch("[0-9A-Fa-f]+", w) else 3.75) - 1e-9:
                if spans and a <= spans[-1][1]:
                    spans[-1][1] = a + 20
                else:
                    spans.append([a, a + 20])
        for a, b in spans:
            s, e = m.start() + a, m.start() + b
            if not any(x[0] < e and s < x[2] for x in fixed):
                added.append((s, *((3, e, "hex_entropy") if re.fullmatch("[0-9A-Fa-f]+", value[a:b]) else (4, e, "mixed_entropy"))))
    said = lambda spans: ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(spans))
    return [sum(x[3] == k for x in fixed) for k in ("assign", "access", "hex")] + [hashlib.sha256(said(fixed).encode()).hexdigest(), said(fixed + added), len(added)]


def secret_texts(r):
    some = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    parts = [
        lambda: some("abcdefghij ", r.randint(1, 60)), lambda: f'token = "{some(HEX, 40)}', lambda: f"PassWord={some(B64, r.randint(3, 20))}", lambda: some(B64, r.randint(15, 90)), lambda: some("0123456789ABCDEF", r.randint(15, 60)),
        lambda: some(HEX, r.randint(25, 60)), lambda: f"sha256:{some(HEX, 28)}", lambda: f"AKIA{some('ABCDEF0123', r.randint(8, 20))}", lambda: "é漢🙂", lambda: "this-is-a-long-slug-of-words-and-2024", lambda: f"https://a.example/{some(B64, 30)}",
        lambda: f"Secret:'x{some('xyz', 9)}", lambda: f"token=secret:{some(B64, 10)}", lambda: some("0123456789", 30), lambda: f"{'a' * 19}1{some(B64, 24)}{'a' * 26}{some(B64, 21)}", lambda: "12345678-1234-1234-1234-1234567890ab",
        lambda: f"ſecret={some(HEX, 9)}", lambda: f"api_key : {some(B64, 9)}", lambda: f"{some(HEX, 33)}api_key={some(HEX, 40)}", lambda: f"{some(B64, 40)}==",
    ]
    return ["".join(r.choice(parts)() + r.choice(["", " ", "\n", ", "]) for _ in range(r.randint(0, 12))) for _ in range(500)]


def test_secrets(spark, tmp_path):
    rows = ODD + list(enumerate(secret_texts(random.Random(12))))
    got = queries.op12_secret_scan(spark, folder_of(spark, tmp_path, rows))
    assert sorted(map(list, got.collect()), key=repr) == sorted(([d, *brute_secrets(t)] for d, t in rows), key=repr)
    sql = by_sql(tmp_path, oracles.secrets_sql())
    assert rows_like(got, sql) == sql and sum(x["n_added"] for x in sql) > 200


def test_planted_secrets_and_clean_text(spark):
    r = random.Random(13)
    clean = ["Reviewed in 2024 by the committee", "see https://docs.example/guide/v2/getting-started-2024-05-01", "id 12345678-1234-1234-1234-1234567890ab", "call get_user_account_information_v2 now", "sha1: " + "".join(r.choice(HEX) for _ in range(30)), "AbstractSingletonProxyFactoryBean2", "0123456789abcdefghijklmnop"]
    planted = ["key " + "".join(r.choice(B64[:62]) for _ in range(40)) for _ in range(200)] + ["value " + "".join(r.choice("0123456789ABCDEF") for _ in range(40)) for _ in range(200)]
    got = {x["text"]: x["added_spans"] for x in secret_scan.scan(spark.createDataFrame([(t,) for t in clean + planted], "text string")).collect()}
    assert [t for t in clean if got[t]] == []
    assert sum(bool(got[t]) for t in planted) >= 0.98 * len(planted)


def test_long_texts_with_many_secrets(spark):
    """Steps grow with m ** 1.5 at most: these took minutes when an array was made again for every match."""
    r = random.Random(14)
    rows = [(1, " ".join("".join(r.choice(HEX) for _ in range(33)) for _ in range(3_000))), (2, "".join(r.choice(B64) for _ in range(20_000)))]
    got = {x[0]: (x[1], x[2]) for x in secret_scan.scan(spark.createDataFrame(rows, "doc_id int, text string")).selectExpr("doc_id", "size(base_spans)", "size(added_spans)").collect()}
    assert got[1] == (3_000, 0) and got[2][1] > 0


def test_secrets_stay_in_the_jvm(spark, tmp_path):
    df = queries.op12_secret_scan(spark, folder_of(spark, tmp_path, ODD))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_names_that_clash(spark):
    taken = spark.createDataFrame([(1, "password=abcdefgh1", "b", "h", 1, "f", 2)], "doc_id long, text string, base_spans string, hits string, n_runs int, found string, _text int")
    got = secret_scan.scan(taken)
    assert got.columns == ["doc_id", "text", "hits", "n_runs", "found", "_text", "base_spans", "added_spans"] and len(got.first()["base_spans"]) == 1
    got = runs.periodic_runs(taken, loop_by="doc_id")
    assert got.columns[:6] == ["doc_id", "text", "base_spans", "hits", "found", "_text"] and got.first()["n_runs"] == 0 and got.first()["_text"] == 2


# 13


def brute_runs(words):
    """For every period, the stretches of equal words that far apart; those with a smaller period are left out."""
    n, out = len(words), []
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= 12 and not any(all(words[k] == words[k + d] for k in range(i, j + q - d)) for d in range(1, q)):
                out.append((i, j + q - i, q))
            i = max(j, i + 1)
    return sorted(out, key=lambda x: (x[0], x[2]))


def brute_row(doc, text):
    words = words_of(text)
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    first = max(found, key=lambda x: (x[1], -x[0], -x[2])) if found else None
    best = (*first, 1000 * first[1] // first[2]) if first else (None,) * 4
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(found), *best, hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in found).encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(), len(words))


def looped_text(r):
    words = [r.choice("abcdefgh é漢".split() + ["w", " x"]) for _ in range(r.randint(0, 60))] if r.random() < 0.6 else [str(r.random()) for _ in range(r.randint(0, 60))]
    for _ in range(r.randint(0, 3)):
        if words:
            a, p, m = r.randrange(len(words)), r.randint(1, 9), r.randint(1, 40)
            words[a:a] = [words[min(a + i % p, len(words) - 1)] for i in range(m)]
    return "".join(w + r.choice([" ", "\n", "\t", "  ", "\x0b\x0c\r"]) for w in words)


def test_periodic_runs(spark, tmp_path):
    r = random.Random(15)
    rows = [(d, "x " * 500 if t and t.startswith("x ") else t) for d, t in ODD] + [(i, looped_text(r)) for i in range(600)]
    got = queries.op13_periodic_runs(spark, folder_of(spark, tmp_path, rows))
    want = sorted((brute_row(d, t) for d, t in rows), key=repr)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[1] for w in want) > 100


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("words", [["a"] * 300, fibonacci(400), list("abcabcabcabd" * 30), list("ab" * 10 + "c" + "ab" * 10), [str(i % 97) for i in range(400)]])
def test_runs_of_special_words(words):
    assert runs.word_runs(words) == brute_runs(words)


def test_runs_of_few_letters():
    r = random.Random(16)
    for _ in range(1500):
        words = [r.randrange(r.choice([1, 2, 2, 3])) for _ in range(r.randint(0, 60))]
        assert runs.word_runs(words) == brute_runs(words)


def test_no_documents(spark, tmp_path):
    folder = folder_of(spark, tmp_path, [])
    assert queries.op12_secret_scan(spark, folder).count() == 0 and queries.op13_periodic_runs(spark, folder).count() == 0
