"""Spelling variants: words one letter apart, found by partition-and-enumerate signatures of their letter multisets.

A word is a binary vector with one dimension for each (letter, how many times it came before). Replacing a letter changes
two dimensions, inserting or deleting one changes one, so near words have a Hamming distance of two or one and their lengths
say which. For distance two the dimensions are dealt into PARTS parts, of which at least PARTS - 2 agree: a word has one
signature for every choice of PARTS - 2 parts. For distance one two parts do, of which one agrees. Two words that are near
also share their first or their last half, since one letter differs; the half and the length belong to the signature.
Equal signatures meet in an equi-join, and the edit distance decides every meeting pair.

A signature that more than CROWD words share is not joined as it is: its words are dealt again, by the half that may
differ with one place left out, one signature for each place. Only words that are near, or equal up to that place, meet
then, so no group's square is enumerated, and nothing is left out.

Forms point to a near word at least FACTOR times as frequent, so following them ends; roots are found by doubling the
steps. Nulls and ties: a null text has no words; a null doc_id deletes no letter; forms of equal frequency are the smallest
in code-point order; repeated rows count again; an empty table gives an empty result. All other columns are ignored. The
vocabulary, not the text, is written and joined; counts are combined before the shuffle.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize

PARTS = 4
#: Words with one signature that are compared with each other as they are.
CROWD = 64
FACTOR = 10
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def runs(docs: DataFrame, least: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, run): maximal runs of letters of `least` code points or more, A-Z lower-cased."""
    found = F.explode(F.regexp_extract_all(text, F.lit(f"[A-Za-z\\u00C0-\\u00FF]{{{least},}}"), F.lit(0)))
    rows = docs.select(F.col(key).alias("key"), found.alias("run"))
    return rows.select("key", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", _UPPER, _UPPER.lower())).otherwise(F.col("run")).alias("run"))


def misspelt(rows: DataFrame, every: int = 31) -> DataFrame:
    """The contract's rewriting of (key, run): where crc32 of `<key>:<run>` is a multiple of `every`, one letter goes."""
    h = F.crc32(F.concat(F.col("key").cast("string"), F.lit(":"), F.col("run")).cast("binary"))
    rows = rows.withColumn("h", F.coalesce(h, F.lit(1)))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    return rows.select("key", F.when(F.col("h") % every == 0, less).otherwise(F.col("run")).alias("run"))


def vocabulary(rows: DataFrame, least: int = 7, times: int = 2) -> DataFrame:
    """(word, n): words of (key, run) with `least` code points and `times` occurrences or more."""
    return rows.where(F.length("run") >= least).groupBy(F.col("run").alias("word")).agg(F.count("*").alias("n")).where(F.col("n") >= times)


def _parts(word: str) -> Column:
    """An array of PARTS hashes of the parts of the word's vector."""
    letters = f"array_distinct(filter(split({word}, ''), c -> c <> ''))"
    dimensions = f"flatten(transform({letters}, c -> transform(sequence(1, length({word}) - length(replace({word}, c, ''))), k -> xxhash64(c, k))))"
    folded = ", ".join(f"aggregate(z, 0L, (s, x) -> if(pmod(x, {PARTS}) = {p}, s ^ x, s))" for p in range(PARTS))
    return F.expr(f"get(transform(array({dimensions}), z -> array({folded})), 0)")


def signatures(words: DataFrame) -> DataFrame:
    """(signature, kind, word, n). kind // 2 is 0 where one letter is replaced, 1 and 2 for the shorter and the longer word of
    an insertion; kind % 2 is 0 where the first half is in common, 1 for the last."""
    parts = words.withColumn("parts", _parts("word")).withColumn("size", F.length("word"))
    made = []
    for role, longer in ((0, 0), (1, 0), (2, 1)):  # the lengths of halves follow from the shorter word's
        size = F.col("size") - longer
        half = F.floor(size / 2).cast("int")
        for side, same in ((0, F.substring(F.col("word"), F.lit(1), half)), (1, F.right("word", size - half))):
            if role == 0:
                kept = [[F.get("parts", F.lit(p)) for p in chosen] for chosen in combinations(range(PARTS), PARTS - 2)]
            else:
                kept = [[F.get("parts", F.lit(p)).bitwiseXOR(F.get("parts", F.lit(p + 1)))] for p in (0, 2)]
            for i, hashes in enumerate(kept):
                made.append(F.struct(F.xxhash64(F.lit(min(role, 1) * 100 + side * 50 + i), size, same, *hashes).alias("signature"), F.lit(role * 2 + side).cast("byte").alias("kind")))
    return parts.select("word", "n", F.explode(F.array(*made)).alias("s")).select("s.signature", "s.kind", "word", "n")


def _meet(rows: DataFrame) -> DataFrame:
    """(word, n, other, other_n): near pairs among the rows that share a signature, each once or more."""
    a, b = rows.alias("a"), rows.alias("b")
    roles = F.expr("(a.kind < 2 AND b.kind < 2 AND a.word < b.word) OR (a.kind IN (2, 3) AND b.kind > 3)")
    joined = a.join(b, (F.col("a.signature") == F.col("b.signature")) & roles & (F.levenshtein("a.word", "b.word", 1) == 1))
    return joined.select("a.word", "a.n", F.col("b.word").alias("other"), F.col("b.n").alias("other_n"))


def _places(rows: DataFrame) -> DataFrame:
    """Crowded rows dealt again: one row for each place that the half which may differ can leave out. The shorter word of an
    insertion leaves nothing out: it is what the longer one leaves."""
    same = "CAST(floor((length(word) - if(kind > 3, 1, 0)) / 2) AS int)"
    rest = f"if(kind % 2 = 0, substring(word, {same} + 1), left(word, {same} + if(kind > 3, 1, 0)))"
    rows = rows.withColumn("rest", F.expr(rest))
    rows = rows.select("signature", "kind", "word", "n", "rest", F.expr("explode(if(kind IN (2, 3), array(0), sequence(1, length(rest))))").alias("place"))
    less = F.expr("if(place = 0, rest, concat(left(rest, place - 1), substring(rest, place + 1)))")
    return rows.select(F.xxhash64("signature", F.when(F.col("kind") < 2, F.col("place")).otherwise(F.lit(0)), less).alias("signature"), "kind", "word", "n")


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other, other_n): each ordered pair of near words of (word, n), once or more. All joins read one exchange by
    signature, since they need the same columns of it."""
    rows = signatures(words).withColumn("crowd", F.count("*").over(Window.partitionBy("signature")))
    few, many = rows.where(F.col("crowd").between(2, CROWD)).drop("crowd"), rows.where(F.col("crowd") > CROWD).drop("crowd")
    pairs = _meet(few).unionAll(_meet(_places(many)))
    both = F.array(F.struct("word", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    return pairs.select(F.explode(both).alias("p")).select("p.word", "p.other", "p.other_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) without cycles -> (word, root): the last word that forms lead to."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        now = materialize(now, "roots")
        on = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = now.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = materialize(moved, "roots")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        now = moved.select("word", "root")


def variants(words: DataFrame, factor: int = FACTOR) -> DataFrame:
    """(word, n) -> (word, form, root, n, n_near, form_n)."""
    words = materialize(words, "words")
    best = F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form")))
    near = near_pairs(words).groupBy("word", "other").agg(F.first("other_n").alias("other_n")).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, "word", "left")
    fits = -F.col("best.m") >= factor * F.col("n")
    rows = materialize(known.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.form")).alias("form"), F.when(fits, -F.col("best.m")).alias("form_n")), "forms")
    ends = roots(rows.where("form IS NOT NULL").select("word", "form"))
    return rows.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
