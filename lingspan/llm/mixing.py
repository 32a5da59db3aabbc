"""Mixing sources to target weights by hierarchical budgeting.

Leaves are (domain, lang, source) triples. The token budget goes down the tree: at every node it is shared among the
children in proportion to their weights, but no child gets more than its supply (the tokens below it times
max_epochs). What a child cannot use goes to its siblings first; only what the whole family cannot use is left to the
parent's siblings, because a parent's supply is the sum of its children's. All shares are whole tokens. Each leaf then
takes whole epochs, and of the next epoch, in an order seeded by (seed, epoch, doc_id; without one the text), the longest prefix that fits.

The prefix is found in two steps: sums over BUCKETS slices of the seeded order (a bounded table per leaf), then a
running sum inside a slice, so a leaf with a third of all rows is never sorted in one task. Weights are whole numbers;
a node without one has weight 1. A null domain, lang or source is the node 'none'. Null or empty texts have 0 tokens
and ride along with their place in the order. Repeated rows count as often as they occur. An empty table gives an
empty result.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import free_names, materialize

#: Hex digits of the order hash that make a slice: 16 ** 3 slices a leaf.
SLICE_DIGITS = 3
LEVELS = ("mix_domain", "mix_lang", "mix_source")
RESULT = (*LEVELS, "mix_tokens", "mix_budget", "mix_copies")


def estimated_tokens(text: str = "text") -> Column:
    """A token for each four bytes begun; the budget's unit."""
    return F.floor((F.coalesce(F.octet_length(text), F.lit(0)) + 3) / 4).cast("long")


def _weight(column: str, weights: dict[str, int]) -> Column:
    if not weights:
        return F.lit(1).cast("long")
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(sorted(weights.items()))])
    return F.coalesce(F.get(F.array(F.try_element_at(table, F.col(column))), F.lit(0)), F.lit(1)).cast("long")


def _share(nodes: DataFrame, parent: list[str], weight: Column) -> DataFrame:
    """Splits `budget` of each family among its rows up to `supply`, in proportion to weights: adds `given`.

    Families are ordered by supply / weight. Going up that order a row is filled entirely if what is left, spread over
    the rows not yet filled, reaches its ratio; from the first row where it does not, all others share what is left.
    What rounding leaves over goes to the first unfilled rows in name order, a token each. Every node table has at most
    as many rows as there are leaves; families are metadata, not documents."""
    fam = Window.partitionBy(*parent) if parent else Window.partitionBy(F.lit(0))
    names = [c for c in LEVELS if c in nodes.columns]
    up = fam.orderBy((F.col("supply") / F.col("w")), *names)
    nodes = nodes.withColumn("w", weight)
    nodes = nodes.withColumns({
        "below": F.coalesce(F.sum("supply").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "w_left": F.sum("w").over(up.rowsBetween(0, Window.unboundedFollowing)),
    })
    full = (F.col("budget") - F.col("below")) * F.col("w") >= F.col("supply") * F.col("w_left")
    nodes = nodes.withColumn("full", full)
    nodes = nodes.withColumn("full", F.min(F.col("full").cast("int")).over(up.rowsBetween(Window.unboundedPreceding, 0)) == 1)
    nodes = nodes.withColumns({
        "rest": F.col("budget") - F.sum(F.when(F.col("full"), F.col("supply")).otherwise(0)).over(fam),
        "w_rest": F.sum(F.when(F.col("full"), 0).otherwise(F.col("w"))).over(fam),
    })
    nodes = nodes.withColumn("given", F.when(F.col("full"), F.col("supply")).otherwise(F.expr("greatest(rest, 0L) * w div greatest(w_rest, 1L)")))
    order = fam.orderBy("full", *names)
    nodes = nodes.withColumn("over", F.greatest(F.col("rest"), F.lit(0)) - F.sum(F.when(F.col("full"), 0).otherwise(F.col("given"))).over(fam))
    nodes = nodes.withColumn("given", F.when(~F.col("full") & (F.row_number().over(order) <= F.col("over")), F.least("supply", F.col("given") + 1)).otherwise(F.col("given")))
    return nodes.select(*[c for c in nodes.columns if c not in ("w", "below", "w_left", "full", "rest", "w_rest", "over")])


def budgets(leaves: DataFrame, weights: dict[str, dict[str, int]], share: tuple[int, int], max_epochs: int) -> DataFrame:
    """leaves (domain, lang, source, tokens) -> the same plus budget; share is the part of all tokens to hand out."""
    leaves = leaves.withColumn("supply", F.col("tokens") * max_epochs)
    top = leaves.groupBy(LEVELS[0]).agg(F.sum("supply").alias("supply"))
    total = leaves.agg(F.expr(f"coalesce(sum(tokens), 0L) * {share[0]} div {share[1]}")).scalar()
    level = _share(top.withColumn("budget", F.least(total, F.sum("supply").over(Window.partitionBy(F.lit(0))))), [], _weight(LEVELS[0], weights.get("domain", {})))
    for depth, name in ((2, "lang"), (3, "source")):
        cols = list(LEVELS[:depth])
        below = leaves.groupBy(*cols).agg(F.sum("supply").alias("supply"))
        level = below.join(level.select(*cols[:-1], F.col("given").alias("budget")), cols[:-1])
        level = _share(level, cols[:-1], _weight(cols[-1], weights.get(name, {})))
    return leaves.join(level.select(*LEVELS, F.col("given").alias("leaf_budget")), list(LEVELS))


def mix(docs: DataFrame, domain: Column, weights: dict[str, dict[str, int]], share: tuple[int, int] = (3, 5), max_epochs: int = 4, seed: int = 7) -> DataFrame:
    """docs plus mix_domain, mix_lang, mix_source, mix_tokens, mix_budget (the leaf's) and mix_copies (0: not taken).

    Columns of docs with the result's names are replaced, all others stay."""
    none = F.lit("none")
    keep = [c for c in docs.columns if c not in RESULT]
    aside = dict(zip(keep, free_names([*keep, *RESULT], *(f"kept_{i}" for i in range(len(keep))))))  # the steps' own names start with mix_
    who = F.coalesce(F.col("doc_id").cast("string"), F.concat(none, F.md5(F.coalesce("text", F.lit("")))))  # before any shuffle, so texts that are not kept stay out of it
    rows = docs.select(
        *[F.col(c).alias(a) for c, a in aside.items()], F.coalesce(domain, none).alias("mix_domain"), F.coalesce("lang", none).alias("mix_lang"), F.coalesce("source", none).alias("mix_source"),
        estimated_tokens().alias("mix_tokens"), who.alias("mix_who"),
    )
    # Leaves, plan and slices are written, since each is read more than once: unwritten, the driver would plan them anew each time.
    leaves = materialize(rows.groupBy(*LEVELS).agg(F.sum("mix_tokens").alias("tokens")), "leaves")
    plan = materialize(budgets(leaves, weights, share, max_epochs).select(
        *LEVELS, F.col("leaf_budget").alias("mix_budget"),
        F.expr("CASE WHEN tokens > 0 THEN leaf_budget div tokens ELSE 0L END").alias("mix_epochs"),
        F.expr("CASE WHEN tokens > 0 THEN leaf_budget % tokens ELSE 0L END").alias("mix_part"),
    ), "budgets")
    rows = rows.join(plan, list(LEVELS))
    rows = rows.withColumn("mix_order", F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("mix_epochs").cast("string"), "mix_who")))
    rows = rows.withColumn("mix_slice", F.substring("mix_order", 1, SLICE_DIGITS))
    cut = rows.groupBy(*LEVELS, "mix_slice").agg(F.sum("mix_tokens").alias("tokens"))
    before = Window.partitionBy(*LEVELS).orderBy("mix_slice").rowsBetween(Window.unboundedPreceding, -1)
    cut = materialize(cut.select(*LEVELS, "mix_slice", F.coalesce(F.sum("tokens").over(before), F.lit(0)).alias("mix_base")), "slices")
    inside = Window.partitionBy(*LEVELS, "mix_slice").orderBy("mix_order", "mix_tokens").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.join(cut, [*LEVELS, "mix_slice"]).withColumn("mix_upto", F.col("mix_base") + F.sum("mix_tokens").over(inside))
    copies = F.col("mix_epochs") + F.when((F.col("mix_part") > 0) & (F.col("mix_upto") <= F.col("mix_part")), 1).otherwise(0)
    return rows.select(*[F.col(a).alias(c) for c, a in aside.items()], *LEVELS, "mix_tokens", "mix_budget", copies.cast("long").alias("mix_copies"))


def mixture(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """The chosen documents themselves, a row for each copy, with the input's columns only."""
    aside = dict(zip(RESULT, free_names([*docs.columns, *RESULT], *(f"kept_{c}" for c in RESULT))))
    chosen = mix(docs.withColumns({a: F.col(c) for c, a in aside.items() if c in docs.columns}), *args, **kwargs).where("mix_copies > 0")
    (copy,) = free_names(chosen.columns, "copy")
    copies = chosen.select("*", F.explode(F.sequence(F.lit(1), F.col("mix_copies").cast("int"))).alias(copy))
    return copies.select(*[F.col(aside.get(c, c)).alias(c) for c in docs.columns])
