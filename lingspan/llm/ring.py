"""Sharding by a consistent-hash ring with virtual nodes and bounded loads, in DataFrame functions only.

The ring has CELLS equal cells. A shard owns VNODES pseudo-random cells; a key falls into one cell and belongs to the
first virtual node at or after it, clockwise. A shard is full once its bytes reach the bound (1 + slack) * mean; the
cells of keys that find their shard full continue clockwise to the next distinct shard that is not. The walk runs on
per-cell byte totals, at most CELLS rows whatever the input's size, so only the bounded placement table is broadcast
and no task ever holds a shard's rows. Rows of a cell are numbered inside the cell and moved by the cell's offset,
which makes slots gapless without sorting whole shards in one task.

A cell that holds over 1 / SPLIT of the bound, as one of a key that a third of all rows have, is split: its rows are
written once with their places in the table, dealt over as many pieces as keep within that size, and a piece walks like a
cell. So balance depends on single rows only. All heavy cells together have at most n_shards * SPLIT pieces and one each.

Nulls and ties: a null doc_id hashes as the text 'null'; a null text has size 1 and crc32 of the empty string; equal
rows get different slots; an empty table gives an empty result. Columns of the input that clash with the result's are
replaced by the result's; all others stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .shared import free_names, materialize

#: Cells of the ring. Bounds the placement table: at most this many rows of three numbers are broadcast.
CELLS = 65536
VNODES = 64
RESULT = ("size", "text_crc32", "shard", "slot")
#: A cell or piece of one has about 1 / SPLIT of a shard's bytes at most.
SPLIT = 512


def _hash32(text: Column) -> Column:
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def _cell(key: Column, cells: int) -> Column:
    return F.floor(_hash32(F.concat(F.lit("key:"), key)) * cells / (1 << 32)).cast("int")


def ring(spark: SparkSession, n_shards: int, vnodes: int = VNODES, cells: int = CELLS) -> DataFrame:
    """(from_cell, upto_cell, prefs): the arcs between virtual nodes with the distinct shards met clockwise."""
    points = (
        spark.range(n_shards * vnodes)
        .select((F.col("id") % n_shards).cast("int").alias("shard"), _hash32(F.concat(F.lit("node:"), (F.col("id") % n_shards).cast("string"), F.lit(":"), F.floor(F.col("id") / n_shards).cast("string"))).alias("at"))
        .agg(F.array_sort(F.collect_list(F.struct("at", "shard"))).alias("p"))
    )  # n_shards * vnodes points: a parameter, not data
    shards = F.transform("p", lambda x: x["shard"])
    arcs = points.select("p", shards.alias("s"), F.explode(F.sequence(F.lit(0), F.size("p"))).alias("i"))
    turned = F.concat(F.slice("s", F.col("i") + 1, F.size("s")), F.col("s"))
    at_cell = lambda x: F.floor(x["at"] * cells / (1 << 32)).cast("int")
    return arcs.select(
        F.when(F.col("i") == 0, 0).otherwise(at_cell(F.get("p", F.col("i") - 1)) + 1).alias("from_cell"),
        F.coalesce(at_cell(F.get("p", F.col("i"))), F.lit(cells - 1)).alias("upto_cell"),
        F.array_distinct(turned).alias("prefs"),
    ).where("from_cell <= upto_cell")


def _bound(loads: DataFrame, n_shards: int, slack: float) -> DataFrame:
    """One row with the bytes at which a shard is full."""
    return loads.agg(F.ceil(F.sum("bytes") / n_shards * (1 + slack)).alias("b"))


def place_cells(loads: DataFrame, n_shards: int, slack: float = 0.0, vnodes: int = VNODES, cells: int = CELLS) -> DataFrame:
    """loads (cell, piece, bytes, n) -> (cell, piece, shard, base): the bounded-load walk, one round for each shard a cell may
    meet.

    With slack 0 the bound is the mean itself: shards below it always accept, so every piece finds a place and no shard
    exceeds the mean by more than one piece."""
    spark = loads.sparkSession
    arcs = ring(spark, n_shards, vnodes, cells).select(F.explode(F.sequence("from_cell", "upto_cell")).alias("cell"), "prefs")
    state = loads.join(F.broadcast(arcs), "cell").select("cell", "piece", "bytes", "n", "prefs", _bound(loads, n_shards, slack).scalar().alias("bound"), F.lit(0).alias("step"), F.lit(False).alias("placed"))
    for _ in range(n_shards):
        at = Window.partitionBy(F.get("prefs", F.col("step"))).orderBy(F.desc("placed"), "cell", "piece")
        before = F.coalesce(F.sum("bytes").over(at.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        state = state.withColumn("fits", F.col("placed") | (before < F.col("bound")))
        state = state.select("cell", "piece", "bytes", "n", "prefs", "bound", (F.col("step") + F.when(F.col("fits"), 0).otherwise(1)).alias("step"), F.col("fits").alias("placed"))
    placed = state.select("cell", "piece", F.get("prefs", F.least("step", F.lit(n_shards - 1))).alias("shard"), "n")
    upto = Window.partitionBy("shard").orderBy("cell", "piece").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select("cell", "piece", "shard", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("base"))


def shard_by_ring(docs: DataFrame, n_shards: int = 16, slack: float = 0.0, key: str = "doc_id", text: str = "text", vnodes: int = VNODES, cells: int = CELLS, columns: list[str] | None = None) -> DataFrame:
    """docs (or the given columns of it) plus size, text_crc32, shard and slot; size is the UTF-8 bytes of the text plus 1."""
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [c for c in (docs.columns if columns is None else columns) if c not in RESULT]
    cell, piece, base, pieces, order = free_names([*keep, *RESULT], "cell", "piece", "base", "pieces", "order")
    crc = F.crc32(body.cast("binary"))
    dealt_by = F.coalesce(F.col(key).cast("string"), F.concat(F.lit("text:"), crc.cast("string")))  # rows without a key spread by text
    rows = docs.select(*keep, (F.octet_length(body) + 1).cast("long").alias("size"), crc.alias("text_crc32"), _cell(dealt_by, cells).alias(cell), F.col(key).alias(order))
    count = lambda df: df.groupBy(F.col(cell).alias("cell"), F.col(piece).alias("piece")).agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    loads = materialize(count(rows.withColumn(piece, F.lit(0).cast("long"))), "loads")
    most = F.greatest(F.floor(_bound(loads, n_shards, slack).scalar() / SPLIT), F.lit(1))
    heavy = loads.withColumn("pieces", F.ceil(F.col("bytes") / most)).where("pieces > 1 AND n > 1").select("cell", "pieces")
    heavy = materialize(heavy, "heavy").withColumnsRenamed({"cell": cell, "pieces": pieces})
    if heavy.isEmpty():
        rows = rows.withColumn(piece, F.lit(0).cast("long"))
    else:
        dealt = rows.join(F.broadcast(heavy), cell)  # at most CELLS rows, as are the light ones'
        dealt = materialize(dealt.withColumn(piece, F.pmod(F.monotonically_increasing_id(), F.col(pieces))).drop(pieces), "dealt")
        rows = rows.join(F.broadcast(heavy.select(cell)), cell, "left_anti").withColumn(piece, F.lit(0).cast("long")).select(dealt.columns).unionAll(dealt)
        light = loads.join(heavy.select(F.col(cell).alias("cell")), "cell", "left_anti")
        loads = materialize(light.unionByName(count(dealt)), "loads")
    placed = place_cells(loads, n_shards, slack, vnodes, cells).withColumnsRenamed({"cell": cell, "piece": piece, "base": base})
    within = Window.partitionBy(cell, piece).orderBy(order, "text_crc32", "size")
    return (
        rows.join(F.broadcast(placed), [cell, piece])  # at most CELLS rows and the pieces
        .withColumn("slot", (F.col(base) + F.row_number().over(within) - 1).cast("long"))
        .select(*keep, *RESULT)
    )
