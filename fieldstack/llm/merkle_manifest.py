"""Merkle manifest of a table: a hash tree for each group of rows, one tree over the groups, and an inclusion proof for every row.

A row's leaf is the digest of its fields. Within a group the leaves ascend by ``order``; as long as a level has several nodes,
every ``FAN`` consecutive ones (the last run may be shorter) become the digest of their concatenated digests. What remains is the
group's subroot (of a lone row: its leaf). The subroots, ordered by group with null first, make the root in the same way.

1. Rows are ranked within their group without a task for each group: a range partitioning by (group, order), whose partitions number
   their rows, and a prefix sum over the counts of (group, partition).
2. A rank's digits in base ``FAN`` are columns. Blocks of FAN^DIGITS consecutive ranks are rolled up in one shuffle: grouping by all
   digits but the last nests up to three nodes in a struct with their digest, grouping by all but the last two nests those, and so on,
   until a block is one struct. Blocks are the leaves of the next tier, so no struct ever holds more than FAN^DIGITS rows, however
   large a group is; only digests go up.
3. Going down, a block's row and the proof of its root, which the tier above has emitted, meet in a group-by of their union. One
   transform walks down the nested structs, adding at each level the digests left and right of the path, and an explode emits the rows.

Nothing but two maxima reaches the driver, and every tier is a table in the shared folder. Fields are strings or integers.

Defined results: a null field enters a leaf as ``-``, any other as its UTF-8 byte count, ``:`` and its value, so null, empty and ``-``
differ, and so do shifted borders. A null group is a group like others, the first; null order values come first. Rows of equal order
are ranked by their leaves; equal rows have a place and a proof each. An empty table gives an empty result. Only the columns
named are read; the result's own ones start with mk_, so no other column can clash with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stash

FAN = 3
DIGITS = 6              # 729 rows in a block
UP = "struct<path: array<struct<before: string, after: string>>, subroot: string, root: string>"


def digest(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row's fields, each with its length."""
    texts = [f.cast("string") for f in fields]
    return digest(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and a proof lead to."""
    return F.aggregate(path, leaf, lambda h, step: digest(F.concat(step["before"], h, step["after"])))


def siblings(path: Column) -> Column:
    """All digests of a proof, level by level, left to right, as one text."""
    return F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), "")


def _ranked(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (a written table with mk_g and mk_h) plus mk_rank, from 0 within mk_g, and mk_levels, the height of the group's tree."""
    by = ["mk_g", *order, "mk_h", "mk_u"]
    # mk_u spreads equal rows; the ids given after the sort count a partition's rows from its number * 2^33
    placed = stash(rows.withColumn("mk_u", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
                   .drop("mk_u").withColumn("mk_at", F.monotonically_increasing_id()), "merkle-order")
    placed = placed.withColumn("mk_part", F.shiftright("mk_at", 33))
    in_order = Window.partitionBy("mk_g").orderBy("mk_part")
    counts = placed.groupBy("mk_g", "mk_part").agg(F.count("*").alias("n"), F.min("mk_at").alias("first"))
    offsets = counts.select(
        "mk_g", "mk_part", (F.sum("n").over(in_order) - F.col("n") - F.col("first")).alias("mk_shift"),
        F.sum("n").over(Window.partitionBy("mk_g")).alias("mk_n"))
    heights = " + ".join(f"cast(mk_n > {FAN ** k}L as int)" for k in range(39))
    return (placed.join(stash(offsets, "merkle-offsets", 1), ["mk_g", "mk_part"])
            .selectExpr(*rows.columns, "mk_at + mk_shift as mk_rank", f"{heights} as mk_levels"))


def _nested(nodes: DataFrame, below: int) -> DataFrame:
    """Nodes (mk_g, mk_levels, mk_rank, mk_h, mk_x) of level ``below`` to blocks (mk_g, mk_levels, mk_block, mk_h, mk_kids)."""
    digits = [f"mk_d{k}" for k in range(DIGITS)]
    rows = nodes.select("mk_g", "mk_levels", F.expr(f"mk_rank div {FAN ** DIGITS}").alias("mk_block"), *[
        F.expr(f"cast(mk_rank div {FAN ** k} % {FAN} as int)").alias(d) for k, d in enumerate(digits)], "mk_h", "mk_x")
    rows = rows.repartition("mk_g", "mk_block")         # each group-by below finds its rows together already
    held = "mk_x"
    for k in range(DIGITS):
        keys = ["mk_g", "mk_levels", "mk_block", *digits[:k:-1]]
        kid = F.struct(F.col(digits[k]).alias("d"), F.col("mk_h").alias("h"), F.col(held).alias("of"))
        rows = rows.groupBy(*keys).agg(F.sort_array(F.collect_list(kid)).alias("mk_kids"))
        joined = digest(F.array_join(F.transform("mk_kids", lambda x: x["h"]), ""))
        rows = rows.withColumn("mk_h", F.when(F.col("mk_levels") > below + k, joined).otherwise(F.col("mk_kids")[0]["h"]))
        held = "mk_kids"
    return rows.select("mk_g", "mk_levels", "mk_block", "mk_h", "mk_kids")


def _tiers(nodes: DataFrame) -> list[DataFrame]:
    """Written tables of blocks; in the last one every group is one block, whose mk_h is the top of its tree."""
    tiers = [stash(_nested(nodes, 0), "merkle-tier")]
    height = tiers[0].agg(F.max("mk_levels")).first()[0] or 0
    while DIGITS * len(tiers) < height:
        upper = tiers[-1].select("mk_g", "mk_levels", F.col("mk_block").alias("mk_rank"), "mk_h",
                                 F.struct(F.col("mk_block").alias("at")).alias("mk_x"))
        tiers.append(stash(_nested(upper, DIGITS * len(tiers)), "merkle-tier"))
    return tiers


def _paths(kids: Column, level: int, below: int, levels: Column, up: Column) -> Column:
    """(mk_x, mk_h, path) of every leaf below ``kids``, the children of a node of ``level``; ``up``: that node's own path."""
    def beside(k: Column, test) -> Column:
        return F.array_join(F.transform(F.filter(kids, lambda o: test(o["d"], k["d"])), lambda o: o["h"]), "")

    def path(k: Column) -> Column:
        step = F.struct(beside(k, lambda a, b: a < b).alias("before"), beside(k, lambda a, b: a > b).alias("after"))
        return F.when(levels >= below + level, F.concat(F.array(step), up)).otherwise(up)

    if level == 1:
        return F.transform(kids, lambda k: F.struct(k["of"].alias("mk_x"), k["h"].alias("mk_h"), path(k).alias("path")))
    return F.flatten(F.transform(kids, lambda k: _paths(k["of"], level - 1, below, levels, path(k))))


def _emitted(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(mk_g, mk_x, mk_h, mk_up) of every leaf of the trees. ``tops``: (mk_g, mk_up) of each tree's top."""
    known = tops.select("mk_g", F.lit(0).cast("long").alias("mk_block"), "mk_up")
    for t in reversed(range(len(tiers))):
        kids = tiers[t].schema["mk_kids"].dataType.simpleString()
        blocks = tiers[t].select("mk_g", "mk_block", "mk_levels", "mk_kids", F.lit(None).cast(UP).alias("mk_up"))
        above = known.select("mk_g", "mk_block", F.lit(None).cast("int").alias("mk_levels"), F.lit(None).cast(kids).alias("mk_kids"), "mk_up")
        both = blocks.union(above).groupBy("mk_g", "mk_block").agg(*[
            F.first(c, ignorenulls=True).alias(c) for c in ("mk_levels", "mk_kids", "mk_up")])
        leaves = _paths(F.col("mk_kids"), DIGITS, DIGITS * t, F.col("mk_levels"), F.col("mk_up")["path"])
        rows = both.select("mk_g", "mk_up", F.explode(leaves).alias("mk_leaf")).select(
            "mk_g", "mk_leaf.mk_x", "mk_leaf.mk_h",
            F.struct(F.col("mk_leaf.path").alias("path"), "mk_up.subroot", "mk_up.root").alias("mk_up"))
        known = rows.select("mk_g", F.col("mk_x.at").alias("mk_block"), "mk_up") if t else rows
    return known


def merkle_manifest(docs: DataFrame, fields: list[str], group: str = "source", order: str = "doc_id",
                    carry: dict[str, Column] | None = None) -> DataFrame:
    """``order`` and ``group`` of each row, the columns of ``carry`` (over ``docs``), mk_leaf, mk_subroot, mk_root and mk_path (steps
    of the digests before and after the row's own, from the leaf up)."""
    carry = carry or {}
    leaves = stash(docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("mk_g"),      # null: before all others
        F.col(order).alias("mk_order"), leaf_digest([F.col(f) for f in fields]).alias("mk_h"),
        *[c.alias(f"mk_c{i}") for i, c in enumerate(carry.values())]), "merkle-leaves")
    held = F.struct("mk_order", *[f"mk_c{i}" for i in range(len(carry))])
    tiers = _tiers(_ranked(leaves, ["mk_order"]).withColumn("mk_x", held))

    subroots = stash(tiers[-1].select(F.lit("").alias("mk_g"), F.struct(F.col("mk_g").alias("at")).alias("mk_x"), "mk_h"), "merkle-subroots")
    over = _tiers(_ranked(subroots.withColumn("mk_at_g", F.col("mk_x.at")), ["mk_at_g"]))
    root = over[-1].select("mk_g", F.struct(F.expr("cast(array() as array<struct<before: string, after: string>>)").alias("path"),
                                            F.lit(None).cast("string").alias("subroot"), F.col("mk_h").alias("root")).alias("mk_up"))
    tops = _emitted(over, root).select(F.col("mk_x.at").alias("mk_g"), F.struct(
        F.col("mk_up.path").alias("path"), F.col("mk_h").alias("subroot"), "mk_up.root").alias("mk_up"))
    return _emitted(tiers, tops).select(
        F.col("mk_x.mk_order").alias(order), F.when(F.col("mk_g") != "", F.expr("substr(mk_g, 2)")).alias(group),
        *[F.col(f"mk_x.mk_c{i}").alias(name) for i, name in enumerate(carry)], F.col("mk_h").alias("mk_leaf"),
        F.col("mk_up.subroot").alias("mk_subroot"), F.col("mk_up.root").alias("mk_root"), F.col("mk_up.path").alias("mk_path"))
