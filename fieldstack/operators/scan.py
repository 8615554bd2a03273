"""Ordered scans (running totals, last-seen, next value) that put neither a whole partition key nor all
its chunks into one task.

A plain ``sum(..) over (partition by batch order by ts)`` sends every row of a batch to a
single task; if one batch holds a third of the data, that task holds a third of the data.
Here the order is cut into chunks (any column that is monotone in the order, such as the
minute of a timestamp or the split offset of a file), and the window runs per (key, chunk).
What a chunk must know of the others comes from a prefix scan over a tree of chunk
summaries: an up-sweep merges the summaries of ``2 ** BITS`` neighbours into their parent's,
level by level; a down-sweep gives each node its parent's carry plus what its elder (or
next) siblings add, by a window over siblings alone. So no task ever sees more than
``2 ** BITS`` summaries of a key, however many chunks a batch or a file has. The result equals the
single-partition window exactly; rows without a key or a chunk are scanned like others, the latter first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BITS = 13           # a node has up to 8,192 children
LEVELS = 3          # so chunk numbers span 39 bits: minutes of a million years, offsets in files of 256 GB
HALF = 1 << (BITS * LEVELS - 1)


def _chunked(df: DataFrame, chunk: Column) -> DataFrame:
    """``df`` with _chunk, the chunk as a number from 0 on, minutes of a time. Numbers beyond the tree's span share its first or
    last chunk, which keeps their order."""
    kind = df.select(chunk.alias("c")).schema["c"].dataType.typeName()
    if kind in ("timestamp", "timestamp_ntz", "date"):
        number = F.date_diff(chunk.cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 1440
        if kind != "date":
            number = number + F.hour(chunk) * 60 + F.minute(chunk)
    else:
        number = chunk.cast("long")
    return df.withColumn("_chunk", F.when(number.isNull(), 0).otherwise(
        F.greatest(F.least(number, F.lit(HALF - 1)), F.lit(-HALF)) + HALF).cast("long"))


def _match(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null equal to null."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys]
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def _sweep(nodes: DataFrame, part: list[str], names: list[str], merge: Callable[[str], Column], over: Callable[[str, Window], Column],
           add: Callable[[Column, Column], Column], totals: bool = False, level: int = 1) -> DataFrame:
    """(part, _chunk, _carry_<name>[, _total_<name>]) of ``nodes`` (part, _chunk, names), one row for each chunk. ``merge``: a parent's
    value from its children's; ``over``: what siblings give to a node; ``add``: that and the parent's carry."""
    nodes = nodes.withColumn("_parent", F.shiftright("_chunk", BITS))
    siblings = Window.partitionBy(*part, "_parent").orderBy("_chunk")
    inner = nodes.select(*part, "_chunk", "_parent", *[over(n, siblings).alias(f"_in_{n}") for n in names], *[
        F.sum(n).over(Window.partitionBy(*part, "_parent")).alias(f"_total_{n}") for n in names if totals and level == LEVELS])
    if level == LEVELS:             # all chunks have one parent here
        return inner.select(*part, "_chunk", *[F.col(f"_in_{n}").alias(f"_carry_{n}") for n in names],
                            *[c for c in inner.columns if c.startswith("_total_")])
    parents = nodes.groupBy(*part, "_parent").agg(*[merge(n).alias(n) for n in names]).withColumnRenamed("_parent", "_chunk")
    above = _sweep(parents, part, names, merge, over, add, totals, level + 1).withColumnRenamed("_chunk", "_parent")
    both = _match(inner, above, [*part, "_parent"])
    return both.select(*part, "_chunk", *[add(F.col(f"_in_{n}"), F.col(f"_carry_{n}")).alias(f"_carry_{n}") for n in names],
                       *[f"_total_{n}" for n in names if totals])


def _earlier(window) -> Window:
    return window.rowsBetween(Window.unboundedPreceding, -1)


def _upto(part: list[str], order: list[str]) -> Window:
    return Window.partitionBy(*part, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)


def running_sums(df: DataFrame, part: list[str], order: list[str], chunk: Column,
                 values: dict[str, Column]) -> DataFrame:
    """Adds inclusive running sums ``name`` = sum(values[name]) in ``order`` within ``part``,
    plus ``_total_<name>`` = the sum over the whole key."""
    x = _chunked(df, chunk).withColumns({f"_v_{n}": v for n, v in values.items()})
    # chunks count from 0, so this is the key itself; a constant key stays a column, and the plan shows it beside its chunk
    nodes = x.groupBy(*[F.when(F.col("_chunk") >= 0, F.col(c)).alias(c) for c in part], "_chunk").agg(
        *[F.sum(f"_v_{n}").alias(n) for n in values])
    carry = _sweep(nodes, part, list(values), F.sum, lambda n, w: F.coalesce(F.sum(n).over(_earlier(w)), F.lit(0)),
                   lambda inner, above: inner + above, totals=True)
    x = x.withColumns({f"_in_{n}": F.sum(f"_v_{n}").over(_upto(part, order)) for n in values})
    x = _match(x.drop(*[f"_v_{n}" for n in values]), carry, [*part, "_chunk"])
    x = x.withColumns({n: F.col(f"_in_{n}") + F.col(f"_carry_{n}") for n in values})
    return x.drop("_chunk", *[f"_in_{n}" for n in values], *[f"_carry_{n}" for n in values])


def last_seen(df: DataFrame, part: list[str], order: list[str], chunk: Column, key: Column,
              name: str) -> DataFrame:
    """Adds ``name`` = the latest non-NULL ``key`` at or before each row (``key`` must
    increase with the order, e.g. the row's own order key where it starts a record)."""
    x = _chunked(df, chunk).withColumn("_k", key)
    nodes = x.groupBy(*part, "_chunk").agg(F.max("_k").alias("k"))
    carry = _sweep(nodes, part, ["k"], F.max, lambda n, w: F.max(n).over(_earlier(w)),
                   lambda inner, above: F.coalesce(inner, above))
    x = _match(x.withColumn("_in", F.max("_k").over(_upto(part, order))).drop("_k"), carry, [*part, "_chunk"])
    return x.withColumn(name, F.coalesce(F.col("_in"), F.col("_carry_k"))).drop("_chunk", "_in", "_carry_k")


def next_value(df: DataFrame, part: list[str], order: list[str], chunk: Column, value: Column,
               name: str) -> DataFrame:
    """Adds ``name`` = ``value`` of the next row in order within ``part`` (NULL for the
    last row), without a single-partition window."""
    x = _chunked(df, chunk).withColumn("_val", F.struct(value.alias("v")))      # a struct tells no next row from a null value
    nodes = x.groupBy(*part, "_chunk").agg(F.min_by("_val", F.struct(*[F.col(c) for c in order])).alias("first"))
    carry = _sweep(nodes, part, ["first"], lambda n: F.min_by(n, "_chunk"), lambda n, w: F.lead(n).over(w),
                   lambda inner, above: F.coalesce(inner, above))
    x = x.withColumn("_lead", F.lead("_val").over(Window.partitionBy(*part, "_chunk").orderBy(*order))).drop("_val")
    x = _match(x, carry, [*part, "_chunk"])
    return x.withColumn(name, F.coalesce(F.col("_lead"), F.col("_carry_first"))["v"]).drop("_chunk", "_lead", "_carry_first")
