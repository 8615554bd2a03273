"""Approximate nearest neighbours by inner product: a hash-prefix forest.

A tree is a sorted array of long hash strings: the sides of ``bits`` random hyperplanes, its own for each tree.
A query descends every tree to the entries that share the longest prefix with its own string, and ascends all trees in step,
one bit shorter at a time, until the shared ranges hold enough candidates. Candidates are scored exactly.

Hyperplanes see angles alone, so inner products are made angles: a row gets a component more that fills it up to the length M, a query 0.
M is the 0.9 quantile of the lengths (by dimension), as with the largest one a few long rows would leave all others at a right angle to every
query; the rows longer than M, a tenth at most, are candidates of every query. Rows of one length are hashed by their angles.

Rows are dealt to index blocks of about ``block`` rows, queries to query blocks; a pair of blocks is a task, so index and queries
grow without any task growing. A block's sorted arrays give the number of entries that share each prefix length;
the sums over blocks and trees fix each query's length (one row a query and index block), and a second pass scores the ranges of that
length and returns a block's best. A vector that many rows share is spread over the blocks like any other.

``candidates``: the ranges' total size to ascend to, in all rows and as their share; entries found in several trees count for each.
With 64 trees, three quarters find 98 % of true neighbours at a cosine of 0.35 among unrelated directions (the hardest case; about 63 % of the rows, 77 % with the longest if
lengths spread by a lognormal of sigma 1); clustered
vectors find theirs in far shorter ranges. Hyperplanes are drawn from ``seed``; nothing is fitted.

Defined results: vectors that are null, zero, or hold a null or non-finite component take no part, nor do rows with a null id. Rows
that repeat an id count once, with the least vector. Queries meet only candidates of their own dimension. Ties go to the smaller id. An empty table
gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stash


def _vectors(table: pa.Table) -> np.ndarray:
    lists = table.column("vec").combine_chunks()
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.chunk(0)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), -1)


STEPS = 256         # steps of an octave in which lengths are counted
SLACK = 1.01        # lengths up to this multiple of M count as M: the steps, and rows of one length but for rounding


def planes(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    """The last row is the filling component's."""
    return np.random.default_rng([seed, dim]).standard_normal((dim + 1, trees * bits)).astype(np.float32)


def filled(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors, the component that fills each up to M (in parts of M), and whether it is longer than M."""
    x, peak = _vectors(rows), rows.column("peak").to_numpy()
    with np.errstate(over="ignore"):
        square = ((x / peak[:, None]) ** 2).sum(axis=1)
    return x, np.sqrt(np.maximum(1.0 - square, 0.0)), square > SLACK ** 2


def hash_strings(x: np.ndarray, trees: int, bits: int, seed: int, fill: np.ndarray | None = None) -> np.ndarray:
    """(trees, rows) strings as integers, first bit highest."""
    weight = np.uint64(1) << np.arange(bits - 1, -1, -1, dtype=np.uint64)
    normal = planes(x.shape[1], trees, bits, seed)
    side = x.astype(np.float32) @ normal[:-1]
    if fill is not None:
        side += fill.astype(np.float32)[:, None] * normal[-1]
    side = side > 0
    return np.stack([(side[:, t * bits:(t + 1) * bits] * weight).sum(axis=1, dtype=np.uint64) for t in range(trees)])


def _range(array: np.ndarray, key: np.ndarray, drop: np.ndarray | int) -> tuple[np.ndarray, np.ndarray]:
    """Where the strings stand that agree with ``key`` but for its last ``drop`` bits."""
    drop = np.asarray(drop, dtype=np.uint64)
    lo = (key >> drop) << drop
    return (np.searchsorted(array, lo, side="left"),
            np.searchsorted(array, lo + ((np.uint64(1) << drop) - np.uint64(1)), side="right"))


def _counts(trees: int, bits: int, seed: int):
    def run(_: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        if not index.num_rows or not queries.num_rows:
            return pa.table({"query": pa.array([], pa.int64()), "sizes": pa.array([], pa.list_(pa.int64()))})
        x, fill, _ = filled(index)
        keys = hash_strings(x / index.column("peak").to_numpy()[:, None], trees, bits, seed, fill)
        asked = hash_strings(_vectors(queries), trees, bits, seed)
        keys.sort(axis=1)
        sizes = np.zeros((queries.num_rows, bits + 1), dtype=np.int64)
        for t in range(trees):
            for drop in range(bits + 1):
                lo, hi = _range(keys[t], asked[t], drop)
                sizes[:, drop] += hi - lo
        return pa.table({"query": queries.column("id"), "sizes": pa.array(list(sizes), pa.list_(pa.int64()))})
    return run


def _search(trees: int, bits: int, seed: int, k: int):
    def run(_: tuple, index: pa.Table, queries: pa.Table) -> pa.Table:
        out_q, out_id, out_s = [], [], []
        if index.num_rows and queries.num_rows:
            (x, fill, long), q = filled(index), _vectors(queries)
            ids = index.column("id").to_numpy()
            keys = hash_strings(x / index.column("peak").to_numpy()[:, None], trees, bits, seed, fill)
            order = np.argsort(keys, axis=1, kind="stable")
            drop = queries.column("drop").to_numpy().astype(np.uint64)
            asked = hash_strings(q, trees, bits, seed)
            spans = [_range(np.take(keys[t], order[t]), asked[t], drop) for t in range(trees)]
            lo, hi = (np.stack(s, axis=1).tolist() for s in zip(*spans))
            for i, me in enumerate(queries.column("id").to_pylist()):
                found = long.copy()
                for t in range(trees):
                    found[order[t, lo[i][t]:hi[i][t]]] = True
                found &= ids != me
                at = np.flatnonzero(found)
                if len(at) > k:     # a quick product first, then the measure itself on all that may be among the best
                    quick = x[at] @ q[i]
                    least = np.partition(quick, len(at) - k)[len(at) - k]
                    at = at[quick >= least - 1e-9 * (1.0 + abs(least))]
                score = (x[at] * q[i]).sum(axis=1)
                best = np.lexsort((ids[at], -score))[:k]
                out_q.append(np.full(len(best), me))
                out_id.append(ids[at][best])
                out_s.append(score[best])
        cat = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, dtype=kind)
        return pa.table({"query_id": pa.array(cat(out_q, np.int64), pa.int64()), "vec_id": pa.array(cat(out_id, np.int64), pa.int64()),
                         "score": pa.array(cat(out_s, np.float64), pa.float64())})
    return run


def forest_search(vectors: DataFrame, is_query: Column, vec_id: str = "vec_id", embedding: str = "embedding", k: int = 20,
                  trees: int = 64, bits: int = 24, candidates: tuple[int, float] = (2000, 0.75), block: int = 4096,
                  query_block: int = 512, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found of every row that is a query."""
    whole = F.col("vec").isNotNull() & (F.array_size("vec") > 0) & ~F.exists(
        "vec", lambda v: F.coalesce(F.isnan(v) | (F.abs(v) == float("inf")), F.lit(True))) & F.exists("vec", lambda v: v != 0)
    rows = (vectors.select(F.col(vec_id).cast("long").alias("id"), F.col(embedding).cast("array<double>").alias("vec"),
                           is_query.alias("q")).where("id is not null").where(whole)
            .groupBy("id").agg(F.min("vec").alias("vec"), F.max("q").alias("q"))
            .withColumns({"dim": F.array_size("vec"), "h": F.xxhash64(F.lit(seed), "id")}))
    rows = stash(rows, "vectors")
    n, m = rows.selectExpr("count(*)", "count_if(q)").first()
    # M by dimension, exactly in steps: lengths are a few thousand integers
    top = F.expr("array_max(transform(vec, v -> abs(v)))")
    lengths = rows.select("dim", "vec", top.alias("top")).selectExpr(
        "dim", f"""cast(round({STEPS} * (log2(top) + 0.5 * log2(aggregate(vec, 0D, (a, v) -> a + (v / top) * (v / top))))) as int) as step""")
    peaks = stash(lengths.groupBy("dim").agg(F.expr(f"greatest(power(2D, floor(percentile(step, 0.9)) / {STEPS}), 1e-300D)").alias("peak")), "peaks", 1)
    rows = rows.join(peaks, "dim")
    blocks, query_blocks = max(1, -(-n // block)), max(1, -(-m // query_block))
    index = rows.select("id", "vec", "dim", "peak", F.pmod("h", F.lit(blocks)).alias("ib"),
                        F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))).alias("qb"))
    queries = rows.where("q").select(*[F.col(c).alias(c) for c in ("id", "vec", "dim")],
                                    F.pmod(F.shiftright("h", 20), F.lit(query_blocks)).cast("int").alias("qb"))

    def meet(asked: DataFrame, run, schema: str) -> DataFrame:
        spread = asked.withColumn("ib", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
        keys = ["dim", "ib", "qb"]
        return index.groupBy(*keys).cogroup(spread.groupBy(*keys)).applyInArrow(run, schema)

    sizes = meet(queries, _counts(trees, bits, seed), "query long, sizes array<long>")
    total = sizes.groupBy("query").agg(F.array(*[F.sum(F.get("sizes", F.lit(d))) for d in range(bits + 1)]).alias("sizes"))
    want = max(candidates[0], int(candidates[1] * n))
    deep = total.select("query", F.expr(f"""cast(coalesce(nullif(array_position(transform(sizes, s -> s >= {want}), true), 0) - 1,
                                                          {bits}) as int)""").alias("drop"))
    deep = stash(deep, "lengths")
    found = meet(queries.join(deep, F.col("id") == F.col("query")).drop("query"), _search(trees, bits, seed, k),
                 "query_id long, vec_id long, score double")
    ranked = found.selectExpr("query_id", """row_number() over (partition by query_id order by score desc, vec_id) as rank""",
                              "vec_id", "score")
    return ranked.where(F.col("rank") <= k)
