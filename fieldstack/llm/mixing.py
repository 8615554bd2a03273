"""Mixing sources to target weights by temperature.

A source's weight is its token share raised to an exponent, normalised. The exponent (1: as found, 0: all alike) is
bisected until the weights' entropy reaches ``entropy`` nats, or until no source is repeated more than ``repetition``
times. The weights are realised under a token budget: a source whose quota is e times its tokens gets floor(e) whole
epochs and a last one in part.

Every epoch is a permutation of blocks: a hash deals a source's documents to blocks of about ``block_tokens`` tokens and
another, new for each epoch, orders them; documents within a block are ordered likewise. A partial epoch takes whole blocks
in that order while they fit, and documents of the block that does not, while they fit. Sorting the result by
(mx_epoch, mx_order) gives the training order, with the sources interleaved.

Without a budget, the budget is what shows the source with the largest token count exactly once; with an exponent of
at most 1 every other source is then seen at least once, so no document is left out.

One row for each source goes through the driver (counts of a group-by), nothing else. Sums over blocks and the
boundary blocks' documents run on narrow rows without texts. The number of blocks is bounded by ``max_blocks`` whatever the input.

Defined results: a null or empty text has no tokens and costs none; a source without tokens is shown once. Null is a
source like others. Repeated rows are documents of their own. An empty table gives an empty result. Extra columns pass
through; those named mx_.. are replaced.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own, stash

_SPACES = r" \t\n\u000B\u000C\r"


def word_count(text: str = "text") -> Column:
    words = F.expr(f"split(btrim({text}, '{_SPACES}'), '[\\\\x20\\\\x09-\\\\x0D]+')")
    return F.when(F.coalesce(F.get(words, F.lit(0)), F.lit("")) == "", F.lit(0)).otherwise(F.array_size(words)).cast("long")


@dataclass(frozen=True)
class Mixture:
    exponent: float
    budget: int
    weights: dict[str | None, float]
    epochs: dict[str | None, int]       # whole epochs
    rest: dict[str | None, int]         # tokens of the partial epoch


def _weights(shares: list[float], exponent: float) -> list[float]:
    top = max(shares)
    raw = [math.exp(exponent * math.log(p / top)) for p in shares]
    total = math.fsum(raw)
    return [w / total for w in raw]


def solve(tokens: dict[str | None, int], budget: int | None = None, entropy: float | None = None,
          repetition: float | None = None) -> Mixture:
    """The mixture of sources with these token counts. Give ``entropy`` or ``repetition``."""
    if (entropy is None) == (repetition is None):
        raise ValueError("give a target entropy or a repetition limit")
    if repetition is not None and repetition < 1 and budget is None:
        raise ValueError("without a budget a source is seen once or more; the limit must be 1 or more")
    names = sorted((s for s, t in tokens.items() if t > 0), key=lambda s: (s is not None, s))
    total = sum(tokens.values())
    whole, rest = {s: 1 for s in tokens}, {s: 0 for s in tokens}
    if not names:
        return Mixture(1.0, 0, {}, whole, rest)
    counts = [tokens[s] for s in names]
    shares = [c / total for c in counts]
    biggest = counts.index(max(counts))

    def seen(a: float) -> list[float]:
        """Epochs of each source."""
        w = _weights(shares, a)
        b = budget if budget is not None else counts[biggest] / w[biggest]
        return [b * x / c for x, c in zip(w, counts)]

    def too_flat(a: float) -> bool:
        if repetition is not None:
            return max(seen(a)) > repetition
        w = _weights(shares, a)
        return -math.fsum(x * math.log(x) for x in w if x > 0) > entropy

    lo, hi = 0.0, 1.0
    if too_flat(hi):
        if repetition is not None and budget is not None and budget > repetition * total * (1 + 1e-12):
            raise ValueError("the budget is more than the repetition limit allows with any weights")
        while entropy is not None and too_flat(hi) and hi < 64:
            lo, hi = hi, hi * 2
    if too_flat(lo):
        for _ in range(60):
            mid = (lo + hi) / 2
            lo, hi = (mid, hi) if too_flat(mid) else (lo, mid)
        exponent = hi
    else:
        exponent = lo
    weights, epochs = _weights(shares, exponent), seen(exponent)
    if budget is None:
        epochs[biggest] = 1.0
    for s, e, c in zip(names, epochs, counts):
        e = round(e) if abs(e - round(e)) < 1e-9 else e
        whole[s] = math.floor(e)
        rest[s] = int((e - whole[s]) * c)
    spent = sum(whole[s] * tokens[s] + rest[s] for s in names)
    return Mixture(exponent, budget if budget is not None else spent, dict(zip(names, weights)), whole, rest)


def _order(seed: int, *parts: Column | str) -> Column:
    return F.xxhash64(F.lit(seed), *parts)


def temperature_mix(docs: DataFrame, source: str = "source", tokens: Column | None = None, budget: int | None = None,
                    entropy: float | None = None, repetition: float | None = None, seed: int = 0,
                    block_tokens: int = 1 << 16, max_blocks: int = 1 << 20) -> DataFrame:
    """One row for each showing of a document: ``docs`` plus mx_tokens, mx_epoch, mx_block and mx_order."""
    spark = docs.sparkSession
    docs = own(docs, "mx_")
    key = [F.col(c) for c in ("doc_id", "text") if c in docs.columns]
    keyed = docs.withColumns({"mx_source": F.col(source), "mx_tokens": word_count() if tokens is None else tokens,
                              "mx_id": F.xxhash64(F.lit(seed), *key)})
    narrow = stash(keyed.select("mx_source", "mx_tokens", "mx_id"), "tokens")
    totals = {r.mx_source: r.t for r in narrow.groupBy("mx_source").agg(
        F.sum("mx_tokens").alias("t")).collect()}           # one row a source
    plan = solve(totals, budget, entropy, repetition)
    per_block = max(block_tokens, sum(totals.values()) // max_blocks + 1)
    sources = spark.createDataFrame(
        [(s, max(1, -(-t // per_block)), plan.epochs[s], plan.rest[s]) for s, t in totals.items()],
        "mx_s string, mx_blocks long, mx_whole long, mx_rest long")

    def placed(df: DataFrame) -> DataFrame:
        return (df.join(sources, F.col("mx_source").cast("string").eqNullSafe(F.col("mx_s")))
                .withColumn("mx_block", F.pmod(F.col("mx_id"), F.col("mx_blocks"))).drop("mx_s", "mx_blocks"))

    # the partial epoch (number mx_whole): which blocks fit, and which one is cut
    part = placed(narrow).where("mx_rest > 0")
    order = _order(seed, "mx_whole", "mx_source", "mx_block")
    sums = part.groupBy("mx_source", "mx_block", "mx_whole", "mx_rest").agg(F.sum("mx_tokens").alias("t")).select(
        "*", order.alias("o"))
    run = sums.selectExpr("mx_source", "mx_block", "mx_rest", "t", """coalesce(sum(t) over (partition by mx_source
                          order by o, mx_block rows between unbounded preceding and 1 preceding), 0) as before""")
    states = stash(run.where("before <= mx_rest").selectExpr(
        "mx_source as mx_bs", "mx_block as mx_bb", "mx_rest - before as mx_room", "before + t <= mx_rest as mx_fits"), "blocks", 1)
    on_block = F.col("mx_source").eqNullSafe(F.col("mx_bs")) & (F.col("mx_block") == F.col("mx_bb"))
    inner = _order(seed, "mx_whole", "mx_id")
    edge = part.join(states.where("not mx_fits"), on_block).select("mx_bs", "mx_bb", "mx_room", "mx_tokens", inner.alias("o"))
    # the edge block's documents in order, while they fit: the last one's order is all that is kept
    fit = edge.selectExpr("*", """sum(mx_tokens) over (partition by mx_bs, mx_bb order by o
                          range between unbounded preceding and current row) as upto""").where("upto <= mx_room")
    cuts = fit.groupBy("mx_bs", "mx_bb").agg(F.max("o").alias("mx_cut"))
    states = stash(states.join(cuts.select(F.col("mx_bs").alias("cs"), F.col("mx_bb").alias("cb"), "mx_cut"),
                               F.col("mx_bs").eqNullSafe(F.col("cs")) & (F.col("mx_bb") == F.col("cb")), "left")
                   .select("mx_bs", "mx_bb", "mx_fits", "mx_cut"), "blocks", 1)

    more = F.coalesce(F.col("mx_fits") | (inner <= F.col("mx_cut")), F.lit(False)).cast("long")
    shown = placed(keyed).join(states, on_block, "left").withColumn("mx_n", F.col("mx_whole") + more)
    return (shown.where("mx_n > 0").withColumn("mx_epoch", F.explode(F.expr("transform(sequence(0L, mx_n - 1), e -> cast(e as int))")))
            .withColumn("mx_order", _order(seed, F.col("mx_epoch").cast("long"), "mx_source", "mx_block"))
            .select(*docs.columns, "mx_tokens", "mx_epoch", "mx_block", "mx_order"))
