"""Quality classifier by Bradley-Terry pairwise ranking.

A document's strength is a linear function of its features; the probability that one document is better than another is the logistic function
of the difference of their strengths. The weights are learned from preference pairs (a document labelled 1 is preferred to
one labelled 0) by logistic loss on feature differences with a ridge, by Newton's method. A threshold turns strengths into classes: the
quantile of the labelled documents' strengths at the share of label 0.

1. One pass over the texts gives each document's features, all computed from its bytes: shares of character classes and of single
   symbols, neighbouring character classes, lengths of words and lines, repeated words, windows and lines. They are written as a narrow table.
2. Labelled documents are dealt by a hash of their row to blocks of about ``BLOCK`` rows. Within a block every document of the
   more frequent class is paired with ``PAIRS`` of the other, in turn, so the number of pairs is linear in the documents, whatever the
   balance. All labelled documents take part: no sample.
3. A Newton step is one pass: tasks add up gradient and Hessian over their blocks' pairs; one array of a few hundred
   squared numbers reaches the driver. Strengths are counted in steps of 1/256 for the quantile, combined map-side.

Only the text enters a score. Defined results: a null text is an empty one; both are scored like others (their shares are 0). Repeated
rows are scored and learned each. Labels of a document that disagree are decided by their mean, an even one is no label; null ids have no
label. Without documents of both classes the score is the share of label 1 for all, 0.5 without any label. An empty table gives
an empty result. Extra columns pass through; those named qr_.. are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, U64, SpanHash, files_for, flat, line_spans, own, slices, small_batches, stash, summed, word_spans

BLOCK = 512             # labelled documents that are paired with each other
PAIRS = 4               # partners of each document of the more frequent class
RIDGE = 1e-3
STEPS = 25              # of Newton's method at most
GRID = 256              # steps of a strength in one unit, for the quantile
SYMBOLS = [b for b in range(33, 127) if not chr(b).isalnum()]

# lower case, upper case, digit, white space, sentence punctuation, other symbol, byte of a longer character, control
_KINDS = np.full(256, 7, dtype=np.uint8)
_KINDS[97:123], _KINDS[65:91], _KINDS[48:58], _KINDS[128:] = 0, 1, 2, 6
_KINDS[SYMBOLS] = 5
_KINDS[[ord(c) for c in ".,;:!?'\"()-"]] = 4
_KINDS[SPACE] = 3
KINDS = 8
SHAPES = 13
DIMENSION = KINDS + len(SYMBOLS) + KINDS * KINDS + SHAPES


# ------------------------------------------------------------------ features

def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _repeated(text: np.ndarray, key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text: keys, distinct keys, the count of its most frequent key."""
    order = np.lexsort((key, text))
    t, k = text[order], key[order]
    new = np.ones(len(k), dtype=bool)
    new[1:] = (t[1:] != t[:-1]) | (k[1:] != k[:-1])
    first = np.flatnonzero(new)
    runs = np.diff(np.append(first, len(k)))
    most = np.zeros(n, dtype=np.int64)
    np.maximum.at(most, t[first], runs)
    return np.bincount(text, minlength=n), np.bincount(t[first], minlength=n), most


def features(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """texts x DIMENSION, from the bytes of texts side by side."""
    n = len(offs) - 1
    size = np.diff(offs)
    text = np.repeat(np.arange(n), size)
    bytes_ = np.bincount(text * 256 + buf, minlength=n * 256).reshape(n, 256)
    kind = _KINDS[buf]
    kinds = np.bincount(text * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS)
    same = text[1:] == text[:-1]
    beside = np.bincount((text[1:] * KINDS + kind[:-1])[same] * KINDS + kind[1:][same], minlength=n * KINDS * KINDS).reshape(n, KINDS * KINDS)
    every = size[:, None]

    starts, ends, of = word_spans(buf, offs)
    hashes = SpanHash(buf, lower=True)
    words, distinct, most = _repeated(of, hashes(starts, ends), n)
    whole = np.flatnonzero(of[2:] == of[:-2]) if len(of) > 2 else np.zeros(0, dtype=np.int64)
    windows, window_kinds, _ = _repeated(of[whole], hashes(starts[whole], ends[whole + 2]), n)
    heads = np.concatenate([[0], np.cumsum((kind == 1) | (kind == 5) | (kind == 2))])
    solid = heads[ends] - heads[starts]
    loud = np.bincount(of, weights=(solid == ends - starts) & (ends - starts > 1), minlength=n)
    tail = np.bincount(of, weights=_KINDS[buf[ends - 1]] == 5 if len(ends) else None, minlength=n)
    ls, le, lt = line_spans(buf, offs)
    lines, line_kinds, _ = _repeated(lt, hashes(ls, le), n)
    length = np.bincount(of, weights=ends - starts, minlength=n)
    squares = np.bincount(of, weights=(ends - starts).astype(float) ** 2, minlength=n)
    mean = _share(length, words)
    shape = np.stack([
        np.log1p(size), np.log1p(words), np.log1p(mean), np.log1p(np.maximum(_share(squares, words) - mean ** 2, 0)),
        _share(distinct, words), _share(most, words), _share(windows - window_kinds, windows), _share(lines - line_kinds, lines),
        np.log1p(_share(words, lines)), _share(loud, words), _share(tail, words),
        _share(kinds[:, 1], kinds[:, 0] + kinds[:, 1]), np.log1p(lines)], axis=1)
    logs = np.log1p(100 * np.concatenate([_share(kinds, every), _share(bytes_[:, SYMBOLS], every), _share(beside, every)], axis=1))
    return np.concatenate([logs, shape], axis=1).astype(np.float32)


def _feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in slices(batch, "qr_text"):
            x = features(*flat(piece.column("qr_text")))
            packed = pa.FixedSizeBinaryArray.from_buffers(pa.binary(4 * DIMENSION), len(x), [None, pa.py_buffer(x.tobytes())])
            rest = [c for c in piece.schema.names if c != "qr_text"]
            yield pa.RecordBatch.from_arrays([piece.column(c) for c in rest] + [packed.cast(pa.binary())], [*rest, "qr_x"])


def with_features(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, plus qr_x: packed floats."""
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c != text]
    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in rest)
    return docs.select(*rest, F.col(text).alias("qr_text")).mapInArrow(_feature_rows, f"{kinds + ', ' if kinds else ''}qr_x binary")


# ------------------------------------------------------------------ preference pairs

def pair_up(label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(preferred, other): positions of a block's rows, each row of the more frequent class in PAIRS pairs."""
    good, bad = np.flatnonzero(label == 1), np.flatnonzero(label == 0)
    if not len(good) or not len(bad):
        return good[:0], bad[:0]
    many, few = (good, bad) if len(good) >= len(bad) else (bad, good)
    count = min(PAIRS, len(few))
    left = np.repeat(many, count)
    right = few[(np.arange(len(many))[:, None] * count + np.arange(count)).ravel() % len(few)]
    return (left, right) if many is good else (right, left)


def _blocks(rows: pa.Table) -> pa.Table:
    x = b"".join(v.as_py() for v in rows.column("qr_x"))
    return pa.table({"label": pa.array([rows.column("qr_label").to_numpy().astype(np.int8).tobytes()], pa.binary()), "x": pa.array([x], pa.binary())})


def _rows(row: dict) -> tuple[np.ndarray, np.ndarray]:
    return (np.frombuffer(row["label"].as_buffer(), dtype=np.int8),
            np.frombuffer(row["x"].as_buffer(), dtype=np.float32).reshape(-1, DIMENSION).astype(np.float64))


@dataclass(frozen=True)
class Ranking:
    weights: np.ndarray | None      # of the plain features; None: one class only
    threshold: float
    share: float                    # of label 1
    pairs: int = 0
    loss: float = 0.0


def newton(blocks: DataFrame, centre: np.ndarray, scale: np.ndarray, ridge: float = RIDGE) -> tuple[np.ndarray, int, float]:
    """(weights of standardised features, pairs, loss): the minimum of the mean logistic loss of pairs plus ridge / 2 * |w|^2."""
    d = DIMENSION
    w, step, best = np.zeros(d), np.zeros(d), np.inf
    pairs = 0
    for _ in range(2 * STEPS):
        def of(row: dict, w=w + step) -> np.ndarray:
            label, x = _rows(row)
            a, b = pair_up(label)
            z = (x - centre) / scale
            out = np.zeros(2 + d + d * d)
            for lo in range(0, len(a), 1024):
                diff = z[a[lo:lo + 1024]] - z[b[lo:lo + 1024]]
                margin = diff @ w
                p = 1 / (1 + np.exp(np.clip(margin, -500, 500)))         # chance of the wrong order
                out[0] += len(diff)
                out[1] += np.logaddexp(0, -margin).sum()
                out[2:2 + d] -= diff.T @ p
                out[2 + d:] += (diff.T @ (diff * (p * (1 - p))[:, None])).ravel()
            return out

        total = summed(blocks, of, 2 + d + d * d)
        pairs = int(total[0]) if total is not None else 0
        if not pairs:
            return w, 0, 0.0
        tried = w + step
        loss = total[1] / pairs + ridge / 2 * tried @ tried
        if loss > best + 1e-12:         # too far: half the step
            step = step / 2
            if np.abs(step).max() < 1e-9:
                break
            continue
        gradient = total[2:2 + d] / pairs + ridge * tried
        w, done = tried, best - loss < 1e-7 and np.isfinite(best)
        best = loss
        if done or np.abs(gradient).max() < 1e-7:
            break
        step = -np.linalg.solve(total[2 + d:].reshape(d, d) / pairs + ridge * np.eye(d), gradient)
    return w, pairs, float(best)


def _strengths(weights: np.ndarray):
    """Column function of packed features: their strength."""
    def run(x: pa.ChunkedArray) -> np.ndarray:
        x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
        return np.frombuffer(flat(x)[0].tobytes(), dtype=np.float32).reshape(-1, DIMENSION).astype(np.float64) @ weights
    return run


def _with_strength(rows: DataFrame, weights: np.ndarray) -> DataFrame:
    """``rows`` with qr_s in place of qr_x."""
    of = _strengths(weights)
    rest = [c for c in rows.columns if c != "qr_x"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(c) for c in rest] + [pa.array(of(batch.column("qr_x")))], [*rest, "qr_s"])

    return rows.mapInArrow(run, ", ".join([f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rest] + ["qr_s double"]))


def learn_ranking(rows: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", ridge: float = RIDGE) -> Ranking:
    """The ranking from ``rows`` (a written table with ``key`` and qr_x) and ``labels`` (``key``, ``label`` of 0 or 1)."""
    decided = labels.where(F.col(label).isin(0, 1)).groupBy(F.col(key).alias("qr_key")).agg(F.avg(label).alias("qr_mean")).where(
        "qr_key is not null and qr_mean <> 0.5").select("qr_key", F.expr("cast(qr_mean > 0.5 as int)").alias("qr_label"))
    known = stash(rows.join(decided, F.col(key) == F.col("qr_key")).select("qr_label", "qr_x"), "labelled")
    count = {r.qr_label: r["count"] for r in known.groupBy("qr_label").count().collect()}       # two rows at most
    total = sum(count.values())
    share = count.get(1, 0) / total if total else 0.5
    if len(count) < 2:
        return Ranking(None, 0.0, share)
    parts = -(-total // BLOCK)
    dealt = known.withColumn("qr_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(parts)))
    blocks = stash(dealt.groupBy("qr_block").applyInArrow(_blocks, "label binary, x binary"), "pairs", files_for(total * DIMENSION // 64))

    def moments(row: dict) -> np.ndarray:
        x = _rows(row)[1]
        return np.concatenate([[len(x)], x.sum(0), (x * x).sum(0)])

    sums = summed(blocks, moments, 1 + 2 * DIMENSION)
    centre = sums[1:1 + DIMENSION] / sums[0]
    spread = np.sqrt(np.maximum(sums[1 + DIMENSION:] / sums[0] - centre ** 2, 0))
    scale = np.where(spread > 1e-4, spread, np.inf)         # a feature that never changes says nothing
    w, pairs, loss = newton(blocks, centre, scale, ridge)
    if not pairs:
        return Ranking(None, 0.0, share)
    weights = w / scale
    placed = _with_strength(known, weights).select(F.expr(f"cast(round(qr_s * {GRID}) as bigint)").alias("s"))
    cut = placed.agg(F.percentile("s", 1 - share).alias("q")).first().q / GRID      # counts of whole numbers, combined map-side
    return Ranking(weights, cut, share, pairs, loss)


def score_quality(rows: DataFrame, ranking: Ranking) -> DataFrame:
    """``rows`` (with qr_x) plus qr_score, from 0 to 1 with the threshold at 0.5, and qr_predicted."""
    if ranking.weights is None:
        scored = rows.drop("qr_x").withColumn("qr_score", F.lit(float(ranking.share)))
    else:
        z = F.col("qr_s") - F.lit(float(ranking.threshold))
        scored = _with_strength(rows, ranking.weights).withColumn("qr_score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).drop("qr_s")
    return scored.withColumn("qr_predicted", F.expr("cast(qr_score >= 0.5 as int)"))


def quality_ranking(docs: DataFrame, labels: DataFrame, learnable: Column, key: str = "doc_id", text: str = "text",
                    label: str = "quality") -> DataFrame:
    """``docs`` without text, plus qr_score and qr_predicted, learned from the labels of the ``learnable`` rows."""
    docs = own(docs, "qr_")
    rows = stash(with_features(docs.withColumn("qr_learn", F.coalesce(learnable, F.lit(False))), text), "features")
    ranking = learn_ranking(rows.where("qr_learn").select(key, "qr_x"), labels, key, label)
    return score_quality(rows.drop("qr_learn"), ranking)
