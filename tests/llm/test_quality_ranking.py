"""Features by a plain count, Newton against gradient descent, held-out accuracy, odd rows."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldstack.llm import quality_ranking as Q
from fieldstack.llm.common import flat

TEXTS = ["", "one Two  three\nONE two three\n\nOne two three", "a", "x!! YY ## zü 12\tüü", "\n", "same same same same", "é" * 300 + " z"]


def plain(text):
    """Some of the features, by Python's own strings."""
    b = text.encode()
    words = [w for w in "".join(" " if c in " \t\n\v\f\r" else c for c in text).split(" ") if w]
    low = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in words]
    lines = [x.lower() if x.isascii() else x for x in text.split("\n")]
    count = Counter(low)
    share = lambda p, w: p / max(w, 1)      # noqa: E731
    upper = sum("A" <= c <= "Z" for c in text)
    lower = sum("a" <= c <= "z" for c in text)
    return {
        Q.KINDS + Q.SYMBOLS.index(ord("!")): math.log1p(100 * share(text.count("!"), len(b))),
        1: math.log1p(100 * share(upper, len(b))), 6: math.log1p(100 * share(sum(x > 127 for x in b), len(b))),
        -13: math.log1p(len(b)), -12: math.log1p(len(words)), -9: share(len(count), len(low)),
        -8: share(max(count.values(), default=0), len(low)), -6: share(len(lines) - len(set(lines)), len(lines)),
        -2: share(upper, upper + lower), -1: math.log1p(len(lines))}


def test_features():
    x = Q.features(*flat(pa.array(TEXTS)))
    assert x.shape == (len(TEXTS), Q.DIMENSION) and np.isfinite(x).all()
    for row, text in zip(x, TEXTS):
        for i, v in plain(text).items():
            assert row[i] == pytest.approx(v, abs=1e-6), (text, i)
    for i, text in enumerate(TEXTS):        # neighbours in a batch don't matter
        assert np.array_equal(Q.features(*flat(pa.array([text])))[0], x[i])
    assert Q.features(*flat(pa.array([], pa.string()))).shape == (0, Q.DIMENSION)


def test_pairs():
    label = np.array([1, 0, 1, 1, 0, 1, 1], dtype=np.int8)
    good, bad = Q.pair_up(label)
    assert (label[good] == 1).all() and (label[bad] == 0).all()
    assert set(Counter(good.tolist()).values()) == {2} and set(Counter(bad.tolist()).values()) == {5}
    assert len(set(zip(good.tolist(), bad.tolist()))) == 10
    assert all(len(x) == 0 for x in Q.pair_up(np.ones(4, dtype=np.int8)))
    many = np.r_[np.zeros(600), np.ones(9)].astype(np.int8)
    assert len(Q.pair_up(many)[0]) == 600 * Q.PAIRS


def docs_table(spark, rows):
    return spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, qr_x string, quality int").repartition(3)


def labels_table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int").select("doc_id", "quality")


def corpus(n, seed=0):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(rng.integers(5, 80))]
        rows.append((i, " ".join(w + "#%" for w in words) if i % 4 == 0 else " ".join(words)))
    return rows


def test_newton_minimises_the_loss(spark):
    """No smaller loss by gradient steps from its result; overlapping classes, so the minimum is inside."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((90, Q.DIMENSION)).astype(np.float32)
    label = (x[:, 0] + rng.standard_normal(90) > 0).astype(np.int8)
    blocks = spark.createDataFrame([(bytearray(label[i:i + 30].tobytes()), bytearray(x[i:i + 30].tobytes())) for i in (0, 30, 60)], "label binary, x binary")
    w, pairs, loss = Q.newton(blocks, np.zeros(Q.DIMENSION), np.ones(Q.DIMENSION), ridge=0.05)
    diff = []
    for i in (0, 30, 60):
        a, b = Q.pair_up(label[i:i + 30])
        diff.append(x[i:i + 30][a].astype(float) - x[i:i + 30][b])
    diff = np.concatenate(diff)
    value = lambda v: np.logaddexp(0, -diff @ v).mean() + 0.025 * v @ v      # noqa: E731
    slope = -(diff.T @ (1 / (1 + np.exp(diff @ w)))) / len(diff) + 0.05 * w
    assert pairs == len(diff) and loss == pytest.approx(value(w), abs=1e-9) and np.abs(slope).max() < 1e-3
    assert w[0] == max(w) and value(w) < value(np.zeros_like(w))


def test_learns_from_learnable_rows_alone(spark):
    """Held-out documents are told; wrong labels on them change nothing."""
    rows = corpus(240)
    held = F.col("doc_id") % 3 == 1
    out = []
    for flip in (False, True):
        labels = [(i, int(i % 4 > 0) ^ (flip and i % 3 == 1), 0) for i, _ in rows]
        got = Q.quality_ranking(docs_table(spark, rows), labels_table(spark, labels), ~held)
        out.append(sorted((r.doc_id, r.qr_score, r.qr_predicted) for r in got.collect()))
    assert [(i, p) for i, _, p in out[0]] == [(i, p) for i, _, p in out[1]] == [(i, int(i % 4 > 0)) for i, _ in rows]
    assert all(0 <= s <= 1 and p == (s >= 0.5) for _, s, p in out[0])


def test_odd_rows(spark):
    """Null and empty texts, null and repeated ids, disagreeing and null labels, a text of two million characters."""
    rows = corpus(60) + [(60, None), (61, ""), (None, "abc def"), (5, "b c"), (5, "b c"), (62, "ab " * 700_000)]
    labels = [(i, int(i % 4 > 0), 0) for i in range(60)] + [(61, 1, 0), (61, 0, 0), (None, 0, 1), (7, None, 0), (9, 2, 0), (999, 0, 0), (8, 0, 1)]
    got = Q.quality_ranking(docs_table(spark, rows), labels_table(spark, labels), F.lit(True)).collect()
    assert len(got) == len(rows) and all(0 <= r.qr_score <= 1 for r in got)
    by = {r.doc_id: r.qr_score for r in got}
    assert by[60] == by[61]
    assert "text" not in got[0].asDict() and got[0].quality == 3


def test_one_class_no_label_no_rows(spark):
    rows = corpus(8)
    for labels, want in (([(1, 1, 0)], 1.0), ([(1, 0, 0)], 0.0), ([], 0.5)):
        got = Q.quality_ranking(docs_table(spark, rows), labels_table(spark, labels), F.lit(True)).collect()
        assert {r.qr_score for r in got} == {want} and len(got) == 8
    assert Q.quality_ranking(docs_table(spark, []), labels_table(spark, []), F.lit(True)).collect() == []


def test_held_out_accuracy(spark, documents):
    from fieldstack.llm.queries import op13_quality_ranking
    import duckdb
    truth = dict(duckdb.sql(f"select doc_id, quality from '{documents[0]}/labels.parquet'").fetchall())
    got = op13_quality_ranking(spark, documents[0]).collect()
    assert len(got) == len(documents[1])
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    told = [r.predicted == truth[r.doc_id] for r in got if r.held_out and r.doc_id in truth]
    assert np.mean(told) >= 0.95
