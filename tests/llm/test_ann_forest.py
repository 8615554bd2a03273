import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from fieldstack.llm.ann_forest import _range, forest_search, hash_strings
from fieldstack.llm.queries import op5_ann_forest


def exact(ids, x, q, k=20):
    s = (x * x[q]).sum(axis=1)
    at = np.flatnonzero(ids != ids[q])
    return [(int(ids[i]), s[i]) for i in at[np.lexsort((ids[at], -s[at]))][:k]]


def test_recall_and_order(spark, documents):
    import duckdb
    rows = duckdb.connect().execute(f"select vec_id, embedding from '{documents[0]}/embeddings.parquet'").fetchall()
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=float)
    got = {}
    for r in op5_ann_forest(spark, documents[0]).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(ids[ids % 20 == 0].tolist())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in exact(ids, x, int(np.flatnonzero(ids == q)[0]))}) for q in got)
    assert hits >= 0.9 * 20 * len(got)
    for q, found in got.items():
        score = dict(exact(ids, x, int(np.flatnonzero(ids == q)[0]), len(ids)))
        assert len(found) == 20 and all(s == score[i] for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))


def test_short_ranges_still_recall_clusters(spark):
    """Clustered vectors: a fortieth of the rows as candidates; small blocks, so that every step crosses blocks."""
    rng = np.random.default_rng(3)
    centre = rng.standard_normal((50, 32))
    x = np.round((centre[np.arange(2000) % 50] + 0.15 * rng.standard_normal((2000, 32))), 3).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    got = forest_search(df, F.col("vec_id") % 50 == 0, k=10, trees=12, candidates=(50, 0.05), block=300, query_block=16).collect()
    hits = sum(r.vec_id in {i for i, _ in exact(np.arange(2000), x, r.query_id, 10)} for r in got)
    assert len(got) == 400 and hits >= 360


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [1.0, 0.0]), (2, [1.0, 0.0]), (1, [0.5, 0.5]), (4, None), (5, [0.0, 0.0]), (6, [nan, 1.0]),
            (7, [inf, 1.0]), (8, [None, 1.0]), (9, []), (None, [1.0, 1.0]), (40, [1.0, 2.0, 3.0]), (3, [1.0, 0.0]), (60, [0.0, 0.0])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<float>, dim int, q int")
    got = [tuple(r) for r in forest_search(df, F.col("vec_id") % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2, 1.0), (0, 2, 3, 1.0), (0, 3, 20, 1.0), (0, 4, 1, 0.5),
                   (20, 1, 0, 1.0), (20, 2, 2, 1.0), (20, 3, 3, 1.0), (20, 4, 1, 0.5)]
    assert forest_search(df.limit(0), F.lit(True)).collect() == []


@pytest.mark.parametrize("drop", [0, 1, 5, 16])
def test_ranges_are_shared_prefixes(drop):
    keys = np.sort(hash_strings(np.random.default_rng(0).standard_normal((500, 8)), 2, 16, 1)[0])
    lo, hi = _range(keys, keys[::50], drop)
    for a, b, key in zip(lo, hi, keys[::50]):
        assert set(range(a, b)) == {i for i, k in enumerate(keys) if int(k) >> drop == int(key) >> drop}


@pytest.mark.parametrize("n", [3000, 8000])
@pytest.mark.parametrize("lengths", ["one", "lognormal", "few ten times longer", "one a million times longer"])
def test_recall_on_unequal_lengths(spark, n, lengths):
    """Unrelated directions. Sizes above those at which the least number of candidates is a larger share."""
    rng = np.random.default_rng(4)
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x *= {"one": np.ones((n, 1)), "lognormal": rng.lognormal(0, 1, (n, 1)), "few ten times longer": np.where(rng.random((n, 1)) < 0.01, 10, 1),
          "one a million times longer": np.where(np.arange(n) == 7, 1e6, 1)[:, None]}[lengths]
    df = spark.createDataFrame(pd.DataFrame({"vec_id": np.arange(n), "embedding": x.tolist()}), "vec_id long, embedding array<double>")
    got = forest_search(df, F.col("vec_id") % (n // 40) == 0, k=20).collect()
    asked = {r.query_id for r in got}
    want = {q: {i for i, _ in exact(np.arange(n), x, q)} for q in asked}
    hits = sum(r.vec_id in want[r.query_id] for r in got)
    assert len(asked) >= 40 and hits >= 0.95 * 20 * len(asked)
