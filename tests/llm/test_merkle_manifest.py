"""Hash trees and proofs against a plain tree in Python."""

import hashlib

import pytest
from pyspark.sql import functions as F

from fieldstack.llm import merkle_manifest as M

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(level):
    """(top, for each node its steps (before, after) from the bottom up)."""
    steps = [[] for _ in level]
    where = list(range(len(level)))
    while len(level) > 1:
        runs = [level[i:i + 3] for i in range(0, len(level), 3)]
        for n, at in enumerate(where):
            run, k = runs[at // 3], at % 3
            steps[n].append(("".join(run[:k]), "".join(run[k + 1:])))
        where = [at // 3 for at in where]
        level = [h(*run) for run in runs]
    return level[0], steps


def manifest(rows):
    """Sorted (doc_id, source, leaf, subroot, root, path) by brute force."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    tops, inner = [], {}
    for s in names:
        own = sorted(((r[0], leaf(r)) for r in groups[s]), key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        top, steps = tree([x[1] for x in own])
        tops.append(top)
        inner[s] = (own, top, steps)
    root, over = tree(tops)
    return sorted((repr(d), repr(s), x, inner[s][1], root, path + over[g])
                  for g, s in enumerate(names) for (d, x), path in zip(inner[s][0], inner[s][2]))


def got(df):
    return sorted((repr(r.doc_id), repr(r.source), r.mk_leaf, r.mk_subroot, r.mk_root, [tuple(s) for s in r.mk_path]) for r in df.collect())


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 7, "y") for r in rows],
                                 "doc_id long, source string, lang string, n_chars long, text string, mk_g string, d int, at string")


SIZES = {None: 4, "": 1, "a": 1, "b": 2, "c": 3, "d": 10, "é": 28, "Z": 95}


@pytest.mark.parametrize("digits", [1, 2, 6])
def test_against_a_plain_tree(spark, monkeypatch, digits):
    """Trees of one row to several tiers (with few digits), in any order of rows."""
    monkeypatch.setattr(M, "DIGITS", digits)
    rows = [(1000 * n - 7 * i, s, None if i % 5 == 0 else "de", i, f"text {i}\nline ü" if i % 4 else None)
            for n, (s, k) in enumerate(SIZES.items()) for i in range(k)]
    df = table(spark, rows[::-1]).repartition(5)
    out = M.merkle_manifest(df, FIELDS)
    assert got(out) == manifest(rows)
    assert out.where(M.fold(F.col("mk_leaf"), F.col("mk_path")) != F.col("mk_root")).count() == 0


def test_odd_rows(spark):
    """Null ids, equal ids, equal rows, empty texts, a text of two million characters; null is not empty."""
    rows = [(None, "s", None, None, None), (None, "s", None, None, ""), (5, "s", "l", 0, "x"), (5, "s", "l", 0, "x"),
            (5, "s", "l", 0, "y"), (9, None, "l", 0, "ab " * 700_000), (-3, None, "", 1, "-")]
    assert got(M.merkle_manifest(table(spark, rows), FIELDS)) == manifest(rows)
    assert len({leaf(r) for r in rows}) == 6


def test_empty_table(spark):
    out = M.merkle_manifest(table(spark, []), FIELDS)
    assert out.collect() == [] and "mk_root" in out.columns


def test_one_row(spark):
    row = M.merkle_manifest(table(spark, [(1, "s", "l", 1, "t")]), FIELDS).first()
    assert row.mk_leaf == row.mk_subroot == row.mk_root == leaf((1, "s", "l", 1, "t")) and row.mk_path == []


def test_changes_are_seen(spark):
    """A changed text, or two fields with a shifted border, lead to another root."""
    rows = [(i, "s", "ab", 1, "c\nd") for i in range(5)]
    df = table(spark, rows)
    out = M.merkle_manifest(df, FIELDS, carry={"other": M.leaf_digest([F.when(F.col("doc_id") == 3, F.lit("cd")).otherwise(F.col(f))
                                                                       if f == "text" else F.col(f) for f in FIELDS])})
    bad = out.where(M.fold(F.col("other"), F.col("mk_path")) != F.col("mk_root"))
    assert [r.doc_id for r in bad.collect()] == [3]
    assert leaf((1, "s", "ab", 1, "c")) != leaf((1, "s", "a", 1, "bc"))


def test_group_of_equal_ids_is_spread(spark):
    """A hot group: its ranks are those of one sorted list, over many partitions."""
    rows = [(i // 2, "hot" if i % 3 else "s", "l", i % 2, "t") for i in range(4000)]
    out = M.merkle_manifest(table(spark, rows).repartition(16), FIELDS)
    assert got(out) == manifest(rows)
