import collections
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from fieldstack.llm import minhash_dedup as M
from fieldstack.llm.common import flat
from fieldstack.llm.queries import op4_minhash

WORD = re.compile("[^\x20\x09-\x0D]+")


def shingles(t, k):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    return frozenset(zip(*(w[i:] for i in range(k)))) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, k=2, percent=80):
    sets = [(d, shingles(t, k)) for d, t, *_ in rows]
    up = {d: d for d, _ in sets if d is not None}

    def top(x):
        while up[x] != x:
            x = up[x]
        return x
    where = collections.defaultdict(list)
    for i, (d, s) in enumerate(sets):
        for x in s if d is not None else ():
            where[x].append(i)
    both = collections.Counter(p for at in where.values() for p in itertools.combinations(at, 2))
    for (i, j), n in both.items():
        if 100 * n >= percent * (len(sets[i][1]) + len(sets[j][1]) - n):
            a, b = top(sets[i][0]), top(sets[j][0])
            up[max(a, b)] = min(a, b)
    return [(d, len(s), None if d is None else top(d), d is None or top(d) == d) for d, s in sets]


def run(make, rows, **kw):
    order = lambda r: tuple(-1 if x is None else x for x in r)      # noqa: E731
    got = sorted((tuple(r) for r in M.near_duplicates(make(rows), **kw).collect()), key=order)
    return got, order


def family(seed, n, edits, words=60, base=1000):
    rnd = random.Random(seed)
    text = [f"w{rnd.randrange(10 ** 6)}" for _ in range(words)]
    out = []
    for i in range(n):
        t = list(text)
        for _ in range(rnd.randrange(edits + 1)):
            t[rnd.randrange(words)] = f"e{rnd.randrange(10 ** 6)}"
        out.append((base + i, " ".join(t)))
    rnd.shuffle(out)
    return out


@pytest.mark.parametrize("rows", [
    family(1, 40, 4) + family(2, 40, 9, base=5000) + family(3, 12, 1, words=9, base=9000),
    [(3, "A b"), (2, "a B"), (9, "a b"), (1, None), (4, ""), (5, " \n"), (6, "one"), (7, "ONE"), (8, "one one"), (None, "a b"), (3, "A b")],
    [(1, "a b c d e"), (2, "a b c d e f"), (3, "b c d e f"), (1, "x y z"), (11, "x y z"), (12, "a b c d e")],      # one doc_id, two texts
    [(1, "same " * 30000), (2, "same " * 10), (3, "same same")], [(1, None)], [],
])
def test_cases(make, rows):
    got, order = run(make, rows, shingle=2)
    assert got == sorted(brute(rows), key=order)


def test_five_word_shingles(make):
    rows = family(4, 30, 3, words=120)
    got, order = run(make, rows)
    assert got == sorted(brute(rows, 5), key=order)


def test_query(spark, documents):
    got = sorted(tuple(r) for r in op4_minhash(spark, documents[0]).collect())
    assert got == sorted(brute(documents[1]))


def test_densified_signatures_estimate_similarity():
    """Bins of small sets agree as often as the sets are similar."""
    probe = M._probe_table(200)
    rnd, error = random.Random(5), []
    for n in (6, 20, 300):
        for _ in range(30):
            core = [f"c{rnd.random()}" for _ in range(n)]
            texts = [" ".join(core + [f"x{rnd.random()}" for _ in range(n // 3)]) for _ in range(2)]
            h, o = M.shingle_sets(*flat(pa.array(texts)), 1)
            a, b = (set(h[x:y].tolist()) for x, y in zip(o[:-1], o[1:]))
            sig = M.signatures(h, o, 200, probe)
            error.append((sig[0] == sig[1]).mean() - len(a & b) / len(a | b))
    assert abs(np.mean(error)) < 0.02 and np.std(error) < 0.12


def test_components(spark):
    edges = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 150), (150, 120), (7, 7)]
    nodes = spark.createDataFrame([(i,) for i in {x for e in edges for x in e} | {500}], "node long")
    got = {r.node: r.comp for r in M.components(nodes, spark.createDataFrame(edges, "x long, y long")).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 200: 100, 150: 100, 120: 100, 500: 500}


def test_long_patterned_words_differ(make):
    """Thue-Morse words of 1,024 letters, whose polynomial hashes modulo 2^64 agree for any odd base: 2 common shingles of 6 are no link."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"one two three {word} four"), (2, f"one two three {other} four"), (3, f"one TWO three {word.upper()} four")]
    got, _ = run(make, rows, shingle=2)
    assert [(r[0], r[2]) for r in got] == [(1, 1), (2, 2), (3, 1)]


@pytest.mark.parametrize("n", range(4, 15))
def test_tiny_links_share_a_subset(n):
    """Every linked pair of tiny sets has a bucket in common: random pairs for each size, as unlike as a link lets them be."""
    rng = np.random.default_rng(n)
    m, trials = 14, 20000 if n < 10 else 500
    for lone_x, lone_y in itertools.product(range(3), repeat=2):
        both = n - lone_x
        if both < 1 or both + lone_y > m or 100 * both < 80 * (both + lone_x + lone_y):
            continue
        pool = rng.integers(1, 2 ** 63, (trials, both + lone_x + lone_y), dtype=np.int64).astype(np.uint64)
        x, y = np.sort(pool[:, :both + lone_x], axis=1), np.sort(np.delete(pool, np.s_[both:both + lone_x], axis=1), axis=1)
        sets = [(s.ravel(), np.arange(0, s.size + 1, s.shape[1])) for s in (x, y)]
        (kx, ox), (ky, oy) = (M.subset_keys(h, o, 80) for h, o in sets)
        with np.errstate(over="ignore"):        # a key and its pair as one number
            kx, ky = (k * np.uint64(2 ** 20 + 1) + o.astype(np.uint64) for k, o in ((kx, ox), (ky, oy)))
        assert len(np.unique(ox[np.isin(kx, ky)])) == trials


def test_tiny_documents_are_linked(make):
    rnd = random.Random(4)
    rows = []
    for i in range(400):
        w = [f"w{rnd.randrange(10 ** 9)}" for _ in range(rnd.randrange(5, 14))]
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join([*w, f"x{i}"]))]
    got, order = run(make, rows, shingle=2)
    assert got == sorted(brute(rows), key=order) and sum(not r[3] for r in got) == 400
