import collections
import re

import numpy as np

from fieldstack.llm import quality_mcd as Q

WORD = re.compile("[^\x20\x09-\x0D]+")


def brute(t):
    t = t or ""
    w, n = WORD.findall(t), len(WORD.findall(t))
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    cover = {i + j for i in range(n - 2) if seen[tuple(w[i:i + 3])] > 1 for j in range(3)}
    lines = [l for l in t.split("\n") if WORD.search(l)]
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(cover))


def test_base_statistics(make, documents):
    odd = [(-1, None), (-2, ""), (-3, " \n\t"), (-4, "a b c a b c"), (-5, "\n\na\n a\na\f\v"), (-6, "x " * 20000), (-7, "a\u00a0b é\u2028c"),
           (-8, "a b c d"), (-8, "a b c d"), (-9, "f f\\t $<>"), (-10, "a a a"), (-11, "a a a a"), (None, "f\u000cf")]
    rows = [*odd, *((d, t) for d, t, *_ in documents[1])]
    got = Q.quality_rules(make(rows)).collect()
    want = sorted((d is None, d or 0, *brute(t)) for d, t in rows)
    assert sorted((r.doc_id is None, r.doc_id or 0, *(r[c] for c in Q.STATS)) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def brute_mcd(x, h=0.75, steps=3):
    """The same estimate with numpy: two starts, concentration, the smaller determinant."""
    floors = np.diag((np.array(Q.FLOORS) * Q.SCALE) ** 2)
    mad = np.median(np.abs(x - np.median(x, axis=0)), axis=0)
    starts = [(x.mean(axis=0), np.cov(x.T, bias=True)), (np.median(x, axis=0), np.diag((1.4826 * mad) ** 2))]
    dist = lambda m, c: np.einsum("ij,jk,ik->i", x - m, np.linalg.inv(c + floors), x - m)      # noqa: E731
    best = None
    for m, c in starts:
        for _ in range(steps):
            rank = np.round(32 * np.log2(1 + dist(m, c)))
            near = x[rank <= np.quantile(rank, h)]
            m, c = near.mean(axis=0), np.cov(near.T, bias=True)
        det = np.linalg.slogdet(c + floors)[1]
        if best is None or det < best[0]:
            best = (det, dist(m, c))
    d2 = best[1]
    scale = max(1.0, (2 ** (np.median(np.round(32 * np.log2(1 + d2))) / 32) - 1) / Q.CHI2_MEDIAN)
    return d2 / scale


def test_estimates_against_numpy(make):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(160):
        words = ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(int(rng.integers(60, 400)))]
        if i % 16 == 0:
            words = [w + "###$$" for w in words]
        rows.append((i, " ".join(words), "en" if i % 2 else None, "s"))
    got = {r.doc_id: r for r in Q.quality_rules(make(rows)).collect()}
    for lang in (0, 1):
        ids = [i for i in range(160) if i % 2 == lang]
        s = np.array([[float(v) for v in (*brute(rows[i][1]), 1)] for i in ids])
        x = np.round(Q.SCALE * np.log1p(np.stack([s[:, 0], s[:, 1] / s[:, 0], 100 * s[:, 2] / s[:, 1], 100 * s[:, 3] / s[:, 5],
                                                  100 * s[:, 4] / s[:, 0]], axis=1)))
        want = brute_mcd(x)
        assert np.allclose([got[i].distance2 for i in ids], want, rtol=1e-6)
    junk = {i for i in range(160) if i % 16 == 0}
    assert {i for i, r in got.items() if not r.kept} == junk


def test_small_groups_use_their_language_or_all(make):
    rows = [(i, " ".join(f"w{j * i % 97}x{j}" for j in range(80)), "en", f"s{i}") for i in range(60)] + [(99, "word " * 10 + "a b", None, None)]
    got = Q.quality_rules(make(rows)).collect()
    assert len(got) == 61 and sum(r.kept for r in got) == 60


def test_empty(make):
    assert Q.quality_rules(make([])).collect() == []


def test_windows_of_long_texts_repeat_by_all_of_their_hash(make):
    """Two pairs of windows whose 64-bit hashes agree in the first 46 bits, in texts of 140,000 words; and a pair that does repeat."""
    filler = " ".join(f"f{i}" for i in range(140000))
    texts = [f"x w612437 y {filler} x w8385850 y", f"x w6352480 y {filler} x w23530694 y", f"x w612437 y {filler} x w612437 y"]
    got = {r.doc_id: r for r in Q.text_statistics(make(list(enumerate(texts)))).collect()}
    assert [tuple(got[i][c] for c in Q.STATS) for i in range(3)] == [brute(t) for t in texts]
    assert [got[i].n_repeat_words for i in range(3)] == [0, 0, 6]


def test_symbols_go_boilerplate_stays(make):
    """Texts with 12 to 30 symbols for 100 characters of words go; clean ones with a third of their lines twice, and such with a
    stray symbol, stay."""
    rng = np.random.default_rng(7)

    def words(n):
        return ["".join(rng.choice(list("abcdefghij"), rng.integers(2, 9))) for _ in range(n)]

    rows, junk = [], set()
    for i in range(300):
        w = words(int(rng.integers(150, 400)))
        if i % 20 == 0:
            share = (12, 19, 23, 30)[i // 20 % 4] / 100
            w = [x + "#" * int(rng.random() < share * len(x) / (1 - share)) for x in w]
            while 100 * sum(x.count("#") for x in w) < 100 * share * sum(map(len, w)):
                w[int(rng.integers(len(w)))] += "#"
            junk.add(i)
        text = "\n".join(" ".join(w[k:k + 15]) for k in range(0, len(w), 15))
        if i % 20 == 1:         # the last third of the lines again, as footers are
            lines = text.split("\n")
            text = "\n".join(lines + lines[-(len(lines) // 3):])
        if i % 20 == 2:
            text += " 50% & more"
        rows.append((i, text, "en", "s"))
    assert {r.doc_id for r in Q.quality_rules(make(rows)).collect() if not r.kept} == junk
