import collections
import zlib

import numpy as np

from fieldstack.llm import language_mixture as L
from fieldstack.llm.queries import op7_language_mixture


def test_held_out_accuracy(spark, documents):
    import duckdb
    lang = dict(duckdb.connect().execute(f"select doc_id, lang from '{documents[0]}/documents.parquet'").fetchall())
    rows = op7_language_mixture(spark, documents[0]).collect()
    assert len(rows) == len(lang)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    out = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in out]) >= 0.97
    assert all(0 <= r.score <= 1 and abs(sum(r.shares) - 1) < 1e-6 and r.langs[0] == r.lang_pred for r in rows if r.lang_pred != "und")


def profiles(spark, documents):
    rows = [(t, g) for _, t, g, _ in documents[1]] + [(None, "en"), ("text", None)]
    return L.learn_profiles(spark.createDataFrame(rows, "text string, lang string"))


def test_profiles_are_smoothed_counts_of_all_rows(spark, documents):
    got = profiles(spark, documents)
    want = collections.defaultdict(collections.Counter)
    for _, t, g, _ in documents[1]:
        want[g].update(L.trigrams([t])[0].tolist())
    assert got.languages == sorted(want)
    for k, name in enumerate(got.languages):
        c = np.full(L.BUCKETS, L.SMOOTH)
        for b, n in want[name].items():
            c[b] += n
        assert np.allclose(got.logp[k], np.log(c / c.sum()), atol=1e-5)


def brute_shares(model, text, inside, rounds):
    """Expectation-maximisation over words, one by one."""
    bucket, first, _ = L.trigrams([text])
    ends = list(first[1:]) + [len(bucket)]
    like = [[np.exp(float(model.logp[k][bucket[a:b]].astype(float).sum())) for k in inside] for a, b in zip(first, ends)]
    p = [1 / len(inside)] * len(inside)
    for _ in range(rounds):
        total = [0.0] * len(inside)
        for w in like:
            z = sum(x * y for x, y in zip(w, p))
            for k in range(len(inside)):
                total[k] += w[k] * p[k] / z
        p = [t / len(like) for t in total]
    return p


def test_mixtures(spark, make, documents):
    model = profiles(spark, documents)
    by = {g: next(t for _, t, x, _ in documents[1] if x == g and len(t) > 2500) for g in ("en", "de", "fr")}
    half = by["en"][:1500] + "\n" + by["de"][:1500]
    rows, share = L.infer(model, [by["fr"], None, half, "123"], 3, 2.0, 30)
    assert rows.tolist() == [0, 2] and share[0, model.languages.index("fr")] == 1
    en, de = model.languages.index("en"), model.languages.index("de")
    assert abs(share[1, en] - 0.5) < 0.12 and abs(share[1, en] + share[1, de] - 1) < 1e-9
    want = brute_shares(model, half, [en, de], 60)
    assert np.allclose([share[1, en], share[1, de]], want, atol=0.01)
    got = {r.doc_id: r for r in L.language_mixture(make([(0, by["fr"]), (1, half), (1, half)]), model).collect()}
    assert got[0].li_lang == "fr" and set(got[1].li_langs) == {"en", "de"}


def test_the_set_grows_with_the_likelihood(spark, make, documents):
    """Four languages in equal parts are all found; a stray word makes no language. The set is the best of all by brute force."""
    import itertools
    model = profiles(spark, documents)
    words = {g: " ".join(t for _, t, x, _ in documents[1] if x == g and t).split()[:400] for g in ("en", "de", "fr", "es")}
    four = " ".join(w for part in words.values() for w in part)
    rows, share = L.infer(model, [four, " ".join(words["de"][:60])], len(model.languages), 2.0, 30)
    assert (share[0] > 0.15).sum() == 4 and share[0].max() < 0.35
    got = L.language_mixture(make([(0, four)]), model).first()
    assert sorted(got.li_langs) == sorted(words) and got.li_score < 0.35
    # penalised likelihood of every set of languages, by plain iterations
    for i, text in enumerate((four, " ".join(words["de"][:60]))):
        bucket, first, _ = L.trigrams([text])
        logs = np.stack([np.add.reduceat(p[bucket], first) for p in model.logp], axis=1).astype(float)
        value = {}
        for size in range(1, len(model.languages) + 1):
            for chosen in itertools.combinations(range(len(model.languages)), size):
                like, s = np.exp(logs[:, chosen] - logs.max(axis=1, keepdims=True)), np.full(size, 1 / size)
                for _ in range(200):
                    joint = like * s
                    s = (joint / np.maximum(joint.sum(axis=1, keepdims=True), 1e-300)).mean(axis=0)
                value[chosen] = np.log(np.maximum(like @ s, 1e-300)).sum() - 2.0 * (size - 1) * np.log(len(first))
        assert set(np.flatnonzero(share[i])) == set(max(value, key=value.get))


def test_odd_rows(spark, make, documents):
    model = profiles(spark, documents)
    rows = [(1, None), (2, ""), (3, "12 + 3 = 15 !"), (4, "é"), (4, "é"), (None, "the and of the"), (5, "a " * 60000), (6, "\U0001F600\x00")]
    got = {(r.doc_id, r.text): (r.li_lang, r.li_score) for r in L.language_mixture(make(rows), model).collect()}
    assert [got[r][0] for r in rows[:3]] == ["und"] * 3 and got[(6, rows[-1][1])] == ("und", 0.0)
    assert got[(None, "the and of the")][0] == "en" and len(got) == 7
    none = L.learn_profiles(make([(1, None), (2, "x")]).select("text", "lang"))
    assert [r.li_lang for r in L.language_mixture(make([(1, "word")]), none).collect()] == ["und"]
    assert L.language_mixture(make([]), model).collect() == []
