import collections
import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldstack.llm import suffix_dedup as S
from fieldstack.llm.queries import op6_suffix_dedup


def brute(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = collections.Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = np.zeros(len(b), dtype=bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        spans = int(np.diff(np.concatenate([[0], gone.astype(int)])).clip(0).sum())
        out.append((len(b), int(gone.sum()), spans, bytes(np.frombuffer(b, dtype=np.uint8)[~gone])))
    return out


def run(make, texts, **kw):
    rows = S.suffix_dedup(make(list(enumerate(texts))), **kw).collect()
    return [(r.sd_bytes, r.sd_removed, len(r.sd_spans), bytes(r.sd_kept)) for r in sorted(rows, key=lambda r: r.doc_id)]


def noise(rnd, n):
    return "".join(rnd.choice("abcdefghé \n") for _ in range(n))


def corpus(seed):
    rnd = random.Random(seed)
    passage = noise(rnd, 150)
    texts = [noise(rnd, rnd.randrange(300)) + passage[rnd.randrange(60):rnd.randrange(60, 150)] + noise(rnd, rnd.randrange(200)) for _ in range(40)]
    texts += [passage, passage, "", None, "ab" * 200, "x" * 500, "x" * 39, noise(rnd, 3000), passage + passage]
    for t in texts[:6]:
        texts.append(t[:80] + "Z" + t[81:])
    return texts


@pytest.mark.parametrize("max_tiles", [256, 1])
def test_cases(make, max_tiles, monkeypatch):
    """Once with all groups in buckets, once with all of them dealt out by windows."""
    texts = corpus(max_tiles)
    assert run(make, texts, length=40, gram=20, max_tiles=max_tiles) == brute(texts, 40)


def test_null_and_empty(make):
    assert run(make, [None, "", "short"]) == brute([None, "", "short"], 400) and run(make, []) == []


def test_long_texts_in_pieces():
    rnd = np.random.default_rng(0)
    buf = rnd.integers(97, 100, 30_000).astype(np.uint8)
    whole = S.tiles(buf, np.array([0, len(buf)]), 40, 20)
    want = {(int(g), int(u) + i) for g, u, n in zip(whole[0], whole[2], whole[3]) for i in range(n)}
    got = set()
    for lo in range(0, len(buf) - 39, 7000):
        part = buf[lo:lo + 7000 + 39]
        t = S.tiles(part, np.array([0, len(part)]), 40, 20)
        got |= {(int(g), int(u) + lo + i) for g, u, n in zip(t[0], t[2], t[3]) for i in range(n)}
    assert got == want and len(want) == len(buf) - 39


def test_equal_windows_are_in_one_group_at_one_distance():
    rnd = np.random.default_rng(1)
    same = rnd.integers(97, 123, 60).astype(np.uint8)
    bufs = [np.concatenate([rnd.integers(97, 123, k).astype(np.uint8), same, rnd.integers(97, 123, 50).astype(np.uint8)]) for k in (0, 13, 77)]
    seen = []
    for k, b in zip((0, 13, 77), bufs):
        g, _, u, n, dist, _ = S.tiles(b, np.array([0, len(b)]), 40, 20)
        seen.append({(w - k, int(g[i]), int(dist[i] - (w - u[i]))) for i in range(len(g)) for w in range(u[i], u[i] + n[i]) if k <= w <= k + 20})
    assert len(seen[0]) == 21 and seen[0] == seen[1] == seen[2]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 3), max_size=60))
def test_suffix_array(s):
    assert S.suffix_array(np.array(s, dtype=np.int64)).tolist() == sorted(range(len(s)), key=lambda i: s[i:])


@pytest.mark.parametrize("n", [1000, 1001, 1002])
def test_suffix_array_of_periodic_text(n):
    s = np.tile([2, 1, 2, 2], 300)[:n]
    assert S.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


def test_query(spark, documents):
    want = {d: (*b[:3], hashlib.sha256(b[3]).hexdigest()) for (d, *_), b in zip(documents[1], brute([r[1] for r in documents[1]], 400))}
    assert {r[0]: tuple(r)[1:] for r in op6_suffix_dedup(spark, documents[0]).collect()} == want


def test_planted_passages(make):
    """Passages of over 50 words in two documents each: those of 400 bytes go from both, shorter ones stay; clean documents stay."""
    rnd = random.Random(5)
    words = lambda n, size: " ".join("".join(rnd.choice("abcdefghij") for _ in range(size)) for _ in range(n))     # noqa: E731
    texts, want = [], []
    for count, size in ((51, 7), (51, 6), (64, 5), (51, 8), (80, 6), (200, 4)):
        passage = words(count, size)
        for _ in range(2):
            before, after = words(rnd.randrange(1, 90), 5), words(rnd.randrange(1, 90), 5)
            texts.append(f"{before}|{passage}|{after}")
            want.append(len(passage) if len(passage) >= 400 else 0)
    texts += [words(rnd.randrange(60, 300), 5) for _ in range(12)]
    got = [r[1] for r in run(make, texts)]
    near = [0 <= g - w <= 4 for g, w in zip(got, want)]      # the bars and what else the neighbours share by chance
    assert all(near) and sum(w > 0 for w in want) == 8 and got[len(want):] == [0] * 12 and run(make, texts) == brute(texts, 400)
