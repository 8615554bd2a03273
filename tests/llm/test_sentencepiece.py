import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldstack.llm import sentencepiece_unigram as S
from fieldstack.llm.common import flat


@pytest.fixture(scope="module")
def vocab():
    return S.load_vocabulary()


@pytest.fixture(scope="module")
def trie(vocab):
    return S.build_trie({p: i for i, p in enumerate(vocab.pieces) if vocab.normal[i] and p})


def encode(vocab, trie, texts):
    ids, offs = S.Encoder(vocab, trie).encode(*flat(pa.array(texts, pa.string())))
    return [ids[a:b].tolist() for a, b in zip(offs[:-1], offs[1:])]


def brute(vocab, text):
    """Best path over the characters of a whole text, without trie or chunks: (score, ids)."""
    if not text:
        return 0.0, []
    score = {p.decode(): (vocab.scores[i], i) for i, p in enumerate(vocab.pieces) if vocab.normal[i] and p}
    t = " " + text
    best = [(0.0, [])] + [None] * len(t)
    for i in range(len(t)):
        options = [(i + k, *score[t[i:i + k]]) for k in range(1, 17) if t[i:i + k] in score and i + k <= len(t)]
        if not any(j == i + 1 for j, *_ in options):
            options.append((i + 1, vocab.unk_score, None))
        for j, s, ident in options:
            got = best[i][0] + s
            if best[j] is None or got > best[j][0]:
                best[j] = (got, best[i][1] + ([ident] if ident is not None else [int(vocab.byte_ids[b]) for b in t[i:j].encode()]))
    return best[-1]


TEXTS = ["", " ", "  a  bﬁ\n\tx  ", "▁x ▁", "梦" * 60, "x" * 200, "\n", "\n\n a", "a b", "Grüße, naïve café", "\x00\x01", "🙂🙂 🙂", "unbelievable" * 9]


def test_best_path_and_round_trip(vocab, trie, documents):
    texts = TEXTS + [t for _, t, *_ in documents[1] if t and len(t) < 3000][:60]
    got = encode(vocab, trie, texts)
    for t, ids in zip(texts, got):
        score, want = brute(vocab, t)
        spent = sum(vocab.scores[i] for i in ids if vocab.normal[i])
        spent += sum(vocab.unk_score for c in t if not any(c.encode() in p for p, n in zip(vocab.pieces, vocab.normal) if n))
        assert ids == want or abs(spent - score) < 1e-6
        assert S.decode_ids(vocab, ids) == t


def test_against_the_library(vocab, trie, documents):
    """The library, told that the ranks are unigram scores, never finds a better path for a word."""
    import sentencepiece
    raw = open(S.VOCABULARY, "rb").read()
    assert raw.count(b"tok_v0\x18\x02") == 1        # the model type in the file's trainer settings
    library = sentencepiece.SentencePieceProcessor(model_proto=raw.replace(b"tok_v0\x18\x02", b"tok_v0\x18\x01"))
    ranks = S.load_vocabulary(zipf=False)
    words = sorted({w for _, t, *_ in documents[1] for w in (t or "").split()})
    ours = encode(ranks, trie, words)
    theirs = library.encode(words)
    cost = lambda ids: sum(ranks.scores[i] for i in ids)        # noqa: E731
    assert all(cost(a) >= cost(b) for a, b in zip(ours, theirs))
    assert np.mean([a == b for a, b in zip(ours, theirs)]) > 0.99


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=80), max_size=5))
def test_round_trip_of_any_text(vocab, trie, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert [S.decode_ids(vocab, x) for x in encode(vocab, trie, texts)] == texts


def test_lanes_equal_single(vocab, trie, documents):
    e = S.Encoder(vocab, trie)
    e.encode(*flat(pa.array([t for _, t, *_ in documents[1]])))
    for c, (lo, n) in list(e.known.items())[:4000]:
        assert e.ids[lo:lo + n].tolist() == e._one(c)[0].tolist()


def test_memory_is_bounded(vocab, trie, monkeypatch):
    monkeypatch.setattr(S, "REMEMBER", 50)
    e = S.Encoder(vocab, trie)
    for k in range(20):
        e.encode(*flat(pa.array([f"word{i * k} x{i}" for i in range(20)])))
    assert len(e.known) <= 50


def test_operator(spark, make, vocab, documents):
    rows = [(1, None), (2, ""), (2, "two rows"), (2, "two rows"), (None, "x"), (3, "long " * 20000)] + [(d, t) for d, t, *_ in documents[1]]
    out = S.decode(S.encode(make(rows), vocab), vocab).collect()
    assert len(out) == len(rows) and all(r.decoded == r.text for r in out)
    assert all((r.token_ids is None) == (r.text is None) for r in out)
    both = S.encode(make(rows), vocab, check="exact").collect()
    assert all(r.exact is (None if r.text is None else True) for r in both)
    assert sorted(map(str, ((r.doc_id, r.token_ids) for r in both))) == sorted(map(str, ((r.doc_id, r.token_ids) for r in out)))
    assert S.encode(make([]), vocab, check="exact").collect() == []
    ids = spark.createDataFrame([([1, 31999, -4, 99999999, None, 258],)], "token_ids array<int>")
    assert S.decode(ids, vocab).first().decoded == "梦�"
