import collections
import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldstack.llm import line_dedup as L
from fieldstack.llm.common import flat, line_spans
from fieldstack.llm.queries import op10_line_dedup

WS = " \t\n\v\f\r"


def brute(rows, min_chars=20, min_docs=3):
    key = lambda l: "".join(c.lower() if "A" <= c <= "Z" else c for c in l.strip(WS))
    held = collections.defaultdict(set)
    for d, t, *_ in rows:
        for l in (t or "").split("\n"):
            if d is not None and len(key(l)) >= min_chars:
                held[key(l)].add(d)
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [l for l in lines if d is None or len(held[key(l)]) < min_docs or max(held[key(l)]) == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def run(make, rows, **kw):
    got = L.line_dedup(make(rows), **kw)
    assert got.columns.count("ld_dropped") == 1 and "key" in got.columns
    order = lambda r: tuple("" if x is None else str(x) for x in r)     # noqa: E731
    return sorted(((r.doc_id, r.ld_lines, r.ld_dropped, r.text or "") for r in got.collect()), key=order), order


A, B = "a line that stands in many documents", "another line, and long enough it is"


@pytest.mark.parametrize("rows", [
    [(i, f"{A}\nown {i}\n  {A.upper()}\t\n{B if i % 2 else 'b'}") for i in range(9)],
    [(1, A), (1, A), (2, A + "\n" + A), (3, None), (None, A), (4, ""), (5, A), (5, "short\n" + A)],     # repeats and nulls
    [(1, "x" * 19), (2, "x" * 19), (3, "x" * 19)], [(1, "é" * 20), (2, "É" * 20), (3, "é" * 20), (4, "é" * 20)],
    [(7, "\n".join([A] * 5000 + [B] * 300)), (8, A), (9, B + "\n" + A), (3, B)],                   # a long text
    [(1, None)], [],
])
def test_cases(make, rows):
    got, order = run(make, rows)
    assert got == sorted(brute(rows), key=order)


def test_documents_with_tiny_filter(make, documents):
    """The result does not depend on the filters' size."""
    got, order = run(make, documents[1], max_bits=1 << 15)
    assert got == sorted(brute(documents[1]), key=order)


def test_query(spark, documents):
    want = {d: (n, k, hashlib.sha256(t.encode()).hexdigest()) for d, n, k, t in brute(documents[1])}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in op10_line_dedup(spark, documents[0]).collect()} == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab\n \té")), max_size=6))
def test_line_spans(texts):
    import pyarrow as pa
    buf, offs = flat(pa.array(texts, pa.string()))
    starts, ends, text = line_spans(buf, offs)
    want = [(i, l) for i, t in enumerate(texts) for l in (t or "").split("\n")]
    assert [(int(i), buf[a:b].tobytes().decode()) for a, b, i in zip(starts, ends, text)] == want


def test_min_docs(make):
    with pytest.raises(ValueError):
        L.line_dedup(make([(1, A)]), min_docs=1)


def test_half_a_million_repeated_lines(make):
    """Time in proportion to the lines: three documents of 500,000 lines each, of 1,000 kinds; the last one keeps them."""
    import time
    kinds = [f"a line of more than twenty characters {i}" for i in range(1000)]
    text = "\n".join([*(kinds * 500), "short"])
    begun = time.time()
    got = {r.doc_id: (r.ld_lines, r.ld_dropped, len(r.text)) for r in L.line_dedup(make([(i, text) for i in range(3)])).collect()}
    assert got == {0: (500001, 500000, 5), 1: (500001, 500000, 5), 2: (500001, 0, len(text))}
    assert time.time() - begun < 90
