import collections
import math

import pytest

from fieldstack.llm import mixing as X
from fieldstack.llm.queries import op8_temperature_mix


def rows_of(sizes, words=7):
    out, d = [], 0
    for s, n in sizes.items():
        for _ in range(n):
            out.append((d, " ".join(f"w{d}x{j}" for j in range(words + d % 5)), None, s))
            d += 1
    return out


def shown(df):
    seen = collections.defaultdict(lambda: collections.defaultdict(int))
    docs = collections.defaultdict(collections.Counter)
    for r in df.collect():
        seen[r.source][r.mx_epoch] += r.mx_tokens
        docs[r.doc_id][r.mx_epoch] += 1
    return seen, docs


def test_solve_meets_targets():
    tokens = {"a": 900, "b": 90, "c": 10, None: 30}
    m = X.solve(tokens, repetition=3.0)
    epochs = {s: m.epochs[s] + m.rest[s] / tokens[s] for s in tokens}
    assert epochs["a"] == 1 and abs(max(epochs.values()) - 3) < 0.11 and min(epochs.values()) >= 1
    shares = {s: t / 1030 for s, t in tokens.items()}
    raw = {s: p ** m.exponent for s, p in shares.items()}
    assert all(math.isclose(m.weights[s], raw[s] / sum(raw.values())) for s in tokens)
    e = X.solve(tokens, entropy=1.0)
    assert abs(-sum(w * math.log(w) for w in e.weights.values()) - 1.0) < 1e-9
    sharp = X.solve(tokens, entropy=0.1)
    assert sharp.exponent > 1 and abs(-sum(w * math.log(w) for w in sharp.weights.values()) - 0.1) < 1e-9
    b = X.solve(tokens, budget=1030, repetition=2.0)
    assert max(b.weights[s] * 1030 / tokens[s] for s in tokens) <= 2.0 + 1e-9
    assert X.solve(tokens, repetition=1e9).exponent == 0.0 and X.solve(tokens, repetition=1.0).exponent == pytest.approx(1.0)
    assert X.solve({}, repetition=2).epochs == {} and X.solve({"e": 0}, repetition=2).epochs == {"e": 1}
    for bad in ({"repetition": 0.5}, {}, {"entropy": 1, "repetition": 2}, {"budget": 9999, "repetition": 2.0}):
        with pytest.raises(ValueError):
            X.solve(tokens, **bad)


@pytest.mark.parametrize("budget, target", [(None, {"repetition": 2.5}), (3000, {"repetition": 2.0}), (2500, {"entropy": 1.09})])
def test_quotas(make, budget, target):
    sizes = {"big": 300, "mid": 60, None: 20}
    rows = rows_of(sizes)
    tokens = collections.Counter()
    for d, t, _, s in rows:
        tokens[s] += len(t.split())
    df = X.temperature_mix(make(rows), budget=budget, block_tokens=64, seed=3, **target)
    plan = X.solve(dict(tokens), budget=budget, **target)
    seen, docs = shown(df)
    for s in sizes:
        whole, rest = plan.epochs[s], plan.rest[s]
        assert all(seen[s][e] == tokens[s] for e in range(whole))
        assert rest - 12 < seen[s].get(whole, 0) <= rest        # less than the next document's tokens
        assert max(seen[s], default=0) <= whole
    assert all(n == 1 for c in docs.values() for n in c.values())


def test_epochs_are_block_permutations(make):
    got = X.temperature_mix(make(rows_of({"a": 300, "b": 100, "c": 30})), repetition=3.0, block_tokens=64).collect()
    order = collections.defaultdict(lambda: collections.defaultdict(dict))
    for r in got:
        order[r.source][r.mx_epoch].setdefault(r.mx_block, r.mx_order)
        assert order[r.source][r.mx_epoch][r.mx_block] == r.mx_order       # a block has one place in an epoch
    first, second = (sorted(order["c"][e], key=order["c"][e].get) for e in (0, 1))
    assert sorted(first) == sorted(second) and first != second


def test_same_rows_again(make):
    rows = rows_of({"a": 90, "b": 9})
    one, two = (sorted(map(tuple, X.temperature_mix(make(r).repartition(n), repetition=2.0).collect())) for r, n in ((rows, 3), (rows[::-1], 8)))
    assert one == two


def test_odd_rows(make):
    rows = [(1, None, None, "a"), (2, "", None, "empty"), (2, "", None, "empty"), (3, "x " * 50000, None, None), (None, "y z", None, "a"), (4, "y z", None, "a"), (4, "y z", None, "a")]
    seen, _ = shown(X.temperature_mix(make(rows), repetition=1.0))
    assert seen == {"a": {0: 6}, "empty": {0: 0}, None: {0: 50000}}
    assert X.temperature_mix(make([]), repetition=2.0).collect() == []


def test_query_shows_every_document(spark, documents):
    got = op8_temperature_mix(spark, documents[0]).collect()
    assert {r.doc_id for r in got if r.epoch == 0} == {d for d, *_ in documents[1]}
    by = collections.Counter((r.source, r.epoch) for r in got)
    assert max(e for _, e in by) <= 2
