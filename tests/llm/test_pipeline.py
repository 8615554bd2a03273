import collections

import corpus_pipeline as P


def test_stages_against_their_rules(spark, documents):
    """Each stage by a plain rule over the rows that the one before kept."""
    import sys
    sys.path.insert(0, __file__.rsplit("/", 1)[0])
    import test_line_dedup
    import test_minhash_dedup
    docs = spark.read.parquet(f"{documents[0]}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in P.STAGES] == ["language_id", "line_dedup", "near_dedup", "mix", "tokenize"]
    outs = []
    for name, stage in P.STAGES:
        out = stage(spark, docs, documents[0])
        path = f"{spark.sparkContext.getCheckpointDir()}/test-{name}-{id(out)}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        outs.append(docs.collect())
        if name != "tokenize":
            assert docs.columns == P.COLUMNS
    langs, lines, near, mix, tokens = outs
    assert len(langs) >= 0.95 * len(rows) and all(r.text == rows[r.doc_id].text for r in langs)
    want = {d: t for d, _, _, t in test_line_dedup.brute([(r.doc_id, r.text) for r in langs])}
    assert {r.doc_id: r.text for r in lines} == want
    kept = {d for d, *_, k in test_minhash_dedup.brute([(r.doc_id, r.text) for r in lines], 5) if k}
    assert {r.doc_id for r in near} == kept and len(near) == len(kept)
    seen = collections.Counter(r.doc_id for r in mix)
    assert set(seen) == kept and max(seen.values()) <= 2
    assert len(tokens) == len(mix) and all(r.exact for r in tokens) and collections.Counter(r.doc_id for r in tokens) == seen


def test_odd_documents(spark, make, tmp_path):
    long = " ".join(f"the{i} and{i}" for i in range(30000))
    rows = [(1, None, None, None), (2, "", "en", "s"), (3, "the and of the in", "en", "s"), (3, "the and of the in", "en", "s"),
            (None, "the and of", "en", None), (4, "der die das und", "de", "s"), (5, long, "en", None), (6, "123", "en", "t")]
    make(rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = P.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in got} == {3, 4, 5, None} and all(r.exact for r in got)


def test_near_duplicates_without_proper_ids(spark, make):
    """Rows that repeat an id and a text, copies without an id, and an id with two texts, one a copy of another's: one row of each stays."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(30)) for x in "abcd")
    rows = [(1, a, "en", "s"), (1, a, "en", "s"), (None, b, "en", "s"), (None, b, "en", "t"), (7, b, "en", "s"), (8, c, "en", "s"),
            (9, c, "en", "s"), (9, d, "en", "s"), (None, None, "en", "s"), (None, a + " z", "en", "s")]
    got = P.drop_near_duplicates(spark, make(rows), "").collect()
    assert sorted((str(r.doc_id), str(r.text)[:1]) for r in got) == [("1", "a"), ("7", "b"), ("8", "c"), ("9", "d"), ("None", "N")]


def test_mix_is_written_in_training_order(spark, documents):
    """The table reads back by epochs: an epoch's showings come together, and no document twice before all of its block's others."""
    docs = spark.read.parquet(f"{documents[0]}/documents.parquet")
    rows = [r.doc_id for r in P.mix_sources(spark, docs, documents[0]).select("doc_id").collect()]
    seen, epochs = set(), 1
    for x in rows:
        if x in seen:
            seen, epochs = set(), epochs + 1
        seen.add(x)
    assert epochs == 2 and rows != sorted(rows)


def test_empty(spark, make, tmp_path):
    make([]).write.parquet(str(tmp_path / "documents.parquet"))
    assert P.run(spark, str(tmp_path)).collect() == []
