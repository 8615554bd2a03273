"""Near-duplicate components: one-permutation MinHash, banded buckets, star-shaped candidate edges.

A document's set holds its distinct shingles of ``shingle`` words (A-Z lower-cased; fewer words: the whole
sequence as one). Two documents are linked if their sets' Jaccard similarity is at least ``percent`` %.

1. One pass hashes every shingle once. The hash picks a bin, the least hash in a bin is its entry (one
   permutation for all bins), and each empty bin takes the entry of the first full bin in its own random
   order of bins (optimal densification). ``rows`` bins make a band; bands are the buckets' keys.
2. Documents of equal sets fold into one representative first, so exact copies never meet in a bucket.
3. Every bucket is a star: its least member is linked to the others. Each document's least star edge is
   confirmed on the full sets and components are contracted; then the remaining star edges between different
   components, then those of two more stars with random centres, in buckets whose members still lie apart. At last
   pairs of such buckets are compared, only between components, and only where a link is possible: bit maps of the
   sets bound the intersection from above inside the join, so that few pairs that are no links leave it. Pairs that a star misses aren't lost, and pairs inside a component are never made. What is left to
   compare grows with the documents that come near a large component and belong to none.

A pair at exactly 80 % shares none of 40 bands of 5 with a chance of 1.3e-7, less above. The bands of tiny sets, with few full bins, depend
on each other and miss more (1 of 240,000 pairs of 4 and 5 shingles), so sets of up to ``TINY`` shingles meet exactly as well: each
has a bucket for itself and for itself without any one or two of its shingles, as many as a link lets it have alone. Two linked ones
share the bucket of their intersection. Confirmation is exact up to collisions of 64-bit hashes; words of over ``LONG`` bytes are
hashed by a digest, as a polynomial modulo 2^64 is the same for some long words made of two letters in a pattern.

Defined results: a text without words has the empty set and is linked with nothing. Rows that share a
doc_id are in one component. A null doc_id takes no part: component_id null, kept. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, SpanHash, files_for, flat, give_back, mix, slices, small_batches, stash, word_spans


TINY = 14           # shingles of sets that are also linked by their own subsets
LONG = 64           # bytes of words that are hashed by a digest
SKETCH = 4096       # bits of a set's map
FOLDED = 1024       # of the short one


def shingle_sets(buf: np.ndarray, offs: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes in order within each text, offsets) of all texts."""
    starts, ends, text = word_spans(buf, offs)
    n = len(offs) - 1
    word = SpanHash(buf, lower=True)(starts, ends)
    long = np.flatnonzero(ends - starts > LONG)
    if len(long):
        low = LOWER[buf]
        word[long] = [int.from_bytes(hashlib.blake2b(low[a:b].tobytes(), digest_size=8).digest(), "little")
                      for a, b in zip(starts[long].tolist(), ends[long].tolist())]
    count = np.bincount(text, minlength=n)
    with np.errstate(over="ignore"):
        h = word.copy()
        for k in range(1, shingle):
            m = max(0, len(word) - k)
            h[:m] = mix(h[:m] * U64(3) + word[k:])
        first = np.cumsum(count) - count
        rank = np.arange(len(word)) - first[text]
        full = rank <= count[text] - shingle
        hashes, owner = h[full], text[full]
        short = np.flatnonzero((count > 0) & (count < shingle))
        if len(short):  # the whole sequence as one; unlike a shingle of as many words elsewhere
            one = []
            for d in short:
                acc = U64(count[d])
                for w in word[first[d]:first[d] + count[d]]:
                    acc = mix(np.array([acc * U64(5) + w], dtype=U64))[0]
                one.append(acc)
            hashes = np.concatenate([hashes, np.array(one, dtype=U64)])
            owner = np.concatenate([owner, short])
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    hashes, owner = hashes[order], owner[order]
    fresh = np.ones(len(hashes), dtype=bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    hashes, owner = hashes[fresh], owner[fresh]
    return hashes, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def _probe_table(bins: int) -> np.ndarray:
    """Row j: all bins, in the order in which an empty bin j asks them."""
    rng = np.random.default_rng(20240229)
    return np.stack([rng.permutation(bins) for _ in range(bins)])


def signatures(hashes: np.ndarray, offs: np.ndarray, bins: int, probe: np.ndarray) -> np.ndarray:
    """(texts, bins) least hashes by one permutation, densified; rows of empty sets are zeros."""
    n = len(offs) - 1
    owner = np.repeat(np.arange(n), np.diff(offs))
    slot = ((hashes >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)   # hashes in order: slots ascend
    head = np.ones(len(hashes), dtype=bool)
    head[1:] = (slot[1:] != slot[:-1]) | (owner[1:] != owner[:-1])
    sig = np.zeros((n, bins), dtype=U64)
    full = np.zeros((n, bins), dtype=bool)
    sig[owner[head], slot[head]] = hashes[head]
    full[owner[head], slot[head]] = True
    row, col = np.nonzero(~full & (np.diff(offs) > 0)[:, None])
    at = 0
    while len(row):
        src = probe[col, at]
        hit = full[row, src]
        sig[row[hit], col[hit]] = sig[row[hit], src[hit]]   # full stays as it was: only own entries are taken
        row, col = row[~hit], col[~hit]
        at += 1
    return sig


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        key = np.tile(np.arange(1, bands + 1, dtype=U64), (len(sig), 1))
        for r in range(rows):
            key = mix(key * U64(0x9E3779B97F4A7C15) + sig[:, r * bands:(r + 1) * bands])
    return key.view(np.int64)


def subset_keys(hashes: np.ndarray, offs: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(keys, texts): of sets of up to TINY, a key for the set without each choice of as many elements as a partner that is
    linked may lack: (100 - percent) % of them, two at most."""
    size = np.diff(offs)
    keys, owner = [], []
    for n in range(1, TINY + 1):
        at = np.flatnonzero(size == n)
        alone = n * (100 - percent) // 100
        if not len(at) or alone > 2:
            continue
        without = [c for k in range(alone + 1) for c in itertools.combinations(range(n), k)]
        kept = np.ones((n, len(without)), dtype=U64)
        for j, c in enumerate(without):
            kept[list(c), j] = 0
        with np.errstate(over="ignore"):
            sums = mix(hashes[offs[at][:, None] + np.arange(n)] + U64(0xA0761D6478BD642F)) @ kept      # of a subset's elements, in any order
            keys.append(mix(sums + kept.sum(axis=0)).ravel())
        owner.append(np.repeat(at, len(without)))
    if not keys:
        return np.zeros(0, dtype=U64), np.zeros(0, dtype=np.int64)
    return np.concatenate(keys), np.concatenate(owner)


def _sign(shingle: int, bands: int, rows: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        probe = _probe_table(bands * rows)
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, offs = shingle_sets(*flat(piece.column("text")), shingle)
                keys = band_keys(signatures(hashes, offs, bands * rows, probe), bands, rows)
                more, owner = subset_keys(hashes, offs, percent)
                first = np.concatenate([[0], np.cumsum(bands + np.bincount(owner, minlength=len(keys)))]).astype(np.int32)
                every = np.concatenate([keys.ravel(), more.view(np.int64)])[np.argsort(
                    np.concatenate([np.repeat(np.arange(len(keys)), bands), owner]), kind="stable")]
                raw = hashes.tobytes()
                mark = [hashlib.blake2b(raw[8 * a:8 * b], digest_size=16).digest() if b > a else None
                        for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"), pa.array(np.diff(offs)), pa.array(mark, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(first), pa.array(every))],
                    ["doc_id", "n_shingles", "mark", "bands"])
    return run


def sketches(hashes: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """(sets, SKETCH / 64) bit maps: the bit of every hash's last digits."""
    n = len(offs) - 1
    owner = np.repeat(np.arange(n), np.diff(offs))
    bits = np.zeros((n, SKETCH), dtype=np.uint8)
    bits[owner, (hashes % U64(SKETCH)).astype(np.int64)] = 1
    return np.packbits(bits, axis=1, bitorder="little").view(np.int64)


def _sets(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                hashes, offs = shingle_sets(*flat(piece.column("text")), shingle)
                raw = hashes.tobytes()
                maps = sketches(hashes, offs)
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id"),
                    pa.array([raw[8 * a:8 * b] for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, maps.size + 1, SKETCH // 64, dtype=np.int32)), pa.array(maps.ravel()))],
                    ["doc_id", "hashes", "sketch"])
    return run


def _similarity(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both, either = [], []
        for x, y in zip(batch.column("hx"), batch.column("hy")):
            a, b = np.frombuffer(x.as_buffer(), dtype=U64), np.frombuffer(y.as_buffer(), dtype=U64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            both.append(int((b[at] == a).sum()))
            either.append(len(a) + len(b) - both[-1])
        yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(both, pa.int64()),
                                          pa.array(either, pa.int64())], ["x", "y", "both", "either"])
        give_back()


def components(nodes: DataFrame, edges: DataFrame, files: int | None = None) -> DataFrame:
    """(node, comp): the least node each node reaches over ``edges`` (x, y). Every round maps each node to the least of
    its neighbourhood and contracts; nodes drop away at least by halves, so a star takes one round."""
    labels = nodes.select("node", F.col("node").alias("comp"))
    while True:
        edges = stash(edges.where("x <> y").selectExpr("least(x, y) as x", "greatest(x, y) as y").distinct(), "edges", files)
        if edges.isEmpty():
            return labels
        least = stash(edges.unionByName(edges.selectExpr("y as x", "x as y")).groupBy("x")
                      .agg(F.min("y").alias("m")).selectExpr("x as c", "least(x, m) as m"), "least", files)
        labels = stash(labels.join(least, F.col("comp") == F.col("c"), "left")
                       .selectExpr("node", "coalesce(m, comp) as comp"), "labels", files)
        edges = (edges.join(least, F.col("x") == F.col("c")).selectExpr("m as x", "y")
                 .join(least, F.col("y") == F.col("c")).selectExpr("x", "m as y"))


def _compared(pairs: DataFrame, sets: DataFrame, files: int) -> DataFrame:
    """(x, y, both, either): sizes of the intersection and union of the pairs' full sets."""
    a = sets.select(F.col("doc_id").alias("x"), F.col("hashes").alias("hx"))
    b = sets.select(F.col("doc_id").alias("y"), F.col("hashes").alias("hy"))
    return stash(pairs.join(b, "y").join(a, "x").select("x", "y", "hx", "hy")
                 .mapInArrow(_similarity, "x long, y long, both long, either long"), "compared", files)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80, bands: int = 40,
                    rows: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text)."""
    small_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    signed = stash(texts.mapInArrow(_sign(shingle, bands, rows, percent),
                                    "doc_id long, n_shingles long, mark binary, bands array<long>"), "signed")
    # small tables that a join with possibly hot keys meets are written first: such a join can be split
    n = signed.count()
    folded = stash(signed.where("mark is not null").groupBy("mark").agg(F.min("doc_id").alias("rep")), "marks", files_for(n))
    every = stash(signed.join(folded, "mark", "left").selectExpr(
        "doc_id", "n_shingles", "rep", "if(doc_id = rep, bands, null) as bands"), "folded")
    buckets = every.where("bands is not null").select("rep", "n_shingles", F.explode("bands").alias("key"))
    turned = F.col("rep").bitwiseXOR(F.col("key"))       # its least and largest are centres that differ from bucket to bucket
    shared = stash(buckets.groupBy("key").agg(
        F.min("rep").alias("star"), F.max("rep").alias("far"),
        F.min(turned).bitwiseXOR(F.col("key")).alias("star2"), F.max(turned).bitwiseXOR(F.col("key")).alias("star3")).where("star <> far").drop("far"), "shared", files_for(n * bands // 2))
    members = stash(buckets.join(shared, "key"), "members", files_for(n * bands))     # of buckets with two members or more
    nodes = stash(members.select(F.col("rep").alias("node")).distinct(), "nodes", files_for(n))
    files = files_for(nodes.count())       # of tables with a row or so for each node
    sets = stash(texts.join(nodes, F.col("doc_id") == F.col("node"), "left_semi")
                 .mapInArrow(_sets(shingle), "doc_id long, hashes binary, sketch array<long>"), "sets")
    linked = f"100 * both >= {percent} * either"

    def spokes(rows: DataFrame, centre: str) -> DataFrame:
        return rows.where(F.col(centre) != F.col("rep")).selectExpr(
            f"least({centre}, rep) as x", f"greatest({centre}, rep) as y").distinct()

    def joined(labels: DataFrame, pairs: DataFrame) -> DataFrame:
        """Labels after the links among those ``pairs`` that lie in different components."""
        a = labels.select(F.col("node").alias("x"), F.col("comp").alias("cx"))
        b = labels.select(F.col("node").alias("y"), F.col("comp").alias("cy"))
        apart = stash(pairs.join(a, "x").join(b, "y").where("cx <> cy").select("x", "y", "cx", "cy"), "apart", files)
        links = _compared(apart.select("x", "y"), sets, files).where(linked).join(apart, ["x", "y"])
        heads = components(labels.select(F.col("comp").alias("node")).distinct(), links.selectExpr("cx as x", "cy as y"), files)
        return stash(labels.join(heads.withColumnRenamed("comp", "head"), labels.comp == heads.node)
                     .select(labels.node, F.col("head").alias("comp")), "labels", files)

    def mixed(rows: DataFrame, labels: DataFrame) -> DataFrame:
        """The rows of buckets whose members lie in different components, with comp and the bucket's least one."""
        named = rows.join(labels, F.col("rep") == F.col("node")).drop("node")
        apart = stash(named.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                      .where("lo <> hi").drop("hi"), "mixed", 2 * files)
        return stash(named.join(apart, "key"), "mixed", files_for(n * bands))

    stars = stash(spokes(members, "star"), "stars", files)
    one = _compared(stars.groupBy("y").agg(F.min("x").alias("x")).select("x", "y"), sets, files).where(linked)
    labels = joined(components(nodes, one.select("x", "y"), files), stars)
    left = mixed(members, labels).drop("comp", "lo")
    for centre in ("star2", "star3"):
        labels = joined(labels, spokes(left, centre))
    # what still lies apart in a bucket: compared if set sizes and bit maps allow a link; a short map is asked before the long one
    left = mixed(left, labels).where("rep <> star").select("key", "rep", "n_shingles", "comp", "lo")
    words = range(FOLDED // 64)
    folded_word = ["|".join(f"get(sketch, {w + k * len(words)})" for k in range(SKETCH // FOLDED)) for w in words]
    known = sets.select(F.col("doc_id").alias("rep"), "sketch", *[F.expr(e).alias(f"w{i}") for i, e in enumerate(folded_word)])
    known = known.withColumns({"ones": F.expr("aggregate(sketch, 0, (t, v) -> t + bit_count(v))"),
                               "few": F.expr("+".join(f"bit_count(w{i})" for i in words))})
    placed = stash(left.join(known, "rep"), "placed")

    def side(rows: DataFrame, n: str) -> DataFrame:
        return rows.selectExpr(f"key as k{n}", f"rep as {n}", f"n_shingles as n{n}", f"comp as c{n}", f"sketch as s{n}",
                               f"n_shingles - ones as e{n}", f"n_shingles - few as f{n}", *[f"w{i} as w{i}{n}" for i in words], f"lo as lo{n}")

    # common shingles set common bits; those that share a bit with another of their set are added back
    at_most = "+".join(f"bit_count(w{i}x & w{i}y)" for i in words) + "+ least(fx, fy)"
    at_most_long = "aggregate(zip_with(sx, sy, (a, b) -> bit_count(a & b)), 0, (t, v) -> t + v) + least(ex, ey)"
    rest = side(placed, "x").join(side(placed.where("comp <> lo"), "y"), F.expr(
        f"kx = ky and cx <> cy and (cx = lox or x < y) and 100 * least(nx, ny) >= {percent} * greatest(nx, ny) "
        f"and {100 + percent} * ({at_most}) >= {percent} * (nx + ny) and {100 + percent} * ({at_most_long}) >= {percent} * (nx + ny)"))
    labels = joined(labels, stash(rest.selectExpr("least(x, y) as x", "greatest(x, y) as y").distinct(), "rest", files))

    # equal sets and rows of one doc_id: doc -> rep -> component; a doc_id with several texts joins their components
    ids = every.where("rep is not null and doc_id is not null").select("doc_id", "rep").join(
        labels, F.col("rep") == F.col("node"), "left").selectExpr("doc_id", "coalesce(comp, rep) as comp").distinct()
    twice = ids.groupBy("doc_id").agg(F.min("comp").alias("x"), F.max("comp").alias("far")).where("x <> far")
    if not twice.isEmpty():
        more = ids.join(twice, "doc_id").selectExpr("x", "comp as y")
        heads = components(ids.select(F.col("comp").alias("node")).distinct(), more)
        ids = ids.join(heads.withColumnRenamed("comp", "head"), F.col("comp") == F.col("node")).select(
            "doc_id", F.col("head").alias("comp"))
    ids = ids.groupBy("doc_id").agg(F.min("comp").alias("comp")).withColumnRenamed("doc_id", "id")
    return every.join(ids, F.col("doc_id") == F.col("id"), "left").selectExpr(
        "doc_id", "n_shingles", "coalesce(comp, doc_id) as component_id",
        "coalesce(doc_id = coalesce(comp, doc_id), true) as kept")
