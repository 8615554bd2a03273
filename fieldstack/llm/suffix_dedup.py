"""Removal of repeated byte strings by suffix arrays (difference-cover algorithm).

Every byte that a string of ``length`` bytes covers which also starts somewhere else - in any text, the same one included - is
removed; strings are judged on the input.

A suffix array over all bytes would sort every suffix of the corpus, most of which share no long prefix with any other. So
suffixes are dealt out first, exactly: each window of ``length`` bytes selects the least hash of its ``gram``-byte substrings
(the last of equals). Equal windows select equal grams at equal distance, so a window can only repeat within the group of
its gram. Neighbouring windows that select the same place form a tile.

1. Groups of one tile hold nothing repeated. Tiles of equal bytes are one tile with a count: all their windows repeat.
2. Groups with different tiles are dealt to buckets by their gram. A bucket sorts the suffixes of its tiles by the
   difference-cover algorithm modulo 3: sort sampled triples, recurse on their names, sort and merge the remaining suffixes; then adjacent
   suffixes are compared over ``length`` bytes.
3. A group of more than ``max_tiles`` different tiles (a passage with as many contexts) is too much for one bucket; its tiles
   are dealt on in parts of a few windows, by the bytes that these have in common, and the windows of parts that still differ one
   by one, by a hash of all their bytes.
4. The windows found repeated, as runs, join the texts by the texts' hash, and their union is cut out.

Identity of tiles and of hot groups' windows is by 64-bit hashes; everything else is compared byte by byte.

Defined results: a null or short text loses nothing. Rows with the same text lose the same. What remains of a text may not be
valid UTF-8, so it is returned as bytes. Extra columns pass through; those named sd_.. are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import U64, SpanHash, bit_places, bits_hold, flat, key_filter, mix, offsets, own, slices, small_batches, stash

_LOW = U64((1 << 24) - 1)
PIECE = 1 << 22             # bytes of one text that are looked at together
SORTED = 3 << 19            # bytes that one suffix array holds at most
BUCKET = 1 << 18            # bytes of tiles in a bucket, about
PART = 8                    # windows in a part of a tile


# ------------------------------------------------------------------ tiles

def _window_anchors(h: np.ndarray, width: int) -> np.ndarray:
    """For every ``width`` neighbouring hashes the place of the least (by its upper 40 bits; the last of equals)."""
    n = len(h)
    place = np.arange(n, dtype=U64)
    key = (h & ~_LOW) | (_LOW - (place & _LOW))
    blocks = np.concatenate([key, np.full(-n % width, ~U64(0))]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(behind[:n - width + 1], ahead[width - 1:n])
    return (_LOW - (least & _LOW)).astype(np.int64)      # PIECE is below 2^24, so this is the whole place


def tiles(buf: np.ndarray, offs: np.ndarray, length: int, gram: int):
    """(gram hash, text, first window, windows, distance of the gram, tile hash) of all tiles."""
    if len(buf) < length:
        return (np.zeros(0, dtype=U64), *(np.zeros(0, dtype=np.int64) for _ in range(4)), np.zeros(0, dtype=U64))
    span = SpanHash(buf)
    at = np.arange(len(buf) - gram + 1)
    grams = span(at, at + gram)
    anchor = _window_anchors(grams, length - gram + 1)
    start = np.arange(len(buf) - length + 1)
    text = np.searchsorted(offs, start, side="right") - 1
    inside = start + length <= offs[text + 1]
    start, text, anchor = start[inside], text[inside], anchor[inside]
    head = np.ones(len(start), dtype=bool)
    head[1:] = (anchor[1:] != anchor[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(head)
    count = np.diff(np.append(first, len(start)))
    begin = start[first]
    return (grams[anchor[first]], text[first], begin - offs[text[first]], count, anchor[first] - begin,
            span(begin, begin + count - 1 + length))


_TILE = "g long, th long, u long, n int, dist int, tile long"


def _tile_rows(length: int, gram: int):
    def batch_of(got, th: np.ndarray, shift: int) -> pa.RecordBatch:
        g, text, u, n, dist, key = got
        return pa.RecordBatch.from_arrays([
            pa.array(g.view(np.int64)), pa.array(th[text]), pa.array(u + shift), pa.array(n.astype(np.int32)),
            pa.array(dist.astype(np.int32)), pa.array(key.view(np.int64))], ["g", "th", "u", "n", "dist", "tile"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text"):
                buf, offs = flat(piece.column("text"))
                th = piece.column("th").to_numpy(zero_copy_only=False)
                if piece.num_rows == 1 and len(buf) > PIECE:     # a very long text, in overlapping pieces
                    for lo in range(0, len(buf) - length + 1, PIECE):
                        part = buf[lo:lo + PIECE + length - 1]
                        yield batch_of(tiles(part, np.array([0, len(part)]), length, gram), th, lo)
                else:
                    yield batch_of(tiles(buf, offs, length, gram), th, 0)
    return run


# ------------------------------------------------------------------ difference-cover suffix array

def suffix_array(s: np.ndarray) -> np.ndarray:
    """Starts of the suffixes of ``s`` (integers from 1, fewer than 2^21 symbols and values) in order."""
    n = len(s)
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), dtype=np.int64)
    t = np.concatenate([s, [0, 0, 0]]).astype(U64)
    extra = n % 3 == 1                                  # then the triple that starts at the end counts as sampled
    one = np.arange(1, n + extra, 3)
    two = np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    key = (t[sample] << U64(42)) | (t[sample + 1] << U64(21)) | t[sample + 2]
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(key), dtype=np.int64)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    name = np.empty(len(key), dtype=np.int64)
    name[order] = np.cumsum(fresh)
    if fresh.sum() < len(key):
        order = suffix_array(name)
        name[order] = np.arange(1, len(name) + 1)
    rank = np.zeros(n + 3, dtype=U64)
    rank[sample] = name.astype(U64)
    sampled = sample[order]
    if extra:
        sampled = sampled[sampled < n]
    rest = np.arange(0, n, 3)
    rest_key = (t[rest] << U64(21)) | rank[rest + 1]
    by = np.argsort(rest_key, kind="stable")
    rest, rest_key = rest[by], rest_key[by]
    # merge: where each remaining suffix stands among the sampled ones of either residue
    is_one = sampled % 3 == 1
    ones, twos = sampled[is_one], sampled[~is_one]
    less = np.searchsorted((t[ones] << U64(21)) | rank[ones + 1], rest_key)
    less += np.searchsorted((t[twos] << U64(42)) | (t[twos + 1] << U64(21)) | rank[twos + 2],
                            (t[rest] << U64(42)) | (t[rest + 1] << U64(21)) | rank[rest + 2])
    out = np.empty(n, dtype=np.int64)
    place = np.arange(len(rest)) + less
    taken = np.zeros(n, dtype=bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = sampled
    return out


def repeated_windows(buf: np.ndarray, offs: np.ndarray, length: int) -> np.ndarray:
    """Which starts in ``buf`` begin a string of ``length`` bytes, inside one text of ``offs``, that begins elsewhere too."""
    order = suffix_array(buf.astype(np.int64) + 1)
    text = np.searchsorted(offs, order, side="right") - 1
    order = order[order + length <= offs[text + 1]]
    a, b = order[:-1], order[1:]
    h = SpanHash(buf)
    near = np.flatnonzero(h(a, a + length) == h(b, b + length))     # the rest differ; these are compared in full
    same = np.zeros(len(a), dtype=bool)
    step = np.arange(length)
    for i in range(0, len(near), 4096):
        at = near[i:i + 4096]
        same[at] = (buf[a[at, None] + step] == buf[b[at, None] + step]).all(axis=1)
    out = np.zeros(len(buf), dtype=bool)
    out[a[same]] = True
    out[b[same]] = True
    return out


def _runs(flag: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[False], flag, [False]]).astype(np.int8)))
    return [{"s": int(a), "l": int(b - a)} for a, b in zip(edge[::2], edge[1::2])]


_RUNS = T.ArrayType(T.StructType([T.StructField("s", T.IntegerType()), T.StructField("l", T.IntegerType())]))
_FOUND = T.StructType([T.StructField("g", T.LongType()), T.StructField("tile", T.LongType()), T.StructField("runs", _RUNS)])
_ARROW_RUNS = pa.list_(pa.struct([("s", pa.int32()), ("l", pa.int32())]))


def _sort_bucket(length: int):
    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("g", "ascending"), ("tile", "ascending")]).combine_chunks()
        g = rows.column("g").to_numpy()
        data = rows.column("bytes").chunk(0)
        offs = offsets(data)
        raw = np.frombuffer(data.buffers()[2], dtype=np.uint8)
        ends = np.append(np.flatnonzero(g[1:] != g[:-1]) + 1, len(g))
        runs, lo = [], 0
        while lo < len(g):      # whole groups, as many as one array may hold
            fit = ends[(ends > lo) & (offs[ends] <= offs[lo] + SORTED)]
            hi = int(fit[-1]) if len(fit) else int(ends[ends > lo][0])
            flag = repeated_windows(raw[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo], length)
            for i in range(lo, hi):
                a, b = offs[i] - offs[lo], offs[i + 1] - offs[lo]
                runs.append(_runs(flag[a:b - length + 1]))
            lo = hi
        return pa.table({"g": rows.column("g"), "tile": rows.column("tile"), "runs": pa.array(runs, _ARROW_RUNS)})
    return run


def _parts(length: int):
    """Tiles cut into parts of up to PART windows, aligned by their distance to the gram: equal windows are in parts with
    the same core, the bytes that all windows of such a part cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "bytes"):
                data = piece.column("bytes")
                offs = offsets(data)
                buf = np.frombuffer(data.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]]
                begin = offs[:-1] - offs[0]
                n = np.diff(offs) - length + 1
                dist = piece.column("dist").to_numpy().astype(np.int64)
                row = np.repeat(np.arange(len(n)), n)
                i = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                part = (dist[row] - i) // PART
                head = np.flatnonzero(np.append(True, (part[1:] != part[:-1]) | (row[1:] != row[:-1])))
                size = np.diff(np.append(head, len(row)))
                at, first = row[head], i[head]
                start = begin[at] + first
                end = start + size - 1 + length
                core = begin[at] + dist[at] - part[head] * PART
                span = SpanHash(buf)
                turn = ((dist[at] - first) % PART).astype(U64)      # where in its part the first window stands
                with np.errstate(over="ignore"):
                    sub = mix(span(start, end) * U64(PART) + turn)
                raw = buf.tobytes()
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([
                    piece.column("g").take(take), piece.column("tile").take(take), pa.array(first.astype(np.int32)),
                    pa.array(size.astype(np.int32)), pa.array(span(core, core + length - PART + 1).view(np.int64)), pa.array(sub.view(np.int64)),
                    pa.array([raw[x:y] for x, y in zip(start.tolist(), end.tolist())], pa.binary())],
                    ["g", "tile", "i", "l", "core", "sub", "bytes"])
    return run


def _single_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "bytes"):
                data = piece.column("bytes")
                offs = offsets(data)
                buf = np.frombuffer(data.buffers()[2], dtype=np.uint8)[offs[0]:offs[-1]]
                size = np.diff(offs) - length + 1
                row = np.repeat(np.arange(len(size)), size)
                k = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size)
                start = offs[row] - offs[0] + k
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays([
                    piece.column("core").take(take), piece.column("sub").take(take),
                    pa.array(k.astype(np.int32)), pa.array(SpanHash(buf)(start, start + length).view(np.int64))],
                    ["core", "sub", "k", "w"])
    return run


def _hot_groups(cut: DataFrame, length: int) -> DataFrame:
    """(g, tile, runs) of groups with too many tiles for a bucket: the same steps again over parts of tiles, whose groups are
    smaller, and windows one by one where even these differ."""
    parts = stash(cut.select("g", "tile", "dist", "bytes").mapInArrow(
        _parts(length), "g long, tile long, i int, l int, core long, sub long, bytes binary"), "parts")
    cores = stash(parts.groupBy("core").agg(F.count("*").alias("m"), F.min("sub").alias("lo"), F.max("sub").alias("hi"))
                  .where("m > 1").selectExpr("core", "lo <> hi as mixed"), "cores")
    shared = stash(parts.join(cores, "core"), "parts")
    subs = stash(shared.groupBy("core", "sub").agg(F.count("*").alias("c"), F.first("mixed").alias("mixed"), F.min("bytes").alias("bytes")), "subs")
    windows = stash(subs.where("mixed").select("core", "sub", "bytes").mapInArrow(
        _single_windows(length), "core long, sub long, k int, w long"), "windows")
    twice = stash(windows.groupBy("w").agg(F.count("*").alias("m")).where("m > 1").select("w"), "twice")
    alone = subs.where("c = 1").select("core", "sub")
    some = windows.join(twice, "w").join(alone, ["core", "sub"], "left_semi").selectExpr("core", "sub", "k as s", "1 as l")
    every = subs.where("c > 1").selectExpr("core", "sub", "0 as s", f"octet_length(bytes) - {length - 1} as l")
    found = stash(some.unionByName(every), "found")
    return (shared.select("g", "tile", "i", "core", "sub").join(found, ["core", "sub"])
            .groupBy("g", "tile").agg(F.collect_list(F.struct((F.col("i") + F.col("s")).alias("s"), "l")).alias("runs")))


# ------------------------------------------------------------------ the operator

def repeated_runs(docs: DataFrame, length: int, gram: int, max_tiles: int) -> DataFrame:
    """(th, cuts): for the hash of a text, the byte spans (a, b) that go."""
    spark = docs.sparkSession
    texts = docs.select("text").where(f"octet_length(text) >= {length}").withColumn("th", F.xxhash64("text"))
    rows = stash(texts.mapInArrow(_tile_rows(length, gram), _TILE), "tiles")
    groups = stash(rows.groupBy("g").agg(F.count("*").alias("m"), F.min("tile").alias("lo"), F.max("tile").alias("hi"))
                   .where("m > 1").selectExpr("g", "lo <> hi as mixed"), "groups")
    shared = stash(rows.join(groups, "g"), "shared")

    # different tiles of mixed groups, one place of each
    kinds = (shared.where("mixed").groupBy("g", "tile")
             .agg(F.count("*").alias("c"), F.min(F.struct("th", "u", "n", "dist")).alias("one")))
    kinds = stash(kinds.select("g", "tile", "c", "one.*"), "kinds")
    sizes = kinds.groupBy("g").agg(F.count("*").alias("d"))
    big = stash(sizes.where(F.col("d") > max_tiles).select("g"), "big")
    bits, size = key_filter(kinds.select("th").distinct())
    held = spark.sparkContext.broadcast(bits)

    def only_needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.frombuffer(held.value, dtype=np.uint8)
        for batch in batches:
            th = batch.column("th").to_numpy(zero_copy_only=False).view(U64)
            yield batch.filter(pa.array(bits_hold(table, bit_places(th, size))))

    sources = texts.mapInArrow(only_needed, texts.schema).groupBy("th").agg(F.min("text").alias("text"))
    piece = F.substring(F.col("text").cast("binary"), F.col("u").cast("int") + 1, F.col("n") + (length - 1))
    cut = stash(kinds.join(sources, "th").select("g", "tile", "c", "n", "dist", piece.alias("bytes")), "pieces")
    total = cut.agg(F.sum(F.octet_length("bytes"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    small = cut.join(big, "g", "left_anti").select("g", "tile", "bytes", F.pmod(F.xxhash64("g"), F.lit(buckets)).alias("bucket"))
    found = small.groupBy("bucket").applyInArrow(_sort_bucket(length), _FOUND)
    both = found.unionByName(_hot_groups(cut.join(big, "g", "left_semi"), length)).where("array_size(runs) > 0")
    whole = kinds.where("c > 1").selectExpr("g", "tile", "array(struct(0 as s, n as l)) as runs")
    flagged = stash(both.join(whole.select("g", "tile"), ["g", "tile"], "left_anti").unionByName(whole), "flagged")

    alike = shared.where("not mixed").selectExpr("th", "u as a", f"u + n + {length - 1} as b")
    parts = (shared.where("mixed").join(flagged, ["g", "tile"]).selectExpr("th", "u", "explode(runs) as r")
             .selectExpr("th", "u + r.s as a", f"u + r.s + r.l + {length - 1} as b"))
    return stash(alike.unionByName(parts).distinct().groupBy("th").agg(F.collect_list(F.struct("a", "b")).alias("cuts")), "cuts")


def suffix_dedup(docs: DataFrame, length: int = 400, gram: int = 200, max_tiles: int = 256, keep_text: bool = True) -> DataFrame:
    """``docs`` plus sd_bytes (before), sd_removed, sd_spans (removed byte spans) and sd_kept (the bytes that stay)."""
    small_batches(docs.sparkSession)
    docs = own(docs, "sd_")
    cuts = repeated_runs(docs, length, gram, max_tiles).withColumnsRenamed({"th": "sd_h", "cuts": "sd_cuts"})
    joined = docs.withColumn("sd_th", F.xxhash64("text")).join(cuts, F.col("sd_th") == F.col("sd_h"), "left").drop("sd_th", "sd_h")
    names = [c for c in docs.columns if keep_text or c != "text"]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    arrow = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offs = flat(batch.column("text"))
            raw = buf.tobytes()
            lists = batch.column("sd_cuts")
            size, removed, spans, kept = np.diff(offs), np.zeros(batch.num_rows, dtype=np.int64), [], []
            for i, cut in enumerate(lists):
                lo, hi = int(offs[i]), int(offs[i + 1])
                if not cut.is_valid:
                    spans.append([])
                    kept.append(raw[lo:hi])
                    continue
                ab = np.array([(x["a"], x["b"]) for x in cut.as_py()], dtype=np.int64)
                ab = ab[np.argsort(ab[:, 0], kind="stable")]
                reach = np.maximum.accumulate(ab[:, 1])
                head = np.append(True, ab[1:, 0] > reach[:-1])
                a, b = ab[head, 0], reach[np.append(np.flatnonzero(head)[1:] - 1, len(ab) - 1)]
                removed[i] = int((b - a).sum())
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
                text = raw[lo:hi]
                kept.append(b"".join(text[x:y] for x, y in zip([0, *b.tolist()], [*a.tolist(), hi - lo])))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(size), pa.array(removed), pa.array(spans, arrow),
                 pa.array(kept, pa.binary())], [*names, "sd_bytes", "sd_removed", "sd_spans", "sd_kept"])

    return joined.mapInArrow(run, T.StructType([
        *(docs.schema[c] for c in names), T.StructField("sd_bytes", T.LongType()), T.StructField("sd_removed", T.LongType()),
        T.StructField("sd_spans", T.ArrayType(span)), T.StructField("sd_kept", T.BinaryType())]))
