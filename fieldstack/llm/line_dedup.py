"""Line dedup across documents behind two Bloom filters.

A line's key is the line stripped of ASCII white space at both ends, with A-Z lower-cased. A key of
at least ``min_chars`` code points found in at least ``min_docs`` documents (``min_docs`` >= 2) loses
all its lines, except in the largest doc_id that holds it.

1. Every task marks its keys in a *once* filter and those it meets in a second document in a
   *twice* filter; the filters are merged by segment (once & once counts as twice).
2. The twice filter goes to all tasks. Only lines that it holds - suspected repeats - are shuffled,
   by a 128-bit digest, for the exact count and the choice of the document that keeps them.
3. Documents join the numbers of the lines to drop, as a mark for each line, so that the rewrite is one pass over a text's lines.

The filters' size follows the number of rows up to ``max_bits``, which bounds what is broadcast. A
fuller filter only lets more lines through to the exact count; the result never depends on it.

Defined results: a null or empty text is one empty line. Rows with a null doc_id keep all lines and
count for no key. Rows that repeat a doc_id are one document: its lines count once, and the document
keeps or loses them in all its rows. Extra columns pass through; those named ld_.. are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (SEGMENT, SPACE, U64, SpanHash, bit_places, bits_hold, files_for, filter_bits, flat, line_spans, mark_bits, own,
                     slices, small_batches, stash, tree_merge)



def _keys(buf: np.ndarray, offs: np.ndarray, min_chars: int):
    """Key hash, text index, line number and key span of every line that is long enough."""
    starts, ends, text = line_spans(buf, offs)
    solid = np.flatnonzero(~SPACE[buf])
    lo = np.searchsorted(solid, starts)
    hi = np.searchsorted(solid, ends)
    row = np.flatnonzero(hi > lo)
    a, b = solid[lo[row]], solid[hi[row] - 1] + 1
    heads = np.zeros(len(buf) + 1, dtype=np.int64)
    np.cumsum((buf & 0xC0) != 0x80, out=heads[1:])
    long = heads[b] - heads[a] >= min_chars
    row, a, b = row[long], a[long], b[long]
    first = np.searchsorted(text, np.arange(len(offs) - 1))
    return SpanHash(buf, lower=True)(a, b), text[row], row - first[text[row]], a, b


def _task_filters(bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)
        part = 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            for piece in slices(batch, "text"):
                h, text, *_ = _keys(*flat(piece.column("text")), min_chars)
                ids = piece.column("doc_id").to_numpy(zero_copy_only=False)[text]
                pairs = np.unique(np.stack([h, ids.astype(np.int64).view(U64)]), axis=1)[0]
                key, count = np.unique(pairs, return_counts=True)
                places = bit_places(key, bits)
                again = (count > 1) | bits_hold(once, places)
                mark_bits(twice, places[:, again])
                mark_bits(once, places)
        seg = np.flatnonzero(once.reshape(-1, SEGMENT).any(axis=1))
        for lo in range(0, len(seg), 512):
            at = seg[lo:lo + 512]
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(len(at), part, dtype=np.int32)), pa.array(at.astype(np.int32)),
                pa.array([once[i * SEGMENT:(i + 1) * SEGMENT].tobytes() for i in at], pa.binary()),
                pa.array([twice[i * SEGMENT:(i + 1) * SEGMENT].tobytes() for i in at], pa.binary()),
            ], ["part", "seg", "once", "twice"])
    return run


def _merge(rows: pa.Table) -> pa.Table:
    once = np.zeros(SEGMENT, dtype=np.uint8)
    twice = np.zeros(SEGMENT, dtype=np.uint8)
    for a, b in zip(rows.column("once"), rows.column("twice")):
        a, b = (np.frombuffer(x.as_buffer(), dtype=np.uint8) for x in (a, b))
        twice |= b | (once & a)
        once |= a
    return pa.table({"part": rows.column("part").slice(0, 1), "seg": rows.column("seg").slice(0, 1),
                     "once": pa.array([once.tobytes()], pa.binary()),
                     "twice": pa.array([twice.tobytes()], pa.binary())})


_FILTER = "part int, seg int, once binary, twice binary"


def twice_filter(docs: DataFrame, bits: int, min_chars: int) -> np.ndarray:
    """The merged filter of keys seen in two documents or more (plus false positives)."""
    parts = docs.rdd.getNumPartitions()
    rows = docs.withColumn("part", F.spark_partition_id()).mapInArrow(_task_filters(bits, min_chars), _FILTER)
    rows = tree_merge(rows, "seg", parts, _merge, _FILTER)
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in rows.select("seg", "twice").toLocalIterator():   # at most max_bits / 8 bytes in all
        out[r.seg * SEGMENT:(r.seg + 1) * SEGMENT] = np.frombuffer(r.twice, dtype=np.uint8)
    return out


def _suspects(shared, bits: int, min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = np.frombuffer(shared.value, dtype=np.uint8)
        for batch in batches:
            for piece in slices(batch, "text"):
                buf, offs = flat(piece.column("text"))
                h, text, line, a, b = _keys(buf, offs, min_chars)
                hit = np.flatnonzero(bits_hold(twice, bit_places(h, bits)))
                low = buf.tobytes().lower()     # bytes.lower() changes A-Z alone
                digest = [hashlib.blake2b(low[i:j], digest_size=16).digest()
                          for i, j in zip(a[hit].tolist(), b[hit].tolist())]
                at = pa.array(text[hit])
                yield pa.RecordBatch.from_arrays([
                    piece.column("doc_id").take(at), piece.column("text_hash").take(at),
                    pa.array(line[hit].astype(np.int32)), pa.array(digest, pa.binary())],
                    ["doc_id", "text_hash", "line", "key"])
    return run


def dropped_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
                  max_bits: int = 1 << 29) -> DataFrame:
    """(doc_id, text_hash, n, flags): how many lines a document's text loses, and for each line up to the last one that goes whether it does."""
    if min_docs < 2:
        raise ValueError("min_docs must be 2 or more: the filters tell second sightings")
    small_batches(docs.sparkSession)
    texts = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long").alias("doc_id"), "text")
    bits = filter_bits(texts.count(), max_bits=max_bits)
    twice = docs.sparkSession.sparkContext.broadcast(twice_filter(texts, bits, min_chars).tobytes())
    found = stash(texts.withColumn("text_hash", F.xxhash64("text")).mapInArrow(
        _suspects(twice, bits, min_chars), "doc_id long, text_hash long, line int, key binary"), "suspects")
    # written, so that the join below reads it through an exchange of its own and a hot key can be split
    repeated = stash(found.groupBy("key", "doc_id").agg(F.lit(1).alias("one"))
                .groupBy("key").agg(F.count("one").alias("n"), F.max("doc_id").alias("keeper"))
                .where(F.col("n") >= min_docs).select("key", "keeper"), "repeated", files_for(found.count()))
    return (found.join(repeated, "key").where("doc_id <> keeper")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("drop"))
            .mapInArrow(_flags, "doc_id long, text_hash long, n long, flags array<boolean>"))


def _flags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        count, flags = [], []
        for lines in batch.column("drop"):
            at = lines.values.to_numpy()
            mark = np.zeros(int(at.max()) + 1, dtype=bool)
            mark[at] = True
            count.append(len(at))
            flags.append(mark)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), pa.array(count, pa.int64()),
                                          pa.array(flags, pa.list_(pa.bool_()))], ["doc_id", "text_hash", "n", "flags"])


def line_dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3,
               max_bits: int = 1 << 29) -> DataFrame:
    """``docs`` with ``text`` rewritten, plus ``ld_lines`` (before) and ``ld_dropped``; a null text stays null."""
    docs = own(docs, "ld_")
    drops = dropped_lines(docs, min_chars, min_docs, max_bits).select(
        F.col("doc_id").alias("ld_doc"), F.col("text_hash").alias("ld_hash"), F.col("n").alias("ld_n"), F.col("flags").alias("ld_flags"))
    joined = docs.withColumn("ld_key", F.xxhash64("text")).join(
        drops, (F.col("doc_id").cast("long") == F.col("ld_doc")) & (F.col("ld_key") == F.col("ld_hash")), "left")
    newline = F.lit("\n")
    # an array's element is found at once, however many there are; beyond the last there is none
    kept = F.array_join(F.filter(F.split("text", "\n", -1),
                                 lambda x, i: ~F.coalesce(F.get("ld_flags", i), F.lit(False))), "\n")
    return joined.withColumns({
        "ld_lines": F.coalesce(F.octet_length("text") - F.octet_length(F.replace(F.col("text"), newline))
                               + 1, F.lit(1)).cast("long"),
        "ld_dropped": F.coalesce("ld_n", F.lit(0)).cast("long"),
        "text": F.when(F.col("ld_flags").isNull(), F.col("text")).otherwise(kept),
    }).drop("ld_key", "ld_doc", "ld_hash", "ld_n", "ld_flags")
