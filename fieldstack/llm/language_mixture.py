"""Language ID by mixture inference: which languages a document holds, and in what proportions.

Profiles: counts of letter trigrams (a letter with its neighbours, lower-cased; anything but a letter is
a space) by language over all labelled texts, in 2^15 hashed buckets, smoothed to probabilities. A task counts its
rows; the counts are merged by block. Profiles take 2^15 floats for each of at most ``max_languages``
languages, which bounds what goes to the driver and the tasks.

Inference: a document's words are drawn from a mixture of languages. A word's likelihood under a language is
the product of its trigrams' probabilities; expectation-maximisation estimates the proportions. The
language set is the one among the leading 1, 2, .. ``max_set`` languages with the largest log likelihood less
``penalty`` * ln(words) for each language beyond the first. The prediction is its largest share.

Defined results: a null text, a text without a letter, or nothing to learn from: ``und`` with score 0 and no
languages. Ties go to the language that sorts first. Rows are judged one by one, repeated ones alike; extra
columns pass through, and those named li_.. are replaced.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import own, slices, small_batches, tree_merge

BUCKETS = 1 << 15
BLOCK = 1 << 10
SMOOTH = 0.5
_U32 = np.uint32


@dataclass(frozen=True)
class Profiles:
    languages: list[str]        # in order
    logp: np.ndarray            # (languages, BUCKETS) float32


_LETTERS: list[np.ndarray] = []


def _letter_table() -> np.ndarray:
    if not _LETTERS:
        _LETTERS.append(np.fromiter((chr(i).isalpha() for i in range(sys.maxunicode + 1)), dtype=bool))
    return _LETTERS[0]


def trigrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of every letter, first letter of every word, text of every word)."""
    low = [t.lower() if t else "" for t in texts]
    joined = " " + " ".join(low) + " "
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=_U32)
    letter = _letter_table()[chars]
    clean = np.where(letter, chars, _U32(32))
    at = np.flatnonzero(letter)
    with np.errstate(over="ignore"):
        h = clean[at - 1] * _U32(0x9E3779B1) + clean[at] * _U32(0x85EBCA77) + clean[at + 1] * _U32(0xC2B2AE3D)
        h ^= h >> _U32(15)
        h *= _U32(0x2C1B3C6D)
    bucket = (h >> _U32(32 - 15)).astype(np.int32)
    first = np.flatnonzero(~letter[at - 1])
    begin = 1 + np.cumsum([0] + [len(t) + 1 for t in low])
    return bucket, first, np.searchsorted(begin, at[first], side="right") - 1


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: dict[str, np.ndarray] = {}
    part = 0
    for batch in batches:
        if batch.num_rows:
            part = batch.column("part")[0].as_py()
        for piece in slices(batch, "text"):
            langs = piece.column("lang").to_pylist()
            bucket, first, text = trigrams(piece.column("text").to_pylist())
            if not len(first):
                continue
            names = sorted(set(langs))
            code = np.array([names.index(x) for x in langs])[text]
            per_letter = np.repeat(code, np.diff(np.append(first, len(bucket))))
            counts = np.bincount(per_letter * BUCKETS + bucket, minlength=len(names) * BUCKETS)
            for k, name in enumerate(names):
                seen.setdefault(name, np.zeros(BUCKETS, dtype=np.int64))
                seen[name] += counts[k * BUCKETS:(k + 1) * BUCKETS]
    for name, counts in seen.items():
        blocks = range(BUCKETS // BLOCK)
        yield pa.RecordBatch.from_arrays([
            pa.array([f"{b}:{name}" for b in blocks]), pa.array([part] * len(blocks), pa.int32()),
            pa.array([counts[b * BLOCK:(b + 1) * BLOCK].tobytes() for b in blocks], pa.binary())],
            ["block", "part", "counts"])


def _add(rows: pa.Table) -> pa.Table:
    total = np.zeros(BLOCK, dtype=np.int64)
    for x in rows.column("counts"):
        total += np.frombuffer(x.as_buffer(), dtype=np.int64)
    return pa.table({"block": rows.column("block").slice(0, 1), "part": rows.column("part").slice(0, 1),
                     "counts": pa.array([total.tobytes()], pa.binary())})


def learn_profiles(labelled: DataFrame, max_languages: int = 512) -> Profiles:
    """Profiles from all rows of (text, lang) in which neither is null."""
    small_batches(labelled.sparkSession)
    rows = labelled.select("text", "lang").where("text is not null and lang is not null")
    n = rows.select("lang").distinct().limit(max_languages + 1).count()
    if n > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that is meant")
    schema = "block string, part int, counts binary"
    counted = rows.withColumn("part", F.spark_partition_id()).mapInArrow(_count, schema)
    merged = tree_merge(counted, "block", rows.rdd.getNumPartitions(), _add, schema)
    counts: dict[str, np.ndarray] = {}
    for r in merged.select("block", "counts").toLocalIterator():    # 8 * BUCKETS bytes a language
        b, name = r.block.split(":", 1)
        counts.setdefault(name, np.zeros(BUCKETS))[int(b) * BLOCK:(int(b) + 1) * BLOCK] = np.frombuffer(
            r.counts, dtype=np.int64)
    names = sorted(counts)
    table = np.array([counts[x] for x in names]).reshape(len(names), BUCKETS) + SMOOTH
    return Profiles(names, np.log(table / table.sum(axis=1, keepdims=True)).astype(np.float32))


def _segment_sum(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, first, axis=0) if len(first) else x[:0]


def _em(like: np.ndarray, first: np.ndarray, doc: np.ndarray, share: np.ndarray, rounds: int) -> np.ndarray:
    """Proportions (docs, languages) after ``rounds``; ``like`` (words, languages), ``doc`` the word's document."""
    size = np.diff(np.append(first, len(like)))[:, None]
    for _ in range(rounds):
        joint = like * share[doc]
        joint /= joint.sum(axis=1, keepdims=True)
        share = _segment_sum(joint, first) / size
    return share


def infer(profiles: Profiles, texts: list[str | None], max_set: int, penalty: float, rounds: int):
    """(row of each text that has a letter, its shares over languages); shares outside the chosen set are 0."""
    bucket, first, text = trigrams(texts)
    if not len(first) or not profiles.languages:
        return np.zeros(0, dtype=np.int64), np.zeros((0, len(profiles.languages)))
    n = len(profiles.languages)
    logs = np.stack([np.add.reduceat(profiles.logp[k][bucket], first) for k in range(n)], axis=1).astype(np.float64)
    head = np.flatnonzero(np.append(True, text[1:] != text[:-1]))
    rows = text[head]
    words = np.diff(np.append(head, len(text)))
    doc = np.repeat(np.arange(len(rows)), words)
    top = logs.max(axis=1, keepdims=True)
    like = np.exp(logs - top)
    single = _segment_sum(logs, head)
    best = single.argmax(axis=1)
    share = np.zeros((len(rows), n))
    share[np.arange(len(rows)), best] = 1.0
    if n == 1:
        return rows, share
    full = _em(like, head, doc, np.full((len(rows), n), 1.0 / n), rounds)
    order = np.argsort(-full, axis=1, kind="stable")
    gain = single.max(axis=1)
    open_ = np.flatnonzero(np.take_along_axis(full, order[:, 1:2], axis=1)[:, 0] * words >= 0.5)
    for size in range(2, min(max_set, n) + 1):
        if not len(open_):
            break
        inside = np.zeros((len(rows), n), dtype=bool)
        np.put_along_axis(inside, order[:, :size], True, axis=1)
        pick = np.isin(doc, open_)
        sub_like, sub_words = like[pick], words[open_]
        sub_first = np.cumsum(sub_words) - sub_words
        sub_doc = np.repeat(np.arange(len(open_)), sub_words)
        start = np.where(inside[open_], np.maximum(full[open_], 1e-6), 0.0)
        got = _em(sub_like, sub_first, sub_doc, start / start.sum(axis=1, keepdims=True), max(2, rounds // 2))
        mixed = np.log(np.maximum((sub_like * got[sub_doc]).sum(axis=1), 1e-300)) + top[pick, 0]
        value = _segment_sum(mixed, sub_first) - (size - 1) * penalty * np.log(np.maximum(sub_words, 2))
        better = value > gain[open_]
        share[open_[better]] = got[better]
        gain[open_[better]] = value[better]
        if size < n:
            nxt = np.take_along_axis(full[open_], order[open_, size:size + 1], axis=1)[:, 0]
            open_ = open_[nxt * sub_words >= 0.5]
    return rows, share


def language_mixture(docs: DataFrame, profiles: Profiles, max_set: int | None = None, penalty: float = 2.0,
                     rounds: int = 8, keep_text: bool = True) -> DataFrame:
    """``docs`` plus li_lang, li_score (share of li_lang), li_langs and li_shares (the chosen set, largest first). The set grows as
    long as the penalised likelihood does; ``max_set`` limits it only if given."""
    small_batches(docs.sparkSession)
    docs = own(docs, "li_")
    names = [c for c in docs.columns if keep_text or c != "text"]
    added = [T.StructField("li_lang", T.StringType()), T.StructField("li_score", T.DoubleType()),
             T.StructField("li_langs", T.ArrayType(T.StringType())),
             T.StructField("li_shares", T.ArrayType(T.DoubleType()))]
    max_set = max_set or max(1, len(profiles.languages))
    shared = docs.sparkSession.sparkContext.broadcast(profiles)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for piece in slices(batch, "text"):
                rows, share = infer(model, piece.column("text").to_pylist(), max_set, penalty, rounds)
                lang, score = ["und"] * piece.num_rows, [0.0] * piece.num_rows
                langs: list[list[str]] = [[] for _ in lang]
                shares: list[list[float]] = [[] for _ in lang]
                order = np.argsort(-share, axis=1, kind="stable")[:, :max_set].tolist()
                for i, row in enumerate(rows.tolist()):
                    own_ = [k for k in order[i] if share[i, k] > 0]
                    langs[row] = [model.languages[k] for k in own_]
                    shares[row] = [min(1.0, float(share[i, k])) for k in own_]
                    lang[row], score[row] = langs[row][0], shares[row][0]
                yield pa.RecordBatch.from_arrays(
                    [piece.column(c) for c in names] + [
                        pa.array(lang), pa.array(score, pa.float64()), pa.array(langs, pa.list_(pa.string())),
                        pa.array(shares, pa.list_(pa.float64()))], names + [f.name for f in added])

    return docs.mapInArrow(run, T.StructType([docs.schema[c] for c in names] + added))
