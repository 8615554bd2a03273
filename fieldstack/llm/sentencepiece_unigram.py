"""SentencePiece unigram encoding and decoding over a double-array trie.

A text is encoded as the sequence of pieces with the largest sum of log scores (Viterbi). White space marks: each
space is the mark U+2581 of the pieces, and a text starts with one more (the dummy prefix). A character that no
piece starts with falls back to the pieces of its UTF-8 bytes. Decoding joins pieces and bytes, turns marks to spaces and
takes the first one away, so a text comes back exactly: a mark in the text itself is encoded by bytes.

Texts are cut into chunks where no piece reaches across: before a space that follows something else, and around line
ends if no piece holds one. The best path of a text is the best paths of its chunks. The chunks of many texts are reduced
to distinct ones and new ones are solved side by side with numpy, one trie step for all of them at a time; long chunks
one by one. Solved chunks are remembered up to a bound.

The vocabulary file is read where the job starts; its trie is broadcast (its size is the vocabulary's). Where a file holds a
merge-ranked (BPE) vocabulary, its scores are ranks and no log probabilities: ``zipf_scores`` takes log p = -ln(rank + 2).

Defined results: a null text has null ids; an empty text has none. Rows are encoded one by one, repeated rows alike;
extra columns pass through, and those of the added names are replaced. Ids that no text has (bytes that are no UTF-8)
decode with U+FFFD; ids outside the vocabulary and control pieces decode to nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import flat, own, slices, small_batches

MARK = "▁"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"
LONG = 48               # bytes of a chunk that is solved on its own
REMEMBER = 1 << 17      # chunks
WINDOW = 256            # bases that the trie's builder tries at a time


@dataclass(frozen=True)
class Vocabulary:
    pieces: list[bytes]         # by id; a mark is a space; empty where nothing is decoded
    scores: np.ndarray          # by id
    byte_ids: np.ndarray        # id of every byte's piece
    normal: np.ndarray          # by id: pieces that texts are matched with
    unk_score: float


def zipf_scores(ranks: np.ndarray) -> np.ndarray:
    return -np.log(ranks + 2.0)


def load_vocabulary(path: str = VOCABULARY, zipf: bool = True) -> Vocabulary:
    """Pieces and scores of a .model file with byte fallback. ``zipf``: the scores are negated ranks."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    text = [sp.id_to_piece(i) for i in range(n)]
    byte = np.array([sp.is_byte(i) for i in range(n)])
    other = np.array([sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)])
    scores = np.array([sp.get_score(i) for i in range(n)], dtype=np.float64)
    byte_ids = np.zeros(256, dtype=np.int32)
    pieces = [b""] * n
    for i in range(n):
        if byte[i]:
            byte_ids[int(text[i][1:-1], 16)] = i
            pieces[i] = bytes([int(text[i][1:-1], 16)])
        elif not other[i]:
            pieces[i] = text[i].replace(MARK, " ").encode()
    if byte.sum() != 256:
        raise ValueError("the vocabulary has no byte pieces")
    normal = ~byte & ~other
    if zipf:
        scores = np.where(normal, zipf_scores(np.maximum(-scores, 0)), 0.0)
    return Vocabulary(pieces, scores, byte_ids, normal, float(scores[normal].min()) - 10.0)


@dataclass(frozen=True)
class DoubleArray:
    """From node s, byte b leads to t = base[s] + b + 1 if check[t] == s; value[t] is the id of the piece that ends there or -1."""
    base: np.ndarray
    check: np.ndarray
    value: np.ndarray


def build_trie(keys: dict[bytes, int]) -> DoubleArray:
    tree: dict = {}
    for key, ident in keys.items():
        at = tree
        for b in key:
            at = at.setdefault(b, {})
        at[-1] = ident
    base, check, value, used = [0] * 257, [-1] * 257, [-1] * 257, np.zeros(257, dtype=bool)
    used[0] = True
    todo, free, dense = [(0, tree)], 257, 0     # places below dense are left to nodes of one child
    while todo:
        s, node = todo.pop()
        value[s] = node.get(-1, -1)
        kids = sorted(b for b in node if b >= 0)
        if not kids:
            continue
        while free < len(used) and used[free]:
            free += 1
        b = max(0, free - kids[0] - 1) if len(kids) == 1 else max(dense, free - kids[0] - 1, 0)
        # the least base from here on where all children find a free place, a window at a time
        while len(kids) > 1:
            taken = np.zeros(WINDOW, dtype=bool)
            for k in kids:
                row = used[b + k + 1:b + k + 1 + WINDOW]
                taken[:len(row)] |= row
            at = int(taken.argmin())
            if not taken[at]:
                b += at
                break
            b += WINDOW
            dense = max(dense, b - 4 * WINDOW)
        if b + 257 >= len(used):
            grow = b + 258
            for table, empty in ((base, 0), (check, -1), (value, -1)):
                table.extend([empty] * grow)
            used = np.concatenate([used, np.zeros(grow, dtype=bool)])
        base[s] = b
        for k in kids:
            used[b + k + 1] = True
            check[b + k + 1] = s
            todo.append((b + k + 1, node[k]))
    pad = [0] * 257     # a step from any node stays inside the arrays
    return DoubleArray(np.array(base + pad, dtype=np.int32), np.array(check + [-1] * 257, dtype=np.int32),
                       np.array(value + [-1] * 257, dtype=np.int32))


class Encoder:
    """Encodes many texts at once; keeps what it solved."""

    def __init__(self, vocab: Vocabulary, trie: DoubleArray):
        self.v, self.t = vocab, trie
        self.scores = vocab.scores
        self.cut_lines = not any(b"\n" in p for p, n in zip(vocab.pieces, vocab.normal) if n)
        self.known: dict[bytes, tuple[int, int]] = {}
        self.ids = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    # -------------------------------------------------------------- chunks

    def _starts(self, buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
        space = buf == 0x20
        cut = np.zeros(len(buf), dtype=bool)
        cut[1:] = space[1:] & ~space[:-1]
        if self.cut_lines:
            line = buf == 0x0A
            cut |= line
            cut[1:] |= line[:-1]
        cut[offs[:-1]] = True
        return np.flatnonzero(cut)

    def encode(self, buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets) of texts given as bytes and offsets; empty texts have no ids."""
        n = len(offs) - 1
        size = np.diff(offs)
        has = size > 0
        # a space before every text that isn't empty
        shift = np.cumsum(has)
        out = np.full(len(buf) + int(shift[-1]) if n else 0, 0x20, dtype=np.uint8)
        text = np.repeat(np.arange(n), size)
        out[np.arange(len(buf)) + shift[text]] = buf
        head = (offs[:-1] + shift - has)[has]
        if not len(out):
            return np.zeros(0, dtype=np.int32), np.zeros(n + 1, dtype=np.int64)
        starts = self._starts(out, np.append(head, len(out)))
        bounds = np.append(starts, len(out)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(out)])
        coded = chunks.dictionary_encode()
        lo, count = self._solve(coded.dictionary.to_pylist())
        which = coded.indices.to_numpy()
        lo, count = lo[which], count[which]
        ends = np.cumsum(count)
        ids = self.ids[np.repeat(lo - (ends - count), count) + np.arange(int(ends[-1]))]
        first = np.searchsorted(starts, head)          # first chunk of each text that isn't empty
        total = np.zeros(n, dtype=np.int64)
        total[has] = np.add.reduceat(count, first)
        return ids, np.concatenate([[0], np.cumsum(total)])

    def _solve(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) + len(chunks) > REMEMBER:
            self.known, self.used = {}, 0
        known = self.known
        new = [c for c in chunks if c not in known]
        short = sorted((c for c in new if len(c) <= LONG), key=len)
        for i in range(0, len(short), 4096):
            self._lanes(short[i:i + 4096])
        for c in new:
            if len(c) > LONG:
                self._keep([c], *self._one(c))
        where = np.array([known[c] for c in chunks], dtype=np.int64).reshape(-1, 2)
        return where[:, 0], where[:, 1]

    def _keep(self, chunks: list[bytes], ids: np.ndarray, counts: np.ndarray) -> None:
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used:self.used + len(ids)] = ids
        lo = self.used + np.cumsum(counts) - counts
        self.known.update(zip(chunks, zip(lo.tolist(), counts.tolist())))
        self.used += len(ids)

    # -------------------------------------------------------------- Viterbi

    def _lanes(self, chunks: list[bytes]) -> None:
        """Chunks of like length side by side: a row each."""
        n, width = len(chunks), len(chunks[-1])
        size = np.array([len(c) for c in chunks])
        text = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in chunks), dtype=np.uint8).reshape(n, width)
        inside = np.arange(width)[None, :] < size[:, None]
        is_head = ((text & 0xC0) != 0x80) & inside
        t = self.t
        best = np.full((n, width + 1), -np.inf)
        best[:, 0] = 0.0
        back = np.zeros((n, width + 1), dtype=np.int32)
        piece = np.full((n, width + 1), -1, dtype=np.int32)
        for i in range(width):
            lane = np.flatnonzero(is_head[:, i])
            if not len(lane):
                continue
            length = np.ones(len(lane), dtype=np.int64)         # of the character at i
            for k in range(1, 4):
                if i + k < width:
                    length += (length == k) & inside[lane, i + k] & ((text[lane, i + k] & 0xC0) == 0x80)
            alone = np.zeros(n, dtype=bool)                      # a piece of just this character was found
            char_end = np.zeros(n, dtype=np.int64)
            char_end[lane] = i + length
            node, at, go = np.zeros(len(lane), dtype=np.int64), i, lane
            while len(go) and at < width:
                ok = inside[go, at]
                go, node = go[ok], node[ok]
                nxt = t.base[node] + text[go, at] + 1
                ok = t.check[nxt] == node
                go, node, at = go[ok], nxt[ok].astype(np.int64), at + 1
                ident = t.value[node]
                hit = ident >= 0
                rows, found = go[hit], ident[hit]
                alone[rows[char_end[rows] == at]] = True
                score = best[rows, i] + self.scores[found]
                up = score > best[rows, at]
                rows = rows[up]
                best[rows, at], back[rows, at], piece[rows, at] = score[up], i, found[up]
            rows = lane[~alone[lane]]
            ends = char_end[rows]
            score = best[rows, i] + self.v.unk_score
            up = score > best[rows, ends]
            rows, ends = rows[up], ends[up]
            best[rows, ends], back[rows, ends], piece[rows, ends] = score[up], i, -1
        # walk back all lanes together: one (lane, position) step at a time
        lane, at = np.arange(n), size.copy()
        steps = []
        while len(lane):
            steps.append((lane, back[lane, at].astype(np.int64), at, piece[lane, at]))
            at = steps[-1][1]
            lane, at = lane[at > 0], at[at > 0]
        lane, lo, hi, ident = (np.concatenate(x) for x in zip(*steps))
        order = np.lexsort((lo, lane))
        lane, lo, hi, ident = lane[order], lo[order], hi[order], ident[order]
        width_ = np.where(ident < 0, hi - lo, 1)
        ids = np.repeat(ident, width_)
        unk = np.flatnonzero(ids < 0)
        within = np.arange(len(ids)) - np.repeat(np.cumsum(width_) - width_, width_)
        ids[unk] = self.v.byte_ids[text[np.repeat(lane, width_)[unk], (np.repeat(lo, width_) + within)[unk]]]
        self._keep(chunks, ids, np.bincount(lane, weights=width_, minlength=n).astype(np.int64))

    def _one(self, chunk: bytes) -> tuple[np.ndarray, np.ndarray]:
        base, check, value, scores = self.t.base, self.t.check, self.t.value, self.scores
        n = len(chunk)
        best, back, piece = [float("-inf")] * (n + 1), [0] * (n + 1), [-1] * (n + 1)
        best[0] = 0.0
        for i in range(n):
            if chunk[i] & 0xC0 == 0x80:
                continue
            end = i + 1
            while end < n and chunk[end] & 0xC0 == 0x80:
                end += 1
            node, at, alone = 0, i, False
            while at < n:
                nxt = int(base[node]) + chunk[at] + 1
                if check[nxt] != node:
                    break
                node, at = nxt, at + 1
                ident = int(value[node])
                if ident >= 0:
                    alone |= at == end
                    score = best[i] + float(scores[ident])
                    if score > best[at]:
                        best[at], back[at], piece[at] = score, i, ident
            if not alone and best[i] + self.v.unk_score > best[end]:
                best[end], back[end], piece[end] = best[i] + self.v.unk_score, i, -1
        out: list[int] = []
        at = n
        while at:
            out.extend([piece[at]] if piece[at] >= 0 else [int(self.v.byte_ids[b]) for b in chunk[back[at]:at][::-1]])
            at = back[at]
        return np.array(out[::-1], dtype=np.int32), np.array([len(out)])


def decode_ids(vocab: Vocabulary, ids: list[int] | None) -> str | None:
    if ids is None:
        return None
    raw = b"".join(vocab.pieces[i] for i in ids if i is not None and 0 <= i < len(vocab.pieces))
    return raw.removeprefix(b" ").decode("utf-8", "replace")


class Decoder:
    """Decodes many lists of ids at once."""

    def __init__(self, vocab: Vocabulary):
        self.n = len(vocab.pieces)
        self.size = np.array([len(p) for p in vocab.pieces] + [0])
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(vocab.pieces), dtype=np.uint8)

    def decode(self, ids: np.ndarray, offs: np.ndarray) -> list[str]:
        ids = np.where((ids >= 0) & (ids < self.n), ids, self.n)
        out = []
        for lo, hi in zip(offs[:-1].tolist(), offs[1:].tolist()):
            part = ids[lo:hi]
            ends = np.cumsum(self.size[part])
            at = np.repeat(self.start[part] - (ends - self.size[part]), self.size[part]) + np.arange(int(ends[-1]) if len(part) else 0)
            out.append(self.data[at].tobytes().removeprefix(b" ").decode("utf-8", "replace"))
        return out


def _shared(spark, vocab: Vocabulary):
    keys = {p: i for i, p in enumerate(vocab.pieces) if vocab.normal[i] and p}
    return spark.sparkContext.broadcast((vocab, build_trie(keys)))


def encode(docs: DataFrame, vocab: Vocabulary, ids: str = "token_ids", check: str | None = None) -> DataFrame:
    """``docs`` plus the ids of ``text``. ``check`` names a column that says whether the ids decode to the very text (null: null)."""
    small_batches(docs.sparkSession)
    docs = own(docs, ids, *([check] if check else []))
    shared = _shared(docs.sparkSession, vocab)
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType()))] + ([T.StructField(check, T.BooleanType())] if check else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = Encoder(*shared.value), Decoder(shared.value[0])
        for batch in batches:
            for piece in slices(batch, "text"):
                column = piece.column("text")
                got, offs = encoder.encode(*flat(column))
                null = column.is_null()
                added = [pa.ListArray.from_arrays(pa.array(offs.astype(np.int32)), pa.array(got), mask=null)]
                if check:
                    added.append(pc.equal(pa.array(decoder.decode(got, offs), pa.string()), column.cast(pa.string())))
                yield pa.RecordBatch.from_arrays([*piece.columns, *added], [*piece.schema.names, *(f.name for f in fields)])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields]))


def decode(docs: DataFrame, vocab: Vocabulary, ids: str = "token_ids", text: str = "decoded") -> DataFrame:
    """``docs`` plus the text of the ids."""
    small_batches(docs.sparkSession)
    docs = own(docs, text)
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(shared.value)
        for batch in batches:
            lists = batch.column(ids)
            offs = np.asarray(lists.offsets).astype(np.int64)
            got = lists.values.fill_null(-1).to_numpy(zero_copy_only=False)[offs[0]:offs[-1]].astype(np.int64)
            out = decoder.decode(got, offs - offs[0])
            texts = pa.array([None if z else x for x, z in zip(out, lists.is_null().to_pylist())], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, text])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(text, T.StringType())]))
