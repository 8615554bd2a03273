"""Helpers the operators of this subpackage share: tables, shared scratch tables, byte-level text kernels.

The numpy kernels work on the UTF-8 bytes of many texts at once (the buffers of an Arrow
string column), so nothing here loops over words or characters in Python.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fieldstack.session import checkpoint_dir

#: Words are runs of anything but these six bytes (space, \t \n \v \f \r).
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U64 = np.uint64
_BASE = pow(0x9E3779B97F4A7C15, 3, 1 << 64) | 1
_BASE2 = pow(0xC2B2AE3D27D4EB4F, 3, 1 << 64) | 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows in an Arrow batch than Spark's default, for tables of whole texts: a batch stands in the memory of
    the JVM and of the Python worker at once. A smaller setting of the session stays."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def own(df: DataFrame, *names: str) -> DataFrame:
    """``df`` without the columns an operator is about to add (a name that ends in ``_`` is a prefix)."""
    return df.drop(*[c for c in df.columns if any(c == n or n.endswith("_") and c.startswith(n) for n in names)])


def tree_merge(rows: DataFrame, key: str, parts: int, merge, schema: str, fan_in: int = 64) -> DataFrame:
    """Fold the rows of each ``key`` (and int column ``part``, of 0 to parts - 1) into one, ``fan_in`` at a time, so
    that no task takes more than so many however many tasks made them. ``merge``: Arrow table to Arrow table."""
    while True:
        last = parts <= fan_in
        rows = (rows.withColumn("part", F.lit(0) if last else F.expr(f"cast(part div {fan_in} as int)"))
                .groupBy(key, "part").applyInArrow(merge, schema))
        if last:
            return rows
        parts = -(-parts // fan_in)


ROWS_PER_FILE = 200_000


def files_for(rows: int) -> int:
    return max(1, -(-rows // ROWS_PER_FILE))


def stash(df: DataFrame, name: str, files: int | None = None) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: cuts the lineage with files
    that outlive any executor. ``files``: into so many, for narrow tables of a known size; else a file for each task."""
    if files is not None:
        df = df.repartition(files)
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------------ Arrow batches of texts

def slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``max_bytes`` of text each (one row at least)."""
    offs = offsets(batch.column(column))
    lo = 0
    while lo < batch.num_rows:
        hi = int(np.searchsorted(offs, offs[lo] + max_bytes, side="right")) - 1
        hi = min(max(hi, lo + 1), batch.num_rows)
        yield batch.slice(lo, hi - lo)
        lo = hi
    give_back()


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Return freed memory to the system: idle Python workers stand beside busy ones in an executor's memory."""
    pa.default_memory_pool().release_unused()
    if _TRIM:
        _TRIM(0)


def offsets(arr: pa.Array) -> np.ndarray:
    kind = np.int64 if pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type) else np.int32
    if len(arr) == 0:
        return np.zeros(1, dtype=np.int64)
    raw = np.frombuffer(arr.buffers()[1], dtype=kind, count=arr.offset + len(arr) + 1)
    return raw[arr.offset:].astype(np.int64)


def flat(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string column; a null is an empty text."""
    if arr.null_count:
        arr = arr.fill_null("")
    offs = offsets(arr)
    data = arr.buffers()[2] if len(arr) else None
    if data is None:
        return np.zeros(0, dtype=np.uint8), offs - offs[0]
    return np.frombuffer(data, dtype=np.uint8)[offs[0]:offs[-1]], offs - offs[0]


# ------------------------------------------------------------------ words, lines, hashes

def word_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of every word; words never span two texts."""
    solid = ~SPACE[buf]
    left = np.empty(len(buf), dtype=bool)
    left[1:] = ~solid[:-1]
    right = np.empty(len(buf), dtype=bool)
    right[:-1] = left[1:]
    right[:-1] = ~solid[1:]
    inner = offs[:-1][np.diff(offs) > 0]
    if len(buf):
        left[inner] = True
        right[offs[1:][np.diff(offs) > 0] - 1] = True
    starts = np.flatnonzero(solid & left)
    ends = np.flatnonzero(solid & right) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


def line_spans(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text index) of every \\n-split line; an empty text has one empty line."""
    nl = np.flatnonzero(buf == 10)
    count = np.diff(np.searchsorted(nl, offs)) + 1
    first = np.cumsum(count) - count
    total = int(count.sum())
    starts, ends = np.empty(total, dtype=np.int64), np.empty(total, dtype=np.int64)
    is_first = np.zeros(total, dtype=bool)
    is_first[first] = True
    is_last = np.zeros(total, dtype=bool)
    is_last[first + count - 1] = True
    starts[is_first], starts[~is_first] = offs[:-1], nl + 1
    ends[is_last], ends[~is_last] = offs[1:], nl
    return starts, ends, np.repeat(np.arange(len(count)), count)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (xor-shift multiply)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> U64(27))
    h = h * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}
_CODE = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 12)
        with np.errstate(over="ignore"):
            up = np.full(size, base, dtype=U64)
            up[0] = 1
            down = np.full(size, pow(base, -1, 1 << 64), dtype=U64)
            down[0] = 1
            have = _POWERS[base] = (np.multiply.accumulate(up), np.multiply.accumulate(down))
    return have


class SpanHash:
    """64-bit hashes of any byte spans of one buffer, from one prefix sum.

    A span's hash is sum(code[byte] * base^i) shifted back to its own start, so equal bytes
    hash alike wherever they stand."""

    def __init__(self, buf: np.ndarray, lower: bool = False, second: bool = False):
        self.base = _BASE2 if second else _BASE
        code = _CODE[LOWER] if lower else _CODE
        self.prefix = np.zeros(len(buf) + 1, dtype=U64)
        with np.errstate(over="ignore"):
            np.cumsum(code[buf] * _powers(self.base, len(buf) + 1)[0][:len(buf)], out=self.prefix[1:])

    def __call__(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            down = _powers(self.base, len(self.prefix))[1]
            h = (self.prefix[ends] - self.prefix[starts]) * down[starts]
            return mix(h + (ends - starts).astype(U64) * U64(0xD6E8FEB86659FD93))


# ------------------------------------------------------------------ Bloom filters

SEGMENT = 4096          # bytes of a filter that are merged as one row
HASHES = 4


def filter_bits(rows: int, bits_per_row: int = 128, max_bits: int = 1 << 29) -> int:
    want = max(rows * bits_per_row, SEGMENT * 8)
    return min(max_bits, 1 << (want - 1).bit_length())


def bit_places(h: np.ndarray, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        step = (h >> U64(33)) | U64(1)
        return np.stack([(h + U64(i) * step) & U64(bits - 1) for i in range(HASHES)]).astype(np.int64)


def mark_bits(bits: np.ndarray, places: np.ndarray) -> None:
    np.bitwise_or.at(bits, (places >> 3).ravel(), np.left_shift(1, places & 7).astype(np.uint8).ravel())


def bits_hold(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=0)


def key_filter(keys: DataFrame, max_bits: int = 1 << 29) -> tuple[bytes, int]:
    """(filter, bits) of a column of 64-bit hashes; at most ``max_bits`` / 8 bytes reach the driver."""
    name = keys.columns[0]
    bits = filter_bits(keys.count(), 16, max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, part = np.zeros(bits // 8, dtype=np.uint8), 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
                mark_bits(mine, bit_places(batch.column(name).to_numpy(zero_copy_only=False).view(U64), bits))
        for i in np.flatnonzero(mine.reshape(-1, SEGMENT).any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array(
                [mine[i * SEGMENT:(i + 1) * SEGMENT].tobytes()], pa.binary())], ["seg", "part", "bits"])

    def fold(rows: pa.Table) -> pa.Table:
        mine = np.zeros(SEGMENT, dtype=np.uint8)
        for x in rows.column("bits"):
            mine |= np.frombuffer(x.as_buffer(), dtype=np.uint8)
        return pa.table({"seg": rows.column("seg").slice(0, 1), "part": rows.column("part").slice(0, 1),
                         "bits": pa.array([mine.tobytes()], pa.binary())})

    schema = "seg int, part int, bits binary"
    rows = keys.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in tree_merge(rows, "seg", keys.rdd.getNumPartitions(), fold, schema).select("seg", "bits").toLocalIterator():
        out[r.seg * SEGMENT:(r.seg + 1) * SEGMENT] = np.frombuffer(r.bits, dtype=np.uint8)
    return out.tobytes(), bits


# ------------------------------------------------------------------ sums over a table of packed matrices

def summed(blocks: DataFrame, of, width: int, add=np.add, dtype=np.float64) -> np.ndarray | None:
    """The sum (or ``add``) over the rows of ``blocks`` of ``of``(row as dict of Arrow scalars' buffers or values): arrays of
    ``width`` numbers. A task adds its rows up, tasks are added ``fan_in`` at a time; one array reaches the driver, none for no rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, part = None, 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            for i in range(batch.num_rows):
                value = of({c: batch.column(c)[i] for c in batch.schema.names})
                mine = value if mine is None else add(mine, value)
        if mine is not None:
            yield pa.RecordBatch.from_arrays([pa.array([0], pa.int32()), pa.array([part], pa.int32()), pa.array(
                [np.ascontiguousarray(mine, dtype=dtype).tobytes()], pa.binary())], ["key", "part", "total"])

    def fold(rows: pa.Table) -> pa.Table:
        rows, mine = rows.sort_by("total"), None        # in one order, whichever task came first
        for x in rows.column("total"):
            value = np.frombuffer(x.as_buffer(), dtype=dtype)
            mine = value if mine is None else add(mine, value)
        return pa.table({"key": rows.column("key").slice(0, 1), "part": rows.column("part").slice(0, 1),
                         "total": pa.array([mine.tobytes()], pa.binary())})

    schema = "key int, part int, total binary"
    rows = blocks.withColumn("part", F.spark_partition_id()).mapInArrow(run, schema)
    found = tree_merge(rows, "key", blocks.rdd.getNumPartitions(), fold, schema).select("total").collect()     # one row
    return np.frombuffer(found[0].total, dtype=dtype)[:width] if found else None
