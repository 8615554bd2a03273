"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Vectors are made integer, x = floor(scale * c) + shift, so that their number, sums and deviations from the mean are exact. The leading
eigenvectors of their covariance V (centred before multiplying, divisor n) are found without V itself:

1. One pass over the rows gives V Q for a block Q of orthonormal columns (more than are wanted): the sum of xc (xc' Q) over centred rows xc.
2. Rayleigh-Ritz: the eigenvectors of Q'VQ turn Q into approximations of eigenvectors, with residuals |V q - e q|.
3. Chebyshev filter: a three-term recurrence of such passes applies to Q a polynomial of V that is small on the unwanted part
   of the spectrum, from a lower bound of it (by Lanczos steps of one more column in the first filter's passes) up to the
   block's least Ritz value, and grows fast above. QR makes the columns orthonormal again; back to 2.
4. Certified: all wanted residuals are down to rounding, and a random column of its own, filtered along with the block and made orthogonal to
   the wanted vectors, has no Rayleigh quotient above the last wanted eigenvalue, so none was missed. A last pass measures the
   whitened rows' covariance.

The passes read packed blocks of rows from a written table; tasks add up matrices of dimension x block, which are merged as a tree, so
that what reaches the driver depends on the dimension, not on the number of rows.

Defined results: rows whose vector is null, or holds a null or non-finite entry, are left out; so are vectors whose length is not the
most frequent one (of equals, the largest; the empty one never). Repeated rows count each, and null ids are kept. Components whose eigenvalue
is nothing but rounding (constant or dependent dimensions, a single row) are left out, so fewer may come; equal eigenvalues have any
orthonormal basis. An empty table gives an empty result. Entries beyond 2^61 are held there, and a deviation that a long cannot
hold is null. Columns other than the id and the vector are not read, so none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash, summed

BLOCK_NUMBERS = 1 << 18         # numbers in a packed block of rows
LIMIT = 1 << 61
EXACT = 1 << 62
LOW = (1 << 32) - 1
MAX_DEGREE = 24
FIRST_DEGREE = 10               # before the lower bound is known
MAX_CYCLES = 60


@dataclass(frozen=True)
class Whitening:
    n: int
    sums: list[int]             # of each dimension, exact
    vectors: np.ndarray         # dimension x components, unit columns
    values: np.ndarray          # eigenvalues, falling
    trace: float
    residual: float             # largest |V q - e q| of the components, over the largest eigenvalue
    identity_error: float
    passes: int                 # over the rows
    id_type: str
    big: bool                   # needs more than 64 bits on the way


# ------------------------------------------------------------------ packed rows

def pack(rows: DataFrame, key: str, vector: str, scale: float, shift: int) -> tuple[DataFrame | None, int]:
    """Written blocks (ids, x) of the rows that take part, and their dimension."""
    whole = rows.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        "size(v) > 0 and forall(v, c -> coalesce(not isnan(c) and abs(c) < double('inf'), false))")
    common = whole.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if common is None:
        return None, 0
    d = common.d
    per_block = max(1, BLOCK_NUMBERS // d)
    kind = whole.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
            x = np.clip(np.floor(scale * values), -float(LIMIT), float(LIMIT)).astype(np.int64) + shift
            for lo in range(0, len(x), per_block):
                part = x[lo:lo + per_block]
                ids = batch.column("id").slice(lo, len(part))
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, len(part)], pa.int32()), ids),
                    pa.array([part.tobytes()], pa.binary())], ["ids", "x"])

    blocks = whole.where(F.size("v") == d).mapInArrow(run, f"ids array<{kind.simpleString()}>, x binary")
    return stash(blocks, "vectors"), d


def _matrix(row: dict, d: int) -> np.ndarray:
    return np.frombuffer(row["x"].as_buffer(), dtype=np.int64).reshape(-1, d)


def _add_sums(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[n, 2 x dimension halves of sums, least and largest entries]: halves are carried, so that no sum overflows."""
    d = (len(a) - 1) // 4
    out = a + b
    out[1:1 + d] += out[1 + d:1 + 2 * d] >> 32
    out[1 + d:1 + 2 * d] &= LOW
    out[1 + 2 * d:1 + 3 * d] = np.minimum(a[1 + 2 * d:1 + 3 * d], b[1 + 2 * d:1 + 3 * d])
    out[1 + 3 * d:] = np.maximum(a[1 + 3 * d:], b[1 + 3 * d:])
    return out


def exact_sums(blocks: DataFrame, d: int) -> tuple[int, list[int], bool]:
    """(n, sums, whether n * x or its distance from a sum may not fit a long)."""
    def of(row: dict) -> np.ndarray:
        x = _matrix(row, d)
        return np.concatenate([[len(x)], (x >> 32).sum(0), (x & LOW).sum(0), x.min(0), x.max(0)]).astype(np.int64)

    total = summed(blocks.select("x"), of, 1 + 4 * d, _add_sums, np.int64)
    n, high, low, least, most = int(total[0]), *(total[1 + i * d:1 + (i + 1) * d].tolist() for i in range(4))
    sums = [(h << 32) + x for h, x in zip(high, low)]
    reach = [max(abs(n * a), abs(n * b), abs(n * a - s), abs(n * b - s)) for a, b, s in zip(least, most, sums)]
    return n, sums, max(reach) >= EXACT or sum((n * b - n * a) ** 2 for a, b in zip(least, most)) >= EXACT


def _centred(x: np.ndarray, n: int, sums: list[int], big: bool) -> np.ndarray:
    """n * x - S, exact: as longs, or as Python's numbers where those don't hold it."""
    if big:
        return x.astype(object) * n - np.array(sums, dtype=object)
    return x * np.int64(n) - np.array(sums, dtype=np.int64)


# ------------------------------------------------------------------ the iteration

class Covariance:
    """V as a product with blocks of columns: each is a pass over the rows."""

    def __init__(self, blocks: DataFrame, d: int, n: int, sums: list[int], big: bool):
        self.blocks, self.d, self.n, self.sums, self.big, self.passes = blocks.select("x"), d, n, sums, big, 0

    def __matmul__(self, q: np.ndarray) -> np.ndarray:
        n, sums, big, d = self.n, self.sums, self.big, self.d

        def of(row: dict) -> np.ndarray:
            xc = _centred(_matrix(row, d), n, sums, big).astype(np.float64) / n
            return (xc.T @ (xc @ q)).ravel()

        self.passes += 1
        return summed(self.blocks, of, q.size).reshape(q.shape) / n

    def moments(self, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Mean and covariance of the rows projected on ``p``, and the trace of V."""
        n, sums, big, d, k = self.n, self.sums, self.big, self.d, p.shape[1]

        def of(row: dict) -> np.ndarray:
            xc = _centred(_matrix(row, d), n, sums, big).astype(np.float64) / n
            w = xc @ p
            return np.concatenate([w.sum(0), (w.T @ w).ravel(), [(xc * xc).sum()]])

        self.passes += 1
        total = summed(self.blocks, of, k + k * k + 1) / n
        mean = total[:k]
        return mean, total[k:-1].reshape(k, k) - np.outer(mean, mean), float(total[-1])


class Lanczos:
    """Lanczos steps of one vector, given its products: a lower bound of the spectrum."""

    def __init__(self, start: np.ndarray):
        self.basis, self.alpha, self.beta = [start / np.linalg.norm(start)], [], []

    @property
    def vector(self) -> np.ndarray:
        return self.basis[-1]

    def take(self, product: np.ndarray) -> None:
        if len(self.alpha) == len(self.basis):
            return                                      # the space is used up
        self.alpha.append(float(self.vector @ product))
        rest = product
        for _ in range(2):
            rest = rest - np.array(self.basis).T @ (np.array(self.basis) @ rest)
        self.beta.append(float(np.linalg.norm(rest)))
        if self.beta[-1] > 1e-10 * abs(self.alpha[0]):
            self.basis.append(rest / self.beta[-1])

    def least(self) -> float:
        m = len(self.alpha)
        t = np.diag(self.alpha) + np.diag(self.beta[:m - 1], 1) + np.diag(self.beta[:m - 1], -1)
        e, s = np.linalg.eigh(t)
        return max(0.0, float(e[0] - self.beta[m - 1] * abs(s[-1, 0])) * (1 - 1e-6))


def _degree(top: float, last: float, low: float, cut: float, residual: float) -> int:
    """Steps that bring the residual down to rounding, or as many as leave the columns independent."""
    reach = lambda e: np.arccosh(max(1.0, (2 * e - low - cut) / (cut - low)))       # noqa: E731
    need = np.log(max(residual, 1e-15) / 1e-17) / max(reach(last), 1e-3)
    safe = np.log(1e10) / max(reach(top) - reach(last), 1e-3)
    return int(np.clip(np.ceil(min(need, safe)), 2, MAX_DEGREE))


def _outside(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """``x`` made orthogonal to the columns of ``q``, of length 1 (or 0, if they hold it)."""
    for _ in range(2):
        x = x - q @ (q.T @ x)
    size = np.linalg.norm(x)
    return x / size if size > 1e-12 else np.zeros_like(x)


def leading_eigenvectors(v: Covariance, k: int, guard: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, float]:
    """(values, vectors, residual) of the ``k`` largest eigenvalues, certified; the residual is relative to the largest."""
    d = v.d
    rng = np.random.default_rng(seed)
    width = min(d, k + guard)
    q = np.linalg.qr(rng.standard_normal((d, width)))[0]
    lanczos, beside = Lanczos(rng.standard_normal(d)), rng.standard_normal(d)
    low, before = 0.0, np.inf
    for cycle in range(MAX_CYCLES):
        # Rayleigh-Ritz, with one more column: the Lanczos vector at first, then the probe
        extra = _outside(beside, q[:, :k]) if cycle else lanczos.vector
        w = v @ np.column_stack([q, extra])
        w, product = w[:, :-1], w[:, -1]
        t = q.T @ w
        values, turn = np.linalg.eigh((t + t.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, w = q @ turn, w @ turn
        top = float(values[0])
        if top <= 0:
            return values[:0], q[:, :0], 0.0            # all rows are alike
        residual = float(np.linalg.norm(w[:, :k] - q[:, :k] * values[:k], axis=0).max()) / top
        settled = residual <= 3e-15 or residual <= 1e-12 and residual > before / 4
        missed = float(extra @ product) > values[k - 1] + 1e-9 * top
        if settled and (width == d or cycle and not missed):
            return values[:k], q[:, :k], residual
        if cycle == 0:
            lanczos.take(product)
        before = residual
        # the filter: the recurrence of Chebyshev's polynomials on [low, cut]
        cut = max(float(values[-1]), low + 1e-9 * top)
        degree = min(_degree(top, float(values[k - 1]), low, cut, residual), MAX_DEGREE if cycle else FIRST_DEGREE)
        centre, half = (cut + low) / 2, (cut - low) / 2
        y = np.column_stack([q, extra]) if cycle else q
        old = np.zeros_like(y)
        for step in range(degree):
            w = v @ (y if cycle else np.column_stack([y, lanczos.vector]))
            if cycle == 0:
                lanczos.take(w[:, -1])
                w = w[:, :-1]
            w = (w - centre * y) / half
            old, y = y, (w if step == 0 else 2 * w - old)
            size = np.linalg.norm(y, axis=0).max()
            old, y = old / size, y / size
        q = np.linalg.qr(y[:, :width])[0]
        beside = y[:, -1] if cycle else rng.standard_normal(d)
        low = lanczos.least()
    raise RuntimeError(f"no certified eigenvectors after {MAX_CYCLES} cycles (residual {before:.1e})")


def fit_whitening(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, guard: int = 16,
                  scale: float = 64.0, shift: int = 1_000_000) -> tuple[Whitening | None, DataFrame | None]:
    """The whitening of all rows, and their packed blocks; (None, None) if no row takes part."""
    blocks, d = pack(rows, key, vector, scale, shift)
    if blocks is None:
        return None, None
    n, sums, big = exact_sums(blocks, d)
    v = Covariance(blocks, d, n, sums, big)
    values, vectors, residual = leading_eigenvectors(v, min(components, d), guard)
    real = values > 1e-13 * values[:1].sum()
    values, vectors = values[real], vectors[:, real]
    mean, cov, trace = v.moments(vectors / np.sqrt(values))
    error = float(np.abs(cov - np.eye(len(values))).max()) if len(values) else 0.0
    return Whitening(n, sums, vectors, values, trace, residual, error, v.passes, blocks.schema["ids"].dataType.elementType.simpleString(), big), blocks


def whiten(model: Whitening, blocks: DataFrame) -> DataFrame:
    """A row for each packed row and component: id, component, n, deviation, whitened, explained, identity_error."""
    n, sums, big, k = model.n, model.sums, model.big, len(model.values)
    project = model.vectors / np.sqrt(model.values)
    explained, error = model.values / (model.trace or 1.0), model.identity_error

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, x = batch.column("ids")[i].values, _matrix({"x": batch.column("x")[i]}, len(sums))
                for lo in range(0, len(x), 1024):
                    far = _centred(x[lo:lo + 1024], n, sums, big)
                    m = len(far)
                    deviation = pa.array((far * far).sum(axis=1).tolist() if not big else [
                        t if t < 1 << 63 else None for t in (far * far).sum(axis=1).tolist()], pa.int64())
                    of = pa.array(np.repeat(np.arange(m), k))
                    yield pa.RecordBatch.from_arrays([
                        ids.slice(lo, m).take(of), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, n)), deviation.take(of), pa.array(((far.astype(np.float64) / n) @ project).ravel()),
                        pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                        ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.mapInArrow(run, WHITENED.format(model.id_type))


WHITENED = "id {}, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitened_components(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = 32, **more) -> DataFrame:
    """``whiten`` of ``fit_whitening``, empty if no row takes part."""
    model, blocks = fit_whitening(rows, key, vector, components, **more)
    if model is None or not len(model.values):
        return rows.sparkSession.createDataFrame([], WHITENED.format(rows.schema[key].dataType.simpleString()))
    return whiten(model, blocks)
