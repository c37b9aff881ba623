"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

A block Q of orthonormal columns is multiplied by the covariance V without ever forming it:
one Spark pass sums (x - mean) (x - mean)^T Q over all rows, in parts of the rows. A Chebyshev
polynomial of V, by its three-term recurrence one pass a degree, damps the spectrum between 0
and a cut and lifts what is above. Then QR makes the columns orthonormal, and Rayleigh-Ritz
gives eigenvalue and eigenvector estimates, with the residuals that certify them. The cut is
the least Ritz value of the block, which has more columns than are wanted.

Entries are whole numbers, so sums and distances from the mean are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.llm.common import Scratch, fields, map_arrow, read

COMPONENTS = 8
#: Columns of the block beyond the components; they keep the cut away from the wanted spectrum.
GUARD = 24
#: Degree of the polynomial, one pass over the data for each.
DEGREE = 8
#: Largest residual norm |V q - e q| of a certified component, as a share of the greatest eigenvalue.
TOLERANCE = 1e-12
#: Filters after which an uncertified component is an error.
MAX_FILTERS = 200
#: An eigenvalue below this share of the greatest counts as 0 and has no component.
RANK_SHARE = 1e-10

SCALE, SHIFT = 1024.0, 100_000
#: Vectors that are worked on at once.
_ROWS = 4096


class NotCertified(RuntimeError):
    """The components did not settle within MAX_FILTERS filters."""


@dataclass
class Whitening:
    """Of the fit list: its size, exact sums, eigenvalues, their share, eigenvectors by column."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    explained: np.ndarray
    vectors: np.ndarray
    identity_error: float
    passes: int


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    """Each entry c as the whole number floor(1024 c) + 100000, computed in double precision."""
    return np.floor(vectors.astype(np.float64) * SCALE).astype(np.int64) + SHIFT


def _centred(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """x - mean from the exact whole number n x - S."""
    return _distance(x, sums, n).astype(np.float64) / n


def _distance(x: np.ndarray, sums: np.ndarray, n: int) -> np.ndarray:
    """n x - S exactly: as int64 where that is wide enough, as Python's integers beyond."""
    reach = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) * n + max((abs(int(s)) for s in sums), default=0)
    if reach < 1 << 62:
        return x * n - sums.astype(np.int64)
    return x.astype(object) * n - sums


def _deviation(distance: np.ndarray) -> list[int | None]:
    """The exact sum of squares of each row; None where it is no 64-bit integer."""
    most = max(abs(int(distance.max(initial=0))), abs(int(distance.min(initial=0))))
    if most * most * max(distance.shape[1], 1) < 1 << 63:
        return (distance.astype(np.int64) ** 2).sum(axis=1).tolist()
    found = (distance.astype(object) ** 2).sum(axis=1)
    return [int(v) if v < 1 << 63 else None for v in found]


def _usable(column: Column) -> Column:
    """Neither null nor with an entry that is null, not finite, or beyond 2 ** 43 (x would not fit with room to sum)."""
    bound = float(1 << 43)
    return column.isNotNull() & F.forall(column, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= bound))


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return pc.list_flatten(column).to_numpy(zero_copy_only=False).reshape(len(column), size)


def _blocks_of(vectors: DataFrame, size: int) -> DataFrame:
    """The vectors alone, as blocks of rows in one binary value each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), _ROWS):
                own = _matrix(batch.column("_vector").slice(lo, _ROWS), size).astype(np.float64)
                narrow = own.astype(np.float32)
                own = narrow if (narrow == own).all() else own
                yield pa.RecordBatch.from_arrays([pa.array([own.itemsize], pa.int32()), pa.array([own.tobytes()], pa.binary())], names=["width", "block"])

    return map_arrow(vectors, run, "width int, block binary")


def _rows_of(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for width, block in zip(batch.column("width").to_pylist(), batch.column("block"), strict=True):
            yield whole_numbers(np.frombuffer(block.as_buffer(), np.dtype(f"f{width}")).reshape(-1, size))


class _Passes:
    """Sums over all rows of the blocks, each one Spark job.

    A task adds up its own rows and gives one row a cell; cells are summed by Spark. The driver
    gets as many numbers as the sum has cells, however many rows there are.
    """

    def __init__(self, blocks: DataFrame, size: int):
        self.blocks, self.size, self.count = blocks, size, 0

    def total(self, cells: int, of: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(cells)
            for x in _rows_of(batches, size):
                total += of(x).ravel()
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], names=["cell", "part"])

        self.count += 1
        rows = map_arrow(self.blocks, run, "cell int, part double").groupBy("cell").agg(F.sum("part").alias("part")).collect()
        out = np.zeros(cells)
        for cell, part in rows:
            out[cell] = part
        return out

    def exact_sums(self) -> tuple[int, np.ndarray]:
        """Rows, and the exact sum of each dimension."""
        size = self.size

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(size + 1, object)
            for x in _rows_of(batches, size):
                high, low = x >> 20, x & ((1 << 20) - 1)
                total[:size] += high.sum(axis=0).astype(object) * (1 << 20) + low.sum(axis=0).astype(object)
                total[size] += len(x)
            low = [int(t) & ((1 << 40) - 1) for t in total]
            high = [int(t) >> 40 for t in total]
            yield pa.RecordBatch.from_arrays([pa.array(range(size + 1), pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["cell", "high", "low"])

        self.count += 1
        rows = map_arrow(self.blocks, run, "cell int, high long, low long").groupBy("cell").agg(F.sum("high"), F.sum("low")).collect()
        sums = np.zeros(size + 1, object)
        for cell, high, low in rows:
            sums[cell] = high * (1 << 40) + low
        return int(sums[size]), sums[:size]


def chebyshev(times: Callable[[np.ndarray], np.ndarray], q: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """The polynomial of V that stays small on [0, cut], scaled to 1 at ``top``, times q."""
    half = centre = cut / 2
    first = sigma = half / (top - centre)
    before, now = q, (times(q) - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (2 / first - sigma)
        before, now = now, (times(now) - centre * now) * (2 * after / half) - (sigma * after) * before
        sigma = after
    return now


def leading(times: Callable[[np.ndarray], np.ndarray], size: int, wanted: int, guard: int = GUARD, degree: int = DEGREE, tolerance: float = TOLERANCE) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` greatest eigenvalues and unit eigenvectors of V, given by ``times(q) = V q``.

    Ends when every residual is certified; raises ``NotCertified`` otherwise.
    """
    q = np.linalg.qr(np.random.default_rng(11).standard_normal((size, min(size, wanted + guard))))[0]
    for _ in range(MAX_FILTERS):
        z = times(q)
        h = q.T @ z
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        residual = np.linalg.norm(z - q * values, axis=0)[:wanted]
        if residual.max() <= tolerance * max(values[0], 0):
            return values[:wanted], q[:, :wanted]
        cut = max(values[-1], values[0] * 1e-14)
        if cut >= values[0]:
            break
        q = np.linalg.qr(chebyshev(times, q, degree, cut, values[0]))[0]
    raise NotCertified(f"residuals {residual} of eigenvalues {values[:wanted]}")


def _dimension(vectors: DataFrame) -> int:
    """The dimension of most vectors, of equals the greater; 0 if there are none."""
    sizes = vectors.groupBy(F.size("_vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    return sizes["size"] if sizes else 0


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of all ``_vector`` arrays of the usual dimension; None without any."""
    size = _dimension(vectors)
    if not size:
        return None
    with Scratch(vectors.sparkSession) as scratch:
        blocks = _blocks_of(vectors.where(F.size("_vector") == size).select("_vector"), size)
        passes = _Passes(scratch.stored(blocks, "vector-blocks"), size)
        n, sums = passes.exact_sums()

        def times(q: np.ndarray) -> np.ndarray:
            def of(x: np.ndarray) -> np.ndarray:
                c = _centred(x, sums, n)
                return c.T @ (c @ q)

            return passes.total(q.size, of).reshape(q.shape) / n

        trace = float(passes.total(1, lambda x: np.square(_centred(x, sums, n)).sum(keepdims=True))[0]) / n
        if not trace:
            return Whitening(n, sums, np.zeros(0), np.zeros(0), np.zeros((size, 0)), 0.0, passes.count)
        values, basis = leading(times, size, min(components, size))
        whole = values > RANK_SHARE * values[0]
        values, basis = values[whole], basis[:, whole]
        k = len(values)

        def moments(x: np.ndarray) -> np.ndarray:
            w = _centred(x, sums, n) @ basis / np.sqrt(values)
            return np.concatenate((w.sum(axis=0), (w.T @ w).ravel()))

        found = passes.total(k + k * k, moments) / n
        covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
        return Whitening(n, sums, values, values / trace, basis, float(np.abs(covariance - np.eye(k)).max()), passes.count)


def whitened(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """A row for each vector and component: the other columns, then ``component`` (from 1),
    ``n``, ``deviation``, ``whitened``, ``explained`` and ``identity_error``.

    Every entry c becomes x = floor(1024 c) + 100000. The model is fitted on all rows that have
    a vector. Left out are a null vector, one with a null or non-finite entry, or an entry over
    2 ** 43 in size. All vectors should have one dimension: those of another than most (of
    equals, the greater) have no rows either, nor have empty ones. A component whose
    eigenvalue is 0 but for rounding is left out, so equal vectors give no rows at all.
    ``deviation`` is null where it is no 64-bit integer. Repeated rows count as often as they
    stand. Columns of these names are replaced. An empty table gives an empty result.
    """
    rows = vectors.drop(*_MADE).where(_usable(F.col(column))).withColumn("_vector", F.transform(column, lambda c: c.cast("double")))
    own = [c for c in rows.columns if c not in ("_vector", column)]
    schema = ", ".join([*fields(rows, *own)] * bool(own) + [f"{c} {kind}" for c, kind in _MADE.items()])
    model = fit(rows.select("_vector"), components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    size, k = len(model.sums), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch) if k else 0, _ROWS):
                part = batch.slice(lo, _ROWS)
                distance = _distance(whole_numbers(_matrix(part.column("_vector"), size)), model.sums, model.n)
                values = distance.astype(np.float64) / model.n @ model.vectors / np.sqrt(model.values)
                every = pa.array(np.repeat(np.arange(len(part)), k))
                made = [
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(part))),
                    pa.array(np.full(len(part) * k, model.n)),
                    pa.array(_deviation(distance), pa.int64()).take(every),
                    pa.array(values.ravel()),
                    pa.array(np.tile(model.explained, len(part))),
                    pa.array(np.full(len(part) * k, model.identity_error)),
                ]
                yield pa.RecordBatch.from_arrays([*(part.column(c).take(every) for c in own), *made], names=[*own, *_MADE])

    return map_arrow(rows.where(F.size("_vector") == size).select(*own, "_vector"), run, schema)


_MADE = {"component": "int", "n": "long", "deviation": "long", "whitened": "double", "explained": "double", "identity_error": "double"}


def op11_chebyshev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable embedding on the first eight components, whitened."""
    return whitened(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
