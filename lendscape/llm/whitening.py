"""Whitening of embeddings by shifted CholeskyQR.

The components of n rows of d numbers are the right singular vectors of the centred rows Y. They
are found without ever bringing rows together: a pass over the rows adds up the Gram matrix G of
d times d numbers; its Cholesky factor R, taken of G plus a small multiple of the identity, makes
Y R^-1 (a triangular solve within each batch) closer to orthogonal columns; the next pass does
the same with what is left, until the Gram matrix is the identity. The product of the factors is
R of Y = Q R. Its singular values and vectors are those of Y, and unlike those of G they keep
their digits where G is ill conditioned.

Entries are whole numbers, x = floor(64 c) + 1000000, so sums, centring (n x - S) and squared
deviations are exact, and only the fraction of the mean is rounded.

* Work per pass is one scan. Tasks send d (d + 1) / 2 partial sums each, which Spark adds up by
  place; the driver sees one matrix of d columns, whatever the number of rows, and sends back
  triangular factors of that size.
* An output row is computed from its vector and matrices of d columns alone.

* Vectors that are NULL or hold NULL or non-finite entries take no part; nor do empty vectors,
  those of another length than most (ties: the shorter), and those with an entry beyond 2^53
  after scaling, which is no whole number in double precision any more.
* Components of no variance (equal rows, a single row, dependent columns) have no whitened form
  and are left out: fewer than 32 components then.
* A squared deviation beyond 64 bits is NULL, as with very many or very wide rows; the other
  columns do not rest on it.
* The last bits of the results may depend on the order in which tasks deliver partial sums.
* NULL and repeated ids: every row takes part and gets its rows. Other columns are ignored.
* An empty table, or one without a component, gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscape.llm import arrow as A

SCALE = 64
OFFSET = 1_000_000
COMPONENTS = 32
# Passes after which a factor is taken as it is; three do unless columns are dependent.
MOST_PASSES = 8
# Least share of the largest eigenvalue that counts as variance and not as rounding.
LEAST_SHARE = 1e-12
_LARGEST = float(1 << 53)
_ROWS = 4096


@dataclass(frozen=True)
class Whitening:
    """What the passes leave: exact sums, and the projection onto whitened components."""

    n: int
    sums: tuple[int, ...]
    projection: np.ndarray  # d rows, a column per component
    eigenvalues: np.ndarray
    trace: float
    identity_error: float


def sound_vectors(vectors: DataFrame, id_col: str, vector: str) -> DataFrame:
    """(_id, _v) of the rows that take part but for their length."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector).cast("array<double>").alias("_v"))
    odd = F.exists(
        "_v", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * F.lit(float(SCALE)) > F.lit(_LARGEST))
    )
    return rows.filter(F.col("_v").isNotNull() & (F.size("_v") > 0) & ~odd)


def usual_width(rows: DataFrame) -> tuple[int, int]:
    """Most frequent length and its rows; (0, 0) without rows."""
    sizes = rows.groupBy(F.size("_v").alias("width")).agg(F.count(F.lit(1)).alias("n"))
    most = sizes.orderBy(F.desc("n"), "width").first()
    return (most["width"], most["n"]) if most else (0, 0)


def whole(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """The x-vectors of a batch, a row each, without the offset."""
    values = np.asarray(column.combine_chunks().flatten())
    return np.floor(values.reshape(-1, width) * SCALE).astype(np.int64)


def total_by_place(rows: DataFrame, fn: Callable[[pa.Table], np.ndarray], kind: str, size: int) -> list:
    """Sum over all batches of the arrays that ``fn`` returns, by place; ``size`` values."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = fn(pa.Table.from_batches([batch.slice(at, _ROWS)]))
                total = part if total is None else total + part
        if total is not None:
            places = pa.array(np.arange(len(total)), pa.int32())
            values = pa.array(total.tolist(), pa.decimal128(38, 0) if kind == "decimal(38,0)" else pa.float64())
            yield pa.RecordBatch.from_arrays([places, values], ["place", "value"])

    parts = A.reachable(rows.select("_v")).mapInArrow(run, f"place int, value {kind}")
    out: list = [0] * size
    for place, value in parts.groupBy("place").agg(F.sum("value")).collect():
        out[place] = value
    return out


def column_sums(rows: DataFrame, width: int) -> list[int]:
    """Exact sums of x per dimension, without the offset."""

    def add(table: pa.Table) -> np.ndarray:
        x = whole(table["_v"], width)
        small = np.abs(x).max(initial=0) < (1 << 62) // _ROWS
        return (x if small else x.astype(object)).sum(axis=0).astype(object)

    return [int(s) for s in total_by_place(rows, add, "decimal(38,0)", width)]


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows minus their mean: the whole part exactly, then the fraction."""
    mean = np.array([s // n for s in sums], np.int64)
    rest = np.array([float(Fraction(s % n, n)) for s in sums])
    return (x - mean).astype(np.float64) - rest


def solve_right(y: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Y R^-1 for an upper triangular R, column after column."""
    out = np.empty_like(y, order="F")
    for j in range(len(r)):
        out[:, j] = (y[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def gram(rows: DataFrame, width: int, prepared: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """Gram matrix of prepared rows, one pass."""
    upper = np.triu_indices(size)

    def fn(table: pa.Table) -> np.ndarray:
        q = prepared(whole(table["_v"], width))
        return (q.T @ q)[upper]

    out = np.zeros((size, size))
    out[upper] = total_by_place(rows, fn, "double", len(upper[0]))
    return out + np.triu(out, 1).T


def shifted_factor(g: np.ndarray, n: int, first: bool) -> np.ndarray:
    """Upper triangular R with R'R = G + s I.

    The first pass shifts by the rounding a Gram matrix of n rows may hold, so that the factor
    exists whatever the condition. Later ones are well conditioned and are shifted only where
    columns depend on others, by as little as makes the factor exist.
    """
    d, unit = len(g), np.finfo(float).eps / 2
    shift = 11 * (n * d + d * (d + 1)) * unit * np.linalg.norm(g, 2)
    for s in [shift * 10.0**k for k in range(8)] if first else [0.0, *(shift * 10.0**k for k in range(-6, 8))]:
        try:
            r = np.linalg.cholesky(g + s * np.eye(d)).T
        except np.linalg.LinAlgError:
            continue
        if r.diagonal().min() > 0:
            return r
    raise ValueError("no Cholesky factor: the Gram matrix is not finite")


def factor(rows: DataFrame, width: int, n: int, sums: list[int]) -> tuple[np.ndarray, float]:
    """R of the centred rows (Y = Q R), and the trace of their Gram matrix."""
    factors: list[np.ndarray] = []

    def prepared(x: np.ndarray) -> np.ndarray:
        y = centred(x, n, sums)
        for r in factors:
            y = solve_right(y, r)
        return y

    composed, trace = np.eye(width), 0.0
    for k in range(MOST_PASSES):
        g = gram(rows, width, prepared, width)
        if not k:
            trace = float(np.trace(g))
            if trace == 0:
                return np.zeros((width, width)), 0.0
        # Columns that depend on others stay near zero: then G nears a projection instead.
        elif np.abs(g @ g - g).max() <= 1e-13 * width:
            break
        factors.append(shifted_factor(g, n, first=not k))
        composed = factors[-1] @ composed
    return composed, trace


def fit(rows: DataFrame, width: int, n: int, components: int = COMPONENTS) -> Whitening:
    """Components of all rows, which have ``width`` entries each."""
    sums = column_sums(rows, width)
    r, trace = factor(rows, width, n, sums)
    _, sigma, v = np.linalg.svd(r)
    values = sigma**2 / n
    k = min(components, int((values > LEAST_SHARE * values[0]).sum()) if trace else 0)
    projection = v[:k].T / np.sqrt(values[:k])
    error = 0.0
    if k:
        g = gram(rows, width, lambda x: centred(x, n, sums) @ projection, k)
        error = float(np.abs(g / n - np.eye(k)).max())
    return Whitening(n, tuple(sums), projection, values[:k], trace / n, error)


def deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> pa.Array:
    """Sum over dimensions of (n x - S)^2, exactly; NULL beyond 64 bits."""
    mean, rest = [s // n for s in sums], [s % n for s in sums]
    off = x - np.array(mean, np.int64)
    if len(sums) * (n * (int(np.abs(off).max(initial=0)) + 1)) ** 2 < 1 << 62:
        return pa.array(((n * off - np.array(rest, np.int64)) ** 2).sum(axis=1))
    exact = ((n * off.astype(object) - np.array(rest, object)) ** 2).sum(axis=1)
    return pa.array([e if e < 1 << 63 else None for e in exact], pa.int64())


def transform(rows: DataFrame, width: int, model: Whitening) -> DataFrame:
    """A row per vector and component."""
    k = model.projection.shape[1]
    kind = rows.schema["_id"].dataType.simpleString()
    schema = (
        f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
        "identity_error double"
    )
    shares = model.eigenvalues / model.trace if k else model.eigenvalues

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = pa.Table.from_batches([batch.slice(at, _ROWS)])
                x = whole(part["_v"], width)
                white = centred(x, model.n, list(model.sums)) @ model.projection
                m = len(x)
                each = pa.array(np.repeat(np.arange(m), k))
                columns = [
                    part["_id"].take(each).combine_chunks(),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, model.n, np.int64)),
                    deviations(x, model.n, model.sums).take(each),
                    pa.array(white.ravel()),
                    pa.array(np.tile(shares, m)),
                    pa.array(np.full(m * k, model.identity_error)),
                ]
                names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names)

    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    return A.reachable(rows).mapInArrow(run, schema)


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Fit on all sound rows and return each in whitened components."""
    rows = sound_vectors(vectors, id_col, vector)
    width, n = usual_width(rows)
    rows = rows.filter(F.size("_v") == width)
    model = fit(rows, width, n, components) if n else Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0, 0.0)
    out = transform(rows, width, model)
    return out if id_col == "vec_id" else out.withColumnRenamed("vec_id", id_col)
