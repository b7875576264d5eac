"""Whitening of embeddings (operator 13).

1. Every vector becomes whole numbers, x = floor(scale * c). The fit list is
   each distinct x once.
2. n and the exact sums S of each dimension, then the covariance: each task
   centres its rows by S / n and adds up its products; tasks' sums are added
   entry by entry in a shuffle.
3. The covariance (dimensions squared, whatever the number of rows) is reduced
   to a tridiagonal matrix by Householder reflections. Sturm counts tell how
   many eigenvalues lie below a number, so bisection closes in on the leading
   ones to the last bit. Inverse iteration gives their vectors; vectors of
   close eigenvalues are made orthogonal to each other in each step.
4. Means and components are broadcast, and every row is projected.

Results of note: ``deviation`` is exact, computed in whole numbers.
``identity_error`` is measured on the rows: a further pass adds up the products
of the whitened fit list.

Defined results: a row whose vector is null, or holds a null, NaN or infinity,
has no output rows. Repeated rows, and rows with a null id, each get theirs;
repeated vectors count once in the fit. Vectors of different lengths are
different spaces, each with its own fit. A component without variance (an
eigenvalue within rounding of zero) isn't returned; so a single distinct
vector, or empty vectors, give no rows, as does an empty table. Numbers beyond
the range of a long are cut to it by floor; a deviation beyond it is null.
Columns other than the id and vector columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from snapdeck.llm._common import importable, stage

SCALE = 256
EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues closer than this share of the matrix's norm are one cluster.
CLUSTER = 1e-3


# -- leading eigenpairs of a symmetric matrix -------------------------------


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """(diagonal, off-diagonal, reflectors): H v H for Householder reflections
    H = I - 2 u u' that clear one column after the other."""
    a = np.array(v, dtype=np.float64)
    d = len(a)
    off, reflectors = np.zeros(max(0, d - 1)), []
    for k in range(d - 2):
        x = a[k + 1 :, k].copy()
        if not np.any(x[1:]):
            off[k] = x[0]
            reflectors.append(None)
            continue
        length = np.linalg.norm(x)
        off[k] = -np.copysign(length, x[0])
        x[0] += np.copysign(length, x[0])
        u = x / np.linalg.norm(x)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ u
        q = p - (u @ p) * u
        rest -= 2 * (np.outer(u, q) + np.outer(q, u))
        reflectors.append(u)
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return a.diagonal().copy(), off, reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray, least: float) -> np.ndarray:
    """For each number of ``at``: how many eigenvalues are smaller (negative
    pivots of the shifted matrix). ``least`` replaces pivots that vanish."""
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(np.int64)
    for a, b in zip(diagonal[1:], off):
        pivot = np.where(np.abs(pivot) < least, -least, pivot)
        pivot = a - at - b * b / pivot
        below += pivot < 0
    return below


def bisect_leading(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each to neighbouring doubles."""
    d = len(diagonal)
    reach = np.r_[np.abs(off), 0] + np.r_[0, np.abs(off)]
    bound = float(np.max(np.abs(diagonal) + reach))
    least = max(np.finfo(np.float64).tiny, EPS * EPS * bound)
    rank = d - 1 - np.arange(k)  # so many eigenvalues are smaller
    lo = np.full(k, -bound - 2 * EPS * bound - least)
    hi = np.full(k, bound + 2 * EPS * bound + least)
    while True:
        mid = lo + (hi - lo) / 2
        open_ = (mid > lo) & (mid < hi) & (hi - lo > EPS * EPS * bound)
        if not open_.any():
            return mid
        above = sturm_counts(diagonal, off, mid, least) <= rank
        lo, hi = np.where(open_ & above, mid, lo), np.where(open_ & ~above, mid, hi)


def _solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solves (T - shift) x = b by elimination with row exchanges."""
    d = len(diagonal)
    main, up, up2, x = diagonal - shift, np.r_[off, 0.0], np.zeros(d), b.copy()
    for i in range(d - 1):
        low = off[i]
        if abs(low) > abs(main[i]):
            f = main[i] / low
            main[i], up[i], main[i + 1], up2[i], up[i + 1] = (
                low,
                main[i + 1],
                up[i] - f * main[i + 1],
                up[i + 1],
                -f * up[i + 1],
            )
            x[i], x[i + 1] = x[i + 1], x[i] - f * x[i + 1]
        else:
            if abs(main[i]) < least:
                main[i] = least
            f = low / main[i]
            main[i + 1] -= f * up[i]
            x[i + 1] -= f * x[i]
    for i in range(d - 1, -1, -1):
        if abs(main[i]) < least:
            main[i] = least
        x[i] -= (up[i] * x[i + 1] if i + 1 < d else 0.0) + (up2[i] * x[i + 2] if i + 2 < d else 0.0)
        x[i] /= main[i]
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (rows) of a tridiagonal matrix for falling eigenvalues."""
    d = len(diagonal)
    norm = max(float(np.max(np.abs(diagonal))), float(np.max(np.abs(off), initial=0.0)), np.finfo(np.float64).tiny)
    least, rng, out = EPS * norm, np.random.default_rng(0), []
    for j, value in enumerate(values):
        cluster = [out[i] for i in range(j) if values[i] - value <= CLUSTER * norm]
        x = rng.standard_normal(d)
        for _ in range(5):
            x /= np.linalg.norm(x)
            x = _solve_shifted(diagonal, off, value, x, least)
            x /= np.max(np.abs(x))
            for _ in range(2):  # twice: the first time may leave rounding
                for y in cluster:
                    x -= (x @ y) * y
        out.append(x / np.linalg.norm(x))
    return np.array(out).reshape(len(values), d)


def leading_eigenpairs(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, unit vectors as rows) of the k largest eigenvalues of a
    symmetric matrix; each vector's largest entry is positive."""
    k = min(k, len(v))
    top = float(np.max(np.abs(v), initial=0.0))
    if not k or not top:
        return np.zeros(0), np.zeros((0, len(v)))
    diagonal, off, reflectors = tridiagonal(v / top)
    values = bisect_leading(diagonal, off, k)
    vectors = inverse_iteration(diagonal, off, values)
    for i in range(len(reflectors) - 1, -1, -1):
        if (u := reflectors[i]) is not None:
            vectors[:, i + 1 :] -= 2 * np.outer(vectors[:, i + 1 :] @ u, u)
    signs = np.sign(vectors[np.arange(k), np.abs(vectors).argmax(axis=1)])
    return values * top, vectors * signs[:, None]


# -- Spark ------------------------------------------------------------------


@dataclass
class Space:
    """What was fitted on the vectors of one length."""

    n: int
    sums: list[int]
    mean: np.ndarray
    directions: np.ndarray  # components over the roots of their eigenvalues
    explained: np.ndarray
    identity_error: float = 0.0


def whole_numbers(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(id, x) of the rows whose vector has finite entries only."""
    vector = F.col(vector_col)
    finite = lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))
    return df.filter(vector.isNotNull() & F.forall(vector, finite)).select(
        F.col(id_col).alias("id"), F.transform(vector, lambda c: F.floor(c.cast("double") * scale)).alias("x")
    )


def _by_length(column: pa.ListArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, row numbers, matrix) for the vectors of each length."""
    offsets = column.offsets.to_numpy()
    flat = column.values.to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    for d in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == d)
        yield d, rows, flat[offsets[rows][:, None] + np.arange(d)[None, :]]


_PRODUCTS = pa.schema([("dims", pa.int32()), ("i", pa.int32()), ("products", pa.list_(pa.float64()))])


def _add_products(shared, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    maps, sums = shared.value, {}
    for batch in batches:
        for d, _, x in _by_length(batch.column(0)):
            if d in maps:
                mean, directions = maps[d]
                z = x - mean
                if directions is not None:
                    z = z @ directions.T
                sums[d] = sums.get(d, 0) + z.T @ z
    for d, m in sums.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([d] * len(m), pa.int32()), pa.array(range(len(m)), pa.int32()), pa.array(list(m))], schema=_PRODUCTS
        )


def _covariances(fit: DataFrame, maps: dict[int, tuple], counts: dict[int, int]) -> dict[int, np.ndarray]:
    """For each length: the covariance over ``fit(x)`` of (x - mean), or of its
    projection on directions. One row a matrix entry reaches the driver."""
    shared = fit.sparkSession.sparkContext.broadcast(maps)
    parts = importable(fit).mapInArrow(partial(_add_products, shared), "dims int, i int, products array<double>")
    entries = (
        parts.select("dims", "i", F.posexplode("products").alias("j", "v"))
        .groupBy("dims", "i", "j")
        .agg(F.sum("v").alias("v"))
        .collect()
    )
    out = {}
    for d, (_, directions) in maps.items():
        size = d if directions is None else len(directions)
        out[d] = np.zeros((size, size))
    for r in entries:
        out[r["dims"]][r["i"], r["j"]] = r["v"] / counts[r["dims"]]
    return {d: (m + m.T) / 2 for d, m in out.items()}


def fit_spaces(fit: DataFrame, components: int = 4) -> dict[int, Space]:
    """Fits each length's space on ``fit(x)``, whose rows are distinct."""
    moments = (
        fit.select(F.size("x").alias("dims"), F.posexplode("x").alias("i", "v"))
        .groupBy("dims", "i")
        .agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s"))
        .collect()
    )  # a row for each dimension
    sums: dict[int, dict[int, int]] = {}
    counts: dict[int, int] = {}
    for r in moments:
        sums.setdefault(r["dims"], {})[r["i"]] = int(r["s"])
        counts[r["dims"]] = r["n"]
    means = {d: np.array([s[i] / counts[d] for i in range(d)]) for d, s in sums.items()}
    if not means:
        return {}
    spaces = {}
    for d, v in _covariances(fit, {d: (m, None) for d, m in means.items()}, counts).items():
        trace = float(np.trace(v))
        values, vectors = leading_eigenpairs(v, components)
        real = values > d * EPS * trace
        values, vectors = values[real], vectors[real]
        spaces[d] = Space(
            counts[d], [sums[d][i] for i in range(d)], means[d], vectors / np.sqrt(values)[:, None], values / (trace or 1.0)
        )
    measured = {d: (s.mean, s.directions) for d, s in spaces.items() if len(s.directions)}
    for d, c in _covariances(fit, measured, counts).items() if measured else ():
        spaces[d].identity_error = float(np.max(np.abs(c - np.eye(len(c)))))
    return spaces


def deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over the dimensions of (n * x - S)^2, exactly; null beyond a long."""
    if not x.size:
        return pa.array([0] * len(x), pa.int64())
    reach = n * max(abs(int(x.max())), abs(int(x.min()))) + max(map(abs, sums))
    if x.shape[1] * reach * reach < 1 << 63:
        return pa.array(((n * x - np.array(sums)) ** 2).sum(axis=1), pa.int64())
    exact = ((n * x.astype(object) - np.array(sums, dtype=object)) ** 2).sum(axis=1)
    return pa.array([v if v < 1 << 63 else None for v in exact.tolist()], pa.int64())


def _project(shared, schema: pa.Schema, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    spaces = shared.value
    for batch in batches:
        for d, rows, x in _by_length(batch.column(1)):
            space = spaces.get(d)
            k = len(space.directions) if space else 0
            if not k:
                continue
            each = pa.array(np.repeat(np.arange(len(rows)), k))
            m = len(rows)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(np.repeat(rows, k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, space.n)),
                    deviations(x, space.n, space.sums).take(each),
                    pa.array(((x - space.mean) @ space.directions.T).ravel()),
                    pa.array(np.tile(space.explained, m)),
                    pa.array(np.full(m * k, space.identity_error)),
                ],
                schema=schema,
            )


def whiten(
    df: DataFrame,
    components: int = 4,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = SCALE,
) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a
    row for every row with a finite vector and every component."""
    rows = whole_numbers(df, id_col, vector_col, scale)
    spaces = fit_spaces(stage(rows.select("x").distinct(), "whitening-fit"), components)
    schema = T.StructType(
        [
            T.StructField(id_col, df.schema[id_col].dataType),
            T.StructField("component", T.IntegerType()),
            T.StructField("n", T.LongType()),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.DoubleType()),
            T.StructField("explained", T.DoubleType()),
            T.StructField("identity_error", T.DoubleType()),
        ]
    )
    shared = df.sparkSession.sparkContext.broadcast(spaces)  # components x dimensions numbers
    return importable(rows).mapInArrow(partial(_project, shared, to_arrow_schema(schema)), schema)
