"""Whitening of embeddings by covariances from polarisation.

A vector's entries become whole numbers x. Tasks add up, in exact integers, the squares of every centred dimension and of every
sum of two centred dimensions; Var(x_i + x_j) - Var(x_i) - Var(x_j) is then twice the covariance of the two, with no product of
different dimensions formed. The driver sees d * (d + 1) / 2 sums, whatever the number of vectors, and eigh of the d x d matrix
gives the components.

Values are centred by the whole part of their mean before they are squared, so squares stay as small as the spread; the rest of the
mean, under one unit, is taken out of the sums exactly. Sums travel as limbs of 32 bits, so that no size of the table overflows them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablekeeper.llm.repeats import plain
from tablekeeper.llm.storage import stored
from tablekeeper.llm.words import give_back

SCALE, SHIFT = 1024, 100_000
#: Components returned.
COMPONENTS = 8
#: Larger entries count as this, far beyond what a double tells apart from its neighbours.
MOST = 1 << 61
LIMBS = 5
ADDED = ["_n", "_deviation", "_whitened", "_explained", "_identity_error"]


def whiten(frame: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """The other columns of each row that is fitted, and

    `_n` vectors fitted; `_deviation` the sum over dimensions of (n * x - S)^2, exact, S being the sums of x (null where it has
    more than 38 digits); `_whitened` the projections of x - S / n on the first components, each over the root of its eigenvalue;
    `_explained` each component's share of all variance; `_identity_error` the largest absolute entry of the covariance of
    `_whitened` minus the identity.

    A row has no part if its vector is null or empty, holds a null or an entry that is not finite, or has another length than most
    such vectors (of equally common lengths the longest is taken). There are min(components, dimensions) components; one without
    variance has null in `_whitened` and 0 in `_explained` and no part in the error. Repeated rows count as often as they occur.
    Columns of `frame` named like an added one are replaced by it. An empty table gives no rows.
    """
    good = F.col("_v").isNotNull() & F.forall("_v", _finite)
    others = [c for c in frame.columns if c not in ADDED and c != vector]
    rest = F.struct(*[plain(c) for c in others]) if others else F.struct(F.lit(1).alias("_"))
    fit = frame.select(rest.alias("_rest"), plain(vector).alias("_v")).filter(good)
    most = fit.filter(F.size("_v") > 0).groupBy(F.size("_v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 1
    fit = fit.filter(F.size("_v") == d).select("_rest", F.col("_v").cast("array<double>").alias("_v"))

    counted = _sums(fit, d, 1 + d, _plain_sums)
    n, first = counted[0], counted[1:]
    centre = [round_down(s, n) for s in first]
    left = [s - n * c for s, c in zip(first, centre, strict=True)]
    squares = _sums(fit, d, d * (d + 1) // 2, lambda x: _squares(x - np.array(centre, np.int64)))
    values, axes, shares = _components(_covariance(squares, left, n, d), components)

    rows = stored(_projected(fit, d, n, centre, left, values, axes), "whitened")
    error = _identity_error(rows, values)
    kept = [F.col(f"_rest.`{c}`").alias(c) for c in others]
    return rows.select(
        *kept,
        F.lit(n).cast("long").alias("_n"),
        "_deviation",
        "_whitened",
        F.array(*[F.lit(float(s)) for s in shares]).alias("_explained"),
        F.lit(error).alias("_identity_error"),
    )


def _finite(entry: Column) -> Column:
    return entry.isNotNull() & ~F.isnan(entry) & (F.abs(entry.cast("double")) < float("inf"))


def round_down(total: int, n: int) -> int:
    return total // n if n else 0


def numbers(batch: pa.RecordBatch, d: int) -> np.ndarray:
    """x of each vector, as rows of int64."""
    values = batch.column("_v").flatten().to_numpy(zero_copy_only=False).reshape(-1, d)
    with np.errstate(over="ignore"):
        return np.clip(np.floor(values * SCALE), -MOST, MOST).astype(np.int64) + SHIFT


def _plain_sums(x: np.ndarray) -> np.ndarray:
    """The number of rows, then the sum of each dimension."""
    exact = x if len(x) * float(np.abs(x).max()) < 2**62 else x.astype(object)
    return np.concatenate([np.array([len(x)], object), exact.sum(axis=0).astype(object)])


def _squares(y: np.ndarray) -> np.ndarray:
    """For i and j >= i, in that order: the sum of y_i^2 where i = j, else of (y_i + y_j)^2."""
    largest = 2 * float(np.abs(y).max())
    across = np.ascontiguousarray(y.T)
    if len(y) * largest**2 >= 2**62:
        across = across.astype(object)
    out = []
    for i in range(len(across)):
        one, sums = across[i], across[i + 1 :] + across[i]
        if across.dtype == object:
            out.append(np.concatenate([[(one * one).sum()], (sums * sums).sum(axis=1)]))
        else:
            out.append(np.concatenate([[one @ one], np.einsum("jr,jr->j", sums, sums)]))
    return np.concatenate(out).astype(object)


def _sums(fit: DataFrame, d: int, size: int, of: Callable[[np.ndarray], np.ndarray]) -> list[int]:
    """The sums of `of` over all rows. A task sends `size` rows of limbs, so there are few tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, object)
        for batch in batches:
            for start in range(0, batch.num_rows, 8192):
                total += of(numbers(batch.slice(start, 8192), d))
        columns = [pa.array(np.arange(size), pa.int64())]
        for k in range(LIMBS):
            part = total >> (32 * k)
            columns.append(pa.array((part if k == LIMBS - 1 else part & 0xFFFFFFFF).astype(np.int64), pa.int64()))
        yield pa.RecordBatch.from_arrays(columns, names=["k", *(f"l{k}" for k in range(LIMBS))])
        give_back()

    names = [f"l{k}" for k in range(LIMBS)]
    tasks = max(64, 3 * fit.sparkSession.sparkContext.defaultParallelism)
    parts = fit.select("_v").coalesce(tasks).mapInArrow(run, "k long, " + ", ".join(f"{c} long" for c in names))
    out = [0] * size
    for row in parts.groupBy("k").agg(*[F.sum(c).alias(c) for c in names]).collect():
        out[row["k"]] = sum(row[c] << (32 * i) for i, c in enumerate(names))
    return out


def _covariance(squares: list[int], left: list[int], n: int, d: int) -> np.ndarray:
    """The covariance matrix: exact integers until the last division."""
    scaled = np.zeros((d, d), object)
    spot = 0
    for i in range(d):
        for j in range(i, d):
            off = left[i] if i == j else left[i] + left[j]
            scaled[i, j] = n * squares[spot] - off * off  # n^2 times the variance
            spot += 1
    out = np.zeros((d, d))
    for i in range(d):
        for j in range(i, d):
            twice = 2 * scaled[i, i] if i == j else scaled[i, j] - scaled[i, i] - scaled[j, j]
            out[i, j] = out[j, i] = twice / (2 * n * n) if n else 0.0
    return out


def _components(matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Eigenvalues by falling size, 0 where there is no variance, their unit vectors as columns, and their shares."""
    values, axes = np.linalg.eigh(matrix)
    values, axes = values[::-1][:components].copy(), axes[:, ::-1][:, :components]
    values[values <= len(matrix) * np.finfo(float).eps * values[0]] = 0.0
    trace = float(np.trace(matrix))
    return values, axes, values / trace if trace > 0 else np.zeros(len(values))


def deviations(y: np.ndarray, n: int, left: np.ndarray) -> pa.Array:
    """The sum over dimensions of (n * y - left)^2 for each row, exact; null where it has more than 38 digits."""
    d, size = y.shape[1], n * int(np.abs(y).max(initial=0)) + max(map(abs, left.tolist()), default=0)
    kind = pa.decimal128(38, 0)
    if d * size * size < 1 << 62:
        z = n * y - left.astype(np.int64)
        return pa.array(np.einsum("rd,rd->r", z, z), pa.int64()).cast(kind)
    if size < 1 << 50 and d <= 1 << 10:
        z = n * y - left.astype(np.int64)
        high, low = z >> 26, z & ((1 << 26) - 1)
        parts = (np.einsum("rd,rd->r", a, b).tolist() for a, b in ((high, high), (high, low), (low, low)))
        sums = [(a << 52) + (b << 27) + c for a, b, c in zip(*parts, strict=True)]
    else:
        z = n * y.astype(object) - left
        sums = (z * z).sum(axis=1).tolist()
    return pa.array([Decimal(s) if s < 10**38 else None for s in sums], kind)


def _projected(
    fit: DataFrame, d: int, n: int, centre: list[int], left: list[int], values: np.ndarray, axes: np.ndarray
) -> DataFrame:
    varies = values > 0
    turned = axes[:, varies] / np.sqrt(values[varies])
    mean = np.array([r / n if n else 0.0 for r in left])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = numbers(batch, d) - np.array(centre, np.int64)
            out = np.full((len(y), len(values)), np.nan)
            out[:, varies] = (y - mean) @ turned
            flat = pa.array(out.ravel(), pa.float64(), from_pandas=True)  # no variance: null
            lists = pa.ListArray.from_arrays(np.arange(len(y) + 1, dtype=np.int32) * len(values), flat)
            found = [batch.column("_rest"), deviations(y, n, np.array(left, object)), lists]
            yield pa.RecordBatch.from_arrays(found, names=["_rest", "_deviation", "_whitened"])

    schema = T.StructType(
        [
            fit.schema["_rest"],
            T.StructField("_deviation", T.DecimalType(38, 0)),
            T.StructField("_whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return fit.mapInArrow(run, schema)


def _identity_error(rows: DataFrame, values: np.ndarray) -> float:
    spots = [i for i, v in enumerate(values) if v > 0]
    entries = [(i, j) for i in spots for j in spots if i <= j]
    if not entries:
        return 0.0
    at = [F.col("_whitened")[i] for i in range(len(values))]
    found = rows.agg(*[F.covar_pop(at[i], at[j]).alias(f"{i}_{j}") for i, j in entries]).first()
    return max(abs(found[f"{i}_{j}"] - (i == j)) for i, j in entries)
