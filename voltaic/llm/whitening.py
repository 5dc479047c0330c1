"""Whitening of embeddings by the leading eigenvectors of their covariance, found by spectrum slicing.

Vectors are read as whole numbers ``x = floor(64 c) + 1000000``, so counts,
sums and products are exact: tasks add up products of ``x - 1000000`` and the
driver meets one matrix of the size of a vector squared, whatever the number
of rows. From n, the sums S and the products P the covariance
``(n P - S Sᵀ) / n²`` is formed in whole numbers and rounded once.

Eigenvalues are taken by number, largest first:

1. ``above(shift)`` counts the eigenvalues over a shift: the positive pivots of
   the LDLᵀ factors of the shifted matrix (Sylvester's law of inertia), with
   complete pivoting and pivots of one or two rows, so no shift breaks it;
2. intervals are halved until each of the wanted eigenvalues is alone in one
   (or its interval is too narrow to tell neighbours apart: a cluster, whose
   eigenvectors are then kept orthogonal);
3. Rayleigh quotient iteration from the interval's middle converges
   cubically; a quotient that leaves the interval halves it first;
4. counts on either side of the result certify its number.

Null vectors and vectors with null or non-finite entries take no part and are
not returned. Neither are vectors of another length than the most frequent one
(the longer of two as frequent): one covariance has one size. Null ids and
repeated rows count like all others; columns other than id and vector are not
read. Components of variance zero (constant or dependent dimensions, a single
row) have ``whitened`` null and do not count in ``identity_error``; an empty
table gives an empty table. An entry beyond +-2**52 / 64 counts as that bound.
A ``deviation`` that no long can hold is null. Vectors of more than
``MAX_DIMENSION`` entries raise an error.
"""
from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from voltaic.llm.common import ship

MAX_DIMENSION = 1024
#: Fixed scale and offset of the whole numbers.
SCALE, OFFSET = 64.0, 1_000_000
#: Rows handled at a time.
ROWS = 2048
_MOST = float(1 << 52)


# ---- reading ----


def whole(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers of the usable vectors of ``size`` entries, and their ``floor(64 c)``."""
    fits = pc.fill_null(pc.equal(pc.list_value_length(column), size), False)
    rows = np.flatnonzero(fits.to_numpy(zero_copy_only=False))
    entries = column.take(pa.array(rows)).flatten()
    values = pc.fill_null(entries, float("nan")).to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(rows), size)
    finite = np.isfinite(values).all(axis=1)
    return rows[finite], np.floor(np.clip(values[finite] * SCALE, -_MOST, _MOST)).astype(np.int64)


def _sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Usable vectors by length."""
    for batch in batches:
        lengths = pc.fill_null(pc.list_value_length(batch.column(0)), 0).to_numpy(zero_copy_only=False)
        found = [(int(size), len(whole(batch.column(0), int(size))[0])) for size in np.unique(lengths) if size]
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.int32()), pa.array([f[1] for f in found], pa.int64())], names=["size", "n"]
        )


def _products(rows: np.ndarray) -> np.ndarray:
    """Exact sums of products of whole numbers, as Python integers if a long might not hold them."""
    most = int(np.abs(rows).max(initial=0))
    if most * most * len(rows) < 1 << 53:
        real = rows.astype(np.float64)
        return (real.T @ real).astype(np.int64).astype(object)
    wide = rows.astype(object)
    return wide.T @ wide


def _moments(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(i, j, total)``: products of entries i and j; sums have j = -1, the count i = j = -1."""
    count, sums, products = 0, np.zeros(size, object), np.zeros((size, size), object)
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            rows = whole(batch.column(0).slice(start, ROWS), size)[1]
            count += len(rows)
            sums = sums + rows.sum(axis=0, dtype=np.int64).astype(object)
            products = products + _products(rows)
    if count:
        i, j = np.triu_indices(size)
        first = np.concatenate([[-1], np.arange(size), i])
        second = np.concatenate([[-1], np.full(size, -1), j])
        totals = [count, *sums, *products[i, j]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(first, pa.int32()), pa.array(second, pa.int32()), pa.array([str(t) for t in totals])],
            names=["i", "j", "total"],
        )


@dataclass
class Moments:
    """Exact count, sums and products of the vectors of a table."""

    size: int
    count: int
    sums: list[int]
    products: list[list[int]]

    def covariance(self) -> np.ndarray:
        """Covariance of divisor n: whole numbers first, one rounding."""
        n, out = self.count, np.zeros((self.size, self.size))
        for i in range(self.size):
            for j in range(i, self.size):
                out[i, j] = out[j, i] = (n * self.products[i][j] - self.sums[i] * self.sums[j]) / (n * n)
        return out


def moments(vectors: DataFrame, vector_col: str = "embedding") -> Moments | None:
    """Moments of the usable vectors of the most frequent length; None without any."""
    ship(vectors.sparkSession)
    raw = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    sizes = raw.mapInArrow(_sizes, "size int, n long").groupBy("size").agg(F.sum("n").alias("n")).where("n > 0")
    top = sizes.orderBy(F.desc("n"), F.desc("size")).first()
    if top is None:
        return None
    size = top["size"]
    if size > MAX_DIMENSION:
        raise ValueError(f"vectors of {size} entries; at most {MAX_DIMENSION} are allowed")
    parts = raw.mapInArrow(functools.partial(_moments, size), "i int, j int, total string")
    # A decimal sum of task totals: exact, one row per pair of entries.
    added = parts.groupBy("i", "j").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    count, sums, products = 0, [0] * size, [[0] * size for _ in range(size)]
    for i, j, total in added:
        if i < 0:
            count = int(total)
        elif j < 0:
            sums[i] = int(total)
        else:
            products[i][j] = products[j][i] = int(total)
    return Moments(size, count, sums, products)


# ---- spectrum slicing ----

_ALPHA = (1 + 17**0.5) / 8
#: Eigenvalues this close, as a share of the matrix's norm, have their vectors kept orthogonal.
CLOSE = 1e-6


def above(matrix: np.ndarray, shift: float) -> int:
    """Eigenvalues of a symmetric matrix over ``shift``: positive pivots of LDLᵀ with complete pivoting."""
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        k = int(diagonal.argmax())
        off = np.abs(rest)
        np.fill_diagonal(off, 0)
        place = int(off.argmax())
        most = off.flat[place]
        if diagonal[k] >= _ALPHA * most:
            pivot = rest[k, k]
            positive += bool(pivot > 0)
            keep = np.delete(np.arange(len(rest)), k)
            column = rest[keep, k]
            rest = rest[np.ix_(keep, keep)]
            if pivot:
                rest -= np.outer(column, column / pivot)
        else:
            pair = [place // len(rest), place % len(rest)]
            # A pivot of two rows with a dominant off-diagonal entry has one eigenvalue of either sign.
            positive += 1
            keep = np.delete(np.arange(len(rest)), pair)
            columns = rest[np.ix_(keep, pair)]
            block = rest[np.ix_(pair, pair)]
            rest = rest[np.ix_(keep, keep)] - columns @ np.linalg.solve(block, columns.T)
        rest = (rest + rest.T) / 2
    return positive


def _refine(
    matrix: np.ndarray, low: float, high: float, found: list[np.ndarray], tiny: float, edge: float
) -> tuple[float, np.ndarray]:
    """Rayleigh quotient iteration inside an interval that holds one eigenvalue, or one cluster less what is ``found``."""
    size = len(matrix)
    near = np.array(found).reshape(-1, size)
    vector = np.random.default_rng(size + len(near)).standard_normal(size)
    shift, best = (low + high) / 2, None
    for turn in range(60):
        vector = vector - near.T @ (near @ vector)
        try:
            vector = np.linalg.solve(matrix - shift * np.eye(size), vector / np.linalg.norm(vector))
        except np.linalg.LinAlgError:
            shift += tiny
            continue
        for _ in range(2):
            vector = vector - near.T @ (near @ vector)
        vector /= np.linalg.norm(vector)
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        inside = low - edge <= value <= high + edge
        if inside and (best is None or residual < best[0]):
            best = (residual, value, vector)
        elif best is not None and inside and best[0] <= 1e3 * tiny:
            break
        if turn >= 2 and inside:
            shift = value  # the quotient only leads once inverse iteration has turned to the interval's own vector
        elif not inside:
            shift = (low + high) / 2
    if best is None or best[0] > 1e6 * tiny:
        raise ArithmeticError("no eigenvector found in an interval that holds one")
    return best[1], best[2]


def leading(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues of a positive semidefinite matrix, falling, and their unit vectors as columns.

    Eigenvalues not above rounding error are left out, so fewer may come back.
    """
    size = len(matrix)
    norm = float(np.linalg.norm(matrix))
    if not norm:
        return np.zeros(0), np.zeros((size, 0))
    tiny = norm * np.finfo(float).eps
    floor = size * 8 * tiny
    wanted = min(count, above(matrix, floor))
    # Intervals (low, high] with the eigenvalues numbered from ``first`` to ``last``.
    open_, alone = [(floor, norm * (1 + 1e-12), 1, above(matrix, floor))], []
    while open_:
        low, high, first, last = open_.pop()
        if first > last or first > wanted:
            continue
        narrow = high - low <= max(64 * tiny, 1e-10 * high)
        if narrow or (first == last and high - low <= 0.25 * high):
            alone.append((low, high, first, last))
            continue
        middle = (low + high) / 2
        over = min(max(above(matrix, middle), first - 1), last)
        open_ += [(middle, high, first, over), (low, middle, over + 1, last)]
    pairs: list[tuple[float, np.ndarray]] = []
    for low, high, first, last in sorted(alone, key=lambda x: x[2]):
        for _ in range(first, last + 1):
            # Vectors of close eigenvalues are kept orthogonal; the others are by themselves.
            near = [v for value, v in pairs if value - high <= CLOSE * norm]
            pairs.append(_isolated(matrix, low, high, first, last, near, tiny))
    pairs = sorted(pairs, key=lambda x: -x[0])[:wanted]
    return np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs]).reshape(-1, size).T


def _isolated(matrix, low, high, first, last, near, tiny) -> tuple[float, np.ndarray]:
    """The eigenpair numbered ``first`` (or another of its cluster), certified by counts.

    ``above(value + slack) < first <= above(value - slack)`` says that eigenvalue
    ``first`` lies within ``slack`` of ``value``. Neighbours nearer than rounding
    allows to tell apart pass with a wider slack only.
    """
    for slack in (1e3 * tiny, 1e6 * tiny, 1e8 * tiny):
        a, b = low, high
        wide = slack + (high - low if last > first else 0)
        for _ in range(60):
            try:
                value, vector = _refine(matrix, a, b, near, tiny, slack)
                if above(matrix, value + wide) < first and above(matrix, value - wide) >= first:
                    return value, vector
            except ArithmeticError:
                pass
            middle = (a + b) / 2
            if first < last or b - a <= slack:
                break
            a, b = (middle, b) if above(matrix, middle) >= first else (a, middle)
    raise ArithmeticError(f"eigenvalue {first} could not be certified")


# ---- whitening ----


@dataclass
class Whitening:
    """A fitted transform: ``(x - S/n) @ turn``, its components by falling variance."""

    count: int
    sums: np.ndarray
    values: np.ndarray
    turn: np.ndarray
    explained: np.ndarray
    components: int


def fit(vectors: DataFrame, *, vector_col: str = "embedding", components: int = 32) -> Whitening | None:
    """Fit over all usable vectors; None without any."""
    found = moments(vectors, vector_col)
    if found is None:
        return None
    matrix = found.covariance()
    values, turned = leading(matrix, min(components, found.size))
    total = float(np.trace(matrix))
    return Whitening(
        found.count, np.array(found.sums, object), values, turned / np.sqrt(values), values / total if total else values,
        min(components, found.size),
    )


def _whitened(model: Whitening, rows: np.ndarray) -> np.ndarray:
    """Rows centred in exact arithmetic where it counts, then turned and scaled."""
    whole_mean = np.array([s // model.count for s in model.sums], np.int64)
    rest = np.array([(s % model.count) / model.count for s in model.sums])
    return ((rows - whole_mean) - rest) @ model.turn


def _deviations(model: Whitening, rows: np.ndarray) -> list[int | None]:
    """Sum over dimensions of ``(n x - S)²``; the offset of x cancels out."""
    n, most = model.count, int(np.abs(rows).max(initial=0))
    if 2 * n * most < 1 << 62:
        apart = rows * np.int64(n) - model.sums.astype(np.int64)
        if (np.abs(apart).astype(np.float64) ** 2).sum(axis=1).max(initial=0) < 2.0**62:
            return (apart * apart).sum(axis=1).tolist()
    exact = [sum(int(d) ** 2 for d in row.astype(object) * n - model.sums) for row in rows]
    return [e if e < 1 << 63 else None for e in exact]


def _second_moments(model: Whitening, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(i, j, total)`` of whitened rows: products, and sums with j = -1."""
    size = model.turn.shape[1]
    sums, products = np.zeros(size), np.zeros((size, size))
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            made = _whitened(model, whole(batch.column(0).slice(start, ROWS), len(model.sums))[1])
            sums += made.sum(axis=0)
            products += made.T @ made
    i, j = np.triu_indices(size)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.concatenate([np.arange(size), i]), pa.int32()),
            pa.array(np.concatenate([np.full(size, -1), j]), pa.int32()),
            pa.array(np.concatenate([sums, products[i, j]])),
        ],
        names=["i", "j", "total"],
    )


def identity_error(vectors: DataFrame, model: Whitening, *, vector_col: str = "embedding") -> float | None:
    """Largest absolute entry of the whitened rows' covariance minus the identity, measured over all rows."""
    size = model.turn.shape[1]
    if not size:
        return None
    raw = vectors.select(F.col(vector_col).cast("array<double>").alias("v"))
    parts = raw.mapInArrow(functools.partial(_second_moments, model), "i int, j int, total double")
    means, products = np.zeros(size), np.zeros((size, size))
    for i, j, total in parts.groupBy("i", "j").agg(F.sum("total").alias("total")).collect():
        if j < 0:
            means[i] = total / model.count
        else:
            products[i, j] = products[j, i] = total / model.count
    # Whitened rows are centred already: their means are rounding errors.
    return float(np.abs(products - np.outer(means, means) - np.eye(size)).max())


def _apply(model: Whitening, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, ROWS):
            part = batch.slice(start, ROWS)
            at, rows = whole(part.column(1), len(model.sums))
            made = _whitened(model, rows)
            missing = np.zeros((len(rows), model.components - made.shape[1]))
            flat = np.concatenate([made, missing], axis=1).reshape(-1)
            absent = np.tile(np.arange(model.components) >= made.shape[1], len(rows))
            ends = np.arange(len(rows) + 1, dtype=np.int32) * model.components
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(at)),
                    pa.array(_deviations(model, rows), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, mask=absent)),
                ],
                names=names,
            )


def apply(vectors: DataFrame, model: Whitening, *, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(id, deviation, whitened)`` of each usable vector; ``whitened`` holds its components in order."""
    ship(vectors.sparkSession)
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    schema = T.StructType([
        rows.schema["id"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))
    ])
    return rows.mapInArrow(functools.partial(_apply, model, schema.names), schema)


def whiten(
    vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 32
) -> DataFrame:
    """One row per usable vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    model = fit(vectors, vector_col=vector_col, components=components)
    if model is None:
        empty = vectors.select(F.col(id_col).alias("id")).where(F.lit(False))
        kinds = ["component int", "n long", "deviation long", "whitened double", "explained double", "identity_error double"]
        return empty.select("id", *[F.lit(None).cast(k.split()[1]).alias(k.split()[0]) for k in kinds])
    error = identity_error(vectors, model, vector_col=vector_col)
    share = [*model.explained.tolist(), *[0.0] * (model.components - len(model.explained))]
    rows = apply(vectors, model, id_col=id_col, vector_col=vector_col)
    rows = rows.select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select(
        "id",
        (F.col("place") + 1).alias("component"),
        F.lit(model.count).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.array(*[F.lit(s) for s in share]), F.col("place")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
