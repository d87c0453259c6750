"""Operator 12: whitening of embeddings by spectrum slicing.

Entries become long integers ``floor(256 * c)``. The fit list holds each distinct integer
vector once, so copies, however many, do not weigh. Spark makes the list, its sums and its
covariance: every task adds up its share of the list in a few matrices, and these are added
up row by row of the covariance. What reaches the driver is one matrix of dims x dims
numbers (at most ``MAX_DIMS`` squared), whatever the number of vectors.

Its leading eigenpairs come from spectrum slicing. By Sylvester's law the positive pivots of
an LDL' factoring of V - s I count the eigenvalues above s; pivots are chosen over the whole
remainder (1 x 1 or 2 x 2), which bounds their growth. Bisection on these counts isolates
the k-th eigenvalue, Rayleigh quotient iteration from inside its interval converges
cubically, and counts on both sides of what it found certify that it is the k-th. Equal
eigenvalues are taken one after the other, orthogonal to those found.

Defined cases: rows whose vector is null or holds null or non-finite entries are left out;
a shorter vector, an empty one too, counts as filled up with zeros. Components whose
variance is no more than rounding (fewer distinct vectors than components, or all equal)
do not exist and have no rows. An empty table has no rows. Rows of one id, null or not, are
rows of their own. Only the two named columns are looked at. Entries must keep 256 * c
within 2**40; a deviation over 38 digits fails.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import staged, table

COMPONENTS = 4
SCALE = 256
MAX_DIMS = 4096
# At most so many tasks add up the list, so that a row of the covariance is the sum of so
# many rows; each holds one matrix, however long its share.
PARTS = 1024
EPS = np.finfo(float).eps
# Bound of growth in symmetric pivoting: (1 + sqrt(17)) / 8.
PIVOT = (1 + 17**0.5) / 8
BISECTIONS = 200
ITERATIONS = 12


# --- leading eigenpairs of one symmetric matrix ----------------------------------


def above(matrix: np.ndarray, shift: float) -> int:
    """How many eigenvalues lie above ``shift``: the positive pivots of LDL'."""
    rest = matrix - shift * np.eye(len(matrix))
    positive = 0
    while len(rest):
        diagonal = np.abs(np.diag(rest))
        one = int(diagonal.argmax())
        i, j = divmod(int(np.abs(rest).argmax()), len(rest))
        largest = abs(rest[i, j])
        if largest == 0:
            break
        block = [one] if diagonal[one] >= PIVOT * largest else [i, j]
        others = np.delete(np.arange(len(rest)), block)
        pivot, sides = rest[np.ix_(block, block)], rest[np.ix_(others, block)]
        # A 2 x 2 pivot is only taken where it has one root on each side of zero.
        positive += 1 if len(block) == 2 else int(pivot[0, 0] > 0)
        rest = rest[np.ix_(others, others)] - sides @ np.linalg.solve(pivot, sides.T)
        rest = (rest + rest.T) / 2
    return positive


class Slices:
    """Counts of eigenvalues above shifts; every count narrows the intervals."""

    def __init__(self, matrix: np.ndarray):
        self.matrix = matrix
        # No eigenvalue is larger than the largest sum of a row.
        self.norm = float(np.abs(matrix).sum(axis=1).max())
        edge = self.norm * (1 + 4 * EPS)
        self.counts = {-edge: len(matrix), edge: 0}

    def count(self, shift: float) -> int:
        if shift not in self.counts:
            self.counts[shift] = above(self.matrix, shift)
        return self.counts[shift]

    def interval(self, k: int) -> tuple[float, float]:
        """The narrowest known interval that holds the k-th largest eigenvalue."""
        low = max(s for s, n in self.counts.items() if n >= k)
        high = min(s for s, n in self.counts.items() if n < k and s > low)
        return low, high

    def alone(self, k: int) -> bool:
        low, high = self.interval(k)
        return self.counts[low] == k and self.counts[high] == k - 1


def _solve(matrix: np.ndarray, shift: float, vector: np.ndarray, norm: float) -> np.ndarray:
    """(matrix - shift I)^-1 vector, at length one; a singular matrix is moved a little."""
    for nudge in (0.0, EPS * norm, 16 * EPS * norm):
        try:
            out = np.linalg.solve(matrix - (shift + nudge) * np.eye(len(matrix)), vector)
        except np.linalg.LinAlgError:
            continue
        length = np.linalg.norm(out)
        if np.isfinite(length) and length > 0:
            return out / length
    return vector


def _rayleigh(
    matrix: np.ndarray, shift: float, found: list[np.ndarray], norm: float, seed: int
) -> tuple[float, np.ndarray, float]:
    """Value, vector and residual of Rayleigh quotient iteration, orthogonal to ``found``."""

    def apart(x: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for other in found:
                x = x - other * (other @ x)
        length = np.linalg.norm(x)
        return x / length if length else x

    vector = apart(np.random.default_rng(seed).standard_normal(len(matrix)))
    for _ in range(2):  # towards what lies nearest to the middle of the interval
        vector = apart(_solve(matrix, shift, vector, norm))
    value = shift
    best = (value, vector, np.inf)
    for _ in range(ITERATIONS):
        value = float(vector @ matrix @ vector)
        residual = float(np.linalg.norm(matrix @ vector - value * vector))
        if residual < best[2]:
            best = (value, vector, residual)
        if residual <= 4 * EPS * norm:
            break
        vector = apart(_solve(matrix, value, vector, norm))
    return best


def leading(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their vectors as rows.

    Only eigenvalues that stand out from rounding are returned. Each is certified: counts
    on both sides of it, no further off than its residual allows, say that it is the k-th.
    """
    size = len(matrix)
    slices = Slices(matrix)
    floor = 8 * size * EPS * slices.norm
    values: list[float] = []
    vectors: list[np.ndarray] = []
    present = slices.count(floor) if slices.norm > 0 else 0
    for k in range(1, min(wanted, present) + 1):
        for attempt in range(BISECTIONS):
            low, high = slices.interval(k)
            middle = (low + high) / 2
            narrow = high - low <= 16 * EPS * slices.norm
            if slices.alone(k) or narrow:
                value, vector, residual = _rayleigh(matrix, middle, vectors, slices.norm, k)
                margin = max(2 * residual, 16 * size * EPS * slices.norm)
                certified = (
                    residual <= 1e-10 * slices.norm
                    and slices.count(value - margin) >= k
                    and slices.count(value + margin) < k
                )
                if certified:
                    break
            if narrow:
                raise ArithmeticError(f"eigenvalue {k} could not be certified")
            slices.count(middle)
        else:
            raise ArithmeticError(f"eigenvalue {k} could not be isolated")
        values.append(value)
        vectors.append(vector)
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], np.array(vectors).reshape(-1, size)[order]


# --- the fit -----------------------------------------------------------------------


@dataclass(frozen=True)
class Whitening:
    """n and sums of the fit list, and the components as rows; of bounded size."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray
    identity_error: float = 0.0

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])

    @property
    def projection(self) -> np.ndarray:
        """dims x components: from centred entries to whitened ones."""
        return self.vectors.T / np.sqrt(self.values)


def _usable(vector: Column) -> Column:
    finite = F.forall(
        vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf")))
    )
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(rows: DataFrame, row_id: str, vector: str) -> tuple[DataFrame, int]:
    """(row_id, x) of the rows with a usable vector, x filled up to the longest one."""
    typed = rows.select(
        F.col(f"`{row_id}`").alias("row_id"), F.col(f"`{vector}`").cast("array<double>").alias("v")
    ).where(_usable(F.col("v")))
    dims = typed.agg(F.max(F.size("v"))).first()[0] or 0
    if dims > MAX_DIMS:
        raise ValueError(f"vectors of {dims} entries; at most {MAX_DIMS} are supported")
    scaled = F.transform("v", lambda c: F.floor(c * SCALE))
    filler = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))
    return typed.select("row_id", F.concat(scaled, filler).alias("x")), dims


def _matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _sums(fit: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Rows of the list and their exact sums: one row a task, added up by Spark."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(dims, np.int64)
        for batch in batches:
            x = _matrix(batch.column("x"), dims)
            n, sums = n + len(x), sums + x.sum(axis=0)
        if n:
            places = np.arange(-1, dims)
            values = np.concatenate([[n], sums])
            yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(values)], ["at", "s"])

    parts = fit.select("x").coalesce(PARTS).mapInArrow(partial, "at long, s long")
    total = {
        r["at"]: int(r["s"])
        for r in parts.groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    }
    return total.get(-1, 0), [total.get(i, 0) for i in range(dims)]


def _products(fit: DataFrame, dims: int, centre: np.ndarray, turn: np.ndarray | None = None) -> np.ndarray:
    """Sum over the list of y y' with y = x - centre, or of what ``turn`` makes of it."""
    size = dims if turn is None else turn.shape[1]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            y = _matrix(batch.column("x"), dims) - centre
            y = y if turn is None else y @ turn
            total += y.T @ y
        rows = pa.array(list(total), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size)), rows], ["at", "row"])

    def added(rows: pd.DataFrame) -> pd.DataFrame:
        stacked = np.stack(rows["row"].to_numpy())
        return pd.DataFrame({"at": rows["at"].iloc[:1], "row": [stacked.sum(axis=0)]})

    schema = "at long, row array<double>"
    parts = fit.select("x").coalesce(PARTS).mapInArrow(partial, schema)
    rows = parts.groupBy("at").applyInPandas(added, schema).collect()
    total = np.zeros((size, size))
    for row in rows:
        total[row["at"]] = row["row"]
    return (total + total.T) / 2


def fit_whitening(x: DataFrame, dims: int, components: int = COMPONENTS) -> Whitening | None:
    """The model of the distinct vectors ``x``; None where there are none."""
    fit = staged(x.select("x").distinct(), "fit")
    n, sums = _sums(fit, dims) if dims else (0, [])
    if not n:
        return None
    mean = np.array([s / n for s in sums])
    covariance = _products(fit, dims, mean) / n
    values, vectors = leading(covariance, components)
    explained = values / np.trace(covariance) if len(values) else values
    model = Whitening(n, sums, values, vectors, explained)
    if not len(values):
        return model
    identity = _products(fit, dims, mean, model.projection) / n
    error = float(np.abs(identity - np.eye(len(values))).max())
    return Whitening(n, sums, values, vectors, explained, error)


SCHEMA = (
    "component int, n long, deviation decimal(38,0), whitened double, explained double, "
    "identity_error double"
)


def transform(x: DataFrame, dims: int, model: Whitening) -> DataFrame:
    """(row_id, component, n, deviation, whitened, explained, identity_error), a row for
    each row of ``x`` and component; the deviation is exact."""
    k = len(model.values)
    squares = sum(s * s for s in model.sums)
    largest = max(map(abs, model.sums), default=0)
    id_type = x.schema["row_id"].dataType.simpleString()

    def whitened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entries = _matrix(batch.column("x"), dims)
            bound = int(np.abs(entries).max(initial=0)) * max(largest, 1) * dims
            exact = entries if bound < 2**62 else entries.astype(object)
            own = (exact * exact).sum(axis=1)
            mixed = exact @ np.array(model.sums, exact.dtype)
            n = model.n
            deviation = [n * n * int(a) - 2 * n * int(b) + squares for a, b in zip(own, mixed)]
            values = (entries - model.mean) @ model.projection
            rows = np.repeat(np.arange(len(entries)), k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row_id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(entries))),
                    pa.array(np.full(len(rows), n)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(rows)),
                    pa.array(values.reshape(-1)),
                    pa.array(np.tile(model.explained, len(entries))),
                    pa.array(np.full(len(rows), model.identity_error)),
                ],
                names,
            )

    names = ["row_id", *(part.split()[0] for part in SCHEMA.replace("(38,0)", "").split(", "))]
    return x.mapInArrow(whitened, f"row_id {id_type}, {SCHEMA}")


def whiten(
    rows: DataFrame, row_id: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS
) -> DataFrame:
    """Whitened components of every usable row, named by its id."""
    x, dims = integers(rows, row_id, vector)
    model = fit_whitening(x, dims, components)
    if model is None or not len(model.values):
        id_type = x.schema["row_id"].dataType.simpleString()
        out = rows.sparkSession.createDataFrame([], f"row_id {id_type}, {SCHEMA}")
    else:
        out = transform(x, dims, model)
    return out.withColumnRenamed("row_id", row_id)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whiten(table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("long"))
