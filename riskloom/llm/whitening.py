"""Whitening of embeddings from a covariance by polarisation."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskloom.llm.common import field, finite_vector, slices
from riskloom.session import materialize, ship_package

SCALE = 256
COMPONENTS = 4
# Sums travel as digits of this many bits, so that adding them up in longs stays exact.
DIGIT = 32
DIGITS = 6
_EXACT = T.DecimalType(38, 0)


def scaled(vectors: DataFrame, id_col: str, vec_col: str, scale: int = SCALE) -> DataFrame:
    """`id_col`, `x`: the scaled whole-number vectors of all rows that take part."""
    given = vectors.select(F.col(id_col), F.col(vec_col).alias("v")).where(finite_vector("v"))
    lengths = given.groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"))
    usual = lengths.orderBy(F.desc("rows"), F.desc("n")).limit(1).select("n").scalar()
    x = F.transform("v", lambda c: F.floor(c.cast("double") * scale))
    return given.where(F.size("v") == usual).select(id_col, x.alias("x"))


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _within(values: np.ndarray, factor: int, rows: int = 1) -> np.ndarray:
    """The values in longs if sums of `rows` squares of `factor` times them fit, else as whole numbers of any size."""
    most = max(abs(int(values.max(initial=0))), abs(int(values.min(initial=0)))) * factor
    return values.astype(np.int64) if most * most * rows < 1 << 63 else values.astype(object)


def _less(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x - centre, exactly."""
    if max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))), *map(abs, centre.tolist())) < 1 << 61:
        return x - centre.astype(np.int64)
    return x.astype(object) - centre


def square_sums(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """Exact sums over the rows of (u_i + u_j)^2 for i < j and of u_i^2 for i = j, u being x - centre; whole numbers."""
    u = _within(_less(x, centre), 2, len(x))
    size = u.shape[1]
    sums = np.zeros((size, size), object)
    for i in range(size):
        pairs = u[:, i:] + u[:, i : i + 1]
        pairs[:, 0] = u[:, i]
        sums[i, i:] = (pairs * pairs).sum(axis=0)
    return sums


@dataclass(frozen=True)
class Whitening:
    """What whitening needs of the fit list: exact sums, and the leading components."""

    n: int
    sums: list[int]
    centre: list[int]  # the whole number next to each mean
    vectors: np.ndarray  # one component a row
    values: np.ndarray  # their eigenvalues
    trace: float
    rank: int  # components above rounding

    def _offsets(self) -> list[int]:
        return [s - self.n * c for s, c in zip(self.sums, self.centre)]

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened components of the rows; NaN beyond the rank."""
        rest = np.array([s / self.n for s in self._offsets()])
        centred = _less(x, np.array(self.centre, object)).astype(np.float64) - rest
        out = np.full((len(x), len(self.values)), np.nan)
        for k in range(min(self.rank, len(self.values))):
            out[:, k] = (centred * self.vectors[k]).sum(axis=1) / np.sqrt(self.values[k])
        return out

    def deviation(self, x: np.ndarray) -> list[int]:
        """Exact sums over the dimensions of (n * x - S)^2."""
        u = _less(x, np.array(self.centre, object))
        most = max(abs(int(u.max(initial=0))), abs(int(u.min(initial=0))))
        offsets = np.array(self._offsets(), object)
        if (most + 1) * self.n < 1 << 62:
            d = _within(u.astype(np.int64) * self.n - offsets.astype(np.int64), 1, x.shape[1])
        else:
            d = u.astype(object) * self.n - offsets
        return (d * d).sum(axis=1).tolist()


def _square_sums(fit: DataFrame, centre: list[int]) -> dict[tuple[int, int], int]:
    """The square sums of the whole fit list: each task adds up its rows, Spark the tasks."""
    middle = np.array(centre, object)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches):
            found = square_sums(_matrix(batch.column(0)), middle)
            total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(len(total))
            flat = total[i, j].tolist()
            digits = [pa.array([v >> DIGIT * k & (1 << DIGIT) - 1 for v in flat], pa.int64()) for k in range(DIGITS)]
            yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), *digits], names=names)

    names = ["i", "j", *(f"d{k}" for k in range(DIGITS))]
    schema = "i int, j int, " + ", ".join(f"{d} long" for d in names[2:])
    sums = fit.mapInArrow(run, schema).groupBy("i", "j").agg(*[F.sum(d).alias(d) for d in names[2:]])
    return {(r["i"], r["j"]): sum(r[f"d{k}"] << DIGIT * k for k in range(DIGITS)) for r in sums.collect()}


def covariance(n: int, rests: list[int], squares: dict[tuple[int, int], int]) -> tuple[np.ndarray, float]:
    """Covariances, each the double next to its exact value, and their trace.

    With u the values less the whole number next to the mean, n * sum(u^2) - sum(u)^2 is
    n^2 times the variance, whichever number was taken off. The covariance of two
    dimensions is half of what the variance of their sum exceeds theirs by.
    """
    size = len(rests)
    own = [n * squares[i, i] - rests[i] ** 2 for i in range(size)]
    matrix = np.zeros((size, size))
    for i in range(size):
        matrix[i, i] = own[i] / n**2
        for j in range(i + 1, size):
            both = n * squares[i, j] - (rests[i] + rests[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - own[i] - own[j]) / (2 * n**2)
    return matrix, sum(own) / n**2


def fit_whitening(fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening fitted on the vectors `x` of a staged table; None if there are none.

    The driver holds one number for each pair of dimensions, whatever the rows.
    """
    each = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    rows = each.agg(F.count("*").alias("n"), F.sum(F.col("v").cast("decimal(20,0)")).alias("s")).orderBy("i").collect()
    if not rows:
        return None
    n, sums = rows[0]["n"], [int(r["s"]) for r in rows]
    centre = [(2 * s + n) // (2 * n) for s in sums]
    squares = _square_sums(fit, centre)
    matrix, trace = covariance(n, [s - n * c for s, c in zip(sums, centre)], squares)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors.T[::-1][:components]
    signs = np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])
    noise = max(values[0], 0.0) * len(matrix) * np.finfo(float).eps
    return Whitening(n, sums, centre, vectors * signs[:, None], values, trace, int((values > noise).sum()))


def _projected(rows: DataFrame, model: Whitening, id_col: str | None) -> DataFrame:
    """`id_col` if given, `deviation`, `whitened` (an array, null beyond the rank)."""
    ship_package(rows.sparkSession)
    keep = [id_col] if id_col else []
    given = rows.select(*keep, "x")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            x = _matrix(batch.column(len(keep)))
            exact = [Decimal(d) if d < 10**38 else None for d in model.deviation(x)]
            white = pa.array(model.project(x).ravel(), pa.float64(), from_pandas=True)
            offsets = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(model.values))
            columns = [*(batch.column(i) for i in range(len(keep))), pa.array(exact, pa.decimal128(38, 0))]
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(offsets, white)], names=schema.names)

    schema = T.StructType(
        [
            *(field(given, c) for c in keep),
            T.StructField("deviation", _EXACT),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )
    return given.mapInArrow(run, schema)


def identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest absolute entry of the whitened fit list's covariance less the identity; None without components."""
    several = min(model.rank, len(model.values))
    if not several:
        return None
    white = _projected(fit, model, None).select(*(F.get("whitened", F.lit(k)).alias(f"w{k}") for k in range(several)))
    entries = [
        F.abs(F.covar_pop(f"w{a}", f"w{b}") - float(a == b)).alias(f"e{a}_{b}") for a in range(several) for b in range(a, several)
    ]
    return max(white.agg(*entries).first())


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", scale: int = SCALE, components: int = COMPONENTS
) -> DataFrame:
    """`id_col`, `component`, `n`, `deviation`, `whitened`, `explained`, `identity_error`: one row per vector and component.

    A vector's entries c become x = floor(scale * c), at the ends of a long if that is
    beyond it. Each distinct x counts once in the covariance, which is exact: sums of
    whole squares of the centred values of every dimension, and of the sums of every two.
    `whitened` is the centred vector's share along a component over the root of its
    eigenvalue, `explained` the eigenvalue's part of the trace, and `deviation` the exact
    sum of (n * x - S)^2, null beyond 38 digits.

    Vectors that are null, empty, hold null or non-finite entries, or are of another
    length than most (the longest of equally many) take no part. Repeated rows and null
    ids stay, each with its own rows. Components without variance have a null `whitened`;
    without any, `explained` and `identity_error` are null. Other columns are ignored;
    an empty table gives an empty one.
    """
    ship_package(vectors.sparkSession)
    rows = materialize(scaled(vectors, id_col, vec_col, scale), "scaled-vectors")
    fit = materialize(rows.select("x").distinct(), "distinct-vectors")
    model = fit_whitening(fit, components)
    if model is None:
        none = Whitening(0, [], [], np.empty((0, 0)), np.empty(0), 0.0, 0)
        model, error = none, None
    else:
        error = identity_error(fit, model)
    shares = [float(e / model.trace) if model.trace > 0 else None for e in model.values]
    parts = F.lit(shares).cast("array<double>") if shares else F.array().cast("array<double>")
    wide = _projected(rows, model, id_col).select(id_col, "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return wide.select(
        id_col,
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(parts, F.col("k")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
