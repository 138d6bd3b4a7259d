"""Operator 13, embedding whitening: principal components by spectrum slicing.

Vectors become fixed-point integers, so sums are exact.  Two passes over the
table gather the sums and the centred second moments, task by task and added
up in Spark; only the d x d covariance comes to the driver, where
``spectrum.leading`` takes its leading eigenpairs.  A third pass measures the
covariance of the whitened rows, and ``whitened`` projects any table.

What the driver and each task hold is bounded by the vectors' dimension d:
d x d doubles and as many rows as ``ENTRIES_AT_ONCE`` entries make.

Defined results: a vector that is null, empty, or holds a null or non-finite
entry (or one of 2^56 or more, which has no fixed-point integer) is left out;
vectors of another length than most (ties: the longer) are left out too;
repeated rows each count and each get their rows; components whose variance is
numerically zero (``FLAT`` of the largest) do not exist, so fewer than asked
may come, none for one vector or equal ones; extra columns pass through
``whitened``, where its own two columns replace any of their names; empty
tables give no rows.  ``deviation`` is null where it passes 64 bits.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import python_ready, table
from .spectrum import leading

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
LARGEST = 2.0**62
FLAT = 1e-11
ENTRIES_AT_ONCE = 1 << 20


def fixed_point(column: pa.Array, only: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, x): the row numbers of the usable vectors of one length and
    their integers floor(64 c) + 1000000, a piece at a time."""
    sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False) * SCALE
    ends = np.concatenate([[0], np.cumsum(sizes)])
    bad = np.concatenate([[0], np.cumsum(~(np.abs(values) < LARGEST))])
    usable = (bad[ends[1:]] == bad[ends[:-1]]) & (sizes > 0)
    for size in np.unique(sizes[usable]) if only is None else [only]:
        rows = np.flatnonzero(usable & (sizes == size))
        step = max(1, ENTRIES_AT_ONCE // int(size))
        for at in range(0, len(rows), step):
            some = rows[at : at + step]
            yield some, np.floor(values[ends[some][:, None] + np.arange(size)]).astype(np.int64) + SHIFT


def column_sums(x: np.ndarray) -> np.ndarray:
    """Exact sums over the rows, as Python integers where 64 bits are too few."""
    if float(np.abs(x.astype(float)).max(initial=0)) * len(x) < LARGEST:
        return x.sum(axis=0).astype(object)
    return x.astype(object).sum(axis=0)


def sums(vectors: DataFrame) -> DataFrame:
    """(size, pos, n, total) of the usable vectors of each length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for batch in batches:
            for _, x in fixed_point(batch.column(0)):
                held = found.setdefault(x.shape[1], [0, np.zeros(x.shape[1], dtype=object)])
                held[0] += len(x)
                held[1] = held[1] + column_sums(x)
        for size, (n, total) in found.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()), pa.array([n] * size, pa.int64()),
                 pa.array([Decimal(int(t)) for t in total], pa.decimal128(38, 0))], names=["size", "pos", "n", "total"])

    each = vectors.mapInArrow(run, "size int, pos int, n long, total decimal(38,0)")
    return each.groupBy("size", "pos").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def second_moments(vectors: DataFrame, size: int, form: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum of f f^T over the ``width`` numbers f that ``form`` makes of
    each vector: products are added in the tasks, tasks in Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            for _, x in fixed_point(batch.column(0), size):
                f = form(x)
                total += f.T @ f
        i, j = np.triu_indices(width)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], names=["i", "j", "v"])

    parts = vectors.mapInArrow(run, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    out = np.zeros((width, width))
    i, j, v = (parts.column(c).to_numpy() for c in ("i", "j", "v"))
    out[i, j] = v
    out[j, i] = v
    return out


@dataclass(frozen=True)
class Whitening:
    """What was learned: the fit list's size and sums, and its components."""

    n: int
    total: tuple[int, ...]  # exact sums of the integers
    values: np.ndarray
    vectors: np.ndarray  # one column for each component
    trace: float
    identity_error: float = 0.0

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if len(self.values) else self.values

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n: the whole part exactly, then the rest in doubles."""
        whole = np.array([t // self.n for t in self.total], dtype=np.int64)
        part = np.array([(t % self.n) / self.n for t in self.total])
        return (x - whole).astype(float) - part

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """The sum of (n x - S)^2 of each row, exact."""
        whole = np.array([t // self.n for t in self.total], dtype=np.int64)
        part = np.array([t % self.n for t in self.total], dtype=np.int64)
        y = x - whole
        bound = (float(np.abs(y.astype(float)).max(initial=0)) + 1) * self.n
        if bound * bound * x.shape[1] < LARGEST:
            return ((y * self.n - part) ** 2).sum(axis=1).tolist()
        exact = ((y.astype(object) * self.n - part.astype(object)) ** 2).sum(axis=1)
        return [int(d) if d < 1 << 63 else None for d in exact]


def fit(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Components of all usable vectors of ``column``; None without any."""
    python_ready(vectors.sparkSession)
    only = vectors.select(F.col(f"`{column}`").alias("v"))
    gathered = sums(only)
    most = gathered.filter("pos = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    total = [int(r["total"]) for r in gathered.filter(F.col("size") == most["size"]).orderBy("pos").select("total").collect()]
    bare = Whitening(most["n"], tuple(total), np.empty(0), np.empty((len(total), 0)), 0.0)
    covariance = second_moments(only, len(total), bare.centred, len(total)) / bare.n
    e, u = leading(covariance, components)
    real = e > FLAT * max(float(e[0]), 0.0)
    found = Whitening(bare.n, bare.total, e[real], u[:, real], float(np.trace(covariance)))
    if not real.any():
        return found
    k = int(real.sum())
    spread = second_moments(only, len(total), lambda x: np.hstack([found.project(x), np.ones((len(x), 1))]), k + 1) / bare.n
    error = spread[:k, :k] - np.outer(spread[:k, k], spread[:k, k]) - np.eye(k)
    return Whitening(found.n, found.total, found.values, found.vectors, found.trace, float(np.abs(error).max()))


def whitened(vectors: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """All columns of ``vectors`` with ``deviation`` and ``whitened`` (an array
    of one number for each component); rows with a usable vector only."""
    python_ready(vectors.sparkSession)
    kept = [c for c in vectors.columns if c.lower() not in ("deviation", "whitened")]
    vectors = vectors.select(*[f"`{c}`" for c in kept])
    at, size, k = kept.index(column), len(model.total), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x in fixed_point(batch.column(at), size):
                flat, ends = model.project(x).ravel(), np.arange(0, len(rows) * k + 1, k) if k else np.zeros(len(rows) + 1)
                some = batch.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array(model.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat))], names=[*kept, "deviation", "whitened"])

    schema = T.StructType([*vectors.schema.fields, T.StructField("deviation", T.LongType()),
                           T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return vectors.mapInArrow(run, schema)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All usable vectors of the table on their up to 32 leading components."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return digest(vectors, fit(vectors))


def digest(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """The query's columns: one row for each vector and component."""
    if model is None or not len(model.values):
        kind = vectors.schema["vec_id"].dataType.simpleString()
        return vectors.sparkSession.createDataFrame([], f"vec_id {kind}, component int, n long, deviation long, whitened double, "
                                                        "explained double, identity_error double")
    shares = F.array(*[F.lit(float(s)) for s in model.explained])
    each = whitened(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("pos", "whitened"))
    return each.select("vec_id", (F.col("pos") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("pos")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))


QUERIES = {"op13_embedding_whitening": op13_embedding_whitening}
ORACLES: dict = {}
