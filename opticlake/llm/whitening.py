"""Whitening of embeddings by blockwise QR, Householder bidiagonalisation, dqds and twisted factorisations.

* Components become whole numbers, x = floor(scale * c) + offset, so sums are exact: one pass gives the number of rows n and
  the sum S of each dimension.
* Centred rows are (n * x - S) / n, the difference taken in whole numbers: no digits are lost to a large offset. In a second
  pass each task brings its rows to triangular form, block by block (QR of the factor so far and the next block). The factors
  of FAN_IN tasks at a time are brought to one in the same way, until one R of at most dimensions x dimensions is left.
  R^T R is n times the covariance, but the covariance itself, which would square the condition, is never formed.
* R is small. `bidiagonal` gives its singular values by dqds and the directions by twisted factorisations on the driver.
* A third pass whitens the rows and sums the products of the whitened values; the last one gives them out. A task holds
  one batch of rows and one factor. A task that is lost is computed again from the table and the fit.

Edge cases: vectors that are NULL, empty, not of the usual length (the commonest; of several the shortest), with NULL or
non-finite components or with components of 2**48 or more after scaling take no part; a row with a NULL number is a row like
any other; repeated rows count as often as they occur; directions without variance (a singular value of at most 1e-11 of the
largest) are no components, so constant vectors, a single row and an empty table give no rows; a deviation that does not fit
a long is NULL; equal eigenvalues share a plane in which any orthonormal directions are right; further columns are not
looked at. Vectors may have MOST_SIZE components at most.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opticlake.llm.bidiagonal import bidiagonalise, dqds, turn_back, twisted_vectors
from opticlake.llm.catalog import query
from opticlake.llm.vectors import finite_vectors, matrix

COMPONENTS, SCALE, OFFSET = 32, 64, 1_000_000
LARGEST = 1 << 48
MOST_SIZE = 4096  # a factor of that size has 128 MB
LEAST = 1e-11
FAN_IN = 32


@dataclass
class Whitening:
    """What whitens a vector: x goes to (x - sums / n) @ directions / sqrt(values)."""

    n: int
    sums: np.ndarray  # exact, of whole numbers
    directions: np.ndarray  # one column per component
    values: np.ndarray  # eigenvalues of the covariance, falling
    trace: float
    scale: int
    offset: int

    def whole(self, column: pa.Array) -> np.ndarray:
        return whole(column, self.scale, self.offset)

    def apart(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact."""
        return apart(x, self.n, self.sums)

    def apply(self, apart: np.ndarray) -> np.ndarray:
        return apart.astype(np.float64) / self.n @ self.directions / np.sqrt(self.values)


def whole(column: pa.Array, scale: int, offset: int) -> np.ndarray:
    return np.floor(scale * matrix(column)).astype(np.int64) + offset


def apart(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - sums, in longs where they fit, else in Python's numbers."""
    largest = n * int(np.abs(x).max(initial=0)) + max((abs(int(s)) for s in sums), default=0)
    if largest < 1 << 62:
        return n * x - sums.astype(np.int64)
    return n * x.astype(object) - sums


def deviations(apart: np.ndarray) -> pa.Array:
    """Sum of squares of each row, exact; NULL where it is no long."""
    most = int(np.abs(apart).max(initial=0))
    if apart.dtype != object and most**2 * max(1, apart.shape[1]) < 1 << 63:
        return pa.array((apart * apart).sum(1), pa.int64())
    sums = (apart.astype(object) ** 2).sum(1)
    return pa.array([int(s) if s < 1 << 63 else None for s in sums], pa.int64())


def _sums(vectors: DataFrame, scale: int, offset: int) -> DataFrame:
    """(size, place, n, total) of each length of vectors and each of its dimensions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column("vector")
            lengths = pc.list_value_length(column)
            for size in pc.unique(lengths).to_pylist():
                own = whole(column.filter(pc.equal(lengths, size)), scale, offset)
                n, sums = held.get(size, (0, np.zeros(size, object)))
                held[size] = n + len(own), sums + own.sum(0).astype(object)
        rows = [(size, i, n, str(s)) for size, (n, sums) in held.items() for i, s in enumerate(sums)]
        columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int32(), pa.int32(), pa.int64(), pa.string()), strict=True)],
                                         names=["size", "place", "n", "total"])

    found = vectors.select("vector").mapInArrow(scan, "size int, place int, n long, total string")
    return found.groupBy("size", "place").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))


def _merged(parts: DataFrame, merge: Callable[[Iterator[bytes]], bytes | None]) -> bytes | None:
    """The one payload that those of all tasks come to, FAN_IN tasks at a time."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = merge(p for batch in batches for p in batch.column("part").to_pylist())
        if one is not None:
            yield pa.RecordBatch.from_arrays([pa.array([one], pa.binary())], names=["part"])

    tasks = parts.rdd.getNumPartitions()
    while tasks > 1:
        tasks = -(-tasks // FAN_IN)
        parts = parts.repartition(tasks).mapInArrow(scan, "part binary")
    return merge(row["part"] for row in parts.collect())


def _triangle(size: int) -> Callable[[Iterator[bytes]], bytes | None]:
    def merge(parts: Iterator[bytes]) -> bytes | None:
        r = None
        for part in parts:
            rows = np.frombuffer(part).reshape(-1, size)
            r = rows if r is None else np.linalg.qr(np.vstack([r, rows]), mode="r")
        return None if r is None else np.ascontiguousarray(r).tobytes()

    return merge


def _factor(vectors: DataFrame, n: int, sums: np.ndarray, scale: int, offset: int) -> np.ndarray:
    """The triangular factor of all centred rows."""
    size = len(sums)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, rows = np.zeros((0, size)), [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            waiting.append(apart(whole(batch.column("vector"), scale, offset), n, sums).astype(np.float64) / n)
            rows += len(waiting[-1])
            if rows >= 4 * size:
                r, waiting, rows = np.linalg.qr(np.vstack([r, *waiting]), mode="r"), [], 0
        if waiting:
            r = np.linalg.qr(np.vstack([r, *waiting]), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(r).tobytes()], pa.binary())], names=["part"])

    found = _merged(vectors.select("vector").mapInArrow(scan, "part binary"), _triangle(size))
    return np.zeros((0, size)) if found is None else np.frombuffer(found).reshape(-1, size)


def usual_vectors(vectors: DataFrame, number: str, vector: str, scale: int) -> DataFrame:
    return finite_vectors(vectors, number, vector, LARGEST / scale)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """From rows of `usual_vectors`; None where there is nothing to whiten."""
    sums = _sums(rows, scale, offset).persist()
    try:
        usual = sums.groupBy("size").agg(F.max("n").alias("n")).orderBy(F.desc("n"), "size").first()
        if usual is None:
            return None
        size, n = usual["size"], usual["n"]
        if size > MOST_SIZE:
            raise ValueError(f"vectors of {size} components; at most {MOST_SIZE} are taken")
        totals = np.array([int(r["total"]) for r in sums.where(F.col("size") == size).orderBy("place").collect()], object)
    finally:
        sums.unpersist()
    r = _factor(rows.where(F.size("vector") == size), n, totals, scale, offset)
    diagonal, upper, right = bidiagonalise(r)
    squares = dqds(diagonal, upper)
    kept = int((squares > LEAST * LEAST * squares[0]).sum()) if squares[0] > 0 else 0
    if not kept:
        return None
    held = min(components, kept)
    directions = turn_back(twisted_vectors(diagonal, upper, squares, held), right)
    return Whitening(n, totals, directions, squares[:held] / n, float((r * r).sum()) / n, scale, offset)


def identity_error(rows: DataFrame, fit: Whitening) -> float:
    """The largest entry of the covariance of all whitened rows, less the identity."""
    m = fit.directions.shape[1]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((m + 1, m))
        for batch in batches:
            if batch.num_rows:
                white = fit.apply(fit.apart(fit.whole(batch.column("vector"))))
                total[:m] += white.T @ white
                total[m] += white.sum(0)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["part"])

    def merge(parts: Iterator[bytes]) -> bytes:
        return sum((np.frombuffer(p) for p in parts), np.zeros((m + 1) * m)).tobytes()

    total = np.frombuffer(_merged(rows.select("vector").mapInArrow(scan, "part binary"), merge)).reshape(m + 1, m) / fit.n
    return float(np.abs(total[:m] - np.outer(total[m], total[m]) - np.eye(m)).max())


def whiten(vectors: DataFrame, components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET, number: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row per vector that takes part: number, deviation and white, its whitened components, with n, explained and identity_error of the fit."""
    schema = "number long, n long, deviation long, white array<double>, explained array<double>, identity_error double"
    rows = usual_vectors(vectors, number, vector, scale)
    fit = fit_whitening(rows, components, scale, offset)
    if fit is None:
        return vectors.sparkSession.createDataFrame([], schema)
    rows = rows.where(F.size("vector") == len(fit.sums))
    error = identity_error(rows, fit)
    explained = (fit.values / fit.trace).tolist()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            far = fit.apart(fit.whole(batch.column("vector")))
            white = fit.apply(far)
            lists = pa.ListArray.from_arrays(np.arange(len(white) + 1, dtype=np.int32) * white.shape[1], white.ravel())
            yield pa.RecordBatch.from_arrays([batch.column("number"), deviations(far), lists], names=["number", "deviation", "white"])

    found = rows.select("number", "vector").mapInArrow(scan, "number long, deviation long, white array<double>")
    return found.select("number", F.lit(fit.n).cast("long").alias("n"), "deviation", "white",
                        F.array(*map(F.lit, explained)).alias("explained"), F.lit(error).alias("identity_error"))


@query("op11_embedding_whitening")
def op11_embedding_whitening(spark: SparkSession, sf: str) -> DataFrame:
    """One row per vector and component."""
    white = whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))
    each = white.select("*", F.posexplode(F.arrays_zip("white", F.col("explained").alias("share"))).alias("at", "c"))
    return each.select(
        F.col("number").alias("vec_id"), (F.col("at") + 1).alias("component"), "n", "deviation", F.col("c.white").alias("whitened"),
        F.col("c.share").alias("explained"), "identity_error")
