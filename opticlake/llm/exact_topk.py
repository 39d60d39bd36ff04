"""Exact top-k search by integer inner product over a pivot-distance index.

* Space. Components become floor(scale * x). With one more coordinate, sqrt(M^2 - |x|^2) for vectors and 0 for queries
  (M is the largest length), |q - x|^2 = |q|^2 + M^2 - 2 q.x: the highest inner product is the nearest vector.
* Index. Pivots are means of a bounded sample (SAMPLE vectors, SAMPLE_BYTES). Every vector is keyed by its nearest pivot and its
  distance from it. The keys are sorted over the cluster and cut into annuli: blocks of one pivot with a least and a
  largest distance, at most BLOCK_BYTES each. Equal vectors are cut like any others, so a hot vector is many blocks.
* Queries are cut in the same way into blocks of at most QUERY_ROWS, which lie close together.
* Search. A block of queries meets annuli in the order in which they promise near vectors, in steps of growing width. After
  each step the k-th best score of a query is a radius: by the triangle inequality an annulus whose distances from its
  pivot all differ from the query's by more than that holds nothing as good, and is never read. The last step takes all
  annuli that are left, so the search stops only where nothing can be missed.
* Scores are integers: matrix products in double precision where all sums are below 2**53, else in 64-bit integers.

The sample decides only where pivots lie, never the result. On vectors in nearly random directions (distances all alike)
the bounds exclude little, and the search is a scan of all blocks by all blocks of queries.

Edge cases: vectors that are NULL, empty, not of the usual length (the commonest; of several the shortest), with NULL or
non-finite components or with components of 2**27 or more after scaling take no part; rows with a NULL number neither; a
query does not find rows with its own number; other repeated rows are found as often as they occur; a query that occurs
several times is asked once per distinct vector; fewer than k candidates give all of them; ties go to the smaller number;
an empty table gives no rows; further columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opticlake.llm.catalog import query
from opticlake.llm.vectors import finite_vectors, matrix
from opticlake.session import materialize

K, SCALE = 5, 256
LARGEST = 1 << 27  # of a scaled component: a sum of 512 products fits a long
SAMPLE, SAMPLE_BYTES = 4096, 32 << 20
PIVOTS = 256  # most pivots
BLOCK_BYTES = 1 << 19  # of the vectors of a block
QUERY_ROWS = 256
STEPS = [(0, 2), (2, 16), (16, None)]  # blocks that a block of queries meets in each step, the most promising first
SEND_BLOCKS = 100_000  # most blocks whose bounds (36 bytes each) are sent to all tasks
SALTS = 16


@dataclass
class Pivots:
    """Pivots in the space with one more coordinate."""

    points: np.ndarray
    longest: float  # M^2

    def lift(self, rows: np.ndarray) -> np.ndarray:
        return np.hstack([rows, np.sqrt(np.maximum(self.longest - (rows * rows).sum(1), 0.0))[:, None]])

    def far(self, lifted: np.ndarray) -> np.ndarray:
        """Distances of rows from all pivots."""
        return np.stack([np.sqrt(((lifted - p) ** 2).sum(1)) for p in self.points], 1)


def scaled(column: pa.Array | pa.ChunkedArray, scale: int) -> np.ndarray:
    return np.floor(scale * matrix(column))


def _sizes(vectors: DataFrame, scale: int) -> DataFrame:
    """(size, n, longest) of each length of vectors: their number and their largest squared length."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = pa.table({"size": batch.column("vector").value_lengths(), "vector": batch.column("vector")})
            sizes = np.unique(held["size"].to_numpy())
            own = [scaled(held.filter(pa.compute.equal(held["size"], int(s)))["vector"], scale) for s in sizes]
            yield pa.RecordBatch.from_arrays([
                pa.array(sizes, pa.int32()), pa.array([len(x) for x in own], pa.int64()),
                pa.array([float((x * x).sum(1).max()) for x in own], pa.float64())], names=["size", "n", "longest"])

    found = vectors.select("vector").mapInArrow(scan, "size int, n long, longest double")
    return found.groupBy("size").agg(F.sum("n").alias("n"), F.max("longest").alias("longest"))


def fit_pivots(sample: np.ndarray, longest: float, vectors: int, seed: int = 7, rounds: int = 4) -> Pivots:
    """Means of the sample, found by a few rounds of k-means from a seeded start."""
    fit = Pivots(np.zeros((0, 0)), longest)
    rows = fit.lift(sample)
    most = max(1, min(PIVOTS, round(math.sqrt(vectors) / 8), len(rows)))
    rng = np.random.default_rng(seed)
    points = np.unique(rows[rng.choice(len(rows), most, replace=False)], axis=0)
    for _ in range(rounds):
        near = ((points * points).sum(1) - 2 * rows @ points.T).argmin(1)
        points = np.stack([rows[near == i].mean(0) if (near == i).any() else points[i] for i in range(len(points))])
    fit.points = points
    return fit


def _keyed(vectors: DataFrame, pivots: Pivots, scale: int) -> DataFrame:
    """(number, asked, pivot, far, vector as 32-bit integers) of each row."""
    sent = vectors.sparkSession.sparkContext.broadcast(pivots)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = scaled(batch.column("vector"), scale)
            far = sent.value.far(sent.value.lift(rows))
            pivot = far.argmin(1)
            held = np.ascontiguousarray(rows.astype(np.int32))
            width = held.shape[1] * 4
            packed = pa.Array.from_buffers(pa.binary(width), len(held), [None, pa.py_buffer(held)]).cast(pa.binary())
            yield pa.RecordBatch.from_arrays([
                batch.column("number"), batch.column("asked"), pa.array(pivot.astype(np.int32)),
                pa.array(far[np.arange(len(far)), pivot]), packed], names=["number", "asked", "pivot", "far", "vector"])

    return vectors.mapInArrow(scan, "number long, asked boolean, pivot int, far double, vector binary")


_BLOCK = "block long, pivot int, low double, high double, numbers binary, vectors binary, asked binary, n_asked int"


def _annuli(keyed: DataFrame, most: int) -> DataFrame:
    """The index: one row per block of at most `most` vectors of one pivot, next to each other by distance."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        held: pa.Table | None = None

        def pack(part: pa.Table) -> pa.RecordBatch:
            nonlocal made
            part = part.sort_by("number")  # equal scores go to the smaller number, which stands first
            far = part["far"].to_numpy()
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([first + made - 1], pa.int64()), pa.array([part["pivot"][0].as_py()], pa.int32()),
                pa.array([far.min()]), pa.array([far.max()]), pa.array([part["number"].to_numpy().tobytes()], pa.binary()),
                pa.array([b"".join(part["vector"].to_pylist())], pa.binary()),
                pa.array([part["asked"].to_numpy().astype(np.uint8).tobytes()], pa.binary()),
                pa.array([part["asked"].to_numpy().sum()], pa.int32())],
                names=[c.split()[0] for c in _BLOCK.split(", ")])

        for batch in batches:
            part = pa.Table.from_batches([batch])
            held = part if held is None else pa.concat_tables([held, part])
            pivot = held["pivot"].to_numpy()
            at = 0
            while len(pivot) - at > most or (at < len(pivot) and pivot[at] != pivot[-1]):
                end = min(at + most, int(np.searchsorted(pivot, pivot[at], "right")))
                yield pack(held.slice(at, end - at))
                at = end
            held = held.slice(at).combine_chunks()
        if held is not None and held.num_rows:
            yield pack(held)

    dealt = keyed.repartitionByRange("pivot", "far", "number").sortWithinPartitions("pivot", "far", "number")
    return dealt.mapInArrow(scan, _BLOCK)


def _vectors(held: bytes, size: int) -> np.ndarray:
    return np.frombuffer(held, np.int32).reshape(-1, size)


def _query_blocks(blocks: DataFrame, pivots: Pivots, size: int) -> DataFrame:
    """One row per block of queries: their numbers and vectors, and per pivot the least and largest distance from it."""
    sent = blocks.sparkSession.sparkContext.broadcast(pivots)
    asked = blocks.where("n_asked > 0").select("block", "numbers", "vectors", "asked")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, made = TaskContext.get().partitionId() << 32, 0
        numbers, vectors = np.zeros(0, np.int64), np.zeros((0, size), np.int32)

        def pack(n: int) -> pa.RecordBatch:
            nonlocal made, numbers, vectors
            own, numbers = numbers[:n], numbers[n:]
            rows, vectors = vectors[:n], vectors[n:]
            far = sent.value.far(np.hstack([rows.astype(np.float64), np.zeros((n, 1))]))
            made += 1
            return pa.RecordBatch.from_arrays([
                pa.array([first + made - 1], pa.int64()), pa.array([own.tobytes()], pa.binary()), pa.array([rows.tobytes()], pa.binary()),
                pa.array([far.min(0).tolist()]), pa.array([far.max(0).tolist()])], names=["queries", "ids", "rows", "least", "most"])

        for batch in batches:
            for held, rows, marks in zip(*(batch.column(c).to_pylist() for c in ("numbers", "vectors", "asked")), strict=True):
                wanted = np.frombuffer(marks, np.uint8) > 0
                both = np.hstack([np.frombuffer(held, np.int64)[wanted].reshape(-1, 1), _vectors(rows, size)[wanted]])
                both = np.unique(both, axis=0)  # a repeated row is asked once
                numbers, vectors = np.concatenate([numbers, both[:, 0]]), np.concatenate([vectors, both[:, 1:].astype(np.int32)])
                while len(numbers) >= QUERY_ROWS:
                    yield pack(QUERY_ROWS)
        if len(numbers):
            yield pack(len(numbers))

    return asked.mapInArrow(scan, "queries long, ids binary, rows binary, least array<double>, most array<double>")


def _pairs(asked: DataFrame, blocks: DataFrame) -> DataFrame:
    """(queries, block, gap, place): what all distances differ by at least, and the order in which to search.

    A pair of blocks stands for up to QUERY_ROWS times as many vectors; a block meets those of its pivot's distances.
    """
    reach = asked.select("queries", F.posexplode(F.arrays_zip("least", "most")).alias("pivot", "at"))
    bounds = blocks.select("block", "pivot", "low", "high")
    if bounds.count() <= SEND_BLOCKS:
        both = reach.join(F.broadcast(bounds), "pivot")
    else:  # a pivot may hold a third of all blocks
        salted = bounds.withColumn("salt", F.pmod(F.xxhash64("block"), F.lit(SALTS)))
        copies = reach.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).cast("long"))
        both = copies.join(salted, ["pivot", "salt"])
    gap = F.greatest(F.lit(0.0), F.col("low") - F.col("at.most"), F.col("at.least") - F.col("high"))
    # The mean squared distance if directions from the pivot were random.
    guess = F.pow((F.col("at.least") + F.col("at.most")) / 2, 2) + F.pow((F.col("low") + F.col("high")) / 2, 2)
    order = Window.partitionBy("queries").orderBy("guess", "block")
    return both.select("queries", "block", gap.alias("gap"), guess.alias("guess")).withColumn("place", F.row_number().over(order) - 1).drop("guess")


def best_scores(asked: np.ndarray, ids: np.ndarray, rows: np.ndarray, numbers: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions, scores) of each query's k best rows of a block sorted by number, own numbers left out.

    Scores that do not count are the least long.
    """
    nothing = np.iinfo(np.int64).min
    n, k = len(rows), min(k, len(rows))
    most = int(np.abs(asked).max(initial=0)) * int(np.abs(rows).max(initial=0)) * asked.shape[1]
    own = ids[:, None] == numbers[None, :]
    if (most + 1) * n < 1 << 53:
        # The place is a last digit, so that no two are equal; a double holds both exactly.
        key = (asked.astype(np.float64) @ rows.astype(np.float64).T) * n + np.arange(n - 1, -1, -1)
        key[own] = -np.inf
        top = np.argpartition(key, n - k, axis=1)[:, n - k :]
        held = np.take_along_axis(key, top, 1)
        scores = np.where(np.isfinite(held), np.floor(held / n), nothing)
        return top, np.where(scores == nothing, nothing, scores.astype(np.int64))
    score = asked.astype(np.int64) @ rows.astype(np.int64).T
    score[own] = nothing
    # ~score falls as score rises, and no value is lost to a sign.
    top = np.argsort(~score, axis=1, kind="stable")[:, :k]
    return top, np.take_along_axis(score, top, 1)


def _score(pairs: DataFrame, asked: DataFrame, blocks: DataFrame, size: int, k: int) -> DataFrame:
    """(queries, place, query_id, number, score): each query's best in each block that it meets, if as good as its bound."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c) for c in ("queries", "ids", "rows", "bounds", "numbers", "vectors")]
            for i in range(batch.num_rows):
                queries, ids, rows, bounds, numbers, vectors = (c[i].as_py() for c in cols)
                ids, numbers = np.frombuffer(ids, np.int64), np.frombuffer(numbers, np.int64)
                top, score = best_scores(_vectors(rows, size), ids, _vectors(vectors, size), numbers, k)
                least = np.array(bounds, np.int64) if bounds else np.full(len(ids), np.iinfo(np.int64).min + 1)
                who, where = np.nonzero(score >= least[:, None])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(who), queries)), pa.array(who.astype(np.int32)), pa.array(ids[who]),
                    pa.array(numbers[top[who, where]]), pa.array(score[who, where])],
                    names=["queries", "place", "query_id", "number", "score"])

    # The vectors stay where the join deals them; only blocks of queries are sent to each block that they meet.
    meeting = pairs.select("queries", "block").join(asked.select("queries", "ids", "rows", "bounds"), "queries")
    met = meeting.join(blocks.select("block", "numbers", "vectors"), "block")
    return met.select("queries", "ids", "rows", "bounds", "numbers", "vectors").mapInArrow(
        scan, "queries long, place int, query_id long, number long, score long")


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, scale: int = SCALE, number: str = "vec_id",
                vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k rows with the highest scores for each row that is_query holds for."""
    spark = vectors.sparkSession
    rows = finite_vectors(vectors, number, vector, LARGEST / scale, F.coalesce(is_query, F.lit(False)).alias("asked")).where("number IS NOT NULL")
    usual = _sizes(rows, scale).orderBy(F.desc("n"), "size").first()
    if usual is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    size = usual["size"]
    rows = rows.where(F.size("vector") == size)
    # About `most` rows by a hash of the number, however many rows there are.
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * size)))
    share = math.ceil(min(1.0, most / usual["n"]) * 1_000_000)
    picked = rows.where(F.pmod(F.xxhash64("number"), F.lit(1_000_000)) < share).orderBy("number").limit(most).select("vector").toArrow()
    sample = scaled(picked["vector"], scale) if picked.num_rows else np.zeros((1, size))
    pivots = fit_pivots(sample, usual["longest"], usual["n"])

    block_rows = max(64, BLOCK_BYTES // (4 * size))
    blocks = materialize(_annuli(_keyed(rows, pivots, scale), block_rows), "topk-blocks")
    asked = materialize(_query_blocks(blocks, pivots, size), "topk-queries")
    pairs = materialize(_pairs(asked, blocks), "topk-pairs")
    each = asked.select("queries", F.explode(F.sequence(F.lit(0), (F.octet_length("ids") / 8).cast("int") - 1)).alias("place"))

    order = Window.partitionBy("queries", "place").orderBy(F.desc("score"), "number")
    found, limits, held = None, None, asked.withColumn("bounds", F.lit(None).cast("array<long>"))
    for start, end in STEPS:
        step = pairs.where(F.col("place") >= start)
        step = step if end is None else step.where(F.col("place") < end)
        if limits is not None:
            step = step.join(limits, "queries").where(F.col("gap") <= F.col("radius"))
            held = asked.join(limits.select("queries", "bounds"), "queries")
        scored = _score(step, held, blocks, size, k)
        every = scored if found is None else scored.unionByName(found.drop("rank"))
        ranked = every.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        found = materialize(ranked, "topk-found")
        if end is not None:
            worst = each.join(found.where(F.col("rank") == k).select("queries", "place", "score"), ["queries", "place"], "left")
            bounds = worst.groupBy("queries").agg(F.sort_array(F.collect_list(F.struct("place", "score"))).alias("held"))  # one block of queries
            limits = materialize(_radii(asked.select("queries", "rows").join(bounds, "queries"), size, usual["longest"]), "topk-limits")
    return found.select("query_id", "rank", F.col("number").alias("vec_id"), "score")


def _radii(held: DataFrame, size: int, longest: float) -> DataFrame:
    """(queries, radius, bounds): how far anything as good as the k-th best can be, over all queries of a block."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            radius, bounds = [], []
            for rows, held in zip(batch.column("rows").to_pylist(), batch.column("held").to_pylist(), strict=True):
                length = (_vectors(rows, size).astype(np.float64) ** 2).sum(1)
                scores = [h["score"] for h in held]
                known = np.array([-np.inf if s is None else s for s in scores])
                # More than rounding can change a distance by.
                radius.append(float(np.sqrt(np.maximum(length + longest - 2 * known, 0.0).max()) + 1e-6 * math.sqrt(longest) + 1e-9))
                bounds.append([np.iinfo(np.int64).min + 1 if s is None else s for s in scores])
            yield pa.RecordBatch.from_arrays([batch.column("queries"), pa.array(radius, pa.float64()), pa.array(bounds, pa.list_(pa.int64()))],
                                             names=["queries", "radius", "bounds"])

    return held.select("queries", "rows", "held").mapInArrow(scan, "queries long, radius double, bounds array<long>")


SQL = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * CAST(x AS DOUBLE))) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= {K}
"""


@query("op12_exact_topk", SQL)
def op12_exact_topk(spark: SparkSession, sf: str) -> DataFrame:
    return exact_top_k(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("vec_id") % 50 == 0)
