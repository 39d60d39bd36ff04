"""Approximate nearest neighbours by inner product, over balanced posting lists.

* Space. With one more coordinate, sqrt(M^2 - |x|^2) for vectors and 0 for queries (scaled to length M, the largest
  norm), the nearest vector is the one with the largest inner product.
* Lists. Centroids are fitted by k-means on a bounded sample (`SAMPLE` vectors), with a charge on clusters that are
  above their share, so that lists are balanced; there are about as many lists as the square root of the vectors.
  All vectors are then put into lists: the nearest one and, for vectors near a boundary, up to COPIES lists whose
  centroid is at most CLOSE times as far and not much nearer (SHADOW) to a centroid taken before than to the vector.
* Search. Centroids form a neighbour graph in memory (a few MB, sent to the tasks); a best-first walk over it finds the
  lists of a vector or query. A query goes to the lists at most `ratio` times as far as its nearest one, at most PROBES;
  the ratio is the least with which a share of REACHED of the neighbours within the sample are in such a list.
* Scores. Lists are written once. Queries and vectors meet list by list; a list that is expected to be large is cut into
  pieces, its queries too. A piece gives each query's best vectors by exact scores. A query's lists are searched in
  steps, the nearest first, and each step takes only what is as good as the k + 1 best of those before. Queries that
  have found too few vectors are sent to all lists.

Equal vectors are one candidate with their smallest numbers (k + 1 are enough for any query) and one query, so a third
of all rows being the same vector costs nothing.

Edge cases: vectors that are NULL, empty, zero, not of the usual length, or with NULL or non-finite components take no
part; rows with a NULL number neither; a query finds its copies, but not itself; rows that share a number are found
once per distinct vector, and a query's own number is never among its results; an empty table gives no rows; further
columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from opticlake.llm.catalog import query
from opticlake.operators.joins import join_per_key
from opticlake.session import materialize

K = 20
SAMPLE, SAMPLE_BYTES = 16_384, 32 << 20
LISTS = 4096  # most lists
COPIES, CLOSE, SHADOW = 4, 1.1, 0.5
REACHED, PROBES = 0.96, 1024
DEGREE = 24
CHUNK = 256  # rows that are walked over the graph together
PIECE_ROWS = 8192  # rows of vectors, or queries, of a piece that one call scores
STEPS = [(0, 3), (3, 12), (12, PROBES)]  # nearest lists that are searched in each step
CHECKED = 4096  # vectors of the sample that the ratio is taken from


@dataclass
class Lists:
    """Centroids, their neighbour graph, and how often vectors and queries are expected in each."""

    centroids: np.ndarray
    graph: np.ndarray
    apart: np.ndarray  # squared distances between centroids
    norm: float  # the largest length of a vector
    offered: np.ndarray  # vectors of the sample
    pieces: np.ndarray
    query_pieces: np.ndarray
    ratio: float = 2.0

    def lift(self, rows: np.ndarray) -> np.ndarray:
        left = np.maximum(self.norm**2 - (rows * rows).sum(1), 0.0)
        return np.hstack([rows, np.sqrt(left)[:, None]])

    def lift_queries(self, rows: np.ndarray) -> np.ndarray:
        scale = self.norm / np.sqrt((rows * rows).sum(1, keepdims=True))
        return np.hstack([rows * scale, np.zeros((len(rows), 1))])

    def nearest(self, rows: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """The `width` nearest centroids of each row and their squared distances, by a best-first walk over the graph."""
        n, lists = len(rows), len(self.centroids)
        if n > CHUNK:  # bounds the memory of a step
            parts = [self.nearest(rows[at : at + CHUNK], width) for at in range(0, n, CHUNK)]
            return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
        width = min(width, lists)
        entry = np.unique(np.linspace(0, lists - 1, min(lists, 8)).astype(np.int64))
        seen = np.zeros((n, lists + 1), bool)
        seen[:, entry] = True
        seen[:, lists] = True  # filler for short rows of the graph
        norms = (self.centroids**2).sum(1)
        own = (rows**2).sum(1)
        ids = np.full((n, width + len(entry)), lists, np.int64)
        far = np.full(ids.shape, np.inf)
        ids[:, : len(entry)] = entry
        far[:, : len(entry)] = own[:, None] + norms[entry] - 2 * rows @ self.centroids[entry].T
        done = ~np.isfinite(far)
        going = np.arange(n)
        while len(going):
            waiting = np.where(done[going], np.inf, far[going])
            # The walk takes a few of the nearest open centroids at once and ends when the nearest `width` are all done.
            step = np.argpartition(waiting, min(3, waiting.shape[1] - 1), axis=1)[:, :4]
            reach = np.partition(far[going], width - 1, axis=1)[:, width - 1]
            open_ = np.take_along_axis(waiting, step, 1)
            good = np.isfinite(open_) & (open_ <= reach[:, None])
            on = good.any(1)
            going, step, good = going[on], step[on], good[on]
            if not len(going):
                break
            flags = done[going]
            np.put_along_axis(flags, step, np.take_along_axis(flags, step, 1) | good, 1)
            done[going] = flags
            taken = np.take_along_axis(ids[going], step, 1)
            near = np.where(good[:, :, None], self.graph[np.where(good, taken, 0)], lists).reshape(len(going), -1)
            near = np.sort(near, axis=1)
            near[:, 1:][near[:, 1:] == near[:, :-1]] = lists
            fresh = ~seen[going[:, None], near]
            near = np.where(fresh, near, lists)
            seen[going[:, None], near] = True
            where = np.minimum(near, lists - 1)
            dist = own[going, None] + norms[where] - 2 * np.einsum("nd,nkd->nk", rows[going], self.centroids[where])
            dist[near == lists] = np.inf
            every_ids = np.hstack([ids[going], near])
            every_far = np.hstack([far[going], dist])
            every_done = np.hstack([done[going], near == lists])
            best = np.argpartition(every_far, ids.shape[1] - 1, axis=1)[:, : ids.shape[1]]
            ids[going] = np.take_along_axis(every_ids, best, 1)
            far[going] = np.take_along_axis(every_far, best, 1)
            done[going] = np.take_along_axis(every_done, best, 1)
        order = np.argsort(far, axis=1, kind="stable")[:, :width]
        return np.take_along_axis(ids, order, 1), np.maximum(np.take_along_axis(far, order, 1), 0.0)

    def assign(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the nearest list, and further ones for rows near a boundary."""
        ids, far = self.nearest(rows, 4 * COPIES)
        taken = np.zeros(ids.shape, bool)
        taken[:, 0] = True
        for j in range(1, ids.shape[1]):
            good = np.isfinite(far[:, j]) & (far[:, j] <= CLOSE**2 * far[:, 0]) & (taken.sum(1) < COPIES)
            for i in range(j):
                shadow = taken[:, i] & (self.apart[ids[:, i] % len(self.apart), ids[:, j] % len(self.apart)] < SHADOW**2 * far[:, j])
                good &= ~shadow
            taken[:, j] = good
        row, at = np.nonzero(taken)
        return row, ids[row, at]

    def probe(self, rows: np.ndarray, start: int = 0, stop: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) pairs: the lists that a query is sent to, from its nearest `start` on; without `stop`, all lists."""
        ids, far = self.nearest(rows, stop or len(self.centroids))
        good = np.isfinite(far)
        if stop:
            good &= (far <= self.ratio**2 * far[:, :1]) | (np.arange(ids.shape[1]) < STEPS[0][1])
            good[:, :start] = False
        row, at = np.nonzero(good)
        return row, ids[row, at]


def _balanced_centroids(rows: np.ndarray, lists: int, seed: int = 3, rounds: int = 6) -> np.ndarray:
    """K-means in which a cluster above its share is charged for it."""
    rng = np.random.default_rng(seed)
    centroids = rows[rng.choice(len(rows), lists, replace=False)].copy()
    share = len(rows) / lists
    for turn in range(rounds):
        charge = np.zeros(lists)
        label = np.empty(len(rows), np.int64)
        order = rng.permutation(len(rows))
        spread = None
        for at in range(0, len(order), 512):
            own = order[at : at + 512]
            far = (rows[own] ** 2).sum(1)[:, None] + (centroids**2).sum(1) - 2 * rows[own] @ centroids.T
            spread = spread or max(1e-12, float(np.median(far.min(1))))
            label[own] = (far + 0.05 * spread * np.maximum(charge / share - 0.5, 0)).argmin(1)
            charge += np.bincount(label[own], minlength=lists)
        sums = np.zeros_like(centroids)
        np.add.at(sums, label, rows)
        sizes = np.bincount(label, minlength=lists)
        empty = sizes == 0
        centroids = np.where(empty[:, None], rows[rng.choice(len(rows), lists)], sums / np.maximum(sizes, 1)[:, None])
    return centroids


def _needed_ratio(lists: Lists, queries: np.ndarray) -> float:
    """How much farther than its nearest list a query has to look, by its neighbours among the offered vectors."""
    offered = lists.offered
    near = np.argsort(-(queries @ offered.T), axis=1, kind="stable")[:, : K + 1]
    row, where = lists.assign(lists.lift(offered))
    lifted = lists.lift_queries(queries)
    far = np.maximum((lifted**2).sum(1)[:, None] + (lists.centroids**2).sum(1) - 2 * lifted @ lists.centroids.T, 1e-12)
    starts = np.searchsorted(row, np.arange(len(offered) + 1))
    needed = [np.sqrt(far[i, where[starts[j] : starts[j + 1]]].min() / far[i].min()) for i in range(len(queries)) for j in near[i]]
    return float(np.clip(np.quantile(needed, REACHED) * (1 + 1e-9), 1.02, 4.0))


def fit_lists(sample: np.ndarray, norm: float, vectors: int, queries: int) -> Lists:
    """Posting lists from a sample of distinct vectors, for so many vectors and queries in all."""
    count = max(1, min(LISTS, len(sample) // 8, int(math.sqrt(vectors))))
    lists = Lists(np.zeros((0, 0)), np.zeros((0, 0), np.int64), np.zeros((0, 0)), norm, sample[:CHECKED], np.ones(0), np.ones(0))
    lifted = lists.lift(sample)
    lists.centroids = _balanced_centroids(lifted, count)
    norms = (lists.centroids**2).sum(1)
    lists.apart = np.maximum(norms[:, None] + norms - 2 * lists.centroids @ lists.centroids.T, 0)
    np.fill_diagonal(lists.apart, 0)
    degree = min(DEGREE, count - 1)
    graph = np.full((count, 2 * DEGREE), count, np.int64)
    if degree:
        near = np.argsort(lists.apart + np.diag(np.full(count, np.inf)), axis=1)[:, :degree]
        graph[:, :degree] = near
        # Edges go both ways as far as there is room, so that no centroid is left out of reach; a ring joins the rest.
        room = np.full(count, degree)
        for a, b in zip(np.repeat(np.arange(count), degree), near.ravel(), strict=True):
            if room[b] < 2 * DEGREE - 1 and a not in graph[b]:
                graph[b, room[b]] = a
                room[b] += 1
        graph[:, -1] = (np.arange(count) + 1) % count
    lists.graph = graph
    lists.ratio = _needed_ratio(lists, sample[: 256])
    some = lifted[:: max(1, len(lifted) // 2048)]
    put = np.bincount(lists.assign(some)[1], minlength=count) * (vectors / len(some))
    sent = np.bincount(lists.probe(lists.lift_queries(some[:, :-1]), 0, PROBES)[1], minlength=count) * (queries / len(some))
    lists.pieces = np.maximum(1, np.ceil(put / PIECE_ROWS)).astype(np.int64)
    lists.query_pieces = np.maximum(1, np.ceil(sent / PIECE_ROWS)).astype(np.int64)
    return lists


def _rows(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1).astype(np.float64)


def _slack(scores: np.ndarray) -> np.ndarray:
    """More than rounding can change a score by."""
    return 1e-9 * np.maximum(1.0, np.abs(scores))


def _scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, component by component: the same for a pair wherever it is met."""
    out = np.zeros(len(left))
    for i in range(left.shape[1]):
        out += left[:, i] * right[:, i]
    return out


def _clean(vectors: DataFrame, number: str, vector: str) -> DataFrame:
    held = vectors.select(F.col(number).alias("number"), F.col(vector).alias("vector")).where("number IS NOT NULL AND size(vector) > 0")
    finite = F.forall("vector", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float("inf")))
    return held.where(finite & F.exists("vector", lambda x: x != 0))


def _deal(rows: DataFrame, lists: Lists, step: tuple[int, int | None] | None) -> DataFrame:
    """Rows (rep, vector, least) in the pieces of the lists that they go to: vectors, or queries in a step of the search."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                part = batch.slice(at, CHUNK)
                own = _rows(part.column("vector"))
                row, where = lists.probe(lists.lift_queries(own), *step) if step else lists.assign(lists.lift(own))
                rep = part.column("rep").to_numpy()[row]
                # A vector goes to one piece of its list and all pieces of the queries, a query the other way round.
                fixed, spread = (lists.query_pieces, lists.pieces) if step else (lists.pieces, lists.query_pieces)
                times = spread[where]
                mine = np.repeat((rep // 7) % fixed[where], times)
                other = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
                row, where, rep = (np.repeat(x, times) for x in (row, where, rep))
                piece, query_piece = (other, mine) if step else (mine, other)
                yield pa.RecordBatch.from_arrays([
                    pa.array(where.astype(np.int32)), pa.array(piece.astype(np.int32)), pa.array(query_piece.astype(np.int32)),
                    pa.array(rep), part.column("vector").take(pa.array(row)), part.column("least").take(pa.array(row))],
                    names=["list", "piece", "query_piece", "rep", "vector", "least"])

    kind = dict(rows.dtypes)["vector"]
    return rows.select("rep", "vector", "least").mapInArrow(scan, f"list int, piece int, query_piece int, rep long, vector {kind}, least double")


def _best(queries: pa.Table, vectors: pa.Table, k: int) -> pa.Table:
    """Each query's k + 1 best vectors of a piece (more only while scores tie)."""
    out = []
    if queries.num_rows and vectors.num_rows:
        q, v = _rows(queries["vector"]), _rows(vectors["vector"])
        q_rep, v_rep, least = queries["rep"].to_numpy(), vectors["rep"].to_numpy(), queries["least"].to_numpy()
        step = max(1, 2_000_000 // len(v))
        for at in range(0, len(q), step):
            near = q[at : at + step] @ v.T
            bar = least[at : at + step] - _slack(least[at : at + step])
            if len(v) > k + 1:
                top = np.partition(near, -(k + 1), axis=1)[:, -(k + 1)]
                bar = np.maximum(bar, top - _slack(top))
            i, j = np.nonzero(near >= bar[:, None])
            out.append((q_rep[at + i], v_rep[j], _scores(q[at + i], v[j])))
    parts = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 2 + [np.zeros(0)]
    return pa.table({"query": pa.array(parts[0], pa.int64()), "rep": pa.array(parts[1], pa.int64()), "score": pa.array(parts[2], pa.float64())})


def nearest_neighbours(vectors: DataFrame, is_query: Column, k: int = K, number: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score of the k nearest found for each row that is_query holds for."""
    clean = _clean(vectors, number, vector)
    usual = clean.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = clean.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if usual is None:
        return empty
    clean = clean.where(F.size("vector") == usual["n"])
    same = Window.partitionBy("vector").orderBy("number")
    firsts = clean.distinct().withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1)
    grouped = firsts.groupBy("vector").agg(F.sort_array(F.collect_list("number")).alias("numbers"))
    # rep names a distinct vector: its smallest number, told apart where a number comes with several vectors.
    named = grouped.withColumn("rep", F.xxhash64(F.element_at("numbers", 1), "vector"))
    distinct = materialize(named, "neighbours-distinct")
    asked = join_per_key(clean.where(is_query).distinct(), distinct.select("vector", "rep"), ["vector"], "inner")
    asked = materialize(asked.select(F.col("number").alias("query_id"), "rep"), "neighbours-asked")
    queries = distinct.join(asked.select("rep").distinct(), "rep", "left_semi")

    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    total = distinct.agg(F.count("*").alias("n"), F.max(length).alias("norm")).first()
    most = max(64, min(SAMPLE, SAMPLE_BYTES // (8 * usual["n"])))
    share = min(1.0, most / total["n"])
    picked = distinct.where(F.pmod(F.xxhash64("rep"), F.lit(1_000_000)) < math.ceil(share * 1_000_000)).orderBy("rep").limit(2 * most)
    sample = _rows(picked.select("vector").toArrow()["vector"])
    lists = fit_lists(sample[np.random.default_rng(1).permutation(len(sample))], float(total["norm"]), total["n"], queries.count())

    keys = ["list", "piece", "query_piece"]
    nothing = F.lit(float("-inf")).alias("least")
    postings = materialize(_deal(distinct.select("rep", "vector", nothing), lists, None), "neighbours-lists")

    def search(some: DataFrame, step: tuple[int, int | None]) -> DataFrame:
        pairs = _deal(some, lists, step).groupBy(*keys).cogroup(postings.groupBy(*keys))
        scored = pairs.applyInArrow(lambda q, v: _best(q, v, k), "query long, rep long, score double")
        return materialize(scored.groupBy("query", "rep").agg(F.max("score").alias("score")), "neighbours-scored")

    numbers = distinct.select("rep", "numbers", F.element_at("numbers", 1).alias("_first"))
    best = Window.partitionBy("query").orderBy(F.desc("score"), "_first")

    def top(scored: DataFrame) -> DataFrame:
        """The k + 1 best vectors of each query."""
        once = scored.groupBy("query", "rep").agg(F.max("score").alias("score"))
        ranked = join_per_key(once, numbers, ["rep"], "inner").withColumn("_n", F.row_number().over(best))
        return ranked.where(F.col("_n") <= k + 1)

    scored = None
    for step in STEPS:
        bounded = queries.select("rep", "vector", nothing)
        if scored is not None:
            least = top(scored).where(F.col("_n") == k + 1).select(F.col("query").alias("rep"), "score")
            bounded = queries.join(least, "rep", "left").select("rep", "vector", F.coalesce("score", F.lit(float("-inf"))).alias("least"))
        found = search(bounded, step)
        scored = found if scored is None else scored.unionByName(found)
    enough = top(scored).groupBy("query").agg(F.sum(F.size("numbers")).alias("n")).where(F.col("n") > k).select(F.col("query").alias("rep"))
    short = materialize(queries.join(enough, "rep", "left_anti").select("rep", "vector", nothing), "neighbours-short")
    if not short.isEmpty():
        scored = scored.unionByName(search(short, (0, None)))

    found = top(scored).groupBy("query").agg(F.flatten(F.collect_list(F.transform("numbers", lambda n: F.struct(
        (-F.col("score")).alias("far"), n.alias("number"))))).alias("found"))
    own = join_per_key(asked, found.withColumnRenamed("query", "rep"), ["rep"], "inner")
    own = own.groupBy("query_id").agg(F.array_sort(F.flatten(F.collect_list("found"))).alias("found"))
    # A number with several vectors counts with its best one.
    others = F.filter("found", lambda f: f["number"] != F.col("query_id"))
    once = F.filter(others, lambda f, i: (i == 0) | ~F.exists(F.slice(others, F.lit(1), i), lambda g: g["number"] == f["number"]))
    rows = own.select("query_id", F.posexplode(F.slice(once, 1, k)).alias("at", "f"))
    return rows.select("query_id", (F.col("at") + 1).alias("rank"), F.col("f.number").alias("vec_id"), (-F.col("f.far")).alias("score"))


@query("op1_nearest_neighbours")
def op1_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    return nearest_neighbours(vectors, F.col("number") % 20 == 0)
