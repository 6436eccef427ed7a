"""Approximate nearest neighbours by largest inner product, with balanced posting lists.

* A bounded sample gives the centroids: it is halved at the median along its main
  direction until there are ``lists`` parts, which are even by construction.  There is a list for
  about 1,024 vectors, from 64 to 2,048 lists; beyond 2 million vectors lists grow longer instead.
  Vectors are first brought to unit length by one more coordinate, so that the nearest
  by distance has the largest inner product.
* Every row is indexed.  A vector goes to its nearest centroid and, near a boundary, to others of its
  four nearest that are not much farther.
* Queries walk a graph of the centroids, best first, and take all lists up to a ratio of
  the smallest distance, and further ones until these surely hold enough vectors.
* Both ratios are measured on the sample (``pruning``): the boundary is as wide as a mean of 1.2 copies a
  vector allows, and the lists of a query reach as far as 96 in 100 of the true neighbours within the sample
  lie.  Among all rows neighbours are nearer than within the sample, so that is the careful side.  Well
  clustered vectors read a few lists each, vectors without clusters most of them, as their neighbours do lie there.
* Lists and their queries meet in a shuffle.  Long lists and lists with many queries
  are split, so no task holds more than a fixed block of either; a list is sent once per 32,768 of its queries.

Scores are exact: a block's best candidates are computed anew in double precision.

Defined cases: rows with a null id, a null or zero vector, null or non-finite
components or another dimension take no part; of equal vectors the ``k + 1`` smallest
ids are indexed, which is all that any query can return; a repeated row counts once;
ties go to the smaller id; an empty table gives no rows; other columns are left out.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aerostrata.llm.staging import map_arrow, stored

LIST_ROWS, FEWEST_LISTS, MOST_LISTS = 1024, 64, 2048
SAMPLE = 20_000
REPLICAS = 4
WIDEST, COPIES = 1.05, 1.2
ASKED, REACHED = 256, 0.96
BLOCK, QUERY_BLOCK = 4096, 32_768

_FOUND = "query_id long, vec_id long, score double"


@dataclass(frozen=True)
class Centroids:
    """Centroids, the links of their graph, and the largest norm of the vectors."""

    points: np.ndarray
    neighbours: list[np.ndarray]
    norm: float

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        """Unit vectors whose distances to a query's direction fall as inner products grow."""
        scaled = vectors / self.norm
        rest = np.sqrt(np.maximum(0.0, 1.0 - (scaled * scaled).sum(axis=1)))
        return np.column_stack([scaled, rest])


def direction(queries: np.ndarray) -> np.ndarray:
    lengths = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
    return np.column_stack([queries / lengths, np.zeros(len(queries))])


def _halves(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two even halves, split along the line between two means."""
    centre = points.mean(axis=0)
    first = points[np.argmax(((points - centre) ** 2).sum(axis=1))]
    axis = first - centre
    for _ in range(8):
        side = (points - centre) @ axis
        upper = side > np.median(side)
        if upper.all() or not upper.any():
            break
        axis = points[upper].mean(axis=0) - points[~upper].mean(axis=0)
    order = np.argsort((points - centre) @ axis, kind="stable")
    return points[order[: len(order) // 2]], points[order[len(order) // 2 :]]


def fit(sample: np.ndarray, norm: float, lists: int, degree: int = 12) -> Centroids:
    """Centroids of even parts of a sample, and their graph."""
    empty = Centroids(np.zeros((0, sample.shape[1] + 1)), [], norm)
    parts = [empty.lifted(sample)]
    while len(parts) < lists and min(map(len, parts)) >= 16:
        parts = [half for part in parts for half in _halves(part)]
    points = np.stack([part.mean(axis=0) for part in parts])
    n = len(points)
    apart = _distances(points, points)
    np.fill_diagonal(apart, np.inf)
    near = np.argsort(apart, axis=1, kind="stable")[:, : min(degree, n - 1)]
    links = [set(row.tolist()) | {(i + 1) % n, (2 * i + 1) % n} - {i} for i, row in enumerate(near)]
    for i, row in enumerate(near.tolist()):
        for j in row:
            links[j].add(i)
    return Centroids(points, [np.array(sorted(own), np.int64) for own in links], norm)


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    squared = (rows**2).sum(axis=1)[:, None] + (points**2).sum(axis=1) - 2 * rows @ points.T
    return np.sqrt(np.maximum(0.0, squared))


@dataclass(frozen=True)
class Pruning:
    """How far copies of a vector and the lists of a query reach.

    ``floor`` stands for smallest distances below it, as a ratio of nothing would leave out everything.
    """

    boundary: float
    ratio: float
    floor: float = 0.0

    def limit(self, nearest: float) -> float:
        return self.ratio * max(nearest, self.floor)


def homes(distance: np.ndarray, boundary: float) -> tuple[np.ndarray, np.ndarray]:
    """Centroids of every row, nearest first, and which of them get the row or a copy of it."""
    order = np.argsort(distance, axis=1, kind="stable")[:, :REPLICAS]
    near = np.take_along_axis(distance, order, axis=1)
    chosen = near <= boundary * near[:, :1]
    chosen[:, 0] = True
    return order, chosen


def pruning(sample: np.ndarray, centroids: Centroids, k: int) -> Pruning:
    """The boundary that the allowed copies give, and the ratio that reaches the neighbours within the sample."""
    distance = _distances(centroids.lifted(sample), centroids.points)
    nearest = np.sort(distance, axis=1)[:, :REPLICAS]
    beyond = np.sort((nearest[:, 1:] / np.maximum(nearest[:, :1], 1e-12)).ravel())
    spare = int((COPIES - 1) * len(sample))
    boundary = min(WIDEST, float(beyond[spare])) if spare < len(beyond) else WIDEST
    order, chosen = homes(distance, boundary)

    queries = sample[:ASKED]
    k = min(k, len(sample) - 1)
    scores = queries @ sample.T
    scores[np.arange(len(queries)), np.arange(len(queries))] = -np.inf
    top = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else np.zeros((len(queries), 0), np.int64)
    asked = _distances(direction(queries), centroids.points)
    best = asked.min(axis=1)
    floor = max(float(np.median(best)) / 2, 1e-9)
    found = np.where(chosen[top], np.take_along_axis(asked[:, None, :], order[top], axis=2), np.inf)
    needed = found.min(axis=2) / np.maximum(best, floor)[:, None]
    ratio = max(1.0, float(np.quantile(needed, REACHED))) if needed.size else 1.0
    return Pruning(boundary, ratio, floor)


def lists_for(rows: int) -> int:
    """A power of two, so that a list has about ``LIST_ROWS`` rows as long as the sample can tell lists apart."""
    lists = FEWEST_LISTS
    while lists < MOST_LISTS and lists * LIST_ROWS < rows:
        lists *= 2
    return lists


def walk(centroids: Centroids, query: np.ndarray, reach: Pruning, holds: np.ndarray, need: int) -> list[int]:
    """Lists for one query, best first through the graph."""
    far = np.sqrt(((centroids.points - query) ** 2).sum(axis=1)).tolist()
    frontier, seen, taken, held = [(far[0], 0)], {0}, [], 0
    best = far[0]
    while frontier:
        d, at = heapq.heappop(frontier)
        best = min(best, d)
        if d > reach.limit(best) and held >= need:
            break
        taken.append((d, at))
        held += int(holds[at])
        for j in centroids.neighbours[at].tolist():
            if j not in seen:
                seen.add(j)
                heapq.heappush(frontier, (far[j], j))
    taken.sort()
    sums = np.cumsum([holds[at] for _, at in taken]) - np.array([holds[at] for _, at in taken])
    limit = reach.limit(best)
    return [at for (d, at), before in zip(taken, sums.tolist(), strict=True) if d <= limit or before < need]


def usable(vectors: DataFrame, dim: int, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id`` and ``v`` of the rows that take part, each once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col(vector_col).cast("array<double>")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    return rows.where(
        F.col("vec_id").isNotNull()
        & (F.size("v") == dim)
        & F.forall("v", finite)
        & F.exists("v", lambda x: x != 0)
    )


def _matrix(column: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def postings(kept: DataFrame, centroids: Centroids, dim: int, boundary: float) -> DataFrame:
    """``list``, ``main``, ``vec_id``, ``v``: every vector in its list and, near boundaries, in others."""

    def assign(batches):
        for batch in batches:
            lifted = centroids.lifted(_matrix(batch.column(1), dim))
            for i in range(0, len(lifted), BLOCK):
                order, chosen = homes(_distances(lifted[i : i + BLOCK], centroids.points), boundary)
                rows, places = np.nonzero(chosen)
                part = batch.slice(i, len(order)).take(pa.array(rows, pa.int64()))
                lists, main = pa.array(order[rows, places], pa.int32()), pa.array(places == 0, pa.bool_())
                yield pa.RecordBatch.from_arrays([lists, main, *part.columns], ["list", "main", "vec_id", "v"])

    return map_arrow(
        kept.select("vec_id", "v"), assign, "list int, main boolean, vec_id long, v array<double>"
    )


def _probes(queries: DataFrame, centroids: Centroids, dim: int, reach: Pruning, holds: np.ndarray, need: int) -> DataFrame:
    def choose(batches):
        for batch in batches:
            rows, lists = [], []
            for r, query in enumerate(direction(_matrix(batch.column(1), dim))):
                chosen = walk(centroids, query, reach, holds, need)
                rows += [r] * len(chosen)
                lists += chosen
            part = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *part.columns], ["list", "query_id", "q"])

    chosen = queries.select(F.col("vec_id").alias("query_id"), F.col("v").alias("q"))
    return map_arrow(chosen, choose, "list int, query_id long, q array<double>")


def _best(k: int, dim: int):
    """The best of a block of vectors for a block of queries."""

    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        ids = vectors.column("vec_id").to_numpy()
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids) and queries.num_rows:
            v, q = _matrix(vectors.column("v"), dim), _matrix(queries.column("q"), dim)
            query_ids = queries.column("query_id").to_numpy()
            sizes = np.abs(v).max() * np.abs(q).max(axis=1) * dim
            for i in range(0, len(q), 256):
                rough = q[i : i + 256] @ v.T
                for r, row in enumerate(rough):
                    at = np.arange(len(ids))
                    if len(ids) > k + 1:
                        limit = np.partition(row, len(row) - k - 1)[len(row) - k - 1]
                        at = np.flatnonzero(row >= limit - 1e-12 * sizes[i + r])
                    at = at[ids[at] != query_ids[i + r]]
                    # one sum per row, the same for equal vectors wherever they stand
                    scores = (v[at] * q[i + r]).sum(axis=1)
                    order = np.lexsort((ids[at], -scores))[:k]
                    found.append((np.full(len(order), query_ids[i + r]), ids[at][order], scores[order]))
        columns = [np.concatenate(c) for c in zip(*found, strict=True)] or [[], [], []]
        types = [pa.int64(), pa.int64(), pa.float64()]
        return pa.Table.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["query_id", "vec_id", "score"]
        )

    return run


def _split(df: DataFrame, sizes: dict[int, int], key: Column, block: int) -> tuple[DataFrame, dict[int, int]]:
    """Rows with the number of their part, so that a part has about a block of rows."""
    parts = {c: -(-n // block) for c, n in sizes.items()}
    return df.withColumn("part", F.pmod(F.xxhash64(key), _lookup(parts))), parts


def _lookup(values: dict[int, int]) -> Column:
    """A number by list; one entry per list."""
    listed = [values.get(i, 1) for i in range(max(values, default=0) + 1)]
    return F.get(F.array(*[F.lit(n).cast("long") for n in listed]), F.col("list"))


def search(
    vectors: DataFrame,
    is_query: Column,
    folder: str,
    k: int = 20,
    dim: int = 64,
    lists: int | None = None,
    ratio: float | None = None,
    sample: int = SAMPLE,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` of the ``k`` nearest found for each query.

    ``is_query`` is a condition on ``vec_id``.  Centroids are fitted on at most
    ``sample`` vectors (those with the smallest hashes); all rows are indexed.  ``lists`` and
    ``ratio`` follow from the rows and the sample unless they are given.  The postings and the
    lists that queries read stay in ``folder`` as ``lists`` and ``probes``.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors, dim, id_col, vector_col).distinct(), f"{folder}/vectors")
    copies = Window.partitionBy("v").orderBy("vec_id")
    numbered = rows.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
    kept = stored(numbered.drop("copy"), f"{folder}/kept")
    squares = F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x)
    norm, n_rows = kept.agg(F.max(F.sqrt(squares)), F.count("*")).first()
    if norm is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    drawn = kept.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    drawn = _matrix(drawn.column("v"), dim)
    centroids = fit(drawn, norm, lists or lists_for(n_rows))
    reach = pruning(drawn, centroids, k)
    if ratio is not None:
        reach = replace(reach, ratio=ratio)

    index = stored(postings(kept, centroids, dim, reach.boundary), f"{folder}/lists")
    counted = index.groupBy("list").agg(F.count("*").alias("n"), F.count_if("main").alias("own")).collect()
    holds = np.zeros(len(centroids.points), np.int64)
    for row in counted:
        holds[row.list] = row.own
    probes = stored(_probes(rows.where(is_query), centroids, dim, reach, holds, k + 1), f"{folder}/probes")
    asked = {r.list: r.n for r in probes.groupBy("list").agg(F.count("*").alias("n")).collect()}

    # every part of a list meets every part of its queries
    index, list_parts = _split(index, {r.list: r.n for r in counted}, F.col("vec_id"), BLOCK)
    probes, query_parts = _split(probes, asked, F.col("query_id"), QUERY_BLOCK)
    all_parts = lambda parts: F.explode(F.sequence(F.lit(0).cast("long"), _lookup(parts) - 1))
    left = index.select("list", "part", "vec_id", "v", all_parts(query_parts).alias("query_part"))
    right = probes.select("list", F.col("part").alias("query_part"), "query_id", "q", all_parts(list_parts).alias("part"))
    keys = ["list", "part", "query_part"]
    best = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(_best(k, dim), _FOUND)

    # a vector found in two lists is one: equal scores and ids have equal ranks
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.dense_rank().over(order)).where(F.col("rank") <= k)
    return ranked.dropDuplicates(["query_id", "rank"]).select("query_id", "rank", "vec_id", "score")
