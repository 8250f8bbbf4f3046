"""Approximate nearest neighbours from balanced posting lists.

Centroids come from hierarchical clustering with a penalty on size, fitted on a bounded sample of
about FIT_VECTORS vectors; there are at most MAX_LISTS. Every vector is indexed: it goes to the
list of its nearest centroid and, near a boundary, to those of further ones within REPLICATE of
that distance, at most REPLICAS. A query walks an in-memory graph of the centroids best first (a
beam of BEAM or a share BEAM_SHARE of all), takes the lists whose centroid is within PROBE times the
nearest one's distance (and more while they hold too few vectors), and is compared exactly with
their vectors. On clustered vectors the ratio leaves few lists; vectors without any structure need
the whole beam for a recall of 0.9. Long lists are cut into parts of about
PART vectors, so no task holds an unbounded list, and every part is searched.

Equal vectors cannot tell queries apart: of each group only the k + 1 smallest ids can be among k
neighbours with ties to smaller ids, so only these are indexed, and equal query vectors are
searched once. That leaves every result as it is.

Defined results: vectors that are null or zero, hold null or non-finite components or have another
than the most common length (ties: the longer) take no part, as queries or candidates; rows with
null ids take no part; rows that repeat an id count once, with their nearest vector; queries without
candidates have no rows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kartotek.llm.store import written

FIT_VECTORS, MAX_LISTS, LIST_SIZE, PART = 40_000, 8192, 200, 4096
REPLICATE, REPLICAS = 1.12, 3
PROBE, BEAM, BEAM_SHARE, NEIGHBOURS = 1.3, 64, 0.2, 16


def usable(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, v) of the rows that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")).where(
        F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0)
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(v, lambda x: x != 0))
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    return rows.where(F.size("v") == (sizes[0]["n"] if sizes else 0))


# --- centroids and their graph ----------------------------------------------------------------

def _square_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ y.T + (y * y).sum(1), 0)


def _split(x: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    """k clusters; the distance to a cluster grows with its size, so sizes stay near each other."""
    centres = x[rng.choice(len(x), k, replace=False)]
    label = np.zeros(len(x), int)
    sizes = np.full(k, len(x) / k)
    for _ in range(8):
        d = _square_distances(x, centres)
        label = (d + d.mean() * 0.3 * (sizes * k / len(x) - 1)).argmin(1)
        sizes = 0.5 * sizes + 0.5 * np.bincount(label, minlength=k)
        for j in range(k):
            if (label == j).any():
                centres[j] = x[label == j].mean(0)
    return label


def centroids(x: np.ndarray, k: int) -> np.ndarray:
    """About k centroids by hierarchical splitting."""
    rng = np.random.default_rng(5)
    out, todo = [], [(x, k)]
    while todo:
        part, n = todo.pop()
        if n <= 1 or len(part) <= 1:
            out.append(part.mean(0))
            continue
        label = _split(part, min(8, n, len(part)), rng)
        groups = [part[label == j] for j in np.unique(label)]
        if len(groups) == 1:
            out.append(part.mean(0))
            continue
        todo += [(g, max(1, round(n * len(g) / len(part)))) for g in groups]
    return np.unique(np.array(out), axis=0)


@dataclass
class Graph:
    """Centroids, the neighbours of each, and where walks start."""

    centres: np.ndarray
    neighbours: np.ndarray
    entry: int

    def search(self, q: np.ndarray) -> list[tuple[float, int]]:
        """The nearest centroids of the beam (distance, number), nearest first: best-first walk."""
        beam = max(BEAM, int(BEAM_SHARE * len(self.centres)))

        def reach(nodes):
            d = self.centres[nodes] - q
            return np.sqrt((d * d).sum(1)).tolist()

        seen = {self.entry}
        first = reach([self.entry])[0]
        todo, best = [(first, self.entry)], [(-first, self.entry)]
        while todo:
            d, node = heapq.heappop(todo)
            if len(best) >= beam and d > -best[0][0]:
                break
            new = [n for n in self.neighbours[node].tolist() if n not in seen]
            seen.update(new)
            for e, n in zip(reach(new), new, strict=True) if new else ():
                if len(best) < beam or e < -best[0][0]:
                    heapq.heappush(todo, (e, n))
                    heapq.heappush(best, (-e, n))
                    if len(best) > beam:
                        heapq.heappop(best)
        return sorted((-d, n) for d, n in best)


def graph(centres: np.ndarray) -> Graph:
    """Each centroid with its nearest ones, both ways, and with its place on a ring, so that
    every centroid can be reached."""
    n = len(centres)
    links: list[set[int]] = [{(i + 1) % n, (i - 1) % n} - {i} for i in range(n)]
    k = min(NEIGHBOURS, n - 1)
    for lo in range(0, n, 1024):
        d = _square_distances(centres[lo:lo + 1024], centres)
        for i, row in enumerate(d):
            near = np.argpartition(row, k)[: k + 1] if k else []
            for j in near:
                if j != lo + i:
                    links[lo + i].add(int(j))
                    if len(links[j]) < 3 * NEIGHBOURS:
                        links[j].add(lo + i)
    width = max(map(len, links), default=0)
    table = np.array([[*sorted(s), *[i] * (width - len(s))] for i, s in enumerate(links)], int).reshape(n, width)
    middle = int(_square_distances(centres.mean(0)[None], centres)[0].argmin())
    return Graph(centres, table, middle)


# --- index and search -------------------------------------------------------------------------

def _matrix(column) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), -1)


def lists_of(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, list): the lists of every vector."""
    d = np.sqrt(_square_distances(x, centres))
    k = min(REPLICAS, len(centres))
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, 1), axis=1, kind="stable"), 1)
    dist = np.take_along_axis(d, near, 1)
    taken = dist <= REPLICATE * dist[:, :1]
    row, col = np.nonzero(taken)
    return row, near[row, col]


def _nearest(q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of the k nearest ids of x for each row of q, ties to smaller ids; an
    id that stands in several rows counts with its nearest one."""
    order = np.argsort(ids, kind="stable")
    ids, x = ids[order], x[order]
    first = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    names = ids[first]
    rows, found, scores = [], [], []
    for i, v in enumerate(q):
        d = np.sqrt(((x - v) ** 2).sum(1))
        if len(names) < len(d):
            d = np.minimum.reduceat(d, first)
        take = np.arange(len(d))
        if len(d) > k:
            take = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1])
        take = take[np.lexsort((names[take], d[take]))][:k]
        rows.append(np.full(len(take), i))
        found.append(names[take])
        scores.append(d[take])
    return tuple(np.concatenate(c) if c else np.zeros(0) for c in (rows, found, scores))


def search(vectors: DataFrame, queries: DataFrame, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each query but itself.

    ``vectors`` and ``queries`` have (id, v) as ``usable`` gives; candidates are ``vectors``."""
    spark = vectors.sparkSession
    by_id = Window.partitionBy("v").orderBy("id")
    base = written(
        vectors.distinct().withColumn("copy", F.row_number().over(by_id)).where(F.col("copy") <= k + 1).select("id", "v"), "vectors")
    wanted = written(queries.distinct().withColumn("qk", F.xxhash64("v")), "wanted")
    total = base.count()
    out = "qk long, vec_id long, score double"
    if not total or wanted.isEmpty():
        empty = spark.createDataFrame([], out)
        return _ranked(empty.join(wanted, "qk"), k)
    sample = base.where(F.pmod(F.xxhash64("id", "v"), F.lit(total)) < FIT_VECTORS).limit(2 * FIT_VECTORS).select("v").toArrow()
    x = _matrix(sample.column("v"))
    x = x[np.lexsort(x.T[::-1])]
    centres = centroids(x, max(1, min(MAX_LISTS, total // LIST_SIZE)))
    shared = spark.sparkContext.broadcast(graph(centres))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 1000):
                part = batch.slice(lo, 1000)
                row, lists = lists_of(_matrix(part.column(1)), shared.value.centres)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lists.astype(np.int32)), *(c.take(pa.array(row)) for c in part.columns)], ["list", "id", "v"])

    postings = written(base.mapInArrow(index, "list int, id long, v array<double>"), "postings")
    sizes = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # at most MAX_LISTS rows
    counts = spark.sparkContext.broadcast(sizes)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            row, lists, parts = [], [], []
            for i, q in enumerate(_matrix(batch.column(1))):
                found = shared.value.search(q)
                held = 0
                for d, n in found:
                    if d > PROBE * found[0][0] and held >= 20 * (k + 1):
                        break
                    size = counts.value.get(n, 0)
                    held += size
                    for p in range(-(-size // PART)):
                        row.append(i)
                        lists.append(n)
                        parts.append(p)
            take = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(lists, pa.int32()), pa.array(parts, pa.int32()), *(c.take(take) for c in batch.columns)],
                ["list", "part", "qk", "qv"])

    probes = wanted.groupBy("qk").agg(F.first("v").alias("qv")).mapInArrow(
        probe, "list int, part int, qk long, qv array<double>")
    parts = spark.createDataFrame([(n, -(-size // PART)) for n, size in sizes.items()], "list int, parts long")
    placed = postings.join(F.broadcast(parts), "list").withColumn("part", F.pmod(F.xxhash64("id"), "parts").cast("int")).drop("parts")

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.table({"qk": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        row, ids, score = _nearest(
            _matrix(left.column("qv")), right.column("id").to_numpy(), _matrix(right.column("v")), k + 1)
        return pa.table({"qk": left.column("qk").take(pa.array(row)), "vec_id": pa.array(ids), "score": pa.array(score)})

    near = probes.groupBy("list", "part").cogroup(placed.groupBy("list", "part")).applyInArrow(compare, out)
    best = near.groupBy("qk", "vec_id").agg(F.min("score").alias("score"))
    return _ranked(best.join(wanted, "qk"), k)


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """found: qk, vec_id, score and the queries (id) that ask for it."""
    nearest = found.where("vec_id <> id").groupBy(F.col("id").alias("query_id"), "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return (
        nearest.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
