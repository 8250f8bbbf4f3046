"""Hard negatives: for each anchor and each of its positives, the nearest rows of other labels that lie
in a band under the positive's score.

Vectors are integers and scores their inner products. Each vector is turned by a fixed rotation and
kept as one bit a component (its signs) with its alignment: the inner product with its own code of
unit length. What the code leaves over has a known length and is orthogonal to it, so with the
anchor's product with the code (popcounts over the bit planes of the rotated, stepped anchor)
Cauchy-Schwarz gives an interval that surely holds the score. Only rows whose interval meets what is
still asked for are scored, as integers. Results are exact; a wide interval costs time only.

Vectors stand in cells by a hash of their id; anchors visit all cells, in blocks of ANCHORS. A task
holds one block of anchors and their best rows so far while the vectors of the cell stream by, so its
memory does not grow with the data, and it returns at most k rows for each positive. Positives are
found in the same way in cells of one label, so an anchor visits the rows of its own label only.

Defined results: rows with a null id, a null label, a null or empty vector, any null or non-finite
component, or another than the most common length (ties: the longer) take no part; nor do vectors whose
squared length reaches 2^62, as their scores need not fit into a LONG. Of rows that repeat an id the
one with the smallest label and vector takes part. Anchors without positives, and positives without
negatives in their band, have no rows; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartotek.llm.store import written

#: Bits of a rotated anchor's components; anchors of a block; vectors that are compared at once.
PLANES, ANCHORS, SLICE = 6, 16_384, 10_000
#: Vectors of a cell: a CELLS-th of all, within these bounds.
CELLS, LEAST_CELL, LARGEST_CELL = 64, 4096, 1 << 22

_LOW, _HIGH = -(1 << 63), (1 << 63) - 1


def usable(rows: DataFrame, id_column: str, vector_column: str, label: Column, scale: int) -> DataFrame:
    """(id, label, v: floor(scale * component)) of the rows that take part."""
    v = F.col(vector_column).cast("array<double>")
    sound = rows.select(F.col(id_column).cast("long").alias("id"), label.cast("long").alias("label"), v.alias("x")).where(
        F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))))
    sizes = sound.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    scaled = F.transform("x", lambda c: F.floor(c * scale))
    short = F.aggregate("x", F.lit(0.0), lambda s, c: s + F.pow(F.floor(c * scale).cast("double"), 2)) < float(1 << 62)
    ranked = Window.partitionBy("id").orderBy("label", "v")
    return (
        sound.where(F.size("x") == (sizes[0]["n"] if sizes else 0)).where(short).select("id", "label", scaled.alias("v"))
        .withColumn("_row", F.row_number().over(ranked)).where("_row = 1").drop("_row")
    )


# --- codes ------------------------------------------------------------------------------------

@lru_cache(maxsize=4)
def rotation(d: int) -> np.ndarray:
    """A fixed orthogonal matrix."""
    return np.linalg.qr(np.random.default_rng(11).standard_normal((d, d)))[0]


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bits, alignment) of vectors: signs of the rotated vector in 64-bit words, and its inner
    product with these signs at unit length."""
    d = x.shape[1]
    turned = x @ rotation(d)
    signs = turned > 0
    bits = np.zeros((len(x), -(-d // 64) * 64), bool)
    bits[:, :d] = signs
    return (np.packbits(bits, axis=1, bitorder="little").view("<u8"),
            np.where(signs, turned, -turned).sum(1) / np.sqrt(d))


class Anchors:
    """A block of anchors, ready to be met by codes."""

    def __init__(self, q: np.ndarray):
        n, d = q.shape
        self.d = d
        turned = q @ rotation(d)
        self.norm = np.sqrt((turned * turned).sum(1))
        self.low = turned.min(1)
        self.step = np.maximum((turned.max(1) - self.low) / (2 ** PLANES - 1), 1e-300)
        level = np.rint((turned - self.low[:, None]) / self.step[:, None]).astype(np.int64)
        level = np.clip(level, 0, 2 ** PLANES - 1)
        kept = self.low[:, None] + self.step[:, None] * level
        self.total = kept.sum(1)
        self.lost = np.sqrt(((turned - kept) ** 2).sum(1))  # what stepping takes from the anchor
        bits = np.zeros((PLANES, n, -(-d // 64) * 64), bool)
        for j in range(PLANES):
            bits[j, :, :d] = (level >> j) & 1
        self.planes = np.packbits(bits, axis=2, bitorder="little").view("<u8")

    def interval(self, i: int, bits: np.ndarray, norm: np.ndarray, align: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of the score of anchor i with each vector."""
        ones = np.bitwise_count(bits).sum(1, dtype=np.int64)
        stepped = np.zeros(len(bits), np.int64)
        for j in range(PLANES):
            stepped += np.bitwise_count(bits & self.planes[j, i]).sum(1, dtype=np.int64) << j
        with_code = (2 * (self.low[i] * ones + self.step[i] * stepped) - self.total[i]) / np.sqrt(self.d)
        rest = np.sqrt(np.maximum(norm * norm - align * align, 0))
        # The anchor's part off the code is longest where its product with the code is least.
        nearest = np.maximum(np.abs(with_code) - self.lost[i], 0)
        off = np.sqrt(np.maximum(self.norm[i] ** 2 - nearest ** 2, 0))
        slack = align * self.lost[i] + rest * off + 1e-9 * self.norm[i] * norm + 1e-6
        return align * with_code - slack, align * with_code + slack


# --- one cell ---------------------------------------------------------------------------------

class Best:
    """The k best rows (score, id) of each band of each anchor so far."""

    def __init__(self, k: int, ids: np.ndarray, labels: np.ndarray, q: np.ndarray, bands: list[list[tuple[int, int, int]]],
                 same_label: bool):
        self.k, self.ids, self.labels, self.bands, self.same = k, ids, labels, bands, same_label
        self.q, self.anchors = q, Anchors(q.astype(float))
        self.longest = float(self.anchors.norm.max(initial=0))
        self.found = [[(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in b] for b in bands]
        self.floor = [[lo for _, lo, _ in b] for b in bands]
        self.scored = self.met = 0

    def meet(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, bits: np.ndarray, align: np.ndarray) -> None:
        norm = np.sqrt((x.astype(float) ** 2).sum(1))
        # Floating point is exact for integers while every sum stays below 2^53.
        kind = float if self.longest * norm.max(initial=0) < 2.0 ** 52 else np.int64
        x, q = x.astype(kind), self.q.astype(kind)
        for i, bands in enumerate(self.bands):
            if not bands:
                continue
            low, high = self.anchors.interval(i, bits, norm, align)
            fits = (labels == self.labels[i]) == self.same
            if self.same:
                fits &= ids != self.ids[i]
            self.met += int(fits.sum())
            fits &= (high >= min(self.floor[i])) & (low <= max(hi for _, _, hi in bands))
            rows = np.flatnonzero(fits)
            if not len(rows):
                continue
            self.scored += len(rows)
            score, own = (x[rows] @ q[i]).astype(np.int64), ids[rows]
            for j, (_, lo, hi) in enumerate(bands):
                take = (score >= self.floor[i][j]) & (score <= hi)
                if not take.any():
                    continue
                s = np.concatenate([self.found[i][j][0], score[take]])
                n = np.concatenate([self.found[i][j][1], own[take]])
                order = np.lexsort((n, -s))[:self.k]
                self.found[i][j] = (s[order], n[order])
                if len(order) == self.k:
                    self.floor[i][j] = max(lo, int(s[order[-1]]))

    def rows(self) -> pa.RecordBatch:
        out = [(int(self.ids[i]), p, int(n), int(s)) for i, bands in enumerate(self.bands)
               for (p, _, _), (score, near) in zip(bands, self.found[i], strict=True) for s, n in zip(score, near, strict=True)]
        columns = zip(*out, strict=True) if out else ([], [], [], [])
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["anchor", "positive", "other", "score"])


def _matrix(column: pa.Array, kind=np.int64) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _swept(rows: DataFrame, k: int, same_label: bool, low: int, high: int) -> DataFrame:
    """anchor, positive, other, score: the best of each cell. ``rows``: cell (any key), anchor (flag),
    id, label, v, code, align, positives; without positives an anchor asks for the best of all."""

    def bands_of(positives):
        if positives is None:
            return [(0, _LOW, _HIGH)]
        bands = [(p["p"], -(-low * p["s"] // 100), high * p["s"] // 100) for p in positives]
        return [(p, max(lo, _LOW), min(hi, _HIGH)) for p, lo, hi in bands if lo <= hi]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, block, best = None, [], None
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE):
                part = batch.slice(start, SLICE)
                keys = part.column("cell").to_pylist()
                kinds = part.column("anchor").to_pylist()
                cuts = [0, *(i for i in range(1, len(keys)) if keys[i] != keys[i - 1] or kinds[i] != kinds[i - 1]), len(keys)]
                for lo, hi in zip(cuts, cuts[1:], strict=False):
                    if lo == hi:
                        continue
                    if keys[lo] != cell:
                        if best is not None:
                            yield best.rows()
                        cell, block, best = keys[lo], [], None
                    piece = part.slice(lo, hi - lo)
                    if kinds[lo]:
                        block.append(piece)
                        continue
                    if not block:  # a cell that no anchor visits
                        continue
                    if best is None:
                        whole = pa.Table.from_batches(block).combine_chunks()
                        bands = [bands_of(x) for x in whole.column("positives").to_pylist()]
                        best = Best(k, whole.column("id").to_numpy(), whole.column("label").to_numpy(),
                                    _matrix(whole.column("v").combine_chunks()), bands, same_label)
                    words = _matrix(piece.column("code"), np.uint64)
                    best.meet(piece.column("id").to_numpy(), piece.column("label").to_numpy(), _matrix(piece.column("v")),
                              words, piece.column("align").to_numpy())
        if best is not None:
            yield best.rows()

    dealt = rows.repartition("cell").sortWithinPartitions("cell", F.desc("anchor"))
    return dealt.mapInArrow(sweep, "anchor long, positive long, other long, score long")


def _cell_size(total: int) -> int:
    return min(LARGEST_CELL, max(LEAST_CELL, total // CELLS))


def _cells(vectors: DataFrame, anchors: DataFrame, per_cell: int, label: list[str]) -> DataFrame:
    """Every vector and every anchor in each cell where they meet: those of one label, or all. A vector
    stands in one cell for each block of anchors, an anchor in each cell of its block."""
    size, asked = F.ceil(F.col("v_") / per_cell).alias("cells"), F.ceil(F.col("a_") / ANCHORS).alias("blocks")
    held = vectors.groupBy(*label).agg(F.count("*").alias("v_")).select(*label, size)
    wanted = anchors.groupBy(*label).agg(F.count("*").alias("a_")).select(*label, asked)
    if label:
        sizes = held.join(wanted, label)
        join = lambda df: df.join(sizes, label)
    else:
        one = {"cells": F.lit(held.first()[0]), "blocks": F.lit(wanted.first()[0])}
        join = lambda df: df.withColumns(one)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = join(vectors).where("blocks > 0").withColumns({
        "anchor": F.lit(False), "positives": F.lit(None).cast(_POSITIVES), "cell": F.pmod(F.xxhash64("id"), "cells"), "block": every("blocks")})
    right = join(anchors).where("cells > 0").withColumns({
        "anchor": F.lit(True), "block": F.pmod(F.xxhash64("id", F.lit(1)), "blocks"), "cell": every("cells")})
    kept = ["anchor", "id", "label", "v", "code", "align", "positives", F.concat_ws(":", *label, "block", "cell").alias("cell")]
    return left.select(*kept).unionByName(right.select(*kept))


_POSITIVES = "array<struct<p:long,s:long>>"


def coded(vectors: DataFrame) -> DataFrame:
    """``vectors`` (id, label, v) with code and align, written once."""

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                bits, align = encode(_matrix(batch.column("v"), float))
                yield batch.append_column("code", pa.array(list(bits.view(np.int64)), pa.list_(pa.int64()))).append_column(
                    "align", pa.array(align, pa.float64()))

    return written(vectors.mapInArrow(code, "id long, label long, v array<long>, code array<long>, align double"), "codes")


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score for the rows
    (id, label, v) of ``usable`` that are anchors: the first ``negatives`` rows of other labels with
    low * positive_score <= 100 * negative_score <= high * positive_score, for each of its first
    ``positives`` other rows of the same label."""
    rows = coded(vectors)
    per_cell = _cell_size(rows.count())
    anchors = rows.where(is_anchor).withColumn("positives", F.lit(None).cast(_POSITIVES))

    def first(found: DataFrame, keys: list[str], k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), "other")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    near = _swept(_cells(rows, anchors, per_cell, ["label"]), positives, True, low, high)
    near = written(first(near, ["anchor"], positives).select("anchor", "other", "score"), "positives")
    asked = near.groupBy(F.col("anchor").alias("id")).agg(F.collect_list(F.struct(F.col("other").alias("p"), F.col("score").alias("s"))).alias("positives"))
    anchors = written(anchors.drop("positives").join(asked, "id"), "anchors")
    far = first(_swept(_cells(rows, anchors, per_cell, []), negatives, False, low, high), ["anchor", "positive"], negatives)
    pairs = near.select("anchor", F.col("other").alias("positive"), F.col("score").alias("positive_score"))
    return far.join(pairs, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank", F.col("other").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"))
