"""Benchmark decontamination by greedy string tiling.

Tokens are runs of letters and digits, with A-Z as a-z; other ASCII characters only separate. A
seed is MIN_MATCH tokens in a row, known by its Karp-Rabin hash. A bit table of fixed size over
the benchmark's seeds sifts those of the documents, the rest are joined exactly with the
benchmark; no side is broadcast by this code. For each (document, item) pair with a shared seed the
longest match of unmarked tokens is marked again and again until none of MIN_MATCH tokens is left,
so passages count in whatever order they stand. A document is contaminated by an item when the
tiles cover at least ``coverage`` of the item's tokens.

Defined results: null and empty texts have no tokens; items with fewer tokens than a seed flag
nothing; rows with null ids flag nothing and are not flagged; of repeated rows every one is
judged alone and a document's best row counts; equal items both flag; ties between tiles go to
the leftmost in the document, then in the item; empty tables give an empty result; further
columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.llm import bitmap, words
from kartotek.llm.memory import tidy
from kartotek.llm.store import written

MIN_MATCH = 5
COVERAGE = 0.5


def _seeds(texts: pa.Array):
    """(row, position, hash) of every seed, and the tokens of each row."""
    cut = words.cut(texts, lower=True, between=words.BLANKS_AND_SIGNS)
    counts = cut.counts()
    per = np.maximum(counts - MIN_MATCH + 1, 0)
    row = np.repeat(np.arange(len(per)), per)
    at = np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    start = cut.first[:-1][row] + at
    return row, at, words.range_hashes(cut.hashes(), start, start + MIN_MATCH), counts


def _item_seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches):
        row, at, seed, counts = _seeds(batch.column(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed.view(np.int64)), batch.column(0).take(pa.array(row)), pa.array(at.astype(np.int32)),
             pa.array(counts[row].astype(np.int32))],
            ["seed", "item_id", "q", "n_tokens"])


def _doc_seeds(batches: Iterator[pa.RecordBatch], sieve) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches):
        row, at, seed, _ = _seeds(batch.column(2))
        keep = bitmap.contains(sieve.value, seed)
        row, at, seed = row[keep], at[keep], seed[keep]
        yield pa.RecordBatch.from_arrays(
            [pa.array(seed.view(np.int64)), *(batch.column(i).take(pa.array(row)) for i in (0, 1)),
             pa.array(at.astype(np.int32))],
            ["seed", "doc_id", "th", "p"])


def tile(matches: list[tuple[int, int]], least: int = MIN_MATCH) -> list[tuple[int, int, int]]:
    """Tiles (p, q, length) from all seed matches (p, q) of a pair."""
    heap = []
    run = None
    for d, p in sorted({(p - q, p) for p, q in matches}):
        if run and run[0] == d and run[1] + run[2] == p:
            run[2] += 1
            continue
        if run:
            heap.append((-(run[2] + least - 1), run[1], run[1] - run[0]))
        run = [d, p, 1]
    if run:
        heap.append((-(run[2] + least - 1), run[1], run[1] - run[0]))
    heapq.heapify(heap)
    marked_p, marked_q, tiles = set(), set(), []
    while heap:
        length, p, q = heapq.heappop(heap)
        length = -length
        free = [p + k not in marked_p and q + k not in marked_q for k in range(length)]
        if all(free):
            tiles.append((p, q, length))
            marked_p.update(range(p, p + length))
            marked_q.update(range(q, q + length))
            continue
        begin = None
        for k, ok in enumerate([*free, False]):
            if ok and begin is None:
                begin = k
            elif not ok and begin is not None:
                if k - begin >= least:
                    heapq.heappush(heap, (begin - k, p + begin, q + begin))
                begin = None
    return tiles


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, covered, longest = [], [], []
        for hits in batch.column("hits").to_pylist():
            tiles = tile([(h["p"], q) for h in hits for q in h["qs"]])
            counts.append(len(tiles))
            covered.append(sum(t[2] for t in tiles))
            longest.append(max(t[2] for t in tiles))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", "item_id", "n_tokens")),
             *(pa.array(c, pa.int32()) for c in (counts, covered, longest))],
            ["doc_id", "item_id", "n_tokens", "n_tiles", "n_covered", "longest"])


def tilings(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_tokens (of the item), n_tiles, n_covered, longest for every pair of a
    document and an item that could reach any coverage, that is, shares a seed."""
    seeds = (
        benchmark.select("item_id", "text").where("item_id IS NOT NULL")
        .mapInArrow(tidy(_item_seeds), "seed long, item_id long, q int, n_tokens int")
        .groupBy("seed", "item_id", "n_tokens").agg(F.collect_set("q").alias("qs"))
    )
    sieve = docs.sparkSession.sparkContext.broadcast(bitmap.build(seeds, "seed"))
    found = (
        docs.select("doc_id", F.xxhash64("text").alias("th"), "text").where("doc_id IS NOT NULL")
        .mapInArrow(tidy(lambda b: _doc_seeds(b, sieve)), "seed long, doc_id long, th long, p int")
    )
    return (
        found.join(seeds, "seed")
        .groupBy("doc_id", "th", "item_id", "n_tokens").agg(F.collect_list(F.struct("p", "qs")).alias("hits"))
        .mapInArrow(tidy(_tiles), "doc_id long, item_id long, n_tokens int, n_tiles int, n_covered int, longest int")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """doc_id, item_id, coverage, n_tiles, longest of every contaminated pair, once a pair."""
    share = F.col("n_covered") / F.col("n_tokens")
    best = F.struct(share.alias("coverage"), "n_tiles", "longest")
    return (
        tilings(docs, benchmark).where(share >= coverage)
        .groupBy("doc_id", "item_id").agg(F.max(best).alias("best"))
        .select("doc_id", "item_id", "best.*")
    )


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE) -> DataFrame:
    """``docs`` without the contaminated documents; rows with a null doc_id stay. Texts are not shuffled,
    but for those that a bit table of the contaminated ids lets through."""
    found = written(leaks(docs, benchmark, coverage).select("doc_id").distinct(), "contaminated")
    clear, rest = bitmap.parted(docs, found, "doc_id")
    return clear.unionByName(rest.join(found, "doc_id", "left_anti"))
