"""Temperature mixing of sources, with Spark expressions only.

A source's weight is its token share to the power of an exponent, normalised. The exponent is
found by nested sections of [0, 1]: the largest one whose weights still have the target entropy (a
share of the largest possible), or, if that would repeat a source more than ``max_epochs`` times
within the budget, the smallest one that keeps the limit. Every turn evaluates all its cut points
in one aggregation over the sources.

Weights become quotas of tokens, and quotas are drawn as permutations of blocks: each source is cut
into blocks by a hash of the document, each epoch has its own order of blocks, full epochs take all
and the last one takes blocks in order while they fit, then documents of the next block, by hash,
while they fit. So a source gets its quota less than one document short, and no order needs more
than the blocks of one source or the documents of one block in one task.

Defined results: null source is a source of its own; null and empty texts have no tokens; sources
without tokens have no quota and do not appear; rows with null ids and repeated rows count and are
drawn like any other; no tokens at all: no rows; one source: exponent 1; further columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartotek.llm.store import written

ENTROPY_SHARE, MAX_EPOCHS = 0.9, 4.0
#: Tokens of a block, and blocks of a source at most.
BLOCK_TOKENS, MAX_BLOCKS = 20_000, 4096
#: Sections of a turn and turns of the search: 32^6 steps.
SECTIONS, TURNS, DIGITS = 32, 6, 6

WORD = r"[^\x20\x09-\x0D]+"


def hashed(*parts: str | Column) -> Column:
    """60 bits of the MD5 of the parts."""
    text = F.concat_ws(":", *[F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("~")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


@dataclass(frozen=True)
class Mix:
    exponent: float
    tokens: int
    budget: float


def _facts(sources: DataFrame, low: float, high: float) -> list[tuple[float, float, float]]:
    """(exponent, entropy, largest number of epochs per token of budget) at all cut points."""
    points = F.explode(F.transform(
        F.sequence(F.lit(0), F.lit(SECTIONS)), lambda i: F.lit(low) + i * F.lit((high - low) / SECTIONS)))
    rows = (
        sources.select("tokens", points.alias("a"))
        .groupBy("a").agg(F.sum(F.pow("tokens", "a")).alias("z"),
                          F.sum(F.pow("tokens", "a") * F.log("tokens")).alias("s"), F.min("tokens").alias("least"))
        .collect()  # SECTIONS + 1 rows
    )
    return sorted((r["a"], math.log(r["z"]) - r["a"] * r["s"] / r["z"], r["least"] ** (r["a"] - 1) / r["z"]) for r in rows)


def _last(sources: DataFrame, holds) -> float:
    """The largest exponent for which ``holds``, true below and false above it; 0 if none."""
    low, high = 0.0, 1.0
    for _ in range(TURNS):
        facts = _facts(sources, low, high)
        good = [k for k, f in enumerate(facts) if holds(f)]
        if not good:
            return low
        k = max(good)
        low = facts[k][0]
        if k == len(facts) - 1:
            return low
        high = facts[k + 1][0]
    return low


def find_mix(sources: DataFrame, entropy_share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS,
             budget: float | None = None) -> Mix | None:
    """sources: source, tokens > 0. Exponents are rounded to DIGITS towards their limit."""
    total = sources.agg(F.sum("tokens").alias("t"), F.count("*").alias("n")).first()
    if not total["n"]:
        return None
    budget = float(total["t"] if budget is None else budget)
    target = entropy_share * math.log(total["n"])
    scale = 10 ** DIGITS
    by_entropy = math.floor(_last(sources, lambda f: f[1] >= target - 1e-12) * scale) / scale
    # repetition falls as the exponent grows: the limit is broken below, kept above
    broken = _last(sources, lambda f: f[2] * budget > max_epochs)
    first = _facts(sources, 0.0, 1.0)[0]
    by_epochs = 0.0 if first[2] * budget <= max_epochs else min(1.0, math.ceil(broken * scale) / scale)
    return Mix(max(by_entropy, by_epochs), total["t"], budget)


def draw(docs: DataFrame, entropy_share: float = ENTROPY_SHARE, max_epochs: float = MAX_EPOCHS,
         budget: float | None = None) -> DataFrame:
    """doc_id, source, n_tokens, epoch, place (of the document's block in the epoch's order): one
    row for each time a document is drawn."""
    counted = written(docs.select(
        "doc_id", "source", F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens")), "counted")
    sources = written(
        counted.groupBy("source").agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "sources")
    mix = find_mix(sources, entropy_share, max_epochs, budget)
    if mix is None:
        return counted.where("false").select("doc_id", "source", "n_tokens", F.lit(0).cast("long").alias("epoch"),
                                             F.lit(0).alias("place"))
    powered = sources.withColumn("z", F.pow("tokens", F.lit(mix.exponent)))
    z = powered.agg(F.sum("z")).first()[0]
    quotas = powered.select(
        F.col("source").alias("s"), "tokens",
        (F.col("z") / z * mix.budget).alias("quota"),
        F.least(F.greatest(F.ceil(F.col("tokens") / BLOCK_TOKENS), F.lit(1)), F.lit(MAX_BLOCKS)).alias("n_blocks"),
    ).withColumn("full", F.floor(F.col("quota") / F.col("tokens"))).withColumn(
        "rest", F.col("quota") - F.col("full") * F.col("tokens"))
    keyed = counted.join(quotas, F.col("source").eqNullSafe(F.col("s"))).withColumn(
        "block", F.pmod(hashed("source", "doc_id"), F.col("n_blocks")))
    blocks = keyed.groupBy("source", "block").agg(
        F.sum("n_tokens").alias("block_tokens"), F.first("full").alias("full"), F.first("rest").alias("rest"))
    order = Window.partitionBy("source", "epoch").orderBy("turn", "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        blocks.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), F.col("full"))))
        .withColumn("turn", hashed("source", "block", "epoch"))
        .withColumn("place", F.row_number().over(order))
        .withColumn("used", F.coalesce(F.sum("block_tokens").over(before), F.lit(0)))
        .withColumn("room", F.col("rest") - F.col("used"))
        .where("epoch < full OR room > 0")
        .select(F.col("source").alias("s"), F.col("block").alias("b"), "epoch", "place",
                ((F.col("epoch") == F.col("full")) & (F.col("block_tokens") > F.col("room"))).alias("cut"), "room")
    )
    plain = counted.join(quotas.select("s", "n_blocks"), F.col("source").eqNullSafe(F.col("s"))).select(
        "doc_id", "source", "n_tokens", F.pmod(hashed("source", "doc_id"), F.col("n_blocks")).alias("block"))
    drawn = plain.join(placed, F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
    within = Window.partitionBy("source", "block").orderBy(hashed("doc_id", "epoch"), "doc_id", "n_tokens").rowsBetween(
        Window.unboundedPreceding, 0)
    last = drawn.where("cut").withColumn("used", F.sum("n_tokens").over(within)).where("used <= room")
    names = ["doc_id", "source", "n_tokens", "epoch", "place"]
    return drawn.where("NOT cut").select(names).unionByName(last.select(names))
