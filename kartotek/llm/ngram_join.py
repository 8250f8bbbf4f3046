"""Exact Jaccard join of word shingle sets by vertical partitioning.

The order of all shingles (by hash) is cut into fragments, the same for every document of one size
class. Two sets that link differ in at most D shingles, so of more than D fragments at least one
is the same in both: documents meet only under the content of a whole fragment. Links are then
decided exactly: for a candidate pair the overlaps of coarser fragments are counted separately and
summed.

1. One pass over the texts gives each document its set's size and hash. Equal sets are one class.
2. A second pass gives the fragment contents ("postings"). Within a slice of rows, and then within
   each posting, members are tied to one of them only (a star), so a group of n copies makes n
   candidates and not n^2. A fragment may be empty in both sets; a class has E more fragments than
   it needs, and a document with more empty ones than E is cut once more by another hash.
3. Candidates are verified; links give components.
4. A posting of two members is settled then. Only components that meet others in a larger one are
   looked at again. Members of different components in one posting are compared by bit sketches
   that can never hide a link, first along a spanning forest and then, between what is still
   apart, completely. What passes is verified. So every pair of linked documents ends in one
   component, and no pair within one is needed.

Defined results: no text or no words: an empty set, linked with nothing; fewer words than a
shingle: the whole sequence is the one shingle; repeated rows link; rows with a null id make no
links and show the component of equal texts; an empty table gives an empty result; further columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.llm import bitmap, words
from kartotek.llm.components import connected
from kartotek.llm.memory import tidy
from kartotek.llm.store import written
from kartotek.session import configure

#: Ratio of the largest to the smallest size of a size class.
CLASS_RATIO = 1.5
#: Hashes that cut a document with too many empty fragments, one after the other.
SEEDS = 4
#: Vertical fragments in which overlaps are counted.
FRAGMENTS = 8
#: Members of one posting that one task compares with as many others.
BLOCK = 2048
#: Largest sketch, in bits.
SKETCH_BITS = 8192

_U = np.uint64


# --- size classes -----------------------------------------------------------------------------

@lru_cache(maxsize=8)
def _classes(percent: int) -> tuple[np.ndarray, ...]:
    """lows, highs, fragments and spare fragments of all size classes up to 2^31."""
    low, rows = 1, []
    while low < 1 << 31:
        high = max(low, int(low * CLASS_RATIO))
        most = high * (100 - percent) // percent  # differing shingles of a pair whose smaller set is here
        spare = 0
        if most:
            for _ in range(3):
                empty = (most + 1 + spare) * math.exp(-low / (most + 1 + spare))
                spare = math.ceil(empty + math.sqrt(empty))
        rows.append((low, high, most + 1 + spare, spare))
        low = high + 1
    return tuple(np.array(c, np.int64) for c in zip(*rows, strict=True))


def _postings(row: np.ndarray, grams: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, posting) of the sets given by sorted (row, shingle hash)."""
    lows, _, fragments, spares = _classes(percent)
    top = np.searchsorted(lows, sizes, "right") - 1
    least = np.searchsorted(lows, -(-sizes * percent // 100), "right") - 1
    rows_out, keys_out = [], []
    for down in range(int((top - least).max(initial=0)) + 1):
        here = np.flatnonzero(top - least >= down) if down else np.flatnonzero(sizes > 0)
        for seed in range(SEEDS):
            if not len(here):
                break
            kind = top[here] - down
            m = fragments[kind]
            base = np.cumsum(m) - m
            place = np.full(len(sizes), -1)
            place[here] = np.arange(len(here))
            own = place[row]
            mine = own >= 0
            own, g = own[mine], grams[mine]
            spread = g << _U(64 - words.SET_BITS) if not seed else words.mix(g + _U(seed << 56))
            part = ((spread >> _U(32)) * m[own].astype(_U) >> _U(32)).astype(np.int64)
            slot = base[own] + part
            total = np.zeros(int(m.sum()), _U)
            np.add.at(total, slot, words.mix(g))
            count = np.bincount(slot, minlength=len(total))
            owner = np.repeat(np.arange(len(here)), m)
            index = np.arange(len(total)) - base[owner]
            names = words.mix(total + words.mix(
                (index + (kind[owner] << 32) + (seed << 48)).astype(_U)) + count.astype(_U))
            empty = np.bincount(owner[count == 0], minlength=len(here))
            rare = empty > spares[kind]
            keep = count > 0
            if seed == SEEDS - 1:
                keep |= rare[owner]
            rows_out.append(here[owner[keep]])
            keys_out.append(names[keep])
            here = here[rare]
    if not rows_out:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    return np.concatenate(rows_out), np.concatenate(keys_out)


def _set_hash(row: np.ndarray, grams: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.bincount(row, minlength=n).astype(np.int64)
    total = np.zeros(n, _U)
    np.add.at(total, row, words.mix(grams))
    return sizes, words.mix(total + words.mix(sizes.astype(_U)))


def _longs(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64) if x.dtype == _U else x.astype(np.int64), pa.int64())


# --- passes over the texts --------------------------------------------------------------------

def _sizes(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches):
        row, grams = words.shingle_sets(words.cut(batch.column(1), lower=True), size)
        sizes, names = _set_hash(row, grams, batch.num_rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), _longs(sizes), _longs(names)], ["doc_id", "n_shingles", "cls"])


_CANDIDATES = "posting long, cls long, size long, members long, cls2 long, size2 long"


def _first_candidates(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Postings of the members of a slice; where three or more of them share one, only the first
    stays (with their number) and a star ties the others to it."""
    for batch in words.slices(batches):
        row, grams = words.shingle_sets(words.cut(batch.column(0), lower=True), size)
        sizes, names = _set_hash(row, grams, batch.num_rows)
        one = np.zeros(batch.num_rows, bool)
        one[np.unique(names, return_index=True)[1]] = True
        one &= sizes > 0
        mine = one[row]
        row, keys = _postings(row[mine], grams[mine], np.where(one, sizes, 0), percent)
        order = np.argsort(keys, kind="stable")
        row, keys = row[order], keys[order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = keys[1:] != keys[:-1]
        starts = np.flatnonzero(fresh)
        group = np.cumsum(fresh) - 1
        members = np.diff(np.append(starts, len(keys)))[group] if len(keys) else row
        many = members >= 3
        stays = fresh | ~many
        local = np.unique(np.stack([row[starts[group]], row])[:, ~stays], axis=1) if len(keys) else np.zeros((2, 0), np.int64)
        a, b = local
        nothing = pa.nulls(int(stays.sum()), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([_longs(keys[stays]), _longs(names[b])]),
             pa.concat_arrays([_longs(names[row[stays]]), _longs(names[a])]),
             pa.concat_arrays([_longs(sizes[row[stays]]), _longs(sizes[a])]),
             pa.concat_arrays([_longs(np.where(many, members, 1)[stays]), _longs(np.full(len(a), 3))]),
             pa.concat_arrays([nothing, _longs(names[b])]),
             pa.concat_arrays([nothing, _longs(sizes[b])])],
            ["posting", "cls", "size", "members", "cls2", "size2"])


_PAIRS = "a long, na long, b long, nb long"


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (posting, cls): the first member of each posting with each other one,
    and whether the posting has more than these two; such postings themselves are rows with a null b.
    Of an unfinished posting at most two rows are held, or its first one once it is known to have three."""
    held = [np.zeros(0, np.int64) for _ in range(4)]

    def pairs_of(key, cls, size, members, last: bool):
        """Pairs of the finished postings (of all if ``last``), the rows to hold, and postings of three or more."""
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (cls[1:] != cls[:-1])
        at = np.flatnonzero(fresh)
        if len(key):
            members = np.maximum.reduceat(members, at)
        key, cls, size = key[fresh], cls[fresh], size[fresh]
        opens = np.ones(len(key), bool)
        opens[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        big = np.zeros(len(starts), bool)
        if len(key):
            big = (np.diff(np.append(starts, len(key))) >= 3) | (np.maximum.reduceat(members, starts) >= 3)
        hub = starts[run] if len(key) else run
        told = hub != np.arange(len(key))
        keep = [x[:0] for x in (key, cls, size, members)]
        if len(key) and not last:
            tail = starts[-1]
            if big[-1]:
                keep = [key[tail:tail + 1], cls[tail:tail + 1], size[tail:tail + 1], np.array([3])]
            else:
                keep = [key[tail:], cls[tail:], size[tail:], members[tail:]]
                told[tail:] = False
        hub, other = hub[told], np.flatnonzero(told)
        return [cls[hub], size[hub], cls[other], size[other], big[run[told]].astype(np.int64)], keep, key[starts[big]]

    def rows(parts):
        a, na, b, nb, big = (np.concatenate(c) for c in zip(*parts, strict=True))
        low = a < b
        found = np.unique(np.stack([np.where(low, a, b), np.where(low, na, nb), np.where(low, b, a), np.where(low, nb, na), big]), axis=1)
        return pa.RecordBatch.from_arrays([_longs(c) for c in found], ["a", "na", "b", "nb", "big"])

    def named(many):
        nothing = pa.nulls(len(many), pa.int64())
        return pa.RecordBatch.from_arrays([_longs(many), *[nothing] * 3, _longs(np.ones(len(many)))], ["a", "na", "b", "nb", "big"])

    for batch in batches:
        tied = batch.column("cls2").is_valid().to_numpy(zero_copy_only=False)
        plain = [batch.column(c).to_numpy(zero_copy_only=False)[~tied] for c in ("posting", "cls", "size", "members")]
        star = batch.filter(pa.array(tied))
        ready = [star.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("cls", "size", "cls2", "size2")]
        parts = [[*ready, np.ones(star.num_rows, np.int64)]]
        found, held, many = pairs_of(*(np.concatenate(c) for c in zip(held, plain, strict=True)), last=False)
        parts.append(found)
        for out in (rows(parts), named(many)):
            if out.num_rows:
                yield out
    found, _, many = pairs_of(*held, last=True)
    for out in (rows([found]), named(many)):
        if out.num_rows:
            yield out


_SETS = "cls long, size long, sketch array<long>, fragments array<array<long>>"


def _sets(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(cls, size, sketch, fragments): each set in FRAGMENTS vertical fragments, and its sketch: the
    parity of the number of shingles in each of its bits, so two sketches differ in no more bits
    than the sets in shingles."""
    for batch in words.slices(batches):
        row, grams = words.shingle_sets(words.cut(batch.column(1), lower=True), size)
        n = batch.num_rows
        sizes = np.bincount(row, minlength=n)
        slot = row * FRAGMENTS + ((grams >> _U(22)) * _U(FRAGMENTS) >> _U(32)).astype(np.int64)
        ends = np.append(0, np.cumsum(np.bincount(slot, minlength=n * FRAGMENTS)))
        fragments = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), _longs(grams))
        bits = sketch_bits(sizes)
        base = np.append(0, np.cumsum(bits))
        place = base[row] + (words.mix(grams) % bits[row].astype(_U)).astype(np.int64)
        marks = np.bincount(place, minlength=base[-1]) & 1
        sketches = pa.ListArray.from_arrays(
            pa.array(base // 64, pa.int32()), pa.array(np.packbits(marks.astype(bool)).view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), _longs(sizes), sketches,
             pa.ListArray.from_arrays(pa.array(np.arange(0, n * FRAGMENTS + 1, FRAGMENTS), pa.int32()), fragments)],
            ["cls", "size", "sketch", "fragments"])


def sketch_bits(sizes: np.ndarray) -> np.ndarray:
    """Two bits a shingle, doubling, so that sketches of unlike sizes can be folded."""
    steps = np.ceil(np.log2(np.maximum(2 * sizes, 1))).astype(np.int64)
    return np.minimum(SKETCH_BITS, 1 << np.maximum(steps, 7))


# --- links ------------------------------------------------------------------------------------

def _only(sets: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows of ``sets`` but most of those not in ``classes``: a bit table of fixed size, which lets more
    of them through where it fills up, keeps them out of the shuffle before the exact join."""
    sieve = sets.sparkSession.sparkContext.broadcast(bitmap.build(classes, "cls"))

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(bitmap.contains(sieve.value, batch.column(0).to_numpy())))

    return sets.select("cls", "fragments").mapInArrow(tidy(sifted), "cls long, fragments array<array<long>>")


def _differing(percent: int):
    """Bits in which the sketches sa and sb differ, the longer one folded to the other's length."""
    def xor(x, y):
        return x.bitwiseXOR(y)

    def folded(one, other):
        for _ in range(math.ceil(math.log2(100 / percent))):
            half = (F.size(one) / 2).cast("int")
            one = F.when(F.size(one) > F.size(other), F.zip_with(
                F.slice(one, F.lit(1), half), F.slice(one, half + 1, half), xor)).otherwise(one)
        return one

    a, b = F.col("sa"), F.col("sb")
    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda x, y: F.bit_count(xor(x, y))),
                       F.lit(0), lambda x, y: x + y)


def _linked(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, na, b, nb), near in size, that link: overlaps by fragment, summed. Sketches, which
    cannot differ in more bits than the sets in shingles, spare most other pairs the count, and
    only sets of the pairs that are left travel."""
    short = sets.select("cls", "sketch")
    near = written(
        pairs.select("a", "na", "b", "nb")
        .join(short.select(F.col("cls").alias("a"), F.col("sketch").alias("sa")), "a")
        .join(short.select(F.col("cls").alias("b"), F.col("sketch").alias("sb")), "b")
        .where(_differing(percent) * (100 + percent) <= (F.col("na") + F.col("nb")) * (100 - percent))
        .select("a", "na", "b", "nb"), "near")
    used = _only(sets, near.select(F.explode(F.array("a", "b")).alias("cls")))
    left = used.select(F.col("cls").alias("a"), "fragments")
    right = used.select(F.col("cls").alias("b"), F.posexplode("fragments").alias("fragment", "gb"))
    overlap = (
        near.join(left, "a").select("a", "na", "b", "nb", F.posexplode("fragments").alias("fragment", "ga"))
        .where(F.size("ga") > 0).join(right.where(F.size("gb") > 0), ["b", "fragment"])
        .groupBy("a", "b").agg(F.sum(F.size(F.array_intersect("ga", "gb"))).alias("o"),
                               F.first("na").alias("na"), F.first("nb").alias("nb"))
    )
    return overlap.where(F.expr(f"100 * o >= {percent} * (na + nb - o)")).select("a", "b")


def _near_in_size(percent: int):
    return F.expr(f"100 * least(na, nb) >= {percent} * greatest(na, nb)")


def _members(batches: Iterator[pa.RecordBatch], owners) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray, np.ndarray]]:
    """From (cls, grams): pieces of few rows with row, sorted shingles and set sizes, without most rows
    that the bit table ``owners`` does not have."""
    for whole in batches:
        for lo in range(0, whole.num_rows, 128):
            batch = whole.slice(lo, 128)
            batch = batch.filter(pa.array(bitmap.contains(owners.value, batch.column(0).to_numpy())))
            lists = batch.column(1)
            grams = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
            sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            yield batch, row, grams[np.lexsort((grams, row))], sizes


def _member_postings(batches: Iterator[pa.RecordBatch], percent: int, owners, sieve) -> Iterator[pa.RecordBatch]:
    """Postings of members, but most of those that two of all sets share at most."""
    for batch, row, grams, sizes in _members(batches, owners):
        row, keys = _postings(row, grams, sizes, percent)
        keep = bitmap.contains(sieve.value, keys)
        row, keys = row[keep], keys[keep]
        yield pa.RecordBatch.from_arrays(
            [_longs(keys), batch.column(0).take(pa.array(row)), _longs(sizes[row])], ["posting", "cls", "size"])


def _apart(batches: Iterator[pa.RecordBatch], percent: int, forest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of unlike components in one block pair of a posting that the sketches let pass; with
    ``forest`` only the nearest ones that join components. Rows are sorted by (posting, i, j)."""
    key, held, size = None, [], 0
    for batch in batches:
        changes = np.zeros(batch.num_rows, bool)
        for name in ("posting", "i", "j"):
            column = batch.column(name).to_numpy(zero_copy_only=False)
            changes[1:] |= column[1:] != column[:-1]
        starts = [0, *np.flatnonzero(changes).tolist(), batch.num_rows] if batch.num_rows else []
        for lo, hi in zip(starts, starts[1:], strict=False):
            now = tuple(batch.column(c)[lo].as_py() for c in ("posting", "i", "j"))
            if now != key:
                if held:
                    yield from _named(key, _compare(pa.Table.from_batches(held).combine_chunks(), percent, forest))
                key, held = now, []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield from _named(key, _compare(pa.Table.from_batches(held).combine_chunks(), percent, forest))


def _named(key: tuple[int, int, int], found: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs with the block pair they were found in."""
    for pairs in found:
        if pairs.num_rows:
            own = [pa.array(np.full(pairs.num_rows, k), t)
                   for k, t in zip(key, (pa.int64(), pa.int32(), pa.int32()), strict=True)]
            yield pa.RecordBatch.from_arrays([*own, *pairs.columns], ["posting", "i", "j", *pairs.schema.names])


def _folded(sketches: pa.ListArray) -> np.ndarray:
    """Sketches as rows of 64-bit words, all folded to the length of the shortest."""
    flat = sketches.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    lengths = np.diff(sketches.offsets.to_numpy())
    at = np.append(0, np.cumsum(lengths))
    out = np.empty((len(sketches), lengths.min()), np.uint64)
    for k in range(len(sketches)):
        out[k] = np.bitwise_xor.reduce(flat[at[k]:at[k + 1]].reshape(-1, out.shape[1]), 0)
    return out


def _compare(rows: pa.Table, percent: int, forest: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of one block pair that may link, from at most two blocks of rows."""
    cls, size, label, own = (rows.column(c).to_numpy() for c in ("cls", "size", "component", "own"))
    label = label.copy()
    if (label == label[0]).all():
        return
    sketch = _folded(rows.column("sketch").chunk(0))
    across = rows.column("i")[0] != rows.column("j")[0]
    firsts, seconds, held = [], [], 0
    for k in range(len(cls) - 1):
        rest = np.arange(k + 1, len(cls))
        rest = rest[(label[rest] != label[k]) & (cls[rest] != cls[k])
                    & (100 * np.minimum(size[k], size[rest]) >= percent * np.maximum(size[k], size[rest]))]
        if across:
            rest = rest[own[rest] != own[k]]
        if not len(rest):
            continue
        apart = np.bitwise_count(sketch[rest] ^ sketch[k]).sum(1)
        near = apart <= (size[k] + size[rest]) * (100 - percent) // (100 + percent)
        rest, apart = rest[near], apart[near]
        if forest and len(rest):  # the nearest one of each component, which then is one with this
            rest = rest[np.argsort(apart, kind="stable")]
            rest = rest[np.unique(label[rest], return_index=True)[1]]
            label[np.isin(label, label[rest])] = label[k]
        firsts.append(np.full(len(rest), k))
        seconds.append(rest)
        held += len(rest)
        if held > 50_000 or k == len(cls) - 2:
            yield _pair_rows(cls, size, firsts, seconds)
            firsts, seconds, held = [], [], 0
    if held:
        yield _pair_rows(cls, size, firsts, seconds)


def _pair_rows(cls, size, firsts, seconds) -> pa.RecordBatch:
    x, y = np.concatenate(firsts), np.concatenate(seconds)
    x, y = np.where(cls[x] < cls[y], x, y), np.where(cls[x] < cls[y], y, x)
    return pa.RecordBatch.from_arrays(
        [pa.array(c.astype(np.int64)) for c in (cls[x], size[x], cls[y], size[y])], ["a", "na", "b", "nb"])


def _components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(cls, component) of all nodes; one without links is its own component."""
    found = connected(links).withColumnRenamed("node", "cls")
    return nodes.join(found, "cls", "left").select(
        "cls", F.coalesce("component", F.col("cls")).alias("component"))


def shingle_components(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs`` (doc_id, text): the smallest
    doc_id reachable by links, where 100 * intersection >= percent * union."""
    texts = docs.select("doc_id", "text")
    spark = configure(docs.sparkSession)
    sized = written(texts.mapInArrow(tidy(lambda b: _sizes(b, size)), "doc_id long, n_shingles long, cls long"), "sizes")
    classes = sized.where("n_shingles > 0").groupBy("cls").agg(F.min("doc_id").alias("doc_id"))

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    candidates = (
        texts.select("text").mapInArrow(tidy(lambda b: _first_candidates(b, size, percent)), _CANDIDATES)
        .repartition(tasks, "posting").sortWithinPartitions("posting", "cls")
        .mapInArrow(tidy(_stars), _PAIRS + ", big long").groupBy("a", "na", "b", "nb").agg(F.max("big").alias("big"))
    )
    candidates = written(candidates, "candidates")
    many = candidates.where("b IS NULL").select(F.col("a").alias("posting"))  # postings of three or more
    candidates = candidates.where("b IS NOT NULL")
    involved = candidates.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    involved = written(involved.join(classes, "cls"), "involved")
    sieve = spark.sparkContext.broadcast(
        bitmap.build(involved.select(F.xxhash64("doc_id").alias("k")), "k"))

    def sifted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = bitmap.contains(sieve.value, batch.column(2).to_numpy())
            for part in words.slices([batch.filter(pa.array(keep))]):
                row, grams = words.shingle_sets(words.cut(part.column(1), lower=True), size)
                names = _set_hash(row, grams, part.num_rows)[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), _longs(names), part.column(1)], ["doc_id", "cls", "text"])

    chosen = texts.where("doc_id IS NOT NULL").withColumn("k", F.xxhash64("doc_id")).mapInArrow(
        tidy(sifted), "doc_id long, cls long, text string")
    sets = written(
        chosen.join(involved, ["doc_id", "cls"]).dropDuplicates(["doc_id", "cls"]).select("cls", "text").mapInArrow(
            tidy(lambda b: _sets(b, size)), _SETS), "sets")

    tried = candidates.where(_near_in_size(percent))
    links = written(_linked(tried, sets, percent), "links")
    nodes = involved.select("cls")
    component = written(_components(nodes, links), "components")
    links = _close_gaps(candidates, many, sets, links, component, percent, tasks)
    component = _components(nodes, links)

    # components of classes to those of documents
    of_class = component.join(classes, "cls")
    least = of_class.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    named = of_class.join(least, "component").select("cls", "component_id")
    whole = classes.join(named, "cls", "left").select(
        "cls", F.coalesce("component_id", "doc_id").alias("component_id"))
    return sized.join(whole, "cls", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("n_shingles") > 0, F.coalesce("component_id", "doc_id")).otherwise(F.col("doc_id")).alias("component_id"))


def _close_gaps(candidates, many, sets, links, component, percent, tasks) -> DataFrame:
    """Step 4: all links between components that meet in a posting."""
    ends = (
        candidates.where("big = 1").join(component.select(F.col("cls").alias("a"), F.col("component").alias("ca")), "a")
        .join(component.select(F.col("cls").alias("b"), F.col("component").alias("cb")), "b")
        .where("ca <> cb").select(F.explode(F.array("ca", "cb")).alias("component")).distinct()
    )
    members = written(component.join(ends, "component").select("cls", "component"), "members")
    # Sets are sifted and cut in one pass: two in a stage would need two Python workers a task.
    context = sets.sparkSession.sparkContext
    owners = context.broadcast(bitmap.build(members, "cls"))
    sieve = context.broadcast(bitmap.build(many, "posting"))
    postings = written(
        sets.select("cls", F.flatten("fragments").alias("grams"))
        .mapInArrow(tidy(lambda b: _member_postings(b, percent, owners, sieve)), "posting long, cls long, size long")
        .join(members, "cls").select("posting", "cls", "size", "component"), "postings")
    met = written(
        postings.groupBy("posting")
        .agg(F.count("*").alias("n"), F.min("component").alias("p"), F.max("component").alias("q"))
        .where("p <> q AND n > 2").select("posting", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "met")
    blocks = written(
        bitmap.parted(postings, met, "posting")[1].join(met, "posting")
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
        .select("posting", "i", "j", "own", "cls", "size", "component"), "blocks")
    for forest in (True, False):
        if not forest:
            # A block pair without a pair along the forest left nothing out: it has none at all.
            component = written(_components(component.select("cls"), links), "components")
            blocks = (
                blocks.drop("component")
                .join(pairs.select("posting", "i", "j").distinct(), ["posting", "i", "j"], "left_semi")
                .join(component, "cls")
            )
        pairs = written(
            blocks.join(sets.select("cls", "sketch"), "cls")
            .select("posting", "i", "j", "own", "cls", "size", "component", "sketch")
            .repartition(tasks, "posting", "i", "j").sortWithinPartitions("posting", "i", "j")
            .mapInArrow(tidy(lambda b, f=forest: _apart(b, percent, f)), f"posting long, i int, j int, {_PAIRS}"), "pairs")
        found = pairs.select("a", "na", "b", "nb").distinct()
        links = written(links.unionByName(_linked(found, sets, percent)).distinct(), "links")
    return links
