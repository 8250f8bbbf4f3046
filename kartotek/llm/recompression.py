"""Removal of word sequences that stand in an earlier document, found by recompression.

Words are symbols. First every maximal run of one word is named; then each round cuts the alphabet
in two by a bit of each name, and names every pair of a left symbol and a right one. Names are hashes of what
they stand for, so all tasks name alike without a shared dictionary. Inside equal word sequences
all rounds do the same, except near the ends: every symbol carries the stretch of words that
decides it, and it is an interior symbol of every window that holds this stretch.

1. A window of WINDOW words is looked up under one of its interior symbols (the smallest by hash
   of its stretch), or under itself where it has none. That choice depends on the window's words
   alone, so equal windows meet under the same symbol. Only chosen symbols are shuffled.
2. Symbols of two or more different texts reveal repeats. Of equal texts only the one with the
   smallest id takes part; the others repeat it whole.
3. Only windows under such symbols are hashed, shuffled and compared exactly (64 bits of the word
   hashes); those that also start in a document with a smaller id mark their words.

Defined results: null or empty text: no words; a text with fewer words than a window keeps all;
rows with one doc_id are not smaller than each other, and a repeated row gets the same result;
rows with a null id keep all words and repeat nobody; an empty table gives an empty result;
further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kartotek.llm import words
from kartotek.llm.store import written

WINDOW = 13
ROUNDS = 2

_U = np.uint64
_NONE = np.iinfo(_U).max


def _runs(name, start, stop, left, right, row):
    """Maximal runs become one symbol; a run or single symbol is decided by its neighbours too."""
    n = len(name)
    opens = np.ones(n, bool)
    opens[1:] = (name[1:] != name[:-1]) | (row[1:] != row[:-1])
    at = np.flatnonzero(opens)
    ends = np.append(at[1:], n) - 1
    size = ends - at + 1
    named = np.where(size > 1, words.mix(name[at] + words.mix(size.astype(_U) + _U(1 << 40))), name[at])
    before, after = np.maximum(at - 1, 0), np.minimum(ends + 1, n - 1)
    has_before = (at > 0) & (row[before] == row[at])
    has_after = (ends < n - 1) & (row[after] == row[at])
    return (named, start[at], stop[ends],
            np.where(has_before, np.minimum(left[before], left[at]), -1),
            np.where(has_after, np.maximum(right[after], right[ends]), _FAR), row[at])


_FAR = np.int64(1) << 40


def _pairs(name, start, stop, left, right, row, turn):
    """Pairs of a left and a right symbol become one; a symbol that stays is decided by the
    neighbour on the side where it could have merged."""
    n = len(name)
    on_right = (words.mix(name + _U(turn * 0x5851F42D4C957F2D % (1 << 64))) & _U(1)).astype(bool)
    same = np.zeros(n, bool)  # the next symbol is in the same row
    same[:-1] = row[1:] == row[:-1]
    joins = np.zeros(n, bool)
    joins[:-1] = ~on_right[:-1] & on_right[1:] & same[:-1]
    joined = np.zeros(n, bool)
    joined[1:] = joins[:-1]
    after = np.minimum(np.arange(n) + 1, n - 1)
    before = np.maximum(np.arange(n) - 1, 0)
    same_before = np.zeros(n, bool)
    same_before[1:] = same[:-1]
    new_right = np.where(joins, np.maximum(right, right[after]),
                         np.where(on_right, right, np.where(same, np.maximum(right, right[after]), _FAR)))
    new_left = np.where(joins, np.minimum(left, left[after]),
                        np.where(on_right, np.where(same_before, np.minimum(left, left[before]), -1), left))
    named = np.where(joins, words.mix(name + words.mix(name[after]) * _U(3)), name)
    keep = ~joined
    return named[keep], start[keep], np.where(joins, stop[after], stop)[keep], new_left[keep], new_right[keep], row[keep]


def symbols(cut: words.Words, h: np.ndarray, rounds: int = ROUNDS):
    """Left and right end of the deciding stretch of each symbol after ``rounds``."""
    n = len(h)
    at = np.arange(n, dtype=np.int64)
    state = (h, at, at + 1, at, at + 1, cut.doc)
    for turn in range(rounds):
        state = _pairs(*(_runs(*state) if not turn else state), turn + 1)
    return state


def anchors(cut: words.Words, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first word, row, key) of every window: the key under which it is looked up."""
    h = cut.hashes()
    n = len(h)
    counts = cut.counts()
    per = np.maximum(counts - WINDOW + 1, 0)
    row = np.repeat(np.arange(len(per)), per)
    first = cut.first[:-1][row] + np.arange(len(row)) - np.repeat(np.cumsum(per) - per, per)
    if not len(first):
        return first, row, np.zeros(0, _U)
    _, _, _, left, right, _ = symbols(cut, h, rounds)
    whole = (left >= 0) & (right < _FAR)
    left, right = left[whole], right[whole]
    near = right - left <= WINDOW
    left, right = left[near], right[near]
    order = np.argsort(left, kind="stable")
    left, right = left[order], right[order]
    key = words.range_hashes(h, left, right)
    best = np.full(n + WINDOW, _NONE, _U)
    for back in range(WINDOW):
        begin = left - back
        fits = (begin >= 0) & (right <= begin + WINDOW)
        np.minimum.at(best, begin[fits], key[fits])
    chosen = best[first]
    bare = chosen == _NONE
    chosen[bare] = words.range_hashes(h, first[bare], first[bare] + WINDOW)
    return first, row, chosen


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, th, doc_id): the keys of each text once; of equal texts in a slice the smallest id."""
    for batch in words.slices(batches):
        doc = batch.column(0).to_numpy()
        th = batch.column(1).to_numpy()
        order = np.lexsort((doc, th))
        first = np.ones(len(order), bool)
        first[1:] = th[order[1:]] != th[order[:-1]]
        batch = batch.take(pa.array(np.sort(order[first])))
        doc, th = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        _, row, key = anchors(words.cut(batch.column(2)))
        if len(key):
            moved = np.ones(len(key), bool)
            moved[1:] = (key[1:] != key[:-1]) | (row[1:] != row[:-1])
            row, key = row[moved], key[moved]
        yield pa.RecordBatch.from_arrays(
            [pa.array(key.view(np.int64)), pa.array(th[row]), pa.array(doc[row])], ["key", "th", "doc_id"])


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by (key, th, doc_id): of each key with several texts, one row a text."""
    key = th = doc = np.zeros(0, np.int64)
    met = False  # the key that the held row ends has had other texts
    for batch in batches:
        new = [batch.column(i).to_numpy() for i in range(3)]
        if not len(new[0]):
            continue
        key, th, doc = (np.concatenate(c) for c in zip((key, th, doc), new, strict=True))
        fresh = np.ones(len(key), bool)
        fresh[1:] = (key[1:] != key[:-1]) | (th[1:] != th[:-1])
        key, th, doc = key[fresh], th[fresh], doc[fresh]
        same = key[1:] == key[:-1]
        shared = np.zeros(len(key), bool)
        shared[1:] |= same
        shared[:-1] |= same
        if met:  # the first row went out with its key's earlier rows
            shared[0] = False
        if len(key) == 1:
            continue
        yield pa.RecordBatch.from_arrays([pa.array(c[shared]) for c in (key, th, doc)], ["key", "th", "doc_id"])
        met = bool(key[-1] == key[-2])
        key, th, doc = key[-1:], th[-1:], doc[-1:]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(window, doc_id, th, pos, done) of the windows under shared keys. Where a smaller id of the
    slice has the window too, the row is done, and spread; so one document a slice is left to meet
    the others, however many have the window."""
    for batch in words.slices(batches):
        cut = words.cut(batch.column(2))
        first, row, key = anchors(cut)
        lists = batch.column(3)
        shared = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64).view(_U)
        owner = np.repeat(np.arange(batch.num_rows), np.diff(lists.offsets.to_numpy()))
        want = np.unique(words.mix(shared + words.mix(owner.astype(_U))))
        keep = np.isin(words.mix(key + words.mix(row.astype(_U))), want)
        first, row = first[keep], row[keep]
        window = words.range_hashes(cut.hashes(), first, first + WINDOW)
        doc = batch.column(0).to_numpy()[row]
        order = np.lexsort((doc, window))
        fresh = np.ones(len(order), bool)
        fresh[1:] = window[order[1:]] != window[order[:-1]]
        least = doc[order][np.flatnonzero(fresh)[np.cumsum(fresh) - 1]] if len(order) else doc
        done = np.zeros(len(order), bool)
        done[order] = doc[order] > least
        position = (first - cut.first[:-1][row]).astype(np.int32)
        spread = words.mix(window + words.mix(doc.view(_U) + position.astype(_U)))
        take = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.where(done, spread, window).view(np.int64)), batch.column(0).take(take),
             batch.column(1).take(take), pa.array(position), pa.array(done)],
            ["window", "doc_id", "th", "pos", "done"])


def kept_words(text: str | None, starts, copy: bool) -> tuple[list[bytes], int]:
    """Words that stay, and how many there were."""
    found = (text or "").encode().split()
    n = len(found)
    if copy and n >= WINDOW:
        return [], n
    if starts is None or not len(starts):
        return found, n
    marks = np.zeros(n + 1, np.int32)
    starts = np.unique(starts)
    np.add.at(marks, starts, 1)
    np.add.at(marks, starts + WINDOW, -1)
    covered = np.cumsum(marks[:n]) > 0
    return [w for w, c in zip(found, covered.tolist(), strict=True) if not c], n


def _results(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in words.slices(batches):
        totals, removed, digests, texts = [], [], [], []
        for text, starts, copy in zip(*(batch.column(i).to_pylist() for i in (1, 2, 3)), strict=True):
            kept, n = kept_words(text, None if starts is None else np.array(starts), bool(copy))
            joined = b" ".join(kept)
            totals.append(n)
            removed.append(n - len(kept))
            digests.append(hashlib.sha256(joined).hexdigest())
            texts.append(joined.decode() if with_text else None)
        columns = [batch.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                   pa.array(digests, pa.string())]
        names = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        if with_text:
            columns.append(pa.array(texts, pa.string()))
            names.append("kept_text")
        yield pa.RecordBatch.from_arrays(columns, names)


def remove_repeats(docs: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (and kept_text) for each row of ``docs``."""
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(
        "doc_id", F.xxhash64("text").alias("th"), F.xxhash64(F.lit("second"), "text").alias("th2"), "text")
    known = keyed.where("doc_id IS NOT NULL")
    texts = known.select("doc_id", "th", "text")
    shared = written(
        texts.mapInArrow(_looked_up, "key long, th long, doc_id long")
        .repartition(tasks, "key").sortWithinPartitions("key", "th", "doc_id")
        .mapInArrow(_shared, "key long, th long, doc_id long"), "shared")
    by_text = shared.groupBy("doc_id", "th").agg(F.collect_list("key").alias("keys"))
    windows = (
        texts.join(by_text, ["doc_id", "th"]).select("doc_id", "th", "text", "keys")
        .mapInArrow(_windows, "window long, doc_id long, th long, pos int, done boolean")
    )
    repeats = (
        windows.withColumn("first", F.min("doc_id").over(Window.partitionBy("window", "done")))
        .where("done OR doc_id > first").groupBy("doc_id", "th").agg(F.collect_set("pos").alias("starts"))
    )
    ids = known.select("doc_id", "th", "th2")
    copies = (
        ids.join(ids.groupBy("th", "th2").agg(F.min("doc_id").alias("first")), ["th", "th2"])
        .where("doc_id > first").select("doc_id", "th").distinct().withColumn("copy", F.lit(True))
    )
    marks = repeats.join(copies, ["doc_id", "th"], "full")
    out = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return (
        keyed.select("doc_id", "th", "text").join(marks, ["doc_id", "th"], "left")
        .select("doc_id", "text", "starts", "copy")
        .mapInArrow(lambda b: _results(b, with_text), out)
    )
