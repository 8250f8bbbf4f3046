"""Repeated windows against brute force."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from kartotek.llm import recompression as rec
from kartotek.llm import words


def brute(rows):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in split:
        for k in range(len(w) - rec.WINDOW + 1):
            key = tuple(w[k:k + rec.WINDOW])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    out = []
    for i, w in split:
        gone = set()
        for k in range(len(w) - rec.WINDOW + 1):
            if i is not None and first[tuple(w[k:k + rec.WINDOW])] < i:
                gone.update(range(k, k + rec.WINDOW))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in rows], "doc_id long, text string, th int, key string")
    return sorted(map(tuple, rec.remove_repeats(df).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(5)
    for letters in ("ab", "abcdefghij"):
        passages = [rng.choices(letters, k=k) for k in (13, 14, 20, 40, 90)]
        rows = []
        for i in range(150):
            w = rng.choices(letters + "xyz", k=rng.randrange(30))
            for _ in range(rng.randrange(3)):
                at = rng.randrange(len(w) + 1)
                p = rng.choice(passages)
                cut = rng.randrange(len(p))
                w[at:at] = rng.choice([p, p[cut:], p[:cut], ["r"] * rng.randrange(40)])
            rows.append((rng.randrange(10**6), " ".join(w)))
        rows += [(9, rows[0][1]), (rows[5][0], rows[5][1])]
        assert run(spark, rows) == brute(rows)


def test_nulls_empty_copies_and_null_ids(spark):
    long = " ".join(f"w{k}" for k in range(30))
    rows = [(3, None), (2, ""), (5, long), (4, long), (6, long + " end"), (None, long), (7, "w0 w1"), (8, long[: len(long) // 2]),
            (5, long), (9, "a " * 100), (10, "a " * 60)]
    assert run(spark, rows) == brute(rows)
    assert run(spark, []) == []


def test_kept_text(spark):
    long = " ".join(f"w{k}" for k in range(20))
    df = spark.createDataFrame([(1, long), (2, f"before\n{long} after")], "doc_id long, text string")
    got = {r.doc_id: r.kept_text for r in rec.remove_repeats(df, with_text=True).collect()}
    assert got == {1: long, 2: "before after"}


def test_equal_windows_have_equal_keys():
    """Whatever stands around a window, it is looked up under the same key."""
    rng = random.Random(6)
    for letters in ("ab", "abcdef", [f"w{k}" for k in range(500)]):
        for rounds in (1, 2, 3):
            texts, keys = [], {}
            shared = rng.choices(letters, k=40)
            for _ in range(60):
                texts.append(" ".join([*rng.choices(letters, k=rng.randrange(12)), *shared, *rng.choices(letters, k=rng.randrange(12))]))
            cut = words.cut(pa.array(texts, pa.string()))
            first, row, key = rec.anchors(cut, rounds)
            for f, r, k in zip(first.tolist(), row.tolist(), key.tolist(), strict=True):
                at = f - cut.first[r]
                window = tuple(texts[r].split()[at:at + rec.WINDOW])
                assert keys.setdefault(window, k) == k


def test_rounds_shrink_the_text():
    cut = words.cut(pa.array([" ".join(f"w{k % 997}" for k in range(20_000))], pa.string()))
    sizes = [len(rec.symbols(cut, cut.hashes(), r)[0]) for r in (1, 2, 3)]
    assert sizes[0] < 17_000 and sizes[1] < 0.85 * sizes[0] and sizes[2] < 0.85 * sizes[1]
    runs = words.cut(pa.array(["a " * 1000], pa.string()))
    assert len(rec.symbols(runs, runs.hashes(), 1)[0]) == 1
    assert np.all(rec.symbols(runs, runs.hashes(), 1)[3] == -1)
