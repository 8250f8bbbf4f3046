"""Components of the Jaccard join against brute force."""

import random
import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from kartotek.llm import ngram_join, words


def brute(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.setdefault(i, []).append(
            {tuple(w[k:k + size]) for k in range(len(w) - size + 1)} if len(w) >= size else {tuple(w)} if w else set())
    flat = [(i, s) for i, ss in sets.items() for s in ss]
    root = {i: i for i, _ in flat}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, s), (b, t) in combinations(flat, 2):
        if s and t and 100 * len(s & t) >= percent * len(s | t):
            a, b = sorted((top(a), top(b)))
            root[b] = a
    return sorted((i, len(s), top(i)) for i, s in flat)


def run(spark, rows, size, percent):
    df = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, cls int, posting string")
    return sorted(map(tuple, ngram_join.shingle_components(df, size, percent).collect()))


def corpus(rng, n):
    """Copies, near copies at all distances, shared passages and very short texts."""
    vocabulary = [f"w{k}" for k in range(300)]
    base = [rng.choices(vocabulary, k=rng.choice([3, 8, 20, 60, 200])) for _ in range(n // 6)]
    shared = rng.choices(vocabulary, k=40)
    rows = []
    for i in range(n):
        w = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 4, 8])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        if rng.random() < 0.2:
            w += shared
        rows.append((i * 7 - 50, " ".join(w) if rng.random() < 0.9 else " ".join(w).upper()))
    return rows


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
def test_against_brute_force(spark, size, percent):
    rows = corpus(random.Random(percent), 240)
    assert run(spark, rows, size, percent) == brute(rows, size, percent)


def test_a_chain_of_near_copies_is_one_component(spark):
    rng = random.Random(3)
    w = [f"w{k}" for k in range(120)]
    rows = []
    for i in range(60):
        rows.append((i, " ".join(w)))
        w[rng.randrange(len(w))] = f"n{i}"
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)


def test_nulls_empty_short_and_repeated_rows(spark):
    rows = [(5, None), (4, ""), (3, " \n"), (9, "one two"), (8, "ONE two"), (7, "one"), (9, "one two"), (1, "a b c d")]
    assert run(spark, rows, 3, 90) == brute(rows, 3, 90)
    assert run(spark, [], 3, 90) == []


def test_null_ids_keep_their_row(spark):
    df = spark.createDataFrame([(2, "a b c d"), (None, "a b c d"), (1, "a b c d")], "doc_id long, text string")
    got = [tuple(r) for r in ngram_join.shingle_components(df, 3, 90).collect()]
    assert sorted(got, key=str) == sorted([(2, 2, 1), (None, 2, 1), (1, 2, 1)], key=str)


def test_every_linked_pair_shares_a_posting():
    """Sets at the very edge of the similarity, of all sizes, with many empty fragments."""
    rng = np.random.default_rng(4)
    for percent in (80, 90):
        for n in [*range(1, 60), 100, 331, 1000]:
            pool = np.unique(rng.integers(0, 1 << words.SET_BITS, 4 * n + 8, dtype=np.uint64))
            rng.shuffle(pool)
            for extra in range(n // 3 + 1):
                size = n + extra
                if 100 * n < percent * size:
                    break
                a, b = np.sort(pool[:n]), np.sort(pool[:size])
                row = np.repeat([0, 1], [n, size])
                rows, keys = ngram_join._postings(row, np.concatenate([a, b]), np.array([n, size]), percent)
                assert set(keys[rows == 0].tolist()) & set(keys[rows == 1].tolist()), (percent, n, extra)


def test_sketches_never_hide_a_link():
    rng = np.random.default_rng(4)
    for n in (5, 40, 400):
        a = rng.integers(0, 1 << words.SET_BITS, n, dtype=np.uint64)
        b = np.append(a[: n - n // 10], rng.integers(0, 1 << words.SET_BITS, n // 20, dtype=np.uint64))

        def sketch(x):
            bits = int(ngram_join.sketch_bits(np.array([len(x)]))[0])
            marks = np.bincount((words.mix(x) % np.uint64(bits)).astype(int), minlength=bits) % 2
            return np.packbits(marks.astype(bool)).view(np.int64).tolist()

        rows = pa.table({"cls": [0, 1], "size": [len(a), len(b)], "component": [0, 1], "own": [0, 0], "i": [0, 0], "j": [0, 0],
                         "sketch": [sketch(a), sketch(b)]})
        linked = 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b))
        for forest in (True, False):
            assert not linked or sum(x.num_rows for x in ngram_join._compare(rows, 80, forest)) == 1


def test_sketch_bits_double():
    bits = ngram_join.sketch_bits(np.array([1, 64, 65, 128, 129, 4096, 10 ** 6]))
    assert bits.tolist() == [128, 128, 256, 256, 512, 8192, ngram_join.SKETCH_BITS]


def test_links_of_sketches_of_unlike_widths(spark):
    """Pairs at both sides of a doubling of the sketch and of the threshold."""
    rng = np.random.default_rng(5)
    pairs, texts = [], []
    for n, extra in ((60, 10), (60, 15), (60, 16), (120, 30), (500, 125), (500, 126), (3, 0)):
        pool = [f"w{x}" for x in rng.integers(0, 10 ** 9, n + extra + 4)]
        cls = 10 * len(pairs)
        texts += [(cls, " ".join(pool[:n + 4])), (cls + 1, " ".join(pool))]
        pairs.append((cls, n, cls + 1, n + extra))
    sets = spark.createDataFrame(texts, "cls long, text string").coalesce(1).mapInArrow(
        lambda b: ngram_join._sets(b, 5), ngram_join._SETS)
    got = ngram_join._linked(spark.createDataFrame(pairs, "a long, na long, b long, nb long"), sets, 80).collect()
    assert {(r.a, r.b) for r in got} == {(a, b) for a, na, b, nb in pairs if 100 * na >= 80 * nb}


def test_postings_of_three_members_are_named():
    def batch(rows):
        names = [c.split()[0] for c in ngram_join._CANDIDATES.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)

    two, three, sliced = [(5, c, 9, 1, None, None) for c in (1, 2)], [(6, c, 9, 1, None, None) for c in (1, 2, 3)], [(7, 4, 9, 3, None, None)]
    rows = two + three + sliced
    for cut in (*range(1, len(rows)), None):
        parts = [rows[:cut], rows[cut:]] if cut else [rows]
        out = [r for b in ngram_join._stars(map(batch, parts)) for r in b.to_pylist()]
        assert {r["a"] for r in out if r["b"] is None} == {6, 7}
        assert {(r["a"], r["b"], r["big"]) for r in out if r["b"] is not None} >= {(1, 2, 0), (1, 3, 1)}
    assert list(ngram_join._stars(iter([]))) == []
