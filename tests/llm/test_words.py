"""Words, hashes, shingle sets and bit tables against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kartotek.llm import bitmap, words

TEXTS = [None, "", " \t", "one", "One  two\nTHREE", "ÀÉ b\x0bc\x0cd", "x " * 5000, " y z w", "last word ", "one", "a b c a b c"]


def plain(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def low(word):
    return re.sub("[A-Z]", lambda m: m[0].lower(), word)


def test_words_of_every_row():
    cut = words.cut(pa.array(TEXTS, pa.string()).slice(1))
    found = [[] for _ in TEXTS[1:]]
    for s, e, d in zip(cut.starts, cut.ends, cut.doc, strict=True):
        found[d].append(cut.data[s:e].tobytes().decode())
    assert found == [plain(t) for t in TEXTS[1:]]
    assert cut.counts().tolist() == [len(f) for f in found]


def test_hashes_depend_on_content_only(monkeypatch):
    cut = words.cut(pa.array(TEXTS, pa.string()), lower=True)
    names = [low(w) for t in TEXTS for w in plain(t)]
    by_name = {}
    for n, h in zip(names, cut.hashes().tolist(), strict=True):
        assert by_name.setdefault(n, h) == h
    assert len(set(by_name.values())) == len(by_name)
    monkeypatch.setattr(words, "BLOCK", 3)
    assert [by_name[n] for n in names] == cut.hashes().tolist()


def test_shingle_sets():
    rng = random.Random(1)
    texts = TEXTS + [" ".join(rng.choices("ab", k=rng.randrange(9))) for _ in range(200)]
    row, grams = words.shingle_sets(words.cut(pa.array(texts, pa.string()), lower=True), 3)
    name = {}
    for i, t in enumerate(texts):
        w = [low(x) for x in plain(t)]
        want = {tuple(w[k:k + 3]) for k in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set()
        mine = set(grams[row == i].tolist())
        assert len(mine) == len(want) == (row == i).sum()
        key = frozenset(want)
        assert name.setdefault(key, frozenset(mine)) == frozenset(mine)


def test_slices_keep_all_rows():
    rng = random.Random(1)
    texts = ["z" * rng.choice([0, 10, 700_000]) for _ in range(3000)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(range(3001)), pa.array(texts, pa.string())], ["i", "text"])
    parts = list(words.slices([batch, batch.slice(0, 0)]))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(3001))
    assert max(p.num_rows for p in parts) <= words.SLICE


def test_bit_table(spark):
    keys = spark.range(5000).select(F.xxhash64("id").alias("k")).unionByName(spark.createDataFrame([(None,)], "k long"))
    table = bitmap.build(keys, "k", bits=18)
    there = np.array([r.k for r in keys.collect() if r.k is not None])
    assert bitmap.contains(table, there).all()
    other = np.array([r.k for r in spark.range(10**6, 10**6 + 5000).select(F.xxhash64("id").alias("k")).collect()])
    assert bitmap.contains(table, other).mean() < 0.1
    assert not bitmap.build(keys.where("false"), "k", bits=18).any()
