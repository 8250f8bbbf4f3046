"""Nearest neighbours: recall and exact scores against brute force."""

import numpy as np
import pytest

import __spark_entry__ as entry
from kartotek.llm import ann


def brute(rows, k=10, wanted=lambda i: i % 100 == 0):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for q in {i for i in ids if wanted(i)}:
        d = np.sqrt(((x - x[np.flatnonzero(ids == q)[0]]) ** 2).sum(1))
        d[ids == q] = np.inf
        at = np.lexsort((ids, d))[:k]
        out[int(q)] = [(int(ids[a]), float(d[a])) for a in at if d[a] < np.inf]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_on_given_vectors(spark):
    folder = "/root/testdata/sf0.1"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{folder}/embeddings.parquet").collect()]
    want, got = brute(rows), found(entry.queries()["op1_balanced_posting_lists"](spark, folder))
    assert got.keys() == want.keys() and all(len(g) == 10 for g in got.values())
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want) / (10 * len(want))
    assert hits >= 0.9
    exact = {i: np.array(v, float) for i, v in rows}
    for q, near in got.items():
        assert near == sorted(near, key=lambda p: (p[1], p[0]))
        for i, s in near:
            assert abs(s - np.sqrt(((exact[i] - exact[q]) ** 2).sum())) < 1e-12


def test_clustered_vectors_visit_few_lists(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(100, 16)) * 10
    x = np.repeat(centres, 250, 0) + rng.normal(size=(25_000, 16))
    lists = ann.centroids(x, 125)
    graph = ann.graph(lists)
    taken = []
    for q in x[::500]:
        near = graph.search(q)
        d = np.sqrt(((lists - q) ** 2).sum(1))
        assert abs(near[0][0] - d.min()) < 1e-9
        taken.append(sum(s <= ann.PROBE * near[0][0] for s, _ in near))
    assert np.mean(taken) < 6
    sizes = np.bincount(ann.lists_of(x, lists)[1], minlength=len(lists))
    assert sizes.max() < 8 * sizes.mean()


def test_copies_odd_vectors_and_few_candidates(spark):
    rng = np.random.default_rng(2)
    same = [float(v) for v in rng.normal(size=4)]
    rows = [(i, same) for i in range(0, 240, 3)] + [(i, [float(v) for v in rng.normal(size=4)]) for i in (1, 400, 500)]
    odd = [(600, None), (700, [0.0] * 4), (800, [1.0, None, 0.0, 0.0]), (900, [1.0, float("nan"), 0.0, 0.0]),
           (1000, [float("inf"), 0.0, 0.0, 0.0]), (1100, [1.0, 2.0]), (None, same), (1200, []), (0, same)]
    df = spark.createDataFrame([(i, v, 1) for i, v in [*rows, *odd]], "vec_id long, embedding array<float>, id int")
    single = [(i, [float(np.float32(a)) for a in v]) for i, v in rows]
    base = ann.usable(df, "vec_id", "embedding")
    got = found(ann.search(base, base.where("id % 100 = 0")))
    want = brute(single)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}
    few = ann.usable(df.where("vec_id in (0, 1, 400)"), "vec_id", "embedding")
    assert [len(n) for n in found(ann.search(few, few.where("id % 100 = 0"))).values()] == [2, 2]
    none = ann.usable(df.limit(0), "vec_id", "embedding")
    assert ann.search(none, none).collect() == []


def test_long_lists_are_searched_in_parts(spark, monkeypatch):
    monkeypatch.setattr(ann, "PART", 7)
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=5)]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    base = ann.usable(df, "vec_id", "embedding")
    got = found(ann.search(base, base.where("id % 50 = 0"), 5))
    want = brute(rows, 5, lambda i: i % 50 == 0)
    assert {q: [i for i, _ in n] for q, n in got.items()} == {q: [i for i, _ in n] for q, n in want.items()}


@pytest.mark.parametrize("part", [4096, 7])
def test_an_id_repeated_near_the_query_does_not_crowd_out_others(spark, monkeypatch, part):
    monkeypatch.setattr(ann, "PART", part)
    rows = [(100, [0.0, 1.0])] + [(5, [0.001 * k, 1.0]) for k in range(1, 41)] + [(200 + k, [1.0 + k, 1.0]) for k in range(20)]
    vectors = ann.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding")
    got = ann.search(vectors, vectors.where("id = 100"), 10).orderBy("rank").collect()
    assert [r.vec_id for r in got] == [5, *range(200, 209)] and abs(got[0].score - 0.001) < 1e-12
