"""The kernel against brute force, and the machine on planted and held-out texts."""

import random
import zlib
from itertools import combinations

import numpy as np

import __spark_entry__ as entry
from kartotek.llm import toxicity as tox


def brute_kernel(a, b):
    def phi(w):
        w = f"^{w}$"
        out = {}
        for i, j, k in combinations(range(len(w)), 3):
            if k - i < tox.SPAN:
                out[w[i] + w[j] + w[k]] = out.get(w[i] + w[j] + w[k], 0) + tox.DECAY ** (k - i - 2)
        return out

    p, q = phi(a), phi(b)
    norm = np.sqrt(sum(v * v for v in p.values()) * sum(v * v for v in q.values()))
    return sum(v * q.get(u, 0) for u, v in p.items()) / norm if norm else 0.0


def test_kernel():
    names = ["idiot", "idxiot", "i", "", "moron", "idiots", "aaaaaaaa", "stupid"]
    land = tox.Landmarks(names, 3)
    got = land.of_words(names)
    want = np.array([[brute_kernel(a, b) for b in names] for a in names])
    assert np.allclose(got, want, atol=1e-5)
    assert got[0, 1] > 0.45 > got[0, 4]


def test_bounds_never_lose_a_like_word():
    rng = random.Random(1)
    toxic = ["idiot", "moron", "scumbag", "worthless"]
    land = tox.Landmarks([*toxic, "house", "garden"], len(toxic))
    machine = tox.Machine(land, np.ones(6), -1.0, np.zeros(5), len(toxic))
    words = ["".join(rng.choices("idotmrnscubagwhle", k=rng.randrange(1, 9))) for _ in range(2000)]
    words += [w[:k] + "x" + w[k:] for w in toxic for k in range(len(w))]
    got = machine._of_pieces([f"^{w}$" for w in words])[1]
    near = land.of_words(words)
    want = np.where(near[:, :len(toxic)].max(1) >= tox.LIKE, tox.gaussian(near) @ machine.weights - 1.0, -1.0)
    assert np.allclose(got, want, atol=1e-5)
    assert (want > -1).any() and (want == -1).any()


def corpus(n):
    rng = random.Random(9)
    fill = ["".join(rng.choices("aeiourstlnmdh", k=rng.randrange(2, 8))) for _ in range(400)]
    bad = ["idiot", "moron", "worthless", "pathetic"]
    rows = []
    for k in range(n):
        w = rng.choices(fill, k=rng.randrange(5, 60))
        toxic = rng.random() < 0.15
        if toxic:
            for b in rng.sample(bad, rng.choice([1, 1, 2])):
                w.insert(rng.randrange(len(w)), b)
        rows.append((" ".join(w).capitalize() + ".", int(toxic)))
    return rows


def test_gapped_and_spaced_insults_score_and_clean_texts_do_not():
    rows = corpus(1500)
    machine = tox.train([(sorted(tox.words_of(t)), y) for t, y in rows])
    texts = ["so you are an idiot here", "what an IDIOT!", "an idi-ot of the day", "he is an i d i o t today", "a mor.on is there",
             "the idxiot went home", "w o r t h l e s s people"]
    clean = [t for t, y in corpus(300) if not y] + ["", "1 2 3 ..."]
    assert (tox.probabilities(texts, machine, 1) >= tox.THRESHOLD).all()
    assert (tox.probabilities(clean, machine, 1) >= tox.THRESHOLD).mean() < 0.01


def test_a_sample_with_many_toxic_texts():
    rows = [(t, y) for t, y in corpus(4000) if y or len(t) % 6 == 0]
    assert 0.35 < sum(y for _, y in rows) / len(rows) < 0.65
    machine = tox.train([(sorted(tox.words_of(t)), y) for t, y in rows], share=0.15)
    clean = [t for t, y in corpus(400) if not y]
    assert (tox.probabilities(["you idiot", "a mor.on is there"], machine, 2) >= tox.THRESHOLD).all()
    assert (tox.probabilities([*clean, ""], machine, 2) >= tox.THRESHOLD).mean() < 0.01


def test_without_labels_of_both_kinds():
    for rows, score in (([], 0.0), ([(["a"], 0)], 0.0), ([(["a"], 1)], 1.0)):
        got = tox.probabilities(["a", "", "idiot"], tox.train(rows), hash(score))
        assert np.allclose(got, got[0]) and abs(got[0] - score) < 1e-3


def test_held_out_rows_of_the_given_tables(spark):
    folder = "/root/testdata/sf0.1"
    rows = entry.queries()["op3_toxicity_string_kernel"](spark, folder).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert all(r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    caught = [p for y, p in held if y]
    assert sum(caught) / len(caught) > 0.85
    assert sum(p for y, p in held if not y) / sum(not y for y, _ in held) < 0.02


def test_nulls_repeats_empty_tables_and_other_columns(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", 1) for i, (t, _) in enumerate(corpus(300))] + [(None, "the idiot", "x", 1), (7, None, "x", 1), (7, None, "x", 1)],
        "doc_id long, text string, label string, score int")
    labels = spark.createDataFrame(
        [(i, y) for i, (_, y) in enumerate(corpus(300))] + [(None, 1), (3, None), (0, 0), (0, 0)], "doc_id long, toxic int")
    machine = tox.fit(docs, labels)
    assert tox.score(docs, machine).count() == 303
    kept = tox.remove_toxic(docs, machine)
    assert kept.columns == docs.columns and 240 < kept.count() < 290
    assert kept.where("doc_id = 7 AND text IS NULL").count() == 2
    none = tox.fit(docs.limit(0), labels.limit(0))
    assert tox.score(docs.limit(0), none).collect() == []


def test_each_of_several_hundred_insults_counts():
    rng = random.Random(12)

    def word(alphabet, low, high):
        return "".join(rng.choices(alphabet, k=rng.randrange(low, high)))

    fill = [word("aeiourstlnmdh", 2, 8) for _ in range(400)]
    bad = list(dict.fromkeys(word("bcfgjkpqvwxyzaeiou", 6, 11) for _ in range(350)))
    rows = []
    for k in range(9000):
        w = rng.choices(fill, k=rng.randrange(5, 40))
        if k % 3 == 0:
            w += rng.sample(bad, 3)
        rows.append((sorted(set(w)), int(k % 3 == 0)))
    machine = tox.train(rows)
    told = [b for b in bad if sum(b in r for r, _ in rows) >= 15]
    assert len(told) > 300 and machine.n_toxic > 2 * tox.LANDMARKS
    texts = [" ".join([*rng.choices(fill, k=15), b]) for b in told]
    assert (tox.probabilities(texts, machine, 3) >= tox.THRESHOLD).mean() > 0.97
    clean = [" ".join(rng.choices(fill, k=15)) for _ in range(500)]
    assert (tox.probabilities(clean, machine, 3) >= tox.THRESHOLD).mean() < 0.01


def test_a_worker_keeps_a_bounded_number_of_words(monkeypatch):
    """Words that are met once do not pile up: the cache of a worker stays near 100 000 words."""
    from kartotek.llm import toxicity

    machine = toxicity.Machine(None, np.zeros(0), 0.0, np.zeros(5))
    for k in range(3):
        toxicity.probabilities([" ".join(f"w{k}x{i}" for i in range(60_000))], machine, 77)
    assert len(toxicity._CACHE.pop(77)) <= 160_000


def test_words_of_the_same_letters_are_looked_at_once(monkeypatch):
    land = tox.Landmarks(["idiot", "moron", "house"], 2)
    machine = tox.Machine(land, np.array([2.0, 2.0, -1.0]), -1.0, np.zeros(5), 2)
    seen = []
    of_pieces = tox.Machine._of_pieces
    monkeypatch.setattr(tox.Machine, "_of_pieces", lambda self, pieces: (seen.extend(pieces), of_pieces(self, pieces))[1])
    words = ["idiot", "idiot,", "(idiot)", "id-iot", "tree", "tree.", "12", "--", ""]
    got = machine.margins(words)
    assert sorted(seen) == ["^$", "^idiot$", "^tree$"]
    assert len(set(got[:4])) == 1 and got[0] > 0 and (got[4:] == -1.0).all()


def test_a_full_cache_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(tox, "CACHE_SIZE", 1000)
    asked = []
    monkeypatch.setattr(tox.Machine, "margins", lambda self, words: (asked.extend(words), np.zeros(len(words)))[1])
    machine = tox.Machine(None, np.zeros(0), 0.0, np.zeros(5))
    for k in range(4):
        tox.probabilities(["every day " + " ".join(f"w{k}x{i}" for i in range(1100))], machine, 78)
    assert asked.count("every") == asked.count("day") == 1 and len(asked) == 4402
    assert len(tox._CACHE.pop(78)) <= 2200


def test_every_bound_leaves_like_words_of_many_groups():
    rng = random.Random(4)
    toxic = list(dict.fromkeys("".join(rng.choices("abcdefghijklmnopqrstuvwxyzéß", k=rng.randrange(3, 14))) for _ in range(60)))
    land = tox.Landmarks([*toxic, "house", "garden"], len(toxic))
    assert len(land.sieves[1]) == tox.GROUPS and len(land.sieves[0]) > 2
    machine = tox.Machine(land, rng.random() + np.arange(len(toxic) + 2) % 5, -1.0, np.zeros(5), len(toxic))
    words = [*toxic, *(w[:k] + c + w[k:] for w in toxic for k in range(len(w)) for c in "xé"), *(w[1:] for w in toxic), "", "a", "日本語",
             *("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(1, 12))) for _ in range(3000))]
    like, got = machine._of_pieces([f"^{w}$" for w in words])
    near = land.of_words(words)
    assert (like == (near[:, :len(toxic)].max(1) >= tox.LIKE)).all() and 100 < like.sum() < len(words) - 2000
    assert np.allclose(got, np.where(like, tox.gaussian(near) @ machine.weights - 1.0, -1.0), atol=1e-5)
    assert [x.tolist() for x in machine._of_pieces([])] == [[], []]
