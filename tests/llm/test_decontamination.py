"""Greedy string tiling against a plain version, and planted leaks."""

import random
import re

from kartotek.llm import decontamination as dec


def words_of(t):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", t or "")]


def plain_tiles(a, b, least):
    """The textbook loop: longest match of unmarked tokens, leftmost first."""
    marked_a, marked_b, tiles = set(), set(), []
    while True:
        best = (0, 0, 0)
        for p in range(len(a)):
            for q in range(len(b)):
                n = 0
                while (p + n < len(a) and q + n < len(b) and a[p + n] == b[q + n]
                       and p + n not in marked_a and q + n not in marked_b):
                    n += 1
                if n > best[0]:
                    best = (n, p, q)
        n, p, q = best
        if n < least:
            return tiles
        tiles.append((p, q, n))
        marked_a.update(range(p, p + n))
        marked_b.update(range(q, q + n))


def test_tiling_is_the_textbook_one():
    rng = random.Random(1)
    for _ in range(300):
        a, b = rng.choices("abc", k=rng.randrange(25)), rng.choices("abc", k=rng.randrange(25))
        least = rng.choice([2, 3, 5])
        matches = [(p, q) for p in range(len(a) - least + 1) for q in range(len(b) - least + 1)
                   if a[p:p + least] == b[q:q + least]]
        assert dec.tile(matches, least) == plain_tiles(a, b, least)


def leaks(spark, docs, items, **kw):
    d = spark.createDataFrame([(i, t, 0, "s") for i, t in docs], "doc_id long, text string, item_id int, seed string")
    b = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    return d, b, sorted(tuple(r) for r in dec.leaks(d, b, **kw).collect())


def test_against_brute_force(spark):
    rng = random.Random(2)
    vocabulary = [f"v{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([3, 12, 30, 45])))) for k in range(25)] + [(99, None), (98, ""), (97, "a b c d")]
    docs = []
    for i in range(120):
        w = rng.choices(vocabulary, k=rng.randrange(60))
        for _ in range(rng.randrange(3)):
            part = rng.choice(items)[1]
            part = (part or "").split()
            cut = rng.randrange(len(part) + 1)
            piece = rng.choice([part, part[cut:] + part[:cut], part[cut:]])
            at = rng.randrange(len(w) + 1)
            w[at:at] = piece
        docs.append((i, ", ".join(w).upper() if i % 3 else " ".join(w)))
    docs += [(500, None), (501, ""), docs[0]]
    want = set()
    for i, t in docs:
        for k, u in items:
            b = words_of(u)
            if len(b) >= dec.MIN_MATCH:
                tiles = plain_tiles(words_of(t), b, dec.MIN_MATCH)
                share = sum(x[2] for x in tiles) / len(b)
                if share >= 0.5:
                    want.add((i, k, share, len(tiles), max(x[2] for x in tiles)))
    assert leaks(spark, docs, items)[2] == sorted(want)


def test_reordered_parts_count(spark):
    item = [f"q{k}" for k in range(20)]
    swapped = " ".join(["so", *item[10:], "and then", *item[:10], "end"])
    docs, items, found = leaks(spark, [(1, swapped), (2, " ".join(item[:9])), (None, swapped)], [(7, " ".join(item))])
    assert found == [(1, 7, 1.0, 2, 10)]
    kept = dec.remove_contaminated(docs, items)
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 2]
    assert set(kept.columns) == set(docs.columns)


def test_empty_tables(spark):
    assert leaks(spark, [], [(1, "a b c d e f")])[2] == []
    docs, items, found = leaks(spark, [(1, "a b c d e f")], [])
    assert found == [] and dec.remove_contaminated(docs, items).count() == 1


def test_texts_of_clean_documents_are_not_shuffled(spark):
    item = " ".join(f"w{k}" for k in range(40))
    rows = [(i, item if i % 50 == 0 else f"clean {i} " * 20) for i in range(500)] + [(None, item), (7, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = dec.remove_contaminated(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, (r for r in docs.collect() if r.doc_id is None or r.doc_id % 50)))
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    clear = plan[plan.index("Union"):plan.index("Join LeftAnti")]
    assert "may_be" in clear and "Join" not in clear
