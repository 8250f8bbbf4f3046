"""Components against a union-find."""

import random

from kartotek.llm.components import connected


def groups(pairs):
    root = {}

    def top(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in pairs:
        root[top(a)] = top(b)
    out = {}
    for x in root:
        out.setdefault(top(x), set()).add(x)
    return {frozenset(g) for g in out.values()}


def test_chains_stars_cliques_and_loops(spark):
    rng = random.Random(2)
    names = rng.sample(range(-10**12, 10**12), 400)
    pairs = [(names[i], names[i + 1]) for i in range(150)] + [(names[200], names[i]) for i in range(201, 260)]
    pairs += [(names[i], names[j]) for i in range(300, 310) for j in range(300, 310) if i != j]
    pairs += [(names[i], names[rng.randrange(310, 400)]) for i in range(310, 400)] + pairs[:20]
    df = spark.createDataFrame(pairs, "a long, b long")
    got = {}
    for r in connected(df).collect():
        got.setdefault(r.component, set()).add(r.node)
    want = groups([(a, b) for a, b in pairs if a != b])
    assert {frozenset(g) for g in got.values()} == want


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []
