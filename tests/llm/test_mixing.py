"""Mixing: weights, budgets and block permutations."""

import math
from collections import Counter

import pytest

from kartotek.llm import mixing


def table(spark, sizes):
    rows, k = [], 0
    for source, docs in sizes.items():
        for words in docs:
            rows.append((k, " ".join(["w"] * words) if words else None, source, "x", 3))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string, s string, epoch int")


def drawn(spark, sizes, **kw):
    return mixing.draw(table(spark, sizes), **kw).collect()


SIZES = {"big": [10] * 600, "mid": [7] * 60, "small": [5] * 8, None: [3] * 30, "void": [0, 0]}


def test_entropy_target_is_met(spark):
    rows = drawn(spark, SIZES, entropy_share=0.95, max_epochs=1e9)
    tokens = Counter()
    for r in rows:
        tokens[r.source] += r.n_tokens
    totals = {k: sum(v) for k, v in SIZES.items() if sum(v)}
    budget = sum(totals.values())

    def entropy(a):
        z = sum(t ** a for t in totals.values())
        return -sum(t ** a / z * math.log(t ** a / z) for t in totals.values())

    low, high = 0.0, 1.0
    for _ in range(60):
        m = (low + high) / 2
        low, high = (m, high) if entropy(m) >= 0.95 * math.log(4) else (low, m)
    z = sum(t ** low for t in totals.values())
    assert tokens.keys() == totals.keys()
    for source, t in totals.items():
        quota = t ** low / z * budget
        assert quota - max(SIZES[source]) - 0.1 < tokens[source] <= quota + 0.1
        copies = Counter(r.doc_id for r in rows if r.source == source)
        assert max(copies.values()) - min(copies.get(i, 0) for i in copies) <= 1
        assert max(copies.values()) <= math.ceil(quota / t)


def test_repetition_limit_wins(spark):
    rows = drawn(spark, SIZES, entropy_share=1.0, max_epochs=2.0)
    copies = Counter((r.source, r.doc_id) for r in rows)
    assert max(copies.values()) <= 2
    per = Counter()
    for r in rows:
        per[r.source] += r.n_tokens
    assert 75 <= per["small"] <= 80


def test_blocks_are_permuted_anew_each_epoch(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK_TOKENS", 5)
    rows = drawn(spark, SIZES, entropy_share=1.0, max_epochs=1e9)
    orders = {}
    for r in rows:
        if r.source == "small":
            orders.setdefault(r.epoch, {})[r.doc_id] = r.place
    full = [tuple(sorted(o, key=o.get)) for e, o in orders.items() if len(o) == 8]
    assert len(full) > 5 and len(set(full)) > 1


def test_a_given_budget(spark):
    rows = drawn(spark, {"a": [4] * 100, "b": [4] * 100}, budget=200)
    per = Counter()
    for r in rows:
        per[r.source] += r.n_tokens
    assert per == {"a": 100, "b": 100}


@pytest.mark.parametrize("sizes, n", [({}, 0), ({"a": [0, 0]}, 0), ({"a": [3, 3]}, 2), ({None: [1]}, 1)])
def test_edges(spark, sizes, n):
    rows = drawn(spark, sizes)
    assert len(rows) == n and len({r.doc_id for r in rows}) == n


def test_the_plan_has_no_python(spark):
    plan = mixing.draw(table(spark, SIZES))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
