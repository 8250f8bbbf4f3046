"""Base spans against plain regular expressions; proposals, trees and redaction."""

import hashlib
import random
import re
import time

import numpy as np

import __spark_entry__ as entry
from kartotek.llm import boosting, pii

PATTERNS = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def brute(text):
    out = []
    for kind, pattern in PATTERNS:
        for m in re.finditer(pattern, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(d))]
            good = {"email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                    "card": 13 <= len(d) <= 19 and sum(x - 9 if x > 9 else x for x in doubled) % 10 == 0,
                    "phone": 9 <= len(d) <= 15}[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_query_against_brute_force(spark, data_dir):
    got = {r.doc_id: r for r in entry.queries()["op6_pii_candidate_boosting"](spark, data_dir).collect()}
    rows = spark.read.parquet(f"{data_dir}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        base = brute(r.text)
        mine = got[r.doc_id]
        assert mine.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [mine.n_email, mine.n_ip, mine.n_card, mine.n_phone] == [
            sum(b.startswith(k) for b in base) for k in pii.KINDS]
        assert set(base) <= set(mine.spans.split(",")) or not base


def test_odd_texts_against_brute_force():
    rng = random.Random(4)
    parts = ["a@b.co", "x.y@z", "@", "1.2.3.4", "999.1.1.1", "1.2.3.4.5.6", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (555) 555-1234", "+123", "é", " ", "\n", "0", "12345678901234567890", "+4930 1234567.", "00000000000000", "-", "256.0.0.1"]
    for _ in range(3000):
        text = "".join(rng.choices(parts, k=rng.randrange(8)))
        assert [f"{k}:{s}:{e}" for k, s, e in pii.base_spans(text)] == brute(text), text


def sentences(n):
    rng = random.Random(8)
    fill = "the of and with to in on for a we they it was here there".split()
    out = []
    for k in range(n):
        w = rng.choices(fill, k=12)
        digits = "".join(rng.choices("0123456789", k=15))
        check = next(d for d in "0123456789" if pii.luhn(digits + d))
        w.insert(rng.randrange(12), rng.choice([
            f"joe{k}.doe@mail{k % 9}.example.com", f"{rng.randrange(1, 255)}.{k % 256}.3.{rng.randrange(255)}",
            digits + check, f"+49 ({rng.randrange(100, 999)}) 555-{rng.randrange(1000, 9999)}", f"in {rng.randrange(1900, 2030)}",
            f"{rng.randrange(1, 9)}.{rng.randrange(20)}", f"2024-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", "".join(rng.choices("0123456789", k=11))]))
        out.append(" ".join(w))
    return out


def test_the_trees_add_rewritten_spans_and_leave_clean_texts_alone():
    model = pii.fit(sentences(900))

    def added(text):
        return [text[s:e] for _, s, e in pii.added_spans(text, pii.base_spans(text), model)]

    assert added("here we joe.doe (at) mail7.example (dot) com it was") == ["joe.doe (at) mail7.example (dot) com"]
    for clean in ("it was at the dot of it", "in 1999 and 2004 there", "on 2024-05-06 it was", "we 3.11 and 4.0 here", "of 12345 to 99"):
        assert added(clean) == [], clean
    assert model.cuts["email"] <= 1


def test_find_and_redact(spark):
    rows = [(1, "mail a@b.co or 1.2.3.4", 9), (2, None, 9), (3, "", 9), (None, "x@y.org", 9), (1, "mail a@b.co or 1.2.3.4", 9),
            (5, "n " * 40_000 + "z@q.io", 9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans int")
    got = [(r.doc_id, [tuple(s) for s in r.spans], r.n_base) for r in pii.find(df).collect()]
    assert (1, [("email", 5, 11), ("ip", 15, 22)], 2) in got and (2, [], 0) in got and (3, [], 0) in got
    assert (5, [("email", 80000, 80006)], 1) in got and len(got) == 6
    red = pii.redact(df)
    assert red.columns == df.columns
    texts = [r.text for r in red.collect()]
    assert texts.count("mail [EMAIL] or [IP]") == 2 and None in texts and "" in texts and "[EMAIL]" in texts
    assert pii.find(df.limit(0)).collect() == [] and pii.redact(df.limit(0)).collect() == []


def test_redaction_of_touching_spans():
    assert pii.redacted("abcdefgh", [("card", 1, 4), ("phone", 3, 6), ("ip", 6, 7)]) == "a[CARD][IP]h"


def test_boosting_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 4))
    y = ((x[:, 0] > 0.5) ^ (x[:, 2] > 0.3)).astype(int)
    model = boosting.fit(x[:2000], y[:2000])
    boosting.calibrate(model, x[2000:], y[2000:])
    p = model.probability(x[2000:])
    assert ((p > 0.5) == y[2000:]).mean() > 0.97
    cut = boosting.threshold(p, y[2000:], 0.99)
    assert y[2000:][p >= cut].mean() >= 0.99
    assert boosting.threshold(np.array([]), np.array([]), 0.9) == 2.0
    assert boosting.fit(x[:0], y[:0]).probability(x).max() <= 0.5


def test_a_long_table_of_numbers_does_not_hide_the_other_texts(spark):
    rng = random.Random(5)
    table = "\n".join(" ".join(str(rng.randrange(1000, 99999)) for _ in range(8)) for _ in range(20_000))
    asked = "here we joe.doe (at) mail.example (dot) com it was"
    df = spark.createDataFrame(list(enumerate([asked, " " + table, *sentences(900)])), "doc_id long, text string")
    got = pii.find(df).where("doc_id = 0").first()
    assert [(s.kind, asked[s.start:s.end]) for s in got.spans] == [("email", "joe.doe (at) mail.example (dot) com")]



def test_the_kept_candidates_are_bounded_and_their_order_does_not_matter():
    texts = [" ".join(sentences(300)), *sentences(300), "1 234 567 890 " * 20_000]
    one, two = pii.Kept(), pii.Kept()
    for t in texts:
        pii.offer(one, t)
    for t in texts[::-1] + texts:
        pii.offer(two, t)
    assert one.rows() == two.rows() and len(one.rows()) <= pii.FIT_CANDIDATES


def test_megabyte_runs_take_seconds():
    model = pii.fit(sentences(300))
    n = 1_000_000
    for text in ("7" * n, "a" * n + "@", "a" * n + "@b.co", "a@" * (n // 2), "a" * n + " 1", "1." * (n // 2),
                 "1" * (n // 2) + "." + "2" * (n // 2), "+1(" * (n // 3), "+49 30 1234567 " * (n // 15),
                 "a@b.co " * (n // 7), "x at " * (n // 5) + "@"):
        began = time.perf_counter()
        base = pii.base_spans(text)
        pii.redacted(text, base + pii.added_spans(text, base, model))
        print(text[:12], round(time.perf_counter() - began, 2))
        assert time.perf_counter() - began < 30, text[:20]


def test_the_trees_learn_from_every_text_here_or_on_spark(spark, monkeypatch):
    texts = [*sentences(3000), "write joe at mail dot com", "a" * 5000 + "@b.co", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    expected = pii.Counts()
    for t in texts:
        pii.offer(expected, t or "")
    assert {(r.grp, bytes(r.x)): r.n for r in pii.counted(df).collect()} == expected.found
    here = pii.learn(df)
    monkeypatch.setattr(pii, "FIT_ROWS", 0)
    there = pii.learn(df)
    assert here.cuts == there.cuts and here.cuts["email"] <= 1
    assert (here.trees.start, here.trees.slope, here.trees.offset) == (there.trees.start, there.trees.slope, there.trees.offset)
    for a, b in ((here.trees.features, there.trees.features), (here.trees.cuts, there.trees.cuts), (here.trees.leaves, there.trees.leaves)):
        assert len(a) == 40 and all((x == y).all() for x, y in zip(a, b, strict=True))


def test_grown_trees_learn_an_interaction_from_weighted_rows():
    rng = np.random.default_rng(0)
    x = rng.integers(0, 40, (4000, 4)).astype(float)
    y = ((x[:, 0] > 20) ^ (x[:, 2] > 11)).astype(int)
    n = rng.integers(1, 5, 4000)
    edges = [boosting.quantiles(*np.unique(np.repeat(x[:, j], n), return_counts=True)) for j in range(4)]
    model = boosting.grow(lambda *tree: boosting.cells(*tree, edges, x, y, n), edges, int(n @ y), int(n @ (1 - y)))
    again = np.repeat(np.arange(4000), n)
    rows = boosting.grow(lambda *tree: boosting.cells(*tree, edges, x[again], y[again], np.ones(len(again), int)), edges,
                         int(n @ y), int(n @ (1 - y)))
    assert all((a == b).all() for a, b in zip(model.leaves, rows.leaves, strict=True))
    assert ((model.probability(x) > 0.5) == y).mean() > 0.97
