"""Trees and proofs against a plain version, for whole tables and for some leaves only."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from kartotek.llm import merkle
from kartotek.llm.queries import QUERIES

ROW = "grp string, id long, digest string, text string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_levels(leaves):
    out = [list(leaves)]
    while len(out[-1]) > 1:
        out.append([sha(*out[-1][i:i + 3]) for i in range(0, len(out[-1]), 3)])
    return out


def plain_proof(levels, at):
    out = []
    for nodes in levels[:-1]:
        lo = at // 3 * 3
        out.append(("".join(nodes[lo:at]), "".join(nodes[at + 1:lo + 3])))
        at //= 3
    return out


def plain(rows):
    """{(grp, id, digest): [(subroot, proof)]} and the root."""
    key = lambda r: (r[1] is not None, r[1] or 0, r[2])
    groups = sorted({r[0] for r in rows}, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_levels([r[2] for r in sorted((r for r in rows if r[0] == g), key=key)]) for g in groups}
    top = plain_levels([trees[g][-1][0] for g in groups])
    out = {}
    for place, g in enumerate(groups):
        for at, r in enumerate(sorted((r for r in rows if r[0] == g), key=key)):
            out.setdefault(r[:3], []).append((trees[g][-1][0], plain_proof(trees[g], at) + plain_proof(top, place)))
    return out, top[-1][0]


def table_of(sizes, seed=1):
    rng = random.Random(seed)
    rows = [(g, i, sha(str(g), str(i)), "t") for g, n in sizes.items() for i in rng.sample(range(10 * n), n)]
    rng.shuffle(rows)
    return rows


def check(manifest, proved, rows):
    want, root = plain(rows)
    assert manifest.root == root
    got = {}
    for r in proved:
        got.setdefault((r.grp, r.id, r.digest), []).append((r.subroot, [tuple(s) for s in r.proof]))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(want[k]) for k in got}
    return got, want


@pytest.mark.parametrize("depth, part", [(1, 4), (2, 5), (6, 2187)])
def test_trees_of_all_sizes(spark, monkeypatch, depth, part):
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "PART", part)
    monkeypatch.setattr(merkle, "READERS", 1)
    rows = table_of({"b": 1, "a": 2, "é": 3, None: 4, "": 28, "Z": 82, "zz": 9, "c": 10})
    rows += [("a", None, sha("x"), "t"), ("a", None, sha("x"), "t"), ("a", rows[0][1], sha("y"), "t"), ("a", rows[0][1], sha("w"), "t")]
    manifest = merkle.build(spark.createDataFrame(rows, ROW).repartition(5))
    proved = merkle.prove(manifest)
    got, want = check(manifest, proved.collect(), rows)
    assert got.keys() == want.keys()
    folded = proved.select(merkle.fold(F.col("digest"), F.col("proof")).alias("f"), merkle.proof_digest(F.col("proof")).alias("p"), "proof").collect()
    assert {r.f for r in folded} == {manifest.root}
    assert all(r.p == sha(*(s.left + s.right for s in r.proof)) for r in folded)


@pytest.mark.parametrize("wanted", ["id % 17 = 3", "id = 44", "grp = 'b'", "id < 60", "false"])
def test_proofs_of_some_leaves(spark, monkeypatch, wanted):
    monkeypatch.setattr(merkle, "PART", 50)
    rows = table_of({"a": 400, "b": 7}) + [("a", 4444, sha("q"), "t")]
    manifest = merkle.build(spark.createDataFrame(rows, ROW))
    proved = merkle.prove(manifest, manifest.leaves.where(wanted)).collect()
    check(manifest, proved, rows)
    assert len(proved) == manifest.leaves.where(wanted).count()


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 50, 82])
def test_octopus_is_whole_and_least(n):
    leaves = [sha(str(i)) for i in range(n)]
    levels = plain_levels(leaves)
    assert [len(level) for level in levels] == merkle.widths(n) and merkle.height(n) == len(levels) - 1
    rng = random.Random(n)
    for size in {1, n // 2 or 1, n}:
        chosen = rng.sample(range(n), size)
        asked = merkle.missing(chosen, n)
        fetched = {(level, i): levels[level][i] for level, i in asked}
        known = {i: leaves[i] for i in chosen}
        assert merkle.interiors(known, fetched, n)[-1] == {0: levels[-1][0]}
        for gone in asked:  # each fetched node is needed
            assert merkle.interiors(known, {k: v for k, v in fetched.items() if k != gone}, n)[-1] == {}
    assert merkle.missing(range(n), n) == []


def test_odd_tables(spark):
    nothing = merkle.build(spark.createDataFrame([], ROW))
    assert nothing.root is None and merkle.prove(nothing).collect() == []
    single = merkle.build(spark.createDataFrame([(None, None, sha("1"), None)], ROW))
    row = merkle.prove(single).first()
    assert single.root == row.subroot == sha("1") and row.proof == []
    with pytest.raises(ValueError, match="pos"):
        merkle.build(spark.createDataFrame([("a", 1, "x", 1)], "grp string, id long, digest string, pos int"))


def test_fields(spark):
    row = spark.createDataFrame([("é", None, 12)], "a string, b string, c long").select(
        merkle.leaf(F.col("a"), F.col("b"), F.col("c"), F.lit(""))).first()[0]
    assert row == sha("2:é-2:120:")


def test_query_on_odd_documents(spark, tmp_path):
    docs = [(i, f"line {i}\nnext" if i % 3 else f"plain {i}", "en", None if i % 7 == 0 else f"s{i % 3}", i) for i in range(60)]
    docs += [(60, None, None, None, None), (61, "", "en", "s1", 0), (62, "\n" * 500_000, "en", "s1", 0), (None, "a\nb", "en", "s1", 3)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").selectExpr(
        "*", "1 AS pos", "2 AS tree", "3 AS digest").write.parquet(f"{tmp_path}/documents.parquet")
    rows = QUERIES["op11_merkle_manifest"](spark, str(tmp_path)).collect()
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = {d[0]: sha(*map(field, (d[0], d[3], d[2], d[4], d[1]))) for d in docs}
    assert {r.doc_id: r.leaf for r in rows} == leaf and len(rows) == len(docs)
    changed = {d[0] for d in docs if d[0] is not None and zlib.crc32(str(d[0]).encode()) % 2 == 0 and "\n" in (d[1] or "")}
    assert {r.doc_id for r in rows if not r.verified} == changed and len(changed) > 10
    assert all(r.folded_root == r.root for r in rows if r.verified) and all(r.folded_root != r.root for r in rows if not r.verified)
