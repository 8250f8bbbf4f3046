"""Catalogue reconciliation on small hand-made inputs."""

import json

import pytest
from pyspark.sql import functions as F

from kartotek.operators import adapters, catalog, numbering
from kartotek.sources import html, landed

FLAT = "id string, path string, title string, published string, updated string, score double, page_no int, item_pos int"
WEB = "table_id string, category_ids array<string>, category_names array<string>, title string, href string, item_pos int"
NAV = "parent_path string, item_pos int, id string, text string, type string, updated string"
OCC = "id string, path string, title string, updated string, published string, categories array<struct<id:string,name:string>>"


def test_stale_flat_entry_dropped_and_web_only_filled(spark):
    flat = spark.createDataFrame(
        [("first.px", "demo / pop /", "First", "2020-01-01", None, 1.0, 1, 0),
         ("FIRST.px", "/other", "Second copy", "2020-01-01", None, 1.0, 1, 1),
         ("stale.px", "/demo", "Stale", "2020-01-01", None, 1.0, 1, 2)], FLAT)
    web = spark.createDataFrame(
        [("First.px", ["demo", "pop"], ["Demo", "Pop"], "W1", "/a", 0),
         ("first.PX", ["demo", "pop"], ["Demo", "Pop"], "again", "/a2", 1),
         ("first.px", ["elsewhere"], ["Else"], "W2", "/b", 2),
         ("only.px", ["demo"], ["Demo"], "W3", "/c", 3),
         ("gone.px", ["demo"], ["Demo"], "W4", "/d", 4)], WEB)
    entries = spark.createDataFrame(
        [("/demo", 0, "ONLY.px", "From folder", "t", "2022-02-02"), ("/demo", 1, "gone.px", "x", "l", None)], NAV)
    filled = catalog.web_only_metadata(web, flat, entries)
    assert [(r.table_id, r.title, r.updated) for r in filled.collect()] == [("only.px", "From folder", "2022-02-02")]
    got = {(r.table_id, r.path_key): (r.tier, r.title) for r in catalog.match_metadata(web, flat, filled).collect()}
    assert got == {("First.px", "/demo/pop"): ("exact", "First"), ("first.px", "/elsewhere"): ("same_id", "First"),
                   ("only.px", "/demo"): ("folder", "From folder")}
    counts = catalog.reconcile_counts(
        flat.select(F.lower("id").alias("id_key")), web.select(F.lower("table_id").alias("id_key")), filled.select("id_key")).first()
    assert tuple(counts) == (1, 2, 1, 1)


def test_one_table_under_two_paths(spark):
    rows = [("T", "/b", "Title", "2024-01-02T00:00:00", None, [("b", "B")]), ("T", "/A", "Title A", "2023-01-01", None, [("A", "Aa")]),
            ("T", "/c", "Again", "2024-01-02", None, [("A", "Aa")]), ("U", "/", "", "never", "2020-01-01", []),
            ("V", "/a", "V", "never", None, [("a", "a")]), ("V", "/b", "V", "2024-01-01", None, [("a", "a")])]
    candidates, paths = catalog.collapse_occurrences(spark.createDataFrame(rows, OCC))
    got = {r.dataset_code: (r.label, str(r.updated), r.subject_label) for r in candidates.collect()}
    assert got == {"T": ("Title A", "2023-01-01 00:00:00", "Aa"), "U": ("U", "2020-01-01 00:00:00", None)}
    listed = sorted((r.id, r.path_no, r.categories[0].name) for r in paths.filter("id = 'T'").collect())
    assert listed == [("T", 0, "Aa"), ("T", 1, "B")]


def test_folder_tiers_need_exactly_one_hit(spark):
    entries = spark.createDataFrame(
        [("/", 0, "Befolkning", "B", "l", None), ("/", 1, "Örebro-län", "Ö", "l", None), ("/", 2, "AB", "1", "l", None),
         ("/", 3, "ab", "2", "l", None), ("/", 4, "table", "t", "t", None)], NAV)
    wanted = spark.createDataFrame(
        [("/", w) for w in ("Befolkning", "BEFOLKNING", "orebrolan", "AB", "Ab", "table")], "parent_path string, category_id string")
    got = {r.category_id: (r.folder_id, r.tier) for r in catalog.match_folder(entries, wanted).collect()}
    assert got == {"Befolkning": ("Befolkning", "exact"), "BEFOLKNING": ("Befolkning", "caseless"),
                   "orebrolan": ("Örebro-län", "plain"), "AB": ("AB", "exact")}


def test_labels_from_the_tree(spark):
    entries = spark.createDataFrame(
        [("/", 0, "vaesto", "vaesto. Population", "l", None), ("/vaesto", 0, "Synt", "Births", "l", None)], NAV)
    paths = spark.createDataFrame([(["vaesto", "synt"],), (["vaesto", "none"],), (["VAESTO"],)], "category_ids array<string>")
    got = {"/".join(r.category_ids): [c.name for c in r.categories] for r in catalog.override_labels(paths, entries).collect()}
    assert got == {"vaesto/synt": ["Population", "Births"], "VAESTO": ["Population"]}
    tables = paths.withColumn("category_names", F.transform("category_ids", lambda x: F.concat(x, F.lit(" - own"))))
    both = catalog.web_categories(tables, catalog.override_labels(paths, entries))
    names = {"/".join(r.category_ids): [c.name for c in r.categories] for r in both.collect()}
    assert names["vaesto/none"] == ["own", "own"] and names["VAESTO"] == ["Population"]


def test_walk(spark):
    entries = spark.createDataFrame(
        [("/", 0, "a", "a. First", "l", None), ("/", 1, "a", "dup", "l", None), ("/a", 0, "b", "B", "l", None),
         ("/a/b", 0, "T.px", "Table", "t", " "), ("/a/b", 1, "t.PX", "same", "t", None), ("/", 2, "root.px", None, "t", None),
         ("/lost/x", 0, "no.px", "no", "t", None), ("/lost", 0, "x", "x", "l", None)], NAV)
    got = {(r.path, r.id): (r.title, [c.name for c in r.categories]) for r in catalog.walk(entries).collect()}
    assert got == {("/a/b", "T.px"): ("Table", ["First", "B"]), ("/", "root.px"): ("root.px", [])}


def test_tree_page(spark):
    page = """<ul><li class="AspNet-TreeView-Root"><a href="#">Start &amp; all</a><ul>
      <li class="AspNet-TreeView-Parent">B. Bransch<!-- <li> --><ul>
        <li class='AspNet-TreeView-Leaf'><a href="/pxweb/en/Db/Db__B/table%201.px/">Table
           one</a></li></ul></li>
      <li class="AspNet-TreeView-Parent">C<ul><li class="x AspNet-TreeView-Leaf"><a href="/pxweb/en/Db/Db__C/table%201.px/">T</a></li>
        <li class="AspNet-TreeView-Leaf">no link</li></ul></li></ul></li></ul>"""
    rows = html.web_catalog(spark.createDataFrame([("https://h.org/pxweb/en/Db/", page)], "url string, html string")).collect()
    assert [(r.table_id, r.category_ids, r.category_names, r.title) for r in rows] == [
        ("table 1.px", ["Db", "B"], ["Start & all", "B. Bransch"], "Table one"), ("table 1.px", ["Db", "C"], ["Start & all", "C"], "T")]
    assert rows[0].href == "https://h.org/pxweb/en/Db/Db__B/table%201.px/"


def test_responses(spark):
    raw = spark.createDataFrame([(1, 200, True), (2, 404, False), (3, 404, True), (4, 500, False), (5, 400, False), (6, None, False)],
                                "n int, status int, root boolean")
    parts = landed.split_responses(raw, F.col("root"))
    assert {k: sorted(r.n for r in v.collect()) for k, v in parts.items()} == {"ok": [1], "dropped": [2, 5], "fatal": [3, 4, 6]}


def pages(spark, rows):
    bodies = [(f, u, 1, json.dumps({"values": [{"a": 1}], "next_url": n})) for f, u, n in rows]
    return landed.page_links(spark.createDataFrame(bodies, "feed string, url string, page_no int, body string"))


def test_page_chain(spark):
    base = "https://h.org/v3/kpi"
    links = pages(spark, [
        ("good", base, "?page=2"), ("good", base + "?page=2", None), ("self", base, base), ("hole", base, "?page=9"),
        ("detached", base, None), ("detached", base + "?page=2", "?page=3"), ("detached", base + "?page=3", "?page=2"),
        ("shared", base, "?page=2"), ("shared", base + "?page=3", "?page=2"), ("shared", base + "?page=2", None), ("blank", base, " ")])
    got = {r.feed: (r.pages, r.heads, r.missing, r.endless, r.complete) for r in catalog.chain_status(links).collect()}
    assert got == {"good": (2, 1, 0, 0, True), "self": (1, 0, 0, 1, False), "hole": (1, 1, 1, 0, False),
                   "detached": (3, 1, 0, 2, False), "shared": (3, 2, 0, 0, False), "blank": (1, 1, 0, 0, True)}
    assert [r.feed for r in links.filter("fault = 'link'").collect()] == ["blank"]


def test_long_chain(spark):
    rows = [("f", f"https://h.org/?p={i}", f"?p={i + 1}" if i < 199 else None) for i in range(200)]
    assert catalog.chain_status(pages(spark, rows)).first().complete


@pytest.mark.parametrize("bounds", [None, [3, 7, 7, 50], [1000], [-5]])
def test_positions_do_not_depend_on_the_cuts(spark, bounds):
    rows = [("a", i % 37) for i in range(37)] + [("b", i) for i in range(5)]
    df = spark.createDataFrame(rows, "g string, k int").repartition(5)
    got = {(r.g, r.k): r.ordinal for r in numbering.ordinals(df, ["g"], ["k"], bounds=bounds).collect()}
    assert got == {(g, k): k for g, k in rows}


def test_first_and_bounds(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 3).alias("g"))
    assert {r.g: r.k for r in numbering.first_per(df, ["g"], [F.col("k")]).collect()} == {0: 0, 1: 1, 2: 2}
    cuts = numbering.range_bounds(df, "k", 8)
    assert cuts == sorted(cuts) and 7 <= len(cuts) <= 9


def test_adapters(spark):
    assert adapters.get_adapter(" KOLADA ") is adapters.ADAPTERS["kolada"]
    with pytest.raises(ValueError):
        adapters.get_adapter("nope")


def test_listing_rules(spark):
    entries = [{"id": " T1 ", "title": "A", "updated": "2024-01-01", "timeUnit": "Daily", "variableNames": ["a", None], "discontinued": 1,
                "paths": {"B": "b", "A": "a"}, "note": "x"}, {"id": " "}, "junk", {"id": "T2", "label": "", "title": "", "description": " "}]
    raw = spark.createDataFrame([("s", 1, json.dumps({"tables": entries, "page": {"pageNumber": 1, "totalPages": 2}})),
                                 ("s", 2, json.dumps({"page": {"pageNumber": 2, "totalPages": 2}})), ("u", 1, "not json")],
                                "scope string, page_no int, body string")
    rows = catalog.candidates_v2(landed.listing_v2(raw), "https://api/", "https://w.org/statbank/table", "en").collect()
    first, second = sorted(rows, key=lambda r: r.dataset_code)
    assert (first.dataset_code, first.label, first.time_unit, first.discontinued, first.variable_names, first.note) == (
        "T1", "A", "Other", True, ["a"], ["x"])
    assert [n.code for n in first.paths[0]] == ["B", "A"] and first.web_url == "https://w.org/statbank/table/T1/"
    assert (second.label, second.description, second.updated) == ("T2", None, None)
    done = {r.scope: (r.landed_pages, r.bad_pages, r.complete) for r in catalog.listing_complete(landed.listing_pages(raw)).collect()}
    assert done == {"s": (2, 1, False), "u": (1, 1, False)}
