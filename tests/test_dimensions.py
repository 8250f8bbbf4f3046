"""Dimensions, samples, documents and their round trip."""

import itertools
import json
from math import prod

import pytest
from pyspark.sql import functions as F

from kartotek.operators import dimensions, documents, enrich, quality
from kartotek.sources import landed, stored


def raw(spark, *payloads):
    return spark.createDataFrame([(f"D{i}", json.dumps(p, ensure_ascii=False)) for i, p in enumerate(payloads)], "dataset_code string, body string")


V1 = {"title": " Folk ", "variables": [
    {"code": "Region", "text": "region", "values": ["00", "01"], "valueTexts": ["Riket", "Sthlm"], "map": "karta", "elimination": True},
    {"code": "ContentsCode", "text": "tabellinnehåll", "values": [" B1 "], "valueTexts": []},
    {"code": "Tid", "values": ["0", "1"], "valueTexts": ["2024M9", "2024M10"], "time": True}]}


def test_v1_variables(spark):
    dims, cats = dimensions.dimensions_v1(landed.metadata_v1(raw(spark, V1)))
    got = [(r.pos, r.dim_id, r.label, r.role, r.elimination, sorted(r.extras)) for r in dims.orderBy("pos").collect()]
    assert got == [(0, "Region", "region", "geo", True, ["map"]), (1, "ContentsCode", "tabellinnehåll", "metric", False, []),
                   (2, "Tid", "Tid", "time", False, [])]
    assert [(r.cat_id, r.ordinal, r.label) for r in cats.orderBy("pos", "ordinal").collect()] == [
        ("00", 0, "Riket"), ("01", 1, "Sthlm"), ("B1", 0, "B1"), ("0", 0, "2024M9"), ("1", 1, "2024M10")]
    span = dimensions.v1_periods(dims, cats).first()
    assert (span.first_period, span.last_period) == ("2024M10", "2024M9")  # as text


def test_v2_payload(spark):
    payload = {
        "id": ["Tid", "Kön", "Z"], "role": {"time": ["Tid"]}, "note": ["N"], "extension": {"px": {"subject-area": "S"}},
        "dimension": {
            "Kön": {"label": "kön", "category": {"label": {"2": "kvinnor", "1": "män"}}, "note": " n ", "extension": {"elimination": "yes"}},
            "Tid": {"category": {"index": {"2025": 1, "2024": 0}, "label": {"2024": "tjugofyra"}}, "link": {"a": 1}},
            "Z": {"label": "z", "x": None, "category": {"index": ["b", "a"], "unit": {"a": {"label": "kg", "decimals": 1, "base": "g"}}, "odd": 1}}}}
    axes = dimensions.axes_v2(landed.metadata_v2(raw(spark, payload)))
    dims, cats = dimensions.dimensions_v2(axes)
    rows = {r.dim_id: r for r in dims.collect()}
    assert [r.dim_id for r in dims.orderBy("pos").collect()] == ["Tid", "Kön", "Z"]
    assert (rows["Tid"].label, rows["Tid"].role, rows["Kön"].role) == ("Tid", "time", None)
    assert rows["Kön"].note == ["n"] and rows["Kön"].elimination and sorted(rows["Z"].extras) == ["category", "x"]
    got = {}
    for r in cats.orderBy("pos", "ordinal").collect():
        got.setdefault(r.dim_id, []).append((r.cat_id, r.ordinal, r.label))
    assert got == {"Tid": [("2024", 0, "tjugofyra"), ("2025", 1, "2025")], "Kön": [("2", 0, "kvinnor"), ("1", 1, "män")],
                   "Z": [("b", 0, "b"), ("a", 1, "a")]}
    detail = dimensions.category_details(axes).collect()
    assert [(d.dim_id, d.cat_id) for d in detail] == [("Z", "a")]
    unit = dimensions.category_details(axes).select(F.to_json("unit").alias("u")).first().u
    assert json.loads(unit) == {"label": "kg", "decimals": 1, "extension": {"base": "g"}}


def kept(sizes, limit):
    """The cut as a loop, from the last axis backwards."""
    keep = [min(n, 2) for n in sizes]
    for i in reversed(range(len(keep))):
        if prod(keep) <= limit:
            break
        keep[i] = 1
    return keep


def test_sample_selection_equals_the_backward_cut(spark):
    cases = [s for n in (1, 2, 3, 4) for s in itertools.product((1, 2, 5), repeat=n)]
    rows = [(f"D{i}", p, f"d{p}", n) for i, s in enumerate(cases) for p, n in enumerate(s)]
    sizes = spark.createDataFrame(rows, "dataset_code string, pos int, dim_id string, n bigint").cache()
    for limit in (1, 2, 3, 4, 7, 8, 16):
        got = {}
        for r in dimensions.sample_selection(sizes, "dataset_code", limit).collect():
            got.setdefault(r.dataset_code, {})[r.pos] = r.keep
        assert [[got[f"D{i}"][p] for p in range(len(s))] for i, s in enumerate(cases)] == [kept(s, limit) for s in cases]


SAMPLE = {"class": "dataset", "version": "2.0", "id": ["Tid", "Region"], "size": [1, 2], "dimension": {
    "Region": {"category": {"index": {"00": 0, "01": 1}, "note": {"00": ["Hela"]}}, "extension": {"show": "code"}, "note": ["Not"]},
    "Tid": {"category": {"index": ["2024"]}}}}
SELECTED = [("D0", "Region", ["00", "01"]), ("D0", "Tid", ["2024"])]


def check(spark, sample, selected=SELECTED):
    expected = spark.createDataFrame(selected, "dataset_code string, dim_id string, cat_ids array<string>")
    rows = quality.check_sample(expected, landed.sample_v1(raw(spark, sample)), "dataset_code").collect()
    return {r.rule for r in rows}


def changed(**parts):
    sample = json.loads(json.dumps(SAMPLE))
    for path, value in parts.items():
        node = sample
        *up, last = path.split("__")
        for step in up:
            node = node[step]
        node[last] = value
    return sample


def test_sample_checks(spark):
    assert check(spark, SAMPLE) == set()
    assert check(spark, changed(id=["Tid"], size=[1])) == {"axes"}
    assert check(spark, changed(size=[1, 3])) == {"sizes"}
    assert check(spark, changed(dimension__Region__category__index={"00": 0, "99": 1})) == {"categories"}
    assert check(spark, changed(dimension__Region__category__note={"77": ["x"]})) == {"unknown_category"}
    assert check(spark, changed(dimension__Region__extension=[])) == {"object"}
    assert landed.sample_rejects(raw(spark, changed(version="1.0"), changed(**{"class": "collection"}), SAMPLE)).count() == 2


def placeholder(spark, contents, index={"EliminatedValue": 0}, size=1, listed=True, **side):
    ids, sizes = (["Tid", "ContentsCode"], [2, size]) if listed else (["Tid"], [2])
    sample = {"class": "dataset", "version": "2.0", "id": ids, "size": sizes,
              "dimension": {"Tid": {}, "ContentsCode": {"label": "l", "category": {"index": index, **side}}}}
    rows = landed.sample_v1(raw(spark, sample)).withColumn("contents", F.lit(contents).cast("array<string>") if contents is None
                                                          else F.array(*[F.lit(c) for c in contents]))
    return enrich.fix_placeholder(rows).first()


def test_placeholder(spark):
    r = placeholder(spark, None)
    assert (r.placeholder, r.fault, r.sample.id, r.sample.size, list(r.sample.dimension)) == ("dropped", None, ["Tid"], [2], ["Tid"])
    assert placeholder(spark, None, listed=False).sample.id == ["Tid"]
    assert placeholder(spark, None, size=2).fault == "size"
    r = placeholder(spark, ["B1"], ["EliminatedValue"], unit={"EliminatedValue": {"label": "kg"}})
    axis = json.loads(r.sample.dimension["ContentsCode"])
    assert r.placeholder == "renamed" and axis["category"] == {"index": {"B1": 0}, "unit": {"B1": {"label": "kg"}}} and axis["label"] == "l"
    assert placeholder(spark, ["B1"], note={"other": ["x"]}).fault == "category"
    assert placeholder(spark, ["B1", "B2"]).placeholder == "kept"
    assert placeholder(spark, ["B1"], {"B1": 0}).placeholder == "kept"


def test_enrichment_precedence(spark):
    dims, cats = dimensions.dimensions_v1(landed.metadata_v1(raw(spark, V1)))
    sample = landed.sample_v1(raw(spark, changed(dimension__Region__extension={"show": "code", "map": "other"})))
    axes = dimensions.axes_v2(sample.select("dataset_code", F.struct(
        F.col("sample.id").alias("id"), F.lit(None).cast("string").alias("role"), F.col("sample.dimension").alias("dimension")).alias("payload")))
    sampled, _ = dimensions.dimensions_v2(axes)
    keys = ["dataset_code", "dim_id"]
    dims = dims.withColumn("note", F.lit(None).cast("array<string>")).withColumn("link", F.lit(None).cast("variant"))
    rich = enrich.enrich_dimensions(dims, sampled, keys)
    region = rich.filter("dim_id = 'Region'").select("note", F.to_json("extras").alias("extras")).first()
    assert region.note == ["Not"] and json.loads(region.extras) == {"map": "karta", "show": "code"}
    detailed = enrich.enrich_categories(cats, dimensions.category_details(axes), [*keys, "cat_id"])
    assert {r.cat_id: r.note for r in detailed.filter("dim_id = 'Region'").collect()} == {"00": ["Hela"], "01": None}


PAIR = {
    "dataset": {"identity": {"provider_code": "demo", "dataset_code": "T1", "language": "sv"}, "label": "L", "updated": "2024-01-02", "discontinued": False},
    "metadata": {"identity": {"provider_code": "demo", "dataset_code": "T1", "language": "sv"}, "id": ["Tid"],
                 "dimension": {"Tid": {"label": "tid", "category": {"index": {"2024": 0}, "label": {"2024": "2024"}}, "extension": {"elimination": False, "x": None}}},
                 "role": {"time": ["Tid"]}, "paths": [{"path": [{"code": "a", "label": "A"}]}],
                 "retrieval": {"type": "pxweb_v2", "config": {"data_url": "https://x.org/d"}}, "extension": {"kept": None, "deep": {"n": None}}}}


def test_pair_round_trip(spark):
    pair = stored.documents(spark.createDataFrame([(json.dumps(PAIR),)], "body string"))
    assert json.loads(documents.to_json_pair(pair).first().documents) == PAIR


def test_nested_documents(spark):
    dims, cats = dimensions.dimensions_v1(landed.metadata_v1(raw(spark, V1)))
    d = documents.nested_dimensions(dims, cats).first()
    assert d.id == ["Region", "ContentsCode", "Tid"] and (d.role.geo, d.role.time, d.role.metric) == (["Region"], ["Tid"], ["ContentsCode"])
    assert d.dimension["Region"].category["index"] == {"00": 0, "01": 1} and d.dimension["ContentsCode"].category.label == {"B1": "B1"}


def test_metadata_link(spark):
    links = json.dumps([{"rel": "data", "hreflang": "sv", "href": "d"}, {"rel": "metadata", "hreflang": "en", "href": "e"},
                        {"rel": "metadata", "hreflang": "sv", "href": ""}, {"rel": "metadata", "hreflang": "sv", "href": "m"}])
    url = documents.metadata_url(F.try_parse_json(F.lit(links)), F.lit("sv"), F.lit("own"))
    none = documents.metadata_url(F.lit(None).cast("variant"), F.lit("sv"), F.lit("own"))
    assert tuple(spark.range(1).select(url, none).first()) == ("m", "own")


def test_scopes(spark):
    registry = [
        {"code": "a", "label": {"sv": "A"}, "harvest": {"adapter": "pxweb_v1", "languages": ["sv", "en"], "rate_limit": 1.5,
                                                         "config": {"base_api_url": "https://a.org", "database_ids": ["d"], "extension": {"cell_limit": 10}}}},
        {"code": "k", "label": {"sv": "K"}, "harvest": {"adapter": "kolada", "languages": ["sv"], "rate_limit": 0.35, "config": {}}}, {"code": "n", "label": {"sv": "N"}}]
    rows = documents.scopes(stored.providers(spark.createDataFrame([(json.dumps(registry),)], "body string"))).collect()
    assert sorted((r.provider_code, r.language, r.base_api_url, r.cell_limit) for r in rows) == [
        ("a", "en", "https://a.org", 10), ("a", "sv", "https://a.org", 10), ("k", "sv", "https://api.kolada.se/v3", 5000)]


@pytest.mark.parametrize("ids,keys,found", [(["a", "b"], ["b", "a"], set()), ([], ["a"], {"empty", "mismatch"}), (["a", "a"], ["a"], {"duplicate"}),
                                            (["a"], ["b"], {"mismatch"}), (["a", " "], ["a", " "], {"blank"})])
def test_axes(spark, ids, keys, found):
    df = spark.createDataFrame([(1, ids, keys)], "k int, id array<string>, dimension_keys array<string>")
    assert {r.rule for r in quality.check_axes(df, ["k"]).collect()} == found


def test_edges(spark):
    axes = spark.createDataFrame([("D", {"P": ["a", "a", "x"], "a": ["a"], "Q": ["b"]})], "dataset_code string, child map<string,array<string>>")
    cats = spark.createDataFrame([("D", c) for c in ("P", "a", "b")], "dataset_code string, cat_id string")
    rows = quality.check_edges(dimensions.child_edges(axes), cats, ["dataset_code"]).collect()
    assert {(r.parent, r.child, r.rule) for r in rows} == {("P", "a", "duplicate"), ("P", "x", "unknown_child"), ("a", "a", "self"), ("Q", "b", "unknown_parent")}
