"""KPI catalogue, presence and probe plans."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kartotek.operators import dimensions, documents, incremental, kpi, presence
from kartotek.sources import kpi as source


def bodies(spark, rows):
    return spark.createDataFrame([(json.dumps(r),) for r in rows], "body string")


KPIS = [
    {"id": " N07 ", "title": "Bussresor per invånare ( - 2019)", "description": "\t Antal resor.\\nDelat  med  folkmängd. Källa: Trafikanalys. ",
     "operating_area": "Kollektivtrafik & färja", "perspective": "Volym", "auspice": "R", "has_ou_data": True, "is_divided_by_gender": 1,
     "municipality_type": "K", "publ_period": 2031},
    {"id": "N08", "title": "Gatubelysning (-2028)", "operating_area": "\t", "has_ou_data": 0},
    {"id": "\t", "title": "utan nummer"},
]
GROUPS = [
    {"id": "GR", "title": "Resor till arbetet", "members": [{"member_id": " N07 "}, {"member_id": "N07"}, {"member_id": "U99"}]},
    {"id": "GA", "title": "Gator", "members": [{"member_id": "N07"}]},
    {"id": "GA", "title": "Gator", "members": [{"member_id": "N07"}]},
]


def test_catalogue_fields(spark):
    rows = {r.kpi_id: r for r in source.kpis(bodies(spark, KPIS)).collect()}
    assert set(rows) == {"N07", "N08"}
    a, b = rows["N07"], rows["N08"]
    assert a.description == "Antal resor. Delat med folkmängd. Källa: Trafikanalys." and a.raw_description == KPIS[0]["description"]
    assert (a.scope_type, a.has_ou_data, a.is_divided_by_gender) == ("K", True, True)
    assert (b.scope_type, b.has_ou_data, b.operating_area, b.description, b.raw_description) == ("A", False, None, None, None)
    assert str(a.publ_period) == "2031"


def test_candidates(spark):
    kpis, groups = source.kpis(bodies(spark, KPIS)), source.kpi_groups(bodies(spark, GROUPS))
    rows = {r.dataset_code: r for r in kpi.candidates_kpi(kpi.with_groups(kpis, groups), 2026).collect()}
    assert set(rows) == {"N07", "N07_OU", "N08"}
    a = rows["N07"]
    assert (a.source, a.source_origin, a.discontinued, a.discontinued_year) == ("Trafikanalys", "description", True, 2019)
    assert a.subject_code == "kolada:operating_area:Kollektivtrafik%20%26%20f%C3%A4rja"
    assert [p[-1].label for p in a.paths] == ["Kollektivtrafik & färja", "Gator", "Resor till arbetet"]
    assert rows["N07_OU"].data_url.endswith("/oudata/kpi/N07") and rows["N08"].paths is None and rows["N08"].discontinued is False
    assert {(r.group_id, r.kpi_id) for r in kpi.unknown_members(groups, kpis).collect()} == {("GR", "U99")}
    later = {r.dataset_code: r for r in kpi.candidates_kpi(kpi.with_groups(kpis, groups), 2030).collect()}
    for code, row in rows.items():  # another year changes the retired flag only
        assert {k: v for k, v in row.asDict().items() if k not in ("discontinued", "extension")} == {
            k: v for k, v in later[code].asDict().items() if k not in ("discontinued", "extension")}


@pytest.mark.parametrize("raw,fault", [({"id": "G", "title": "Test", "members": "[]"}, "shape"), ({"id": "G", "title": "Test", "members": [{}]}, "member"),
                                       ({"id": "", "title": "Test", "members": []}, "id"), ({"id": "G", "title": "T", "members": []}, None)])
def test_malformed_groups(spark, raw, fault):
    assert source.kpi_groups(bodies(spark, [raw])).first().fault == fault


def test_conflicting_groups(spark):
    other = [{"id": "GA", "title": "Torg", "members": [{"member_id": "N07"}]}]
    assert kpi.conflicting_groups(source.kpi_groups(bodies(spark, GROUPS))).count() == 0
    assert [r.group_id for r in kpi.conflicting_groups(source.kpi_groups(bodies(spark, GROUPS + other))).collect()] == ["GA"]


def observation(area, values, period=2024, name="municipality"):
    return {"kpi": "N1", "period": period, name: area, "values": values}


def test_presence(spark):
    entries = [
        observation("0180", [{"gender": "K", "value": None}, {"gender": "M", "value": 1.5}]), observation("1280", [{"gender": "T", "value": 0}]),
        observation("0114", [{"gender": "T", "value": None}], 2023), observation("0115", [{"gender": "T", "value": 3, "isdeleted": True}], 2022),
        observation("0180", [{"gender": "T", "value": 3}], None), observation(None, [{"gender": "T", "value": 3}], 2021), observation("0999", None, 2020)]
    obs = source.observations(bodies(spark, [{"values": entries}]))
    sets = presence.presence_sets(presence.presence(obs)).first()
    assert (sets.periods, sets.entities) == (["2024"], ["0180", "1280"])
    assert tuple(presence.period_span(obs).first()) == ("N1", 2024, 2024)
    titles = spark.createDataFrame([("0180", "Stockholm")], "id string, title string")
    cats = presence.categories(presence.presence(obs), titles, ["0500"]).filter("dim_id = 'municipality'").orderBy("ordinal").collect()
    assert [(c.cat_id, c.ordinal, c.label) for c in cats] == [("0180", 0, "Stockholm"), ("1280", 1, "1280")]
    kpis = spark.createDataFrame([("N1",), ("N2",)], "kpi_id string")
    assert [r.kpi_id for r in presence.require_presence(kpis, presence.presence(obs)).collect()] == ["N2"]


def test_unit_observations(spark):
    obs = source.observations(bodies(spark, [{"values": [observation("V1", [{"value": 1}], 2020, "ou")]}]), "ou")
    assert obs.first().entity == "V1"


def test_probe_areas(spark):
    areas = spark.createDataFrame([("0000", "Riket", "L"), ("0180", "Sthlm", "K"), ("0001", "Region", "L")], "area_id string, title string, type string")
    kpis = spark.createDataFrame([("a", "A"), ("k", "K"), ("l", "L"), ("x", "X")], "kpi_id string, scope_type string")
    got = {(r.kpi_id, r.area_id) for r in kpi.probe_areas(kpis, areas).collect()}
    assert got == {("a", "0000"), ("a", "0180"), ("a", "0001"), ("k", "0180"), ("k", "0000"), ("l", "0000"), ("l", "0001")}
    assert [r.kpi_id for r in kpi.unknown_scopes(kpis).collect()] == ["x"]
    no_total = areas.filter("area_id <> '0000'")
    assert {r.area_id for r in kpi.probe_areas(kpis.filter("kpi_id = 'k'"), no_total).collect()} == {"0180"}


def test_probe_batches(spark):
    areas = spark.createDataFrame([(f"{i:04d}",) for i in range(30)], "area_id string")
    rows = kpi.probe_batches(areas, 2015, 2024).collect()
    assert sorted((len(r.area_ids), len(r.years)) for r in rows) == [(5, 10), (25, 10)]
    assert kpi.probe_batches(areas, 2024, 2015).count() == 0
    many = spark.createDataFrame([(f"{i:04d}",) for i in range(312)], "area_id string")
    assert kpi.probe_batches(many, 2010, 2029, bounds=["0100", "0222"]).count() == 13
    assert kpi.probe_batches(many, 2010, 2036).count() == 26
    assert kpi.probe_batches(many, 1970, 2029).count() == 39


def test_unit_without_owner(spark):
    ids = spark.createDataFrame([("V1",), ("V2",), ("V3",)], "ou_id string")
    units = spark.createDataFrame([("V1", "t", "0180"), ("V2", "t", "9999")], "ou_id string, title string, area_id string")
    areas = spark.createDataFrame([("0180", "Stockholm", "K")], "area_id string, title string, type string")
    assert {r.ou_id: (r.area_id, r.area_label) for r in kpi.unit_area(ids, units, areas).collect()} == {
        "V1": ("0180", "Stockholm"), "V2": ("9999", "9999"), "V3": ("", "")}


def test_rebuild_keeps_only_current_categories(spark):
    old = [("N1", 2020, "a", "T", 1.0, False), ("N2", 2020, "a", "T", 1.0, False), ("N3", 2020, "a", "T", 1.0, False)]
    new = [("N1", 2024, "b", "T", 1.0, False), ("N2", 2024, "b", "T", 1.0, True), ("N3", 2024, "b", "T", 1.0, False)]
    schema = "kpi string, period int, entity string, gender string, value double, isdeleted boolean"
    stored = presence.presence(spark.createDataFrame(old, schema))
    keys = spark.createDataFrame([("N1",), ("N2",)], "kpi string")
    rows = incremental.rebuild(stored, spark.createDataFrame(new, schema), keys).filter("dim_id = 'year'").collect()
    assert {(r.kpi, r.cat_id) for r in rows} == {("N1", "2024"), ("N2", "2020"), ("N3", "2020")}


def test_change_feed(spark):
    raw = spark.createDataFrame([(datetime(2026, 1, 1), '{"kpi":"N1"}'), (datetime(2026, 2, 1), '{"kpi":"N2"}'), (datetime(2026, 2, 1), '{"kpi":"N2"}'),
                                 (datetime(2026, 2, 1), '{"kpi":5}')], "changed_at timestamp, body string")
    assert [r.kpi for r in source.change_feed(raw, "2026-01-15").collect()] == ["N2"]
    assert source.change_feed_faults(raw).count() == 1


def test_areas_and_units(spark):
    got = source.areas(bodies(spark, [{"id": " 1 ", "title": None, "type": " K "}, {"id": ""}])).collect()
    assert [tuple(r) for r in got] == [("1", "1", "K")]
    got = source.units(bodies(spark, [{"id": "V", "municipality": "1"}, {"id": "W", "municipality": " "}])).collect()
    assert [tuple(r) for r in got] == [("V", "V", "1")]


def test_gender_only_when_split(spark):
    rows = dimensions.gender_dimension(source.kpis(bodies(spark, KPIS))).orderBy("ordinal").collect()
    assert [(r.kpi_id, r.cat_id, r.label) for r in rows] == [("N07", "K", "Kvinnor"), ("N07", "M", "Män"), ("N07", "T", "Totalt")]


def test_retrieval(spark):
    row = spark.range(1).select(documents.retrieval(F.lit("kolada"), F.lit("https://x.org")).alias("k"),
                                documents.retrieval(F.lit("pxweb_v1"), F.lit("https://x.org/å")).alias("p")).first()
    assert row.k.config.data_url is None and row.p.config.data_url == "https://x.org/%C3%A5"
