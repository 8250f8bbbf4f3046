"""Whole runs on landed responses."""

import json
from datetime import datetime, timedelta

import pytest
from kartotek import schemas
from kartotek.plans import harvest

START = datetime(2026, 9, 12, 10)
API1, WEB1 = "https://h.org/api/v1/sv/Db", "https://h.org/pxweb/sv/Db/"


def land(spark, rows):
    full = [("s", f, u, 200, START, p, b if isinstance(b, str) else json.dumps(b)) for f, u, p, b in rows]
    return spark.createDataFrame(full, schemas.RAW_RESPONSE)


def outcomes(df):
    return {r.dataset_code: r for r in df.collect()}


def state(spark, *rows):
    return spark.createDataFrame([("demo", c, "sv", u, f, e) for c, u, f, e in rows], schemas.STATE)


def test_tables_v2(spark):
    tables = [{"id": "T1", "label": "Ett", "updated": "2024-01-02", "firstPeriod": "2024", "timeUnit": "Annual", "paths": [["A", "B"]],
               "links": [{"rel": "metadata", "hreflang": "sv", "href": "https://x.org/å"}]},
              {"id": "T2", "updated": "2024-01-02"}, {"id": "T3", "updated": "2024-01-02"}, {"id": "T4", "updated": None}, {"id": "T5", "updated": "2020-01-01"}]
    good = {"id": ["Tid"], "role": {"time": ["Tid"]}, "note": "N", "dimension": {"Tid": {"category": {"index": ["2024"], "unit": {"2024": {"label": "kg"}}}}},
            "extension": {"px": {"subject-area": "Area", "official-statistics": "yes"}, "contact": "call"}}
    bad = {**good, "id": ["Tid", "Tid"]}
    raw = land(spark, [("listing", "l", 1, {"tables": tables, "page": {"pageNumber": 1, "totalPages": 1}}),
                       ("metadata", "https://a.org/tables/T1/metadata?lang=sv", 1, good), ("metadata", "https://a.org/tables/T2/metadata?lang=sv", 1, bad)])
    known = state(spark, ("T3", datetime(2024, 1, 2), START, False), ("T5", datetime(2024, 1, 1), START, False))
    run = harvest.Run("r1", "demo", "sv", START)
    got = outcomes(harvest.tables_v2(raw, known, run, "https://a.org", "https://w.org"))
    assert {c: r.outcome for c, r in got.items()} == {"T1": "saved", "T2": "failed", "T3": "skipped", "T4": "failed", "T5": "failed"}
    assert got["T2"].error == "id: duplicate" and got["T4"].error == "no usable metadata landed"
    doc = json.loads(got["T1"].documents)
    assert doc["dataset"] == {"identity": {"provider_code": "demo", "dataset_code": "T1", "language": "sv"}, "label": "Ett",
                              "updated": "2024-01-02T00:00:00Z", "time_unit": "Annual", "first_period": "2024", "source_url": "https://w.org/sv/table/T1"}
    meta = doc["metadata"]
    assert (meta["id"], meta["role"], meta["note"], meta["official_statistics"]) == (["Tid"], {"time": ["Tid"]}, ["N"], True)
    assert meta["dimension"]["Tid"]["category"] == {"index": {"2024": 0}, "label": {"2024": "2024"}, "unit": {"2024": {"label": "kg"}}}
    assert meta["metadata_url"] == "https://x.org/%C3%A5" and meta["subject"] == {"label": "Area"} and meta["contact"][0]["raw"] == "call"
    assert [n["code"] for n in meta["paths"][0]["path"]] == ["A", "B"] and "contact" not in meta["extension"]
    few = outcomes(harvest.tables_v2(raw, known, harvest.Run("r1", "demo", "sv", START, limit=2), "https://a.org", "https://w.org"))
    assert {c: (r.outcome, r.attempt_no) for c, r in few.items()} == {
        "T1": ("saved", 1), "T2": ("failed", 2), "T3": ("skipped", None), "T4": ("deferred", 3), "T5": ("deferred", 4)}


PAGE = """<ul><li class="AspNet-TreeView-Root">Db<ul><li class="AspNet-TreeView-Parent">BE. Befolkning<ul>
<li class="AspNet-TreeView-Leaf"><a href="/pxweb/sv/Db/Db__BE/T1.px/">Tabell ett</a></li>
<li class="AspNet-TreeView-Leaf"><a href="/pxweb/sv/Db/Db__BE/T2.px/">Tabell två</a></li>
<li class="AspNet-TreeView-Leaf"><a href="/pxweb/sv/Other/Other__BE/T9.px/">Annan</a></li></ul></li></ul></li></ul>"""
META = {"title": "Titel", "variables": [{"code": "Region", "text": "region", "values": ["0", "1", "2"], "valueTexts": ["A", "B", "C"]},
                                        {"code": "Tid", "text": "år", "values": ["0", "1"], "valueTexts": ["2023", "2024"], "time": True}]}
SAMPLE = {"class": "dataset", "version": "2.0", "id": ["Tid", "Region", "ContentsCode"], "size": [2, 2, 1], "source": "SCB", "note": ["n"],
          "dimension": {"Region": {"category": {"index": {"0": 0, "1": 1}, "note": {"0": ["x"]}}, "extension": {"show": "v"}},
                        "Tid": {"category": {"index": ["0", "1"]}}, "ContentsCode": {"category": {"index": ["EliminatedValue"]}}},
          "extension": {"px": {"heading": ["Tid"], "description": "Om", "subject-code": "BE", "official-statistics": True}}}


@pytest.mark.parametrize("with_web", [True, False])
def test_tables_v1(spark, with_web):
    address = f"{API1}/Db/BE/T1.px" if with_web else f"{API1}/BE/T1.px"
    rows = [("flat", API1, 1, [{"id": "T1.px", "path": "Db/ BE /", "title": "Ett", "published": "2024-01-02T00:00:00"},
                               {"id": "stale.px", "path": "/x", "published": "2024-01-02"}]),
            ("nav", API1, 1, [{"id": "BE", "text": "BE. Folk", "type": "l"}]),
            ("nav", API1 + "/BE", 1, [{"id": "T1.px", "text": "Ett", "type": "t", "updated": "2024-01-02"}, {"id": "T3.px", "text": "Tre", "type": "t", "updated": "x"}]),
            ("nav", API1 + "/Db/BE", 1, [{"id": "T2.px", "text": "Två", "type": "t", "updated": "2024-05-05"}]),
            ("metadata", address, 1, META), ("sample", address, 1, SAMPLE)]
    raw = land(spark, rows + ([("web", WEB1, 1, PAGE)] if with_web else []))
    got = outcomes(harvest.tables_v1(raw, state(spark), harvest.Run("r", "demo", "sv", START), API1, WEB1 if with_web else None))
    assert {c: r.outcome for c, r in got.items()} == ({"T1.px": "saved", "T2.px": "failed"} if with_web else {"T1.px": "saved"})
    doc = json.loads(got["T1.px"].documents)
    data, meta = doc["dataset"], doc["metadata"]
    assert (data["label"], data["first_period"], data["last_period"], data["time_unit"], data["description"]) == ("Titel", "2023", "2024", "Annual", "Om")
    assert meta["id"] == ["Region", "Tid"] and meta["role"] == {"time": ["Tid"], "geo": ["Region"]} and meta["source"] == "SCB" and meta["note"] == ["n"]
    region = meta["dimension"]["Region"]
    assert region["category"] == {"index": {"0": 0, "1": 1, "2": 2}, "label": {"0": "A", "1": "B", "2": "C"}, "note": {"0": ["x"]}}
    assert region["extension"] == {"show": "v", "position": 0, "elimination": False}
    assert meta["subject"]["code"] == "BE" and meta["metadata_url"] == address and "heading" not in meta["extension"]["px"]
    labels = [[n["label"] for n in p["path"]] for p in meta["paths"]]
    assert labels == ([["Db", "Befolkning"]] if with_web else [["Folk"]])


def envelope(*values):
    return {"values": list(values), "next_url": None}


def kpi_rows(period, deleted=False):
    value = [{"gender": "T", "value": 1.0, "isdeleted": deleted}]
    return [("kpi", "k", 1, envelope({"id": "N1", "title": "Ett", "has_ou_data": 1, "is_divided_by_gender": 1, "municipality_type": "K"}, {"id": "N2", "title": "Två"})),
            ("kpi_groups", "g", 1, envelope({"id": "G", "title": "Grupp", "members": [{"member_id": "N1"}, {"member_id": "Z"}]})),
            ("municipality", "m", 1, envelope({"id": "0180", "title": "Stockholm", "type": "K"})),
            ("ou", "o", 1, envelope({"id": "V1", "title": "Skola", "municipality": "0180"})),
            ("data", "d", 1, envelope({"kpi": "N1", "period": period, "municipality": "0180", "values": value})),
            ("oudata", "d", 1, envelope({"kpi": "N1", "period": period, "ou": "V1", "values": value})),
            ("changes", "https://x/data/municipality/1", 1, envelope()), ("changes", "https://x/oudata/municipality/1", 1, envelope({"kpi": "N1"}))]


def test_kpis(spark):
    run = harvest.Run("r", "demo", "sv", START)
    got = outcomes(harvest.kpis(land(spark, kpi_rows(2024)), state(spark), run))
    assert {c: r.outcome for c, r in got.items()} == {"N1": "saved", "N1_OU": "saved", "N2": "failed"}
    assert got["N2"].error == "dimension: no live values"
    area, unit = (json.loads(got[c].documents) for c in ("N1", "N1_OU"))
    assert area["metadata"]["id"] == ["municipality", "year", "gender"] and area["metadata"]["role"] == {"time": ["year"], "geo": ["municipality"]}
    assert (area["dataset"]["first_period"], area["dataset"]["last_period"], area["dataset"]["time_unit"]) == ("2024", "2024", "Annual")
    assert area["metadata"]["dimension"]["gender"]["category"]["label"] == {"K": "Kvinnor", "M": "Män", "T": "Totalt"}
    assert area["metadata"]["retrieval"] == {"type": "kolada", "config": {}}
    assert [p["path"][-1]["label"] for p in area["metadata"]["paths"]] == ["Grupp"]
    ou = unit["metadata"]["dimension"]["ou"]
    assert ou["label"] == "Enhet" and ou["extension"] == {"elimination": False, "category": {"V1": {"municipality_id": "0180", "municipality_label": "Stockholm"}}}
    recent = state(spark, *[(c, None, START - timedelta(days=1), False) for c in ("N1", "N1_OU", "N2")])
    later = harvest.Run("r2", "demo", "sv", START, checkpoint=START - timedelta(days=2))
    again = outcomes(harvest.kpis(land(spark, kpi_rows(2025, True)), recent, later))
    assert {c: r.outcome for c, r in again.items()} == {"N1": "skipped", "N1_OU": "failed", "N2": "skipped"}


GOOD = {"id": ["Tid"], "role": {"time": ["Tid"]}, "dimension": {"Tid": {"category": {"index": ["2024"]}}}}


def v2_run(spark, tables, bodies, listing_status=200, total=1):
    rows = [("s", "listing", "l", listing_status, START, 1, json.dumps({"tables": tables, "page": {"pageNumber": 1, "totalPages": total}}))]
    rows += [("s", "metadata", f"https://a.org/tables/{c}/metadata?lang=sv", status, START, 1, json.dumps(body)) for c, status, body in bodies]
    raw = spark.createDataFrame(rows, schemas.RAW_RESPONSE)
    return outcomes(harvest.tables_v2(raw, state(spark), harvest.Run("r", "demo", "sv", START), "https://a.org"))


def table(code):
    return {"id": code, "updated": "2024-01-02"}


def test_a_run_is_refused_for_what_its_listing_lacks(spark):
    whole = [("A", 200, GOOD), ("B", 200, GOOD)]
    got = v2_run(spark, [table("A"), table("A"), table("B")], whole + whole[:1])
    assert {c: (r.outcome, r.error) for c, r in got.items()} == dict.fromkeys("AB", ("failed", "discovery/A: duplicate"))
    got = v2_run(spark, [table("A")], whole, total=3)
    assert {c: (r.outcome, r.error) for c, r in got.items()} == {"A": ("failed", "listing: incomplete")}
    assert v2_run(spark, [table("A")], whole, listing_status=500) == {}


def test_document_rules_fail_their_dataset(spark):
    def with_category(**category):
        return {**GOOD, "dimension": {"Tid": {"category": {"index": ["2024"], **category}}}}

    bodies = {
        "OK": (200, GOOD), "ERR": (503, GOOD), "DEC": (200, with_category(unit={"2024": {"decimals": -1}})),
        "LON": (200, with_category(coordinates={"2024": [999.0, 1.0]})), "ROLE": (200, {**GOOD, "role": {"time": ["Nope"]}}),
        "KEY": (200, with_category(coordinates={"1999": [1.0, 1.0]})),
        "NEST": (200, {**GOOD, "dimension": {"Tid": {"category": {"index": ["2024"]}, "extension": {"extension": {"x": 1}}}}}),
    }
    got = v2_run(spark, [table(c) for c in bodies], [(c, *b) for c, b in bodies.items()])
    assert {c: r.error for c, r in got.items()} == {
        "OK": None, "ERR": "metadata/503: response", "DEC": "unit/decimals: range", "LON": "coordinates/lon: range",
        "ROLE": "role: unknown_axis", "KEY": "category: unknown_category", "NEST": "extension/extension: nested"}


@pytest.mark.parametrize("change, error", [
    (("kpi", "k", 1, envelope({"id": "N1", "title": "Ett"}, {"id": "N1", "title": "Ett"})), "discovery/N1: duplicate"),
    (("kpi", "k", 1, {"values": [{"id": "N1", "title": "Ett"}], "next_url": "?page=2"}), "kpi: incomplete"),
    (("kpi", "k", 1, {"values": [{"id": "N1", "title": "Ett"}, "x"], "next_url": None}), "kpi: unusable values"),
    (("kpi", "k", 1, envelope({"id": "N1", "title": "Ett", "municipality_type": "Q"})), "kpi/N1: enum"),
    (("changes", "https://x/data/municipality/1", 1, envelope({"kpi": " "})), "changes/kpi: blank"),
    (("kpi_groups", "g", 1, envelope({"id": "G", "title": "A", "members": []}, {"id": "G", "title": "B", "members": []})), "kpi_groups/G: conflict"),
])
def test_a_kpi_run_is_refused(spark, change, error):
    rows = [r for r in kpi_rows(2024) if r[0] != change[0]] + [change]
    got = outcomes(harvest.kpis(land(spark, rows), state(spark), harvest.Run("r", "demo", "sv", START)))
    assert {(r.outcome, r.error) for r in got.values()} in ({("failed", error)}, set())
    assert got or error == "kpi: unusable values"


def test_a_v2_run_without_listing_is_refused(spark):
    raw = land(spark, [("metadata", "https://a.org/tables/A/metadata?lang=sv", 1, GOOD)])
    got = harvest.run_tables_v2(raw, state(spark), harvest.Run("r", "demo", "sv", START), "https://a.org")
    assert got.error == "listing/first page: not answered" and got.outcomes.collect() == []


@pytest.mark.parametrize("gone, error", [
    ("kpi", "kpi/catalogue: not answered"), ("kpi_groups", "kpi_groups/catalogue: not answered"), ("municipality", "municipality/catalogue: not answered"),
    ("ou", "ou/catalogue: not answered"), ("changes", "changes/feed: not answered")])
def test_a_kpi_run_without_a_feed_is_refused(spark, gone, error):
    raw = land(spark, [r for r in kpi_rows(2024) if r[0] != gone])
    recent = state(spark, *[(c, None, START - timedelta(days=1), False) for c in ("N1", "N1_OU", "N2")])
    got = harvest.run_kpis(raw, recent, harvest.Run("r", "demo", "sv", START, checkpoint=START - timedelta(days=2)))
    assert got.error == error
    assert {(r.outcome, r.error) for r in got.outcomes.collect() if r.outcome != "skipped"} <= {("failed", error)}


def planned_rows(without=()):
    """Every request of an incremental run over two areas, answered; ``without``: addresses left out."""
    value = [{"gender": "T", "value": 1.0, "isdeleted": False}]
    years = [list(range(a, min(a + 25, 2030))) for a in range(1970, 2030, 25)]
    feeds = [list(range(2010, 2030))]
    text = lambda ys: ",".join(map(str, ys))
    rows = [r for r in kpi_rows(2024) if r[0] in ("kpi", "kpi_groups", "municipality", "ou")]
    rows = [r for r in rows if r[0] != "municipality"] + [("municipality", "m", 1, envelope({"id": "0114", "title": "B", "type": "K"}, {"id": "0180", "title": "A", "type": "K"}))]
    for kind in ("data", "oudata"):
        for ys in feeds:
            rows.append(("changes", f"https://k.org/v3/{kind}/municipality/0114,0180/year/{text(ys)}?from_date=2026-08-13", 1, envelope()))
    for ident in ("N1", "N2"):
        for ys in years:
            entry = {"kpi": ident, "period": ys[0], "municipality": "0180", "values": value}
            rows.append(("data", f"https://k.org/v3/data/kpi/{ident}/municipality/0114,0180/year/{text(ys)}?page=1", 1, envelope(entry)))
    for y in range(1970, 2030):
        rows.append(("oudata", f"https://k.org/v3/oudata/kpi/N1/year/{y}", 1, envelope({"kpi": "N1", "period": y, "ou": "V1", "values": value})))
    return [r for r in rows if not any(w in r[1] for w in without)]


@pytest.mark.parametrize("without, error, failed", [
    ((), None, {}),
    (("/oudata/municipality/",), "changes/oudata/0/0: not answered", {}),
    (("/kpi/N2/municipality/0114,0180/year/1995",), None, {"N2": "data/N2/0/1: not answered"}),
    (("/oudata/kpi/N1/year/2011",), None, {"N1_OU": "oudata/N1/2011: not answered"})])
def test_a_kpi_run_against_its_request_plan(spark, without, error, failed):
    run = harvest.Run("r", "demo", "sv", START, checkpoint=START - timedelta(days=2))
    got = harvest.run_kpis(land(spark, planned_rows(without)), state(spark), run, "https://k.org/v3/")
    found = outcomes(got.outcomes)
    assert got.error == error
    if error is None:
        assert {c: r.error for c, r in found.items() if r.outcome == "failed"} == failed
        assert {c for c, r in found.items() if r.outcome == "saved"} == {"N1", "N1_OU", "N2"} - failed.keys()
    else:
        assert {r.error for r in found.values()} == {error}


@pytest.mark.parametrize("change, error, faults", [
    ([], None, {}),
    ([("nav", API1 + "/BE")], "nav//BE: not answered", {}),
    ([("nav", API1)], "nav//: not answered", None),
    ([("metadata", None)], None, {"T1.px": "metadata/T1.px: not answered"})])
def test_a_v1_walk_against_its_request_plan(spark, change, error, faults):
    rows = [("nav", API1, 1, [{"id": "BE", "text": "Folk", "type": "l"}, {"id": "T0.px", "text": "Noll", "type": "t", "updated": "2024-01-02"}]),
            ("nav", API1 + "/BE/", 1, [{"id": "T1.px", "text": "Ett", "type": "t", "updated": "2024-01-02"}]),
            ("metadata", API1 + "/T0.px", 1, META), ("sample", API1 + "/T0.px", 1, SAMPLE),
            ("metadata", API1 + "/BE/T1.px", 1, META), ("sample", API1 + "/BE/T1.px", 1, SAMPLE)]
    for feed, address in change:
        rows = [r for r in rows if not (r[0] == feed and (r[1].rstrip("/") == address or (address is None and "T1" in r[1])))]
    got = harvest.run_tables_v1(land(spark, rows), state(spark), harvest.Run("r", "demo", "sv", START), API1)
    assert got.error == error
    found = outcomes(got.outcomes)
    if faults is None:
        assert found == {}
    elif error is None:
        assert {c: r.error for c, r in found.items() if r.error} == faults and found["T0.px"].outcome == "saved"
    else:
        assert {r.error for r in found.values()} == {error}


def test_v1_answers_with_an_error_name_their_status(spark):
    rows = [("nav", API1, 200, [{"id": c, "text": c, "type": "t", "updated": "2024-01-02"} for c in ("A.px", "B.px", "C.px")]),
            ("metadata", API1 + "/A.px", 503, {}), ("metadata", API1 + "/B.px", 200, META), ("sample", API1 + "/B.px", 404, {}),
            ("metadata", API1 + "/C.px", 200, META), ("sample", API1 + "/C.px", 200, {**SAMPLE, "dimension": {
                **SAMPLE["dimension"], "Region": {"category": {"index": {"0": 0, "1": 1}, "unit": {"0": {"decimals": -2}}}}}})]
    raw = spark.createDataFrame([("s", f, u, code, START, 1, json.dumps(b)) for f, u, code, b in rows], schemas.RAW_RESPONSE)
    got = outcomes(harvest.tables_v1(raw, state(spark), harvest.Run("r", "demo", "sv", START), API1))
    assert {c: r.error for c, r in got.items()} == {
        "A.px": "metadata/503: response", "B.px": "sample/404: response", "C.px": "unit/decimals: range"}
