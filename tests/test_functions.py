"""Case lists for the column functions. Expected values are data, one row per case."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from kartotek import functions as fn


def one(spark, column, **values):
    cols = [F.lit(v).cast("string").alias(k) if v is None else F.lit(v).alias(k)
            for k, v in values.items()]
    return spark.range(1).select(*cols).select(column.alias("x")).first()["x"]


def column(spark, column, rows, names):
    schema = ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r["x"] for r in df.select("i", column.alias("x")).orderBy("i").collect()]


def test_source_clause(spark):
    cases = [
        ("Källa: Fiskeverket. Nytt upplägg i år.", "Båtar", "Fiskeverket", "description"),
        ("Källa. Vägmuseet.", "Båtar", "Vägmuseet", "description"),
        ("Källa: Ettan. Källa: Tvåan.", "Båtar", "Tvåan", "description"),
        ("Källor: Tullen och Lotsen.", "Båtar", "Tullen och Lotsen", "description"),
        ("Källa: Hamnen, bl.a. kajerna. Resten kom senare.", "Båtar", "Hamnen, bl.a. kajerna", "description"),
        ("Källa: B. Berg, t.ex. enkäten.", "Båtar", "B. Berg, t.ex. enkäten", "description"),
        ("Källa: www.hamn.example. Sätt.", "Båtar", "www.hamn.example", "description"),
        (None, "Vatten ur bergkällor", "Kolada", "fallback"),
        ("Utan uppgift", "Prov Källa: Tullen.", "Tullen", "title"),
        ("Källa:", "Prov Källa: Tullen.", "Tullen", "title"),
        ("Källa: Lotsen", "Prov Källa: Tullen", "Lotsen", "description"),
        ("Rad.\\nKälla: Hamnens Båtregister\\n", "B", "Hamnens Båtregister", "description"),
        ("Källa: Hamnens loggbok (-2019), Tullen (2020-). Läs försiktigt.", "B",
         "Hamnens loggbok (-2019), Tullen (2020-)", "description"),
        ("Dag: 3 maj. Källa. Tullen.", "B", "Tullen", "description"),
        ("Is. Källa: Isbrytarnas dagbok", "B Källa: Annat.", "Isbrytarnas dagbok", "description"),
    ]
    got = column(spark, fn.source_clause(F.col("d"), F.col("t")),
                 [c[:2] for c in cases], ["d", "t"])
    assert [(r["source"], r["origin"]) for r in got] == [c[2:] for c in cases]


def test_parse_ts(spark):
    cases = {
        "2024-01-02T03:04:05Z": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02T03:04:05+02:00": datetime(2024, 1, 2, 1, 4, 5),
        "2024-01-02T03:04:05": datetime(2024, 1, 2, 3, 4, 5),
        "2024-01-02 03:04": datetime(2024, 1, 2, 3, 4),
        "2024-01-02T03:04:05.1234567": datetime(2024, 1, 2, 3, 4, 5, 123456),
        "2024-01-02": datetime(2024, 1, 2),
        "20260912": datetime(2026, 9, 12),
        "2026-W37-6": datetime(2026, 9, 12),
        " 2024-02-29 ": datetime(2024, 2, 29),
        "2023-02-29": None,
        "2026": None,
        "2026-09": None,
        "12:00": None,
        "": None,
        "not a date": None,
        "2025-W53-1": None,
    }
    got = column(spark, fn.parse_ts(F.col("c")).cast("timestamp_ntz"),
                 [(k,) for k in cases], ["c"])
    assert dict(zip(cases, got)) == cases


@pytest.mark.parametrize(
    "first,last,unit",
    [
        ("2020", "2024", "Annual"), ("2020K1", "2024Q4", "Quarterly"),
        ("2020M01", "2024M12", "Monthly"), ("2020W01", "2024W53", "Weekly"),
        ("2020V01", "2024V02", "Other"), ("2020", "2024M01", "Other"), (None, "2024", "Other"),
    ],
)
def test_time_unit(spark, first, last, unit):
    assert one(spark, fn.time_unit(F.col("a"), F.col("b")), a=first, b=last) == unit


@pytest.mark.parametrize(
    "title,year", [("Vägar (-2019)", 2019), ("Vägar, km (  - 2031 )", 2031), ("Broar (2003-)", None),
                   ("Broar", None)],
)
def test_retired_year(spark, title, year):
    assert one(spark, fn.retired_year(F.col("t")), t=title) == year


def test_bool_and_note(spark):
    values = ["true", "1", "0", '"yes"', '"No"', '"unknown"', "2", "null", "1.5"]
    got = column(spark, fn.coerce_bool_variant(F.try_parse_json("c")), [(v,) for v in values],
                 ["c"])
    assert got == [True, True, False, True, False, None, True, None, None]
    notes = ["null", '"  note "', '[" a ", "", 3]', '""', '[" "]', "3"]
    got = column(spark, fn.normalize_note(F.try_parse_json("c")), [(v,) for v in notes], ["c"])
    assert got == [None, ["note"], ["a", "3"], None, None, None]


def test_text(spark):
    assert one(spark, fn.normalize_text(F.col("c")),
               c="  Text.\\nMetod. \t Källa: SCB.  ") == "Text. Metod. Källa: SCB."
    got = column(spark, fn.normalize_id(F.col("c")),
                 [("Örebro-län",), ("ø/Å",), ("straße",), ("a%20b",)], ["c"])
    assert got == ["orebrolan", "øa", "strasse", "ab"]
    cases = [("BE – Befolkning", "BE", "Befolkning"), ("be: x", "BE", "x"), ("BE.", "BE", "BE"),
             ("Befolkning", "BE", "Befolkning"), ("A.B- c", "A.B", "c"), ("", "Z", "Z")]
    got = column(spark, fn.strip_id_prefix(F.col("n"), F.col("k")), [c[:2] for c in cases],
                 ["n", "k"])
    assert got == [c[2] for c in cases]


def test_urls(spark):
    assert one(spark, fn.encoded_url(F.col("u")),
               u="https://hamn.example/Ö kaj/%20?q=ett två") == (
        "https://hamn.example/%C3%96%20kaj/%20?q=ett%20tv%C3%A5")
    assert one(spark, fn.pct_encode(F.col("u")), u="Å b/~*+") == "%C3%85%20b%2F~%2A%2B"
    assert one(spark, fn.encode_segment(F.col("u")), u="table%201.px") == "table%201.px"
    assert one(spark, fn.pct_decode(F.col("u")), u="a+b%20%zz%") == "a+b %zz%"
    base = "https://h.org/a/b/c?q=1"
    joins = {"?page=2": "https://h.org/a/b/c?page=2", "/x": "https://h.org/x",
             "d": "https://h.org/a/b/d", "../d/": "https://h.org/a/d/",
             "//o.org/z": "https://o.org/z", "http://z.org/q#f": "http://z.org/q#f",
             "./": "https://h.org/a/b/", "#t": "https://h.org/a/b/c?q=1#t"}
    got = column(spark, fn.url_join(F.lit(base), F.col("u")), [(k,) for k in joins], ["u"])
    assert dict(zip(joins, got)) == joins


def test_languages_and_paths(spark):
    api = {"https://x.org/PXWeb/api/v1/en/db": "en", "https://x.org/api/v2/en": None,
           "https://x.org/api/v1": None}
    got = column(spark, fn.api_language(F.col("u")), [(k,) for k in api], ["u"])
    assert dict(zip(api, got)) == api
    web = {"https://x.org/PxWeb/pxweb/en/db/": "en", "https://x.org/pxweb/fi/db": "fi",
           "https://x.org/pxweb": None}
    got = column(spark, fn.web_language(F.col("u")), [(k,) for k in web], ["u"])
    assert dict(zip(web, got)) == web
    assert one(spark, fn.path_tokens(F.col("p")), p="demo / pop%20x /") == ["demo", "pop x"]
    r = one(spark, fn.ids_from_href(F.col("p"), F.lit(2)), p="/pxweb/en/ROT/ROT__F__F2/F21/")
    assert (r["table_id"], r["category_ids"]) == ("F21", ["F", "F2"])
    assert one(spark, fn.ids_from_href(F.col("p"), F.lit(9)), p="/a/b/") is None


def _paths(spark, value):
    got = one(spark, fn.normalize_paths(F.col("p")), p=json.dumps(value))
    return got if got is None else [[(n["code"], n["label"]) for n in p] for p in got]


def test_path_shapes(spark):
    ab = [("A", "Aa"), ("B", "Bb")]
    nodes = [{"id": "A", "label": "Aa"}, {"code": "B", "label": "Bb"}]
    assert _paths(spark, {"paths": [{"path": nodes}, nodes]}) == [ab, ab]
    assert _paths(spark, {"path": nodes}) == [ab]
    assert _paths(spark, [{"path": nodes}]) == [ab]
    assert _paths(spark, [nodes, ["C"]]) == [ab, [("C", "C")]]
    assert _paths(spark, nodes) == [ab]
    assert _paths(spark, {"id": "A", "label": "Aa"}) == [[("A", "Aa")]]
    assert _paths(spark, {"B": "Bb", "A": {"title": "Aa"}}) == [[("B", "Bb"), ("A", "Aa")]]
    assert _paths(spark, "Households") == [[("Households", "Households")]]
    assert _paths(spark, ["Households", " "]) == [[("Households", "Households")]]
    assert _paths(spark, None) is None
    assert _paths(spark, []) is None


def test_contacts_and_extras(spark):
    got = one(spark, fn.normalize_contact(F.try_parse_json("c")),
              c=json.dumps(["free text", {"name": "N", "mail": "m", "fax": 5}]))
    assert [(c["name"], c["mail"], c["raw"]) for c in got] == [
        ("N", "m", None), (None, None, "free text")]
    assert list(got[0]["extension"]) == ["fax"]
    assert one(spark, fn.normalize_contact(F.try_parse_json("c")), c='"x"')[0]["raw"] == "x"
    assert one(spark, fn.normalize_contact(F.try_parse_json("c")), c="null") is None
    r = one(spark, fn.split_extras(fn.as_map(F.try_parse_json("c")), ("label",)),
            c=json.dumps({"label": "L", "x": 1, "extension": {"x": 2, "y": 3}, "z": None}))
    assert list(r["fields"]) == ["label"]
    assert sorted(r["extension"]) == ["x", "y"] and r["conflicts"] == ["x"]


def test_roles(spark):
    cases = [("Tid", "x", "time"), ("Kön", "Region", "geo"), ("ContentsCode", "tid", "metric"),
             ("x", "y", None)]
    got = column(spark, fn.detect_role(F.col("c"), F.col("l"), F.lit(False)),
                 [c[:2] for c in cases], ["c", "l"])
    assert got == [c[2] for c in cases]
    r = one(spark, fn.normalize_role(F.try_parse_json("c")),
            c='{"time":[" Tid ",""],"geo":["R","Tid"],"metric":"x"}')
    assert (r["time"], r["geo"], r["metric"]) == (["Tid"], ["R", "Tid"], None)


def test_year_range(spark):
    assert one(spark, fn.year_range(F.lit(1970), F.lit(1969))) == []
    assert one(spark, fn.year_range(F.lit(1970), F.lit(1972))) == [1970, 1971, 1972]
