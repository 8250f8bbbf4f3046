"""Selection, state, sinks, streams and rules."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kartotek.operators import incremental, quality, sinks
from kartotek.session import fresh_dir
from kartotek.streaming import outcomes as streams

T = datetime(2026, 6, 1, 12)
STATE = "dataset_code string, source_updated_at timestamp, last_fetched_at timestamp, has_error boolean"
KEYS = ["dataset_code"]


@pytest.mark.parametrize(
    "updated,stored,fetched,error,force,expected",
    [(T, T, T, False, False, False), (T - timedelta(days=1), T, T, False, False, True), (T + timedelta(seconds=1), T, T, False, False, True),
     (None, T, T, False, False, True), (T, None, T, False, False, True), (None, None, T, False, False, True), (T, T, None, False, False, True),
     (T, T, T, True, False, True), (T, T, T, False, True, True)])
def test_select_by_timestamp(spark, updated, stored, fetched, error, force, expected):
    cands = spark.createDataFrame([("D", updated)], "dataset_code string, updated timestamp")
    state = spark.createDataFrame([("D", stored, fetched, error)], STATE)
    assert incremental.select_by_timestamp(cands, state, force, KEYS).first().should_fetch is expected


def test_unseen_is_fetched(spark):
    cands = spark.createDataFrame([("N", T)], "dataset_code string, updated timestamp")
    assert incremental.select_by_timestamp(cands, spark.createDataFrame([], STATE), keys=KEYS).first().should_fetch


START = datetime(2026, 9, 12, 10, 30)
OPEN = datetime(2026, 8, 13)


def window(spark, checkpoint, force=False):
    codes = ["SAME", "CHANGED", "NEW", "ERROR", "UNFETCHED", "OLD", "EDGE"]
    cands = spark.createDataFrame([(c, c, k, c + s) for c in codes for k, s in (("data", ""), ("oudata", "_OU"))],
                                  "label string, kpi_id string, kind string, dataset_code string")
    recent, stale = START - timedelta(days=1), START - timedelta(days=30)
    rows = [(c + s, None, None if c == "UNFETCHED" else stale - timedelta(microseconds=1) if c == "OLD" else stale if c == "EDGE" else recent, c == "ERROR")
            for c in codes if c != "NEW" for s in ("", "_OU")]
    feed = spark.createDataFrame([("CHANGED", "oudata")], "kpi_id string, kind string")
    picked = incremental.select_by_window(cands, spark.createDataFrame(rows, STATE), feed, F.lit(START), F.lit(checkpoint).cast("timestamp"), F.lit(force), KEYS)
    return {r.dataset_code for r in picked.filter("should_fetch").collect()}


def test_select_by_window(spark):
    due = {c + s for c in ("NEW", "ERROR", "UNFETCHED", "OLD") for s in ("", "_OU")} | {"CHANGED_OU"}
    assert window(spark, OPEN) == due
    assert len(window(spark, OPEN - timedelta(microseconds=1))) == 14
    assert len(window(spark, None)) == 14
    assert len(window(spark, OPEN, True)) == 14


@pytest.mark.parametrize("bounds", [None, [3, 8], [6]])
def test_bounded_attempts(spark, bounds):
    rows = spark.createDataFrame([("s", i, i >= 5) for i in range(15)], "scope string, pos int, should_fetch boolean").repartition(4)
    got = {r.pos: (r.attempt_no, r.deferred) for r in incremental.bounded(rows, ["scope"], ["pos"], 3, bounds).collect()}
    assert got == {i: (None, False) if i < 5 else (i - 4, i > 7) for i in range(15)}  # five free skips, then 5, 6 and 7
    assert not any(r.deferred for r in incremental.bounded(rows, ["scope"], ["pos"], None, bounds).collect())


def test_checkpoint(spark):
    rows = [("p", T, True, None, None), ("p", T + timedelta(days=1), True, 5, None), ("p", T + timedelta(days=2), True, None, "x"),
            ("p", T + timedelta(days=3), False, None, None), ("q", T, False, None, None)]
    runs = spark.createDataFrame(rows, "provider_code string, started_at timestamp, listing_complete boolean, limit_n int, error string")
    got = {r.provider_code: (r.checkpoint, r.clean_runs) for r in incremental.advance_checkpoint(runs, ["provider_code"]).collect()}
    assert got == {"p": (T, 1), "q": (None, 0)}


OUT = "dataset_code string, seq int, ts timestamp, outcome string, source_updated_at timestamp"


def events():
    stamp = [T + timedelta(hours=i) for i in range(6)]
    return [("S", 0, stamp[0], "saved", T), ("F", 1, stamp[1], "failed", None), ("K", 2, stamp[2], "skipped", None), ("SF", 3, stamp[3], "saved", T),
            ("SF", 4, stamp[4], "failed", None), ("S", 5, stamp[5], "saved", T - timedelta(days=9))]


def test_next_state(spark):
    old = spark.createDataFrame([("S", T, T, True), ("F", T, T, False), ("K", T, T, True), ("X", None, None, False)], STATE)
    rows = incremental.next_state(old, spark.createDataFrame(events(), OUT), KEYS, ["seq"]).collect()
    got = {r.dataset_code: (r.source_updated_at, r.last_fetched_at, r.has_error) for r in rows}
    assert got == {"S": (T - timedelta(days=9), T + timedelta(hours=5), False), "F": (T, T, True), "K": (T, T, True), "X": (None, None, False),
                   "SF": (T, T + timedelta(hours=3), True)}


def test_stream_equals_batch_whatever_the_files(spark, tmp_path):
    rows = events() * 2  # replays
    for i, row in enumerate(rows[::-1]):
        spark.createDataFrame([row], OUT).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(OUT).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    facts = str(tmp_path / "facts")
    for _ in range(2):  # a restart finds nothing new
        streams.finish(streams.stream_outcomes(source, facts, str(tmp_path / "cp"), KEYS, ["seq"]))
    wanted = incremental.next_state(spark.createDataFrame([], STATE), spark.createDataFrame(events(), OUT), KEYS, ["seq"])

    def plain(df):
        return sorted(map(tuple, df.select("dataset_code", "source_updated_at", "last_fetched_at", "has_error").collect()), key=str)

    assert plain(streams.stored_state(spark, facts, KEYS)) == plain(wanted)


def test_stream_takes_older_dates(spark, tmp_path):
    listing = "dataset_code string, updated timestamp"
    spark.createDataFrame([("A", T), ("A", T - timedelta(days=400)), ("B", T)], listing).write.parquet(str(tmp_path / "in"))
    state = spark.createDataFrame([("A", T, T, False)], STATE)
    source = spark.readStream.schema(listing).parquet(str(tmp_path / "in"))
    streams.finish(streams.stream_select(source, state, str(tmp_path / "out"), str(tmp_path / "cp"), KEYS))
    rows = streams.selected(spark, str(tmp_path / "out"), "dataset_code string, updated timestamp, should_fetch boolean").collect()
    got = {(r.dataset_code, r.updated): r.should_fetch for r in rows}
    assert got == {("A", T): False, ("A", T - timedelta(days=400)): True, ("B", T): True}


def test_outcomes_are_idempotent_per_run(spark):
    def run(run_id, errors):
        rows = [(run_id, "A", True, None, "{}"), (run_id, "B", True, errors, "{}"), (run_id, "C", False, None, None)]
        return spark.createDataFrame(rows, "run_id string, dataset_code string, should_fetch boolean, error string, documents string").withColumn(
            "source_updated_at", F.lit(T))

    path = fresh_dir(spark, "outcomes")
    sinks.write_outcomes(run("r1", "y" * 5000), path)
    sinks.write_outcomes(run("r2", None), path)
    sinks.write_outcomes(run("r1", "x" * 5000), path)
    rows = {(r.run_id, r.dataset_code): r for r in spark.read.parquet(path).collect()}
    assert len(rows) == 6 and rows["r1", "B"].error == "x" * 5000 and rows["r1", "B"].documents is None
    assert [rows["r2", d].outcome for d in "ABC"] == ["saved", "saved", "skipped"] and rows["r2", "C"].source_updated_at is None


def test_last_good_document(spark):
    schema = "dataset_code string, run_no int, document string"
    current = spark.createDataFrame([("A", 1, "old"), ("B", 1, "old")], schema)
    saved = spark.createDataFrame([("A", 2, "new"), ("C", 2, "first")], schema)
    once = sinks.upsert_documents(current, saved, KEYS)
    twice = sinks.upsert_documents(once, saved, KEYS)
    for df in (once, twice):
        assert {r.dataset_code: r.document for r in df.collect()} == {"A": "new", "B": "old", "C": "first"}


def test_import(spark):
    schema = "code string, label map<string,string>, rate double"
    old = spark.createDataFrame([("same", {"sv": "a", "en": "b"}, 1.0), ("other", {"sv": "a"}, 1.0), ("null", None, None)], schema)
    new = spark.createDataFrame([("same", {"en": "b", "sv": "a"}, 1.0), ("other", {"sv": "z"}, 1.0), ("new", {}, 1.0), ("null", None, None)], schema)
    got = {r.code: r.status for r in sinks.import_registry(new, old, "code", ["label", "rate"]).collect()}
    assert got == {"same": "unchanged", "other": "differences", "new": "imported", "null": "unchanged"}


def test_roles(spark):
    axes = spark.createDataFrame([("D", "a", 0), ("D", "b", 1)], "k string, dim_id string, pos int")

    def check(*roles):
        rows = spark.createDataFrame([("D", r, i, d) for i, (r, d) in enumerate(roles)], "k string, role string, role_pos int, dim_id string")
        return {r.rule for r in quality.check_roles(axes, rows, "k").collect()}

    assert check(("time", "a"), ("geo", "b")) == set()
    assert check(("time", "x")) == {"unknown_axis"}
    assert check(("time", "b"), ("time", "a")) == {"order"}
    assert check(("time", "a"), ("geo", "a")) == {"two_roles"}
    assert check(("time", "a"), ("time", "a")) == {"duplicate"}


@pytest.mark.parametrize("ordinals,rules", [([0, 1, 2], set()), ([1, 2], {"dense"}), ([0, 0, 1], {"duplicate", "dense"}), ([0, 2], {"dense"})])
def test_category_ordinals(spark, ordinals, rules):
    cats = spark.createDataFrame([("D", "d", f"c{i}", o, "l") for i, o in enumerate(ordinals)], "k string, dim_id string, cat_id string, ordinal int, label string")
    assert {r.rule for r in quality.check_categories(cats, ["k", "dim_id"]).collect()} == rules


def test_dataset_rules(spark):
    fields = "provider_code dataset_code language label updated time_unit first_period last_period source_url doc_url body".split()
    good = dict(zip(fields, ["demo", "T", "sv", "L", "2024-01-02T00:00:00Z", None, None, None, "https://x.org/a%20b", None, '{"label":"L"}']))

    def check(**change):
        row = {**good, **change}
        df = spark.createDataFrame([tuple(row[f] for f in fields)], ", ".join(f"{f} string" for f in fields))
        return {(r.rule, r.path) for r in quality.check_dataset(df, ["dataset_code"], "body").collect()}

    assert check() == set() and check(updated="2024-02-29") == set()
    assert check(language="fi") == {("enum", "identity/language")}
    assert check(body='{"database_id":1}') == {("unknown_field", "")}
    assert check(source_url="https://x.org/a b") == {("url", "source_url")}
    assert check(updated="2023-02-29") == {("date", "updated")} and check(updated="2024-01-02T00:00:00") == {("date", "updated")}
    assert check(label=" ", provider_code="Demo_") == {("blank", "label"), ("pattern", "identity/provider_code")}


def test_registry_rules(spark):
    from kartotek import schemas

    def check(code="demo", label={"sv": "A"}, languages=["sv"], adapter="kolada", rate=0.0, country="SE", website="https://x.org"):
        row = (code, label, None, country, website, (adapter, languages, rate))
        schema = schemas.PROVIDER[7:].split(",extension")[0] + ",harvest:struct<adapter:string,languages:array<string>,rate_limit:double>"
        return {r.path for r in quality.check_providers(spark.createDataFrame([row], schema), ["code"]).collect()}

    assert check() == set()
    assert check(code="X", label={}, languages=["en"], rate=-1.0, country="se", website="x") == {
        "code", "label", "harvest/languages", "harvest/rate_limit", "country_code", "website"}
    assert check(adapter="ftp") == {"harvest/adapter"} and check(languages=[]) == {"harvest/languages"}
