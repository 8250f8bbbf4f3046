"""Published runs, and plans of requests."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kartotek.operators import catalog, requests, runs
from kartotek.plans import harvest, q_runs
from kartotek.plans.harvest import Result, Run

START = datetime(2026, 9, 12, 10)
OUTCOME = "run_id string, provider_code string, dataset_code string, language string, outcome string, error string, source_updated_at timestamp"


def result(spark, run_id, day, *rows, error=None, limit=None):
    run = Run(run_id, "demo", "sv", START + timedelta(days=day), limit=limit)
    full = [(run_id, "demo", c, "sv", o, "e" if o == "failed" else None, START - timedelta(days=30 - day)) for c, o in rows]
    return Result(run, spark.createDataFrame(full, OUTCOME), error)


def read(spark, path):
    state = {r.dataset_code: (r.source_updated_at, r.last_fetched_at, r.has_error) for r in runs.state(spark, path).collect()}
    rows = sorted((r.run_id, r.dataset_code, r.outcome) for r in runs.outcomes(spark, path).collect())
    return state, rows


def test_a_refused_run_without_datasets_leaves_a_row(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.publish(result(spark, "r1", 0, ("A", "saved"), ("B", "failed"), ("C", "skipped")), path)
    runs.publish(result(spark, "r2", 1, error="listing/first page: not answered"), path)
    runs.publish(result(spark, "r3", 2, ("A", "failed"), ("C", "deferred"), limit=1), path)
    rows = {r.run_id: r for r in runs.manifest(spark, path).collect()}
    assert {k: (r.status, r.error, r.discovered, r.attempts, r.saved, r.failed, r.skipped, r.deferred) for k, r in rows.items()} == {
        "r1": ("complete", None, 3, 2, 1, 1, 1, 0), "r2": ("refused", "listing/first page: not answered", 0, 0, 0, 0, 0, 0),
        "r3": ("bounded", None, 2, 1, 0, 1, 0, 1)}
    assert [r.checkpoint for r in runs.checkpoints(spark, path).collect()] == [START]
    assert read(spark, path)[0] == {"A": (START - timedelta(days=30), START, True), "B": (None, None, True)}


def test_readers_see_whole_runs_only(spark, tmp_path):
    path = str(tmp_path / "runs")
    first, second = result(spark, "r1", 0, ("A", "saved")), result(spark, "r2", 1, ("A", "saved"), ("B", "failed"))
    runs.publish(first, path)
    before = read(spark, path)
    # a job that was killed: outcomes of an attempt, half of them, and no row
    second.outcomes.limit(1).drop("run_id").write.parquet(f"{path}/outcomes/run_id=r2/attempt=killed")
    assert read(spark, path) == before
    runs.publish(second, path)
    after = read(spark, path)
    assert after[1] == [("r1", "A", "saved"), ("r2", "A", "saved"), ("r2", "B", "failed")]
    runs.publish(second, path)  # once more: the same state, no row twice
    assert read(spark, path) == after and runs.manifest(spark, path).count() == 2


def test_a_refused_run_changes_no_state(spark, tmp_path):
    path = str(tmp_path / "runs")
    runs.publish(result(spark, "r1", 0, ("A", "saved")), path)
    before = read(spark, path)[0]
    runs.publish(result(spark, "r2", 1, ("A", "failed"), error="discovery/A: duplicate"), path)
    assert read(spark, path)[0] == before


@pytest.mark.parametrize("url, key", [
    ("https://a.org/kpi?page=2", "https://a.org/kpi"), ("https://a.org/x?page=2&from_date=1#f", "https://a.org/x?from_date=1"),
    ("https://a.org/x?from_date=1&page=12", "https://a.org/x?from_date=1"), ("https://a.org/x?subpage=1", "https://a.org/x?subpage=1"),
    ("https://a.org/x/?pageNumber=3&lang=sv", "https://a.org/x/?lang=sv"), ("https://a.org/x//", "https://a.org/x"), (None, None)])
def test_request_key(spark, url, key):
    df = spark.createDataFrame([(url,)], "u string")
    assert df.select(requests.request_key(F.col("u"))).first()[0] == key


def test_plan_of_values(spark):
    areas = spark.createDataFrame([(f"{i:04}", "K" if i < 30 else "L") for i in range(40)] + [("0000", "L")], "area_id string, type string")
    due = spark.createDataFrame([("N1", "N1", "data", "K"), ("N2", "N2", "data", "A"), ("N1", "N1_OU", "oudata", "K")],
                                "kpi_id string, dataset_code string, kind string, scope_type string")
    plan = requests.value_requests(due, areas, "https://k.org/v3/", 2026)
    sizes = {(r.feed, r.dataset_code): r["count"] for r in plan.groupBy("feed", "dataset_code").count().collect()}
    assert sizes == {("data", "N1"): 2 * 3, ("data", "N2"): 2 * 3, ("oudata", "N1_OU"): 60}
    urls = [r.url for r in plan.filter("dataset_code = 'N1'").collect()]
    assert len(set(urls)) == 6 and max(len(u.split("/municipality/")[1].split("/")[0].split(",")) for u in urls) == 25
    changes = requests.change_requests(areas, "https://k.org/v3", 2026, "2026-08-13")
    assert changes.count() == 2 * 2 and changes.filter("url like '%?from_date=2026-08-13'").count() == 4


def test_folders_that_are_asked_for(spark):
    entries = spark.createDataFrame(
        [("/", "A", "l"), ("/A", "B c", "l"), ("/X", "Y", "l"), ("/A", "T", "t"), ("/", "A", "l")], "parent_path string, id string, type string")
    got = {r.url for r in requests.folder_requests(entries, "https://h.org/Db/").collect()}
    assert got == {"https://h.org/Db", "https://h.org/Db/A", "https://h.org/Db/A/B%20c"}


def test_a_plan_is_spread_and_held_against_addresses_as_they_are(spark):
    """Few indicators become many requests, so they leave their split first; addresses are not made distinct in its task."""
    areas = spark.createDataFrame([("0001", "K")], "area_id string, type string")
    due = spark.range(8).coalesce(1).selectExpr("concat('N', id) AS kpi_id", "concat('N', id) AS dataset_code", "'data' AS kind", "'K' AS scope_type")
    asked = requests.value_requests(due, areas, "https://k.org", 2026)
    assert "RepartitionByExpression [kpi_id" in asked._jdf.queryExecution().optimizedPlan().toString()
    raw = spark.createDataFrame(
        [("data", "https://k.org/a?page=1"), ("data", "https://k.org/a?page=2"), ("kpi", None), ("ou", "")], "feed string, url string")
    plan = spark.createDataFrame(
        [("data", "https://k.org/a", "A", "a"), ("data", "https://k.org/b", "B", "b"), ("kpi", None, None, "k"), ("ou", None, None, "o"), ("changes", None, None, "c")], requests.PLAN)
    lacking = requests.missing(plan, raw)
    assert sorted(r.why for r in lacking.collect()) == ["b", "c"]
    text = lacking._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in text and text.count("Aggregate [") == 1  # only the feeds are made distinct


def test_landed_parts_are_spread_and_no_folder_body_grows(spark):
    """A folder is answered in pages of 100 tables; rows leave the split of a small file before they become bodies."""

    class T:
        part = spark.range(12_000).coalesce(1).selectExpr("id AS p_partkey", "'X' AS p_type", "1 AS p_size")

    bodies = q_runs.v1_landed(T, "https://h.org/Db").filter("feed = 'nav' AND status = 200 AND url LIKE '%/F1%'")
    sizes = [r.n for r in bodies.selectExpr("json_array_length(body) AS n").collect()]
    assert len(sizes) == 10 * 3 and max(sizes) == 100  # F1 and F10 to F18
    for raw in (q_runs.v1_landed(T, "https://h.org/Db"), q_runs.v2_landed(T)[0]):
        assert "RepartitionByExpression [p_partkey" in raw.filter("feed = 'metadata'")._jdf.queryExecution().optimizedPlan().toString()


def test_only_requests_with_more_pages_are_followed(spark, monkeypatch):
    page = '{"values":[{"a":1}]%s}'
    rows = [("data", f"https://k.org/data/{i}", page % "") for i in range(50)] + [
        ("kpi", "https://k.org/kpi?page=0", page % ',"next_url":"?page=1"'), ("kpi", "https://k.org/kpi?page=1", page % ""),
        ("ou", "https://k.org/ou?page=0", page % ',"next_url":"?page=1"'), ("oudata", "https://k.org/oudata/1", '{"values":1}')]
    raw = spark.createDataFrame([(f, u, b, 200, 1) for f, u, b in rows], "feed string, url string, body string, status int, page_no int")
    followed, whole = [], catalog.chain_status
    monkeypatch.setattr(catalog, "chain_status", lambda pages, *a: followed.append(pages.count()) or whole(pages, *a))
    got = sorted((r.rule, r.path) for r in harvest._broken_chains(raw).collect())
    assert got == [("incomplete", "ou"), ("unusable values", "oudata")]
    assert followed == [4]
