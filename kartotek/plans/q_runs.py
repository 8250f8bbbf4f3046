"""Whole runs over responses landed from whole tables, with faults in them."""

from __future__ import annotations

from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek.operators import kpi, requests, runs
from kartotek.plans import harvest
from kartotek.plans.bindings import Tables, code, div
from kartotek.plans.oracle import KPI_ID, TABLE_ID
from kartotek.plans.registry import query
from kartotek.session import fresh_dir, spread

START = datetime(2026, 9, 12, 10)


def landed_rows(df, feed: str, url, body, status=None, page=None):
    status, page = F.lit(200) if status is None else status, F.lit(1) if page is None else page
    return df.select(
        F.lit("s").alias("scope"), F.lit(feed).alias("feed"), url.alias("url"), status.cast("int").alias("status"),
        F.lit(START).cast("timestamp").alias("fetched_at"), page.cast("int").alias("page_no"), body.alias("body"))


@query("run_tables_v2", sql=f"""
SELECT {TABLE_ID} AS dataset_code, CASE WHEN p_partkey % 7 = 0 THEN 'skipped' WHEN error IS NULL THEN 'saved' ELSE 'failed' END AS outcome,
       CASE WHEN p_partkey % 7 <> 0 THEN error END AS error
FROM (SELECT p_partkey, CASE WHEN p_partkey % 13 = 0 THEN 'no usable metadata landed' WHEN p_partkey % 17 = 0 THEN 'metadata/503: response'
             WHEN p_partkey % 11 = 9 THEN 'dimension: mismatch' WHEN p_partkey % 11 = 7 THEN 'role: unknown_axis'
             WHEN p_partkey % 11 = 3 THEN 'unit/decimals: range' WHEN p_partkey % 11 = 5 THEN 'coordinates/lon: range' END AS error FROM part)""")
def run_tables_v2(t: Tables):
    """Parts as tables of one scope: listing pages, metadata with faults, some gaps, some known."""
    raw, known = v2_landed(t)
    return harvest.tables_v2(raw, known, harvest.Run("r", "demo", "sv", START), "https://a.org").select("dataset_code", "outcome", "error")


def v2_landed(t: Tables):
    """The landed responses and the stored state of run_tables_v2."""
    k, ident = F.col("p_partkey"), code("T", "p_partkey")
    parts = spread(t.part.select("p_partkey", "p_type", "p_size"), "p_partkey").withColumns({"ident": ident, "block": div("p_partkey", 100)})
    entry = F.struct(F.col("ident").alias("id"), F.col("p_type").alias("label"), F.lit("2024-01-02").alias("updated"))
    total = parts.select("block").distinct().count()
    numbered = parts.groupBy("block").agg(F.array_sort(F.collect_list(entry)).alias("tables"))
    page = F.struct((F.col("block") + 1).alias("pageNumber"), F.lit(total).alias("totalPages"))
    listing = landed_rows(
        numbered, "listing", F.lit("https://a.org/tables"), F.to_json(F.struct("tables", page.alias("page"))), page=F.col("block"))
    fault = k % 11
    unit = F.when(fault == 3, ',"unit":{"x":{"decimals":-1}}').otherwise(',"unit":{"x":{"decimals":1}}')
    place = F.when(fault == 5, ',"coordinates":{"x":[999.0,1.0]}').otherwise(',"coordinates":{"x":[9.0,1.0]}')
    body = F.concat(
        F.lit('{"id":'), F.when(fault == 9, '["Typ","Typ"]').otherwise('["Typ","Tid"]'),
        F.lit(',"role":{"time":["Tid"]'), F.when(fault == 7, ',"metric":["Nope"]').otherwise(""),
        F.lit('},"dimension":{"Typ":{"category":{"index":["x"]'), unit, place,
        F.lit('}},"Tid":{"category":{"index":["'), (k % 60 + 1960).cast("string"), F.lit('"]}}}}'))
    metadata = landed_rows(
        parts, "metadata", F.concat(F.when(k % 13 == 0, "https://a.org/other/").otherwise("https://a.org/tables/"), "ident", F.lit("/metadata?lang=sv")), body,
        F.when(k % 17 == 0, 503).otherwise(200))
    known = parts.filter(k % 7 == 0).select(
        F.lit("demo").alias("provider_code"), F.col("ident").alias("dataset_code"), F.lit("sv").alias("language"),
        F.lit(datetime(2024, 1, 2)).cast("timestamp").alias("source_updated_at"), F.lit(START).cast("timestamp").alias("last_fetched_at"),
        F.lit(False).alias("has_error"))
    return listing.unionByName(metadata), known


@query("run_kpis", sql=f"""
SELECT {KPI_ID} || k.suffix AS dataset_code, CASE WHEN o.p IS NULL THEN 'failed' ELSE 'saved' END AS outcome,
       CASE WHEN o.p IS NULL THEN 'dimension: no live values' END AS error
FROM part JOIN (VALUES (''), ('_OU')) k(suffix) ON k.suffix = '' OR p_partkey % 4 = 0
LEFT JOIN (SELECT DISTINCT l_partkey AS p FROM lineitem WHERE l_linestatus = 'O' AND l_partkey % 3 <> 0) o ON o.p = p_partkey AND k.suffix = ''""")
def run_kpis(t: Tables):
    """Parts as KPIs and lines as observations; two in three KPIs have values where lines are open."""
    k = F.col("p_partkey")
    spans = t.part.select("p_partkey", "p_type", div("p_partkey", 100).alias("block"))
    last = spans.agg(F.max("block")).first()[0]
    entry = F.struct(code("N", "p_partkey").alias("id"), F.concat(F.lit("KPI "), "p_type").alias("title"),
                     (k % 4 == 0).cast("int").alias("has_ou_data"), F.lit("K").alias("municipality_type"))
    pages = spans.groupBy("block").agg(F.array_sort(F.collect_list(entry)).alias("values"))
    link = F.when(F.col("block") < last, F.concat(F.lit("?page="), (F.col("block") + 1).cast("string")))
    envelope = F.to_json(F.struct("values", link.alias("next_url")))
    listed = landed_rows(pages, "kpi", F.concat(F.lit("https://k.org/kpi?page="), F.col("block").cast("string")), envelope, page=F.col("block"))
    value = F.struct(F.lit("T").alias("gender"), F.when(F.col("l_linestatus") == "O", F.col("l_quantity")).alias("value"), F.lit(False).alias("isdeleted"))
    line = F.struct(
        F.when(F.col("l_partkey") % 3 == 0, code("Z", "l_partkey")).otherwise(code("N", "l_partkey")).alias("kpi"),
        F.year("l_shipdate").alias("period"), F.lit("0180").alias("municipality"), F.array(value).alias("values"))
    at = F.concat(F.lit("https://k.org/data/"), F.col("l_orderkey").cast("string"), F.lit("/"), F.col("l_linenumber").cast("string"))
    seen = landed_rows(t.lineitem, "data", at, F.to_json(F.struct(F.array(line).alias("values"))))
    areas = landed_rows(
        t.region.agg(F.count("*")), "municipality", F.lit("https://k.org/municipality"),
        F.lit('{"values":[{"id":"0180","title":"Stad","type":"K"}]}'))
    group = F.struct(F.col("r_name").alias("id"), F.col("r_name").alias("title"), F.array(F.struct(code("N", "r_regionkey").alias("member_id"))).alias("members"))
    groups = landed_rows(
        t.region.agg(F.to_json(F.struct(F.collect_list(group).alias("values"))).alias("b")), "kpi_groups", F.lit("https://k.org/kpi_groups"), F.col("b"))
    units = landed_rows(t.region.agg(F.count("*")), "ou", F.lit("https://k.org/ou"), F.lit('{"values":[]}'))
    raw = reduce(DataFrame.unionByName, [listed, seen, areas, groups, units])
    return harvest.kpis(raw, t.spark.createDataFrame([], harvest.schemas.STATE),
                        harvest.Run("r", "demo", "sv", START)).select("dataset_code", "outcome", "error")


@query("run_tables_v1", sql=f"""
WITH p AS (SELECT p_partkey AS k, p_partkey % 50 AS f, {TABLE_ID} AS id FROM part)
SELECT id AS dataset_code, CASE WHEN e IS NULL THEN 'saved' ELSE 'failed' END AS outcome, e AS error FROM (
  SELECT id, CASE WHEN k % 13 = 0 THEN 'metadata/' || id || ': not answered' WHEN k % 17 = 0 THEN 'metadata/503: response'
                  WHEN k % 11 = 3 THEN 'sample/404: response' WHEN k % 11 = 5 THEN 'unit/decimals: range' END AS e
  FROM p WHERE f % 10 <> 9)""")
def run_tables_v1(t: Tables):
    """Parts as tables in fifty folders; every tenth folder answers 404, so its tables are never seen."""
    api = "https://h.org/api/v1/sv/Db"
    return harvest.tables_v1(
        v1_landed(t, api), t.spark.createDataFrame([], harvest.schemas.STATE), harvest.Run("r", "demo", "sv", START), api).select(
        "dataset_code", "outcome", "error")


def v1_landed(t: Tables, api: str):
    """The landed responses of run_tables_v1."""
    k = F.col("p_partkey")
    ident, folder = code("T", "p_partkey"), F.concat(F.lit("F"), (k % 50).cast("string"))
    at = F.concat(F.lit(f"{api}/"), folder)
    entry = F.struct(ident.alias("id"), F.col("p_type").alias("text"), F.lit("t").alias("type"), F.lit("2024-01-02").alias("updated"))
    table = F.to_json(F.array_sort(F.collect_list(entry)))
    parts = spread(t.part.select("p_partkey", "p_type"), "p_partkey")
    # A folder is answered in pages of a fixed span of keys: no body grows with the data.
    below = parts.groupBy(folder.alias("folder"), div("p_partkey", 5000).alias("block")).agg(table.alias("b")).select(
        "folder", "b", F.concat(F.lit(f"{api}/"), "folder", F.lit("?page="), F.col("block").cast("string")).alias("u"))
    listed = F.struct(F.col("folder").alias("id"), F.col("folder").alias("text"), F.lit("l").alias("type"))
    root = below.select("folder").distinct().agg(F.to_json(F.array_sort(F.collect_list(listed))).alias("b"))
    gone = F.col("folder").endswith("9")
    fault = k % 11
    meta = F.concat(F.lit('{"title":"'), F.col("p_type"), F.lit('","variables":[{"code":"Typ","text":"typ","values":["x","y"],"valueTexts":["X","Y"]},'
                    '{"code":"Tid","text":"tid","values":["0"],"valueTexts":["'), (k % 60 + 1960).cast("string"), F.lit('"],"time":true}]}'))
    unit = F.when(fault == 5, ',"unit":{"x":{"decimals":-1}}').otherwise(',"unit":{"x":{"decimals":1}}')
    sample = F.concat(F.lit('{"class":"dataset","version":"2.0","id":["Typ","Tid"],"size":[2,1],"dimension":{"Typ":{"category":{"index":["x","y"]'), unit,
                      F.lit('}},"Tid":{"category":{"index":["0"]}}}}'))
    address = F.concat(F.when(k % 13 == 0, F.lit("https://h.org/other/")).otherwise(F.concat(at, F.lit("/"))), ident)
    return reduce(DataFrame.unionByName, [
        landed_rows(root, "nav", F.lit(api), F.col("b")),
        landed_rows(below, "nav", F.col("u"), F.when(gone, "{}").otherwise(F.col("b")), F.when(gone, 404).otherwise(200)),
        landed_rows(parts, "metadata", address, meta, F.when(k % 17 == 0, 503).otherwise(200)),
        landed_rows(parts, "sample", address, sample, F.when(fault == 3, 404).otherwise(200))])


@query("run_record", sql=f"""
WITH o AS (SELECT CASE WHEN p_partkey % 7 = 0 THEN 'skipped' WHEN p_partkey % 13 = 0 OR p_partkey % 17 = 0 OR p_partkey % 11 IN (3, 5, 7, 9) THEN 'failed' ELSE 'saved' END AS k FROM part)
SELECT 'whole' AS run_id, 'complete' AS status, NULL AS error, count(*) AS discovered, count(*) FILTER (k = 'saved') AS saved,
       count(*) FILTER (k = 'failed') AS failed, count(*) FILTER (k = 'skipped') AS skipped, 0::BIGINT AS deferred, true AS moves FROM o
UNION ALL SELECT 'no listing', 'refused', 'listing/first page: not answered', 0, 0, 0, 0, 0, false FROM (SELECT count(*) FROM part)""")
def run_record(t: Tables):
    """One whole run and one whose listing never landed, published and read back with the checkpoint."""
    raw, known = v2_landed(t)
    folder = fresh_dir(t.spark, "runs")
    for run_id, landed in (("whole", raw), ("no listing", raw.filter("feed <> 'listing'"))):
        started = START if run_id == "whole" else datetime(2026, 9, 13, 10)
        runs.publish(harvest.run_tables_v2(landed, known, harvest.Run(run_id, "demo", "sv", started), "https://a.org"), folder)
    last = runs.checkpoints(t.spark, folder).select("provider_code", "language", "checkpoint")
    return runs.manifest(t.spark, folder).join(last, ["provider_code", "language"]).select(
        "run_id", "status", "error", "discovered", "saved", "failed", "skipped", "deferred", (F.col("started_at") == F.col("checkpoint")).alias("moves"))


@query("jon_request_plan", sql=f"""
WITH area AS (SELECT lpad(n_nationkey::varchar, 4, '0') AS a, n_regionkey < 3 AS k FROM nation),
scoped AS (SELECT 'A' AS s, a FROM area UNION ALL SELECT 'K', a FROM area WHERE k UNION ALL SELECT 'L', a FROM area WHERE NOT k),
batch AS (SELECT s, (row_number() OVER (PARTITION BY s ORDER BY a) - 1) // 25 AS b FROM scoped),
asked AS (
  SELECT {KPI_ID} AS code, 'data' AS feed, {KPI_ID} || '/' || b || '/' || y AS why, p_partkey AS p, b = 0 AND y = 1 AS second
  FROM part JOIN (SELECT DISTINCT s, b FROM batch) ON s = ['A', 'K', 'L'][p_partkey % 3 + 1], range(3) y(y)
  UNION ALL
  SELECT {KPI_ID} || '_OU', 'oudata', {KPI_ID} || '/' || y, p_partkey, y = 2001 FROM part, range(1970, 2030) y(y) WHERE p_partkey % 4 = 0
)
SELECT code AS dataset_code, 'not answered' AS rule, min(feed || '/' || why) AS path FROM asked WHERE p % 5 = 0 AND second GROUP BY code""")
def jon_request_plan(t: Tables):
    """Every request for the values of parts as indicators; of every fifth one, one request has no answer."""
    k = F.col("p_partkey")
    ident, scope = code("N", "p_partkey"), F.element_at(F.array(*map(F.lit, "AKL")), (k % 3 + 1).cast("int"))
    both = t.part.select(ident.alias("kpi_id"), scope.alias("scope_type"), (k % 4 == 0).alias("has_ou_data"))
    areas = t.nation.select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("area_id"), F.when(F.col("n_regionkey") < 3, "K").otherwise("L").alias("type"))
    plan = requests.value_requests(kpi.kpi_kinds(both), areas, "https://k.org/v3", 2026)
    part = F.expr("cast(substring(dataset_code, 2, 9) as bigint)")
    second = F.col("why").endswith("/0/1") | ((F.col("feed") == "oudata") & F.col("why").endswith("/2001"))
    # A lost answer stands at another address.
    landed = plan.select("feed", F.when((part % 5 == 0) & second, "https://k.org/lost").otherwise(F.concat("url", F.lit("?page=2"))).alias("url"))
    return requests.dataset_faults(requests.missing(plan, landed))
