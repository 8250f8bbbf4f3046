"""Readers and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators import sinks
from kartotek.plans.bindings import Tables, code, iso, text_of
from kartotek.plans.oracle import (
    AREAS, AXES, FLAT, GROUPS, KPIS, NAV, OBS, ORDER_ID, OUTCOMES, UNITS,
)
from kartotek.plans.registry import query
from kartotek.session import fresh_dir
from kartotek.sources import html, kpi, landed, stored


def text_in(v, key):
    return fn.text_at(F.col(v), f"$.{key}")


@query("src_listing_pages", sql=f"""
SELECT (o_orderkey // 10000)::varchar AS scope, ((o_orderkey // 1000) % 10 + 1)::bigint AS page_no,
       (row_number() OVER (PARTITION BY o_orderkey // 1000 ORDER BY o_orderkey) - 1)::bigint AS item_pos,
       CASE WHEN o_orderkey % 101 = 0 THEN ' ' ELSE ' ' || {ORDER_ID} END AS id, o_orderpriority AS subject
FROM orders WHERE NOT ((o_orderkey // 10000) % 4 = 2 AND (o_orderkey // 1000) % 10 = 7)""")
def src_listing_pages(t: Tables):
    return landed.listing_v2(t.listing_bodies).select(
        "scope", F.col("page_no").cast("bigint"), F.col("item_pos").cast("bigint"),
        F.get_json_object("entry", "$.id").alias("id"), F.get_json_object("entry", "$.subjectCode").alias("subject"))


@query("src_paged_values", sql="""
SELECT conv_id::varchar AS feed, turn::bigint AS page_no, v.pos AS item_pos,
       CASE WHEN v.pos = 0 THEN role ELSE 'end' END AS role, (CASE WHEN v.pos = 0 THEN length(text) ELSE 0 END)::bigint AS n
FROM conversations, (VALUES (0::bigint), (1::bigint)) v(pos) WHERE NOT (conv_id % 5 = 1 AND turn = 1)""")
def src_paged_values(t: Tables):
    return landed.paged_values(t.chain).select(
        "feed", F.col("page_no").cast("bigint"), F.col("item_pos").cast("bigint"),
        text_in("value", "role").alias("role"),
        F.try_variant_get("value", "$.n", "bigint").alias("n"))


@query("src_flat_catalog", FLAT, sql="""
SELECT id, path_key, title, '2020-01-01T00:00:00' AS published, updated, 1.0::double AS score FROM flat""")
def src_flat_catalog(t: Tables):
    entry = F.struct("id", "path", "title", "published", "updated", "score")
    bodies = (t.flat.groupBy("page_no")
              .agg(F.transform(F.array_sort(F.collect_list(F.struct("item_pos", entry.alias("e")))),
                               lambda x: x["e"]).alias("es"))
              .select(F.lit("demo/sv").alias("scope"), "page_no", F.to_json("es").alias("body")))
    return landed.flat_catalog(bodies).select(
        "id", fn.path_string(fn.path_tokens(F.col("path"))).alias("path_key"),
        "title", "published", "updated", "score")


@query("src_nav_entries", NAV, sql="""
SELECT '/' AS parent_path, 'R' || r_regionkey AS id,
       'R' || r_regionkey || ' – ' || upper(r_name[1]) || lower(r_name[2:]) AS text, 'l' AS type, NULL AS updated FROM region
WHERE r_name NOT LIKE '% %'
UNION ALL SELECT '/', 'R' || r_regionkey, 'R' || r_regionkey || ' – Middle East', 'l', NULL FROM region WHERE r_name LIKE '% %'
UNION ALL SELECT '/R' || n_regionkey, k || n_nationkey, k || n_nationkey || '. ' || n_name, 'l', NULL
FROM (SELECT *, CASE WHEN n_nationkey % 8 = 7 THEN 'Q' ELSE 'N' END AS k FROM nation)
UNION ALL SELECT path, CASE WHEN v.copy = 1 THEN upper(id) ELSE id END,
       CASE WHEN c_custkey % 9 <> 0 THEN c_name END, 't', '2024-01-01T00:00:00Z'
FROM nav_customer, (VALUES (0), (1)) v(copy) WHERE v.copy = 0 OR c_custkey % 10 = 0""")
def src_nav_entries(t: Tables):
    return landed.nav_entries(t.nav_bodies).select("parent_path", "id", "text", "type", "updated")


@query("src_html_tree", sql=r"""
SELECT url, (a.pos - 1)::bigint AS item_pos, a.href AS table_id, 'nav' AS category, 'Start' AS category_name, a.title
FROM (SELECT url, unnest(regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a>', 1)) AS href,
             unnest(regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a>', 2)) AS title,
             generate_subscripts(regexp_extract_all(html, '<li><a href="/([^"]*)">([^<]*)</a>', 1), 1) AS pos FROM pages) a""")
def src_html_tree(t: Tables):
    marked = F.regexp_replace(
        F.regexp_replace("html", '<li><a href="/', '<li class="x AspNet-TreeView-Leaf"><a href="/db__nav/'),
        "<nav><ul>", '<nav><ul><li class="AspNet-TreeView-Root"> Start<ul>')
    found = html.web_catalog(t.pages.select("url", marked.alias("html")))
    return found.select(
        "url", F.col("item_pos").cast("bigint"), "table_id",
        F.element_at("category_ids", 1).alias("category"),
        F.element_at("category_names", 1).alias("category_name"), "title")


@query("src_variables", AXES, sql="""
SELECT DISTINCT dataset_code, 'Titel ' || dataset_code AS title, pos AS var_pos, dim_id AS code, n AS n_values FROM axis_rows""")
def src_variables(t: Tables):
    return landed.metadata_v1(t.v1_bodies).select(
        "dataset_code", "title", F.col("var_pos").cast("bigint"), text_in("variable", "code").alias("code"),
        F.size(F.try_variant_get("variable", "$.values", "array<variant>")).cast("bigint").alias("n_values"))


@query("src_metadata_v2", AXES, sql="""
SELECT DISTINCT dataset_code, 'Typ,ContentsCode,Tid' AS axis_ids, 'ContentsCode,Tid,Typ' AS dimension_keys,
       ' Payload ' AS note, 'Area ' || block AS subject FROM axis_rows""")
def src_metadata_v2(t: Tables):
    p = F.col("payload")
    return landed.metadata_v2(t.v2_bodies).select(
        "dataset_code", F.array_join(p["id"], ",").alias("axis_ids"),
        F.array_join(F.array_sort(F.map_keys(p["dimension"])), ",").alias("dimension_keys"), fn.text_at(p["note"], "$").alias("note"),
        fn.text_at(p["extension"], "$.px['subject-area']").alias("subject"))


@query("src_sample", AXES, sql="""
SELECT dataset_code, string_agg(least(n, 2)::varchar, ',' ORDER BY pos) AS sizes, 'ok' AS status
FROM (SELECT DISTINCT dataset_code, block, pos, n FROM axis_rows) WHERE block % 5 <> 4 GROUP BY dataset_code
UNION ALL SELECT DISTINCT dataset_code, NULL, 'not a JSON-stat2 dataset' FROM axis_rows WHERE block % 5 = 4""")
def src_sample(t: Tables):
    good = landed.sample_v1(t.sample_bodies).select(
        "dataset_code", F.array_join(F.col("sample")["size"].cast("array<string>"), ",").alias("sizes"),
        F.lit("ok").alias("status"))
    bad = landed.sample_rejects(t.sample_bodies).select(
        "dataset_code", F.lit(None).cast("string").alias("sizes"), F.col("reason").alias("status"))
    return good.unionByName(bad)


@query("src_observations", OBS, sql="""
SELECT kpi, period, entity, o.gender, value, isdeleted FROM obs o
UNION ALL SELECT kpi, period, entity, 'T', NULL, NULL FROM obs""")
def src_observations(t: Tables):
    return kpi.observations(t.observation_bodies).withColumn("period", F.col("period").cast("bigint"))


@query("src_kpis", KPIS, sql="""
SELECT kpi_id, title, description, is_divided_by_gender, scope_type, has_ou_data, operating_area,
       CASE WHEN p_size % 3 <> 0 THEN 'Resurser' END AS perspective, 'T' AS auspice, p_size::varchar AS publ_period,
       CASE WHEN p_partkey % 5 = 1 THEN '  Räknat per\\nkilometer.   Källa: Trafikverket, bl.a. VTI. Se ovan.  ' END AS raw_description
FROM kpis""".replace("\\\\", "\\"))
def src_kpis(t: Tables):
    return kpi.kpis(t.kpi_bodies).select(
        "kpi_id", "title", "description", "is_divided_by_gender", "scope_type", "has_ou_data", "operating_area",
        "perspective", "auspice", F.col("publ_period").try_cast("string").alias("publ_period"), "raw_description")


@query("src_groups", GROUPS, sql="""
SELECT group_id, title, string_agg(kpi_id, ',' ORDER BY kpi_id) AS member_ids FROM members GROUP BY group_id, title""")
def src_groups(t: Tables):
    return kpi.kpi_groups(t.group_bodies).filter("fault is null").select(
        "group_id", "title", F.array_join("member_ids", ",").alias("member_ids"))


@query("src_areas", AREAS, sql="SELECT * FROM areas")
def src_areas(t: Tables):
    return kpi.areas(t.area_bodies)


@query("src_units", UNITS, sql="SELECT * FROM units")
def src_units(t: Tables):
    return kpi.units(t.unit_bodies)


@query("src_state", sql=f"""
SELECT {ORDER_ID} AS dataset_code, CASE WHEN o_orderkey % 19 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS source_updated_at,
       strftime(o_orderdate - INTERVAL 2 HOUR, '%Y-%m-%d %H:%M:%S') AS last_fetched_at, o_orderstatus = 'F' AS has_error
FROM orders""")
def src_state(t: Tables):
    date = F.col("o_orderdate")
    rows = t.orders.select(
        F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), F.lit("sv").alias("language"),
        F.when(F.col("o_orderkey") % 19 != 0, iso(date)).otherwise("").alias("source_updated_at"),
        F.date_format(date, "yyyy-MM-dd'T'HH:mm:ss.SSS'+02:00'").alias("last_fetched_at"),
        F.when(F.col("o_orderstatus") == "F", True).alias("has_error"))
    return stored.harvest_state(rows).select(
        "dataset_code", text_of(F.col("source_updated_at")).alias("source_updated_at"),
        text_of(F.col("last_fetched_at")).alias("last_fetched_at"), "has_error")


def registry(t: Tables):
    """One provider object per supplier."""
    s = F.col("s_suppkey")
    adapter = F.when(s % 3 == 0, "pxweb_v1").when(s % 3 == 1, "pxweb_v2").otherwise("kolada")
    obj = F.struct(
        code("p", "s_suppkey").alias("code"),
        F.create_map(F.lit("sv"), F.col("s_name"), F.lit("en"), F.concat(F.lit("The "), "s_name")).alias("label"),
        F.lit("SE").alias("country_code"),
        F.when(s % 10 != 9, F.struct(
            adapter.alias("adapter"),
            F.when(adapter == "kolada", F.array(F.lit("sv"))).otherwise(F.array(F.lit("sv"), F.lit("en"))).alias("languages"),
            (s % 7 / 10).alias("rate_limit"),
            F.struct(
                F.when(adapter != "kolada", F.concat(F.lit("https://api.example.org/"), s.cast("string"))).alias("base_api_url"),
                F.when(adapter == "pxweb_v1", F.array(F.lit("db"))).alias("database_ids"),
                F.struct(F.when(s % 4 == 0, s.cast("int") + 1).alias("cell_limit")).alias("extension"),
            ).alias("config"))).alias("harvest"))
    return t.supplier.select(F.to_json(F.array(obj)).alias("body"))


@query("src_registry", sql="""
SELECT 'p' || lpad(s_suppkey::varchar, 9, '0') AS code, s_name AS label_sv, 'SE' AS country_code,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL WHEN s_suppkey % 3 = 0 THEN 'pxweb_v1' WHEN s_suppkey % 3 = 1 THEN 'pxweb_v2' ELSE 'kolada' END AS adapter,
       CASE WHEN s_suppkey % 10 = 9 THEN NULL WHEN s_suppkey % 3 = 2 THEN 'sv' ELSE 'sv,en' END AS languages
FROM supplier""")
def src_registry(t: Tables):
    h = F.col("harvest")
    return stored.providers(registry(t)).select(
        "code", F.try_element_at("label", F.lit("sv")).alias("label_sv"), "country_code", h["adapter"].alias("adapter"),
        F.when(h.isNotNull(), F.array_join(h["languages"], ",")).alias("languages"))


@query("src_change_feed", sql="""
SELECT DISTINCT 'K' || user_id AS kpi FROM events WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND event_id % 11 <> 0""")
def src_change_feed(t: Tables):
    raw = t.events.select(
        F.col("ts").alias("changed_at"),
        F.to_json(F.struct(F.when(F.col("event_id") % 11 == 0, " ").otherwise(
            F.concat(F.lit("K"), F.col("user_id").cast("string"))).alias("kpi"))).alias("body"))
    return kpi.change_feed(raw, "2024-01-10 00:00:00")


def document_pairs(t: Tables):
    """One stored pair per order."""
    k = F.col("o_orderkey")
    identity = F.struct(F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), F.lit("sv").alias("language"))
    axis = F.struct(F.lit("Tid").alias("label"),
                    F.struct(F.create_map(F.year("o_orderdate").cast("string"), F.lit(0)).alias("index"),
                             F.create_map(F.year("o_orderdate").cast("string"), F.lit("År")).alias("label")).alias("category"))
    dataset = F.struct(
        identity.alias("identity"), F.concat(F.lit("Order "), k.cast("string")).alias("label"),
        iso(F.col("o_orderdate")).alias("updated"), F.when(k % 3 != 0, F.col("o_orderstatus") == "F").alias("discontinued"))
    metadata = F.struct(
        identity.alias("identity"), F.array(F.lit("Tid")).alias("id"), F.create_map(F.lit("Tid"), axis).alias("dimension"),
        F.struct(F.array(F.lit("Tid")).alias("time")).alias("role"),
        F.struct(F.col("o_orderpriority").alias("label")).alias("subject"))
    return t.orders.select(F.to_json(F.struct(dataset.alias("dataset"), metadata.alias("metadata"))).alias("body"))


@query("src_documents", sql=f"""
SELECT {ORDER_ID} AS dataset_code, 'Order ' || o_orderkey AS label, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS updated,
       CASE WHEN o_orderkey % 3 <> 0 THEN o_orderstatus = 'F' END AS discontinued, 'Tid' AS axis, year(o_orderdate)::varchar AS category,
       o_orderpriority AS subject, true AS same_identity FROM orders""")
def src_documents(t: Tables):
    d, m = F.col("dataset"), F.col("metadata")
    axis = F.try_element_at(m["dimension"], F.lit("Tid"))
    return stored.documents(document_pairs(t)).select(
        d["identity"]["dataset_code"].alias("dataset_code"), d["label"].alias("label"), d["updated"].alias("updated"),
        d["discontinued"].alias("discontinued"), F.array_join(m["id"], ",").alias("axis"),
        F.array_join(F.map_keys(axis["category"]["index"]), ",").alias("category"), m["subject"]["label"].alias("subject"),
        (d["identity"] == m["identity"]).alias("same_identity"))


# --- sinks -------------------------------------------------------------------------------------


@query("snk_outcomes", sql="""
SELECT strftime(ts, '%Y%m%d') AS run_id, event_id, CASE WHEN event_type = 'view' THEN 'skipped' WHEN event_type = 'error' THEN 'failed' ELSE 'saved' END AS outcome,
       (CASE WHEN event_type = 'error' THEN 5000 ELSE 0 END)::bigint AS error_length, event_type NOT IN ('view', 'error') AS has_documents FROM events""")
def snk_outcomes(t: Tables):
    """Written by run, twice over, and read back: the second write replaces the first."""
    kind = F.col("event_type")
    resolved = t.events.select(
        F.date_format("ts", "yyyyMMdd").alias("run_id"), "event_id", (kind != "view").alias("should_fetch"),
        F.when(kind == "error", F.repeat(F.lit("x"), 5000)).alias("error"), F.col("ts").cast("timestamp").alias("source_updated_at"),
        F.col("props").alias("documents"))
    path = fresh_dir(t.spark, "outcomes")
    for _ in range(2):
        sinks.write_outcomes(resolved, path)
    return t.spark.read.schema(
        "event_id bigint, error string, documents string, outcome string, run_id string").parquet(path).select(
        "run_id", "event_id", "outcome", F.coalesce(F.length("error"), F.lit(0)).cast("bigint").alias("error_length"),
        F.col("documents").isNotNull().alias("has_documents"))


@query("snk_upsert_last_good", """ev AS (SELECT o_orderkey, max(event_id) FILTER (WHERE event_type IN ('click', 'purchase')) AS good
         FROM orders LEFT JOIN events ON user_id = o_orderkey GROUP BY 1)""", sql=f"""
SELECT {ORDER_ID} AS dataset_code, coalesce('event ' || good, 'first') AS document, coalesce(good + 1, 0)::bigint AS run_no FROM ev""")
def snk_upsert_last_good(t: Tables):
    current = t.orders.select(code("O", "o_orderkey").alias("dataset_code"), F.lit(0).cast("bigint").alias("run_no"),
                              F.lit("first").alias("document"))
    known = t.orders.select("o_orderkey")
    saved = t.events.filter(F.col("event_type").isin("click", "purchase")).join(
        known, F.col("user_id") == F.col("o_orderkey"), "left_semi").select(
        code("O", "user_id").alias("dataset_code"), (F.col("event_id") + 1).alias("run_no"),
        F.concat(F.lit("event "), F.col("event_id").cast("string")).alias("document"))
    return sinks.upsert_documents(current, saved, ["dataset_code"])


@query("snk_import_diff", sql="""
SELECT 'c' || c_custkey AS code, CASE WHEN c_custkey % 5 = 0 THEN 'imported' WHEN c_custkey % 3 = 0 THEN 'differences' ELSE 'unchanged' END AS status
FROM customer""")
def snk_import_diff(t: Tables):
    k = F.col("c_custkey")
    ident = F.concat(F.lit("c"), k.cast("string")).alias("code")
    sv, en = F.lit("sv"), F.lit("en")
    incoming = t.customer.select(ident, F.create_map(sv, F.col("c_name"), en, F.col("c_mktsegment")).alias("label"), "c_nationkey")
    other = F.when(k % 3 == 0, F.concat("c_name", F.lit("!"))).otherwise(F.col("c_name"))
    existing = t.customer.select(
        F.when(k % 5 == 0, F.concat(F.lit("x"), k.cast("string"))).otherwise(F.concat(F.lit("c"), k.cast("string"))).alias("code"), F.create_map(en, F.col("c_mktsegment"), sv, other).alias("label"), "c_nationkey")
    return sinks.import_registry(incoming, existing, "code", ["label", "c_nationkey"])


@query("snk_run_record", OUTCOMES, sql="""
SELECT run_id, count(*)::bigint AS discovered, count(*) FILTER (WHERE outcome <> 'skipped')::bigint AS attempts,
       strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started_at, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS ended_at FROM outcomes GROUP BY run_id""")
def snk_run_record(t: Tables):
    return sinks.run_summary(t.outcomes, ["run_id"]).select(
        "run_id", "discovered", "attempts", text_of(F.col("started_at")).alias("started_at"), text_of(F.col("ended_at")).alias("ended_at"))
