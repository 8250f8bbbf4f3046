"""Projections, filters and joins."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek import schemas
from kartotek.operators import catalog, dimensions, documents, enrich, incremental, kpi
from kartotek.operators.presence import is_live
from kartotek.plans.bindings import API, WEB, Tables, code, iso, text_of
from kartotek.plans.oracle import (
    AREAS, AXES, CANDIDATES, FLAT, FOLDER, GROUPS, KPIS, OBS, ORDER_ID, SELECTION, STATE, UNITS, WEB as WEB_CTE,
)
from kartotek.plans.q_sources import registry
from kartotek.plans.registry import query
from kartotek.sources import kpi as kpi_source
from kartotek.sources import landed, stored


def kpis(t: Tables):
    return kpi_source.kpis(t.kpi_bodies)


def groups(t: Tables):
    return kpi_source.kpi_groups(t.group_bodies)


def areas(t: Tables):
    return kpi_source.areas(t.area_bodies)


def units(t: Tables):
    return kpi_source.units(t.unit_bodies)


def listed(t: Tables):
    """Listing candidates straight from the entries (the page grouping is SRC1's concern)."""
    rows = t.listing_entries.select(
        "scope", "page_no", (F.col("o_orderkey") % 1000).cast("int").alias("item_pos"), F.to_json("entry").alias("entry"))
    return catalog.candidates_v2(rows, API + "/", WEB, "sv")


@query("prj_candidates_v2", sql=f"""
SELECT {ORDER_ID} AS dataset_code,
       CASE o_orderkey % 3 WHEN 0 THEN 'Order ' || o_orderkey WHEN 1 THEN 'Titel ' || o_orderkey ELSE {ORDER_ID} END AS label,
       CASE WHEN o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS updated,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'Annual' WHEN '2-HIGH' THEN 'Monthly' WHEN '3-MEDIUM' THEN 'Quarterly' ELSE 'Other' END AS time_unit,
       CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate)::varchar END AS first_period, year(o_orderdate)::varchar AS last_period,
       CASE WHEN o_orderkey % 4 = 1 THEN 'Text ' END AS description, CASE WHEN o_orderkey % 5 = 0 THEN 'Not ' || o_orderstatus END AS note,
       o_orderpriority AS subject_code, CASE o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS discontinued,
       'Orders/' || o_orderpriority AS path, 'time,value' AS variable_names,
       'https://api.example.org/v2/tables/' || {ORDER_ID} || '/metadata?lang=sv' AS metadata_url,
       'https://www.example.org/pxweb/sv/table/' || {ORDER_ID} AS web_url
FROM orders WHERE o_orderkey % 101 <> 0""")
def prj_candidates_v2(t: Tables):
    return listed(t).select(
        "dataset_code", "label", text_of(F.col("updated")).alias("updated"), "time_unit", "first_period", "last_period", "description",
        F.array_join("note", "|").alias("note"), "subject_code", "discontinued",
        F.array_join(F.transform(F.element_at("paths", 1), lambda n: n["label"]), "/").alias("path"),
        F.array_join("variable_names", ",").alias("variable_names"), "metadata_url", "web_url")


@query("prj_candidates_v1", FLAT, sql="""
SELECT id, title, CASE WHEN updated IS NULL THEN '2020-01-01 00:00:00' ELSE '2021-05-06 07:08:09' END AS updated,
       CASE WHEN p_partkey % 3 = 0 THEN split_part(path_key, '/', 2) ELSE split_part(path_key, '/', 3) END AS subject_code,
       CASE WHEN p_partkey % 3 = 0 THEN lower(split_part(path_key, '/', 2)) ELSE split_part(path_key, '/', 3) END AS subject_label,
       lower(split_part(path_key, '/', 2)) || CASE WHEN p_partkey % 3 = 0 THEN '' ELSE '>' || split_part(path_key, '/', 3) END AS nodes,
       'https://api.example.org/sv/db%201' || path_key || '/' || id AS api_url FROM flat""")
def prj_candidates_v1(t: Tables):
    labels = t.part.select(F.col("p_type").alias("code"), F.lower("p_type").alias("label")).distinct()
    entries = catalog.candidate_urls_v1(t.flat, "https://api.example.org/", None, "sv", "db 1")
    return catalog.candidates_v1_entry(entries, labels).select(
        "id", "title", text_of(F.col("updated")).alias("updated"), "subject_code", "subject_label",
        F.array_join(F.transform("nodes", lambda n: n["label"]), ">").alias("nodes"), "api_url")


@query("prj_candidates_kpi", KPIS, GROUPS, sql="""
SELECT CASE WHEN k.kind = 'data' THEN kpi_id ELSE kpi_id || '_OU' END AS dataset_code, title AS label, source, origin AS source_origin,
       'kolada:operating_area:' || url_encode(operating_area) AS subject_code, coalesce(retired <= 2026, false) AS discontinued,
       coalesce(retired, 0)::bigint AS discontinued_year, (1 + coalesce(g.n, 0))::bigint AS n_paths,
       'https://api.kolada.se/v3/' || k.kind || '/kpi/' || kpi_id AS data_url
FROM kpis JOIN (VALUES ('data'), ('oudata')) k(kind) ON k.kind = 'data' OR has_ou_data
LEFT JOIN (SELECT kpi_id, count(*) AS n FROM members GROUP BY kpi_id) g USING (kpi_id)""")
def prj_candidates_kpi(t: Tables):
    return kpi.candidates_kpi(kpi.with_groups(kpis(t), groups(t)), 2026).select(
        "dataset_code", "label", "source", "source_origin", "subject_code", "discontinued",
        F.coalesce("discontinued_year", F.lit(0)).cast("bigint").alias("discontinued_year"),
        F.size("paths").cast("bigint").alias("n_paths"), "data_url")


V1_CATS = """SELECT dataset_code, dim_id, cat_id, ordinal,
       CASE WHEN block % 2 = 1 AND n > 1 AND ordinal = n - 1 THEN cat_id ELSE label END AS label FROM axis_rows"""


@query("prj_dimensions_v1", AXES, f"cats AS ({V1_CATS})", sql="""
SELECT c.dataset_code, c.dim_id, c.cat_id, c.ordinal, c.label, CASE WHEN c.dim_id = 'Typ' THEN 'Typ' ELSE c.dim_id || ' text' END AS dim_label,
       CASE c.dim_id WHEN 'Tid' THEN 'time' WHEN 'ContentsCode' THEN 'metric' END AS role, c.dim_id = 'Typ' AS elimination,
       CASE WHEN c.dim_id = 'Typ' THEN 'map' ELSE '' END AS extras FROM cats c""")
def prj_dimensions_v1(t: Tables):
    dims, cats = dimensions.dimensions_v1(landed.metadata_v1(t.v1_bodies))
    dims = dims.select("dataset_code", "dim_id", F.col("label").alias("dim_label"), "role", "elimination",
                       F.array_join(F.map_keys("extras"), ",").alias("extras"))
    return cats.join(dims, ["dataset_code", "dim_id"]).select(
        "dataset_code", "dim_id", "cat_id", F.col("ordinal").cast("bigint"), "label", "dim_label", "role", "elimination", "extras")


@query("prj_dimensions_v2", AXES, sql="""
SELECT dataset_code, pos, dim_id, cat_id, ordinal, label, CASE WHEN dim_id = 'Typ' THEN 'Typ' ELSE dim_id || ' text' END AS dim_label,
       CASE dim_id WHEN 'Tid' THEN 'time' WHEN 'ContentsCode' THEN 'metric' END AS role, 'Not' AS note, dim_id = 'Typ' AS elimination,
       'extra,show' AS extras FROM axis_rows""")
def prj_dimensions_v2(t: Tables):
    axes = dimensions.axes_v2(landed.metadata_v2(t.v2_bodies))
    dims, cats = dimensions.dimensions_v2(axes)
    dims = dims.select("dataset_code", "dim_id", F.col("label").alias("dim_label"), "role", F.array_join("note", "|").alias("note"),
                       "elimination", F.array_join(F.array_sort(F.map_keys("extras")), ",").alias("extras"))
    return cats.join(dims, ["dataset_code", "dim_id"]).select(
        "dataset_code", F.col("pos").cast("bigint"), "dim_id", "cat_id", F.col("ordinal").cast("bigint"), "label", "dim_label", "role",
        "note", "elimination", "extras")


@query("prj_category_forms", sql="""
SELECT c_custkey, v.i::bigint AS ordinal, CASE v.i WHEN 0 THEN c_mktsegment ELSE 'Z' || (c_custkey % 3) END AS cat_id,
       CASE WHEN v.i = 0 THEN lower(c_mktsegment) WHEN c_custkey % 3 = 2 THEN 'zz' ELSE 'Z' || (c_custkey % 3) END AS label
FROM customer, (VALUES (0), (1)) v(i)""")
def prj_category_forms(t: Tables):
    """Index as a map, as a list, or left to the order of the labels."""
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    other = F.concat(F.lit("Z"), (k % 3).cast("string"))
    index = F.when(k % 3 == 0, F.to_json(F.map_from_arrays(F.array(other, seg), F.array(F.lit(1), F.lit(0))))).when(
        k % 3 == 1, F.to_json(F.array(seg, other)))
    labels = F.when(k % 3 == 2, F.to_json(F.map_from_arrays(F.array(seg, other), F.array(F.lower(seg), F.lit("zz"))))).otherwise(
        F.to_json(F.create_map(seg, F.lower(seg))))
    return t.customer.select("c_custkey", F.inline(dimensions.category_entries(index, labels))).withColumn(
        "ordinal", F.col("ordinal").cast("bigint"))


@query("prj_dimension_extension", sql="""
SELECT event_id, event_id % 3 = 0 AS elimination, CASE WHEN event_id % 5 = 0 THEN 'category,k,kind' ELSE 'k,kind' END AS extras,
       regexp_extract(props, '(\\d+)', 1) AS k, event_type AS kind, event_id % 7 = 0 AS nested_fault FROM events""".replace("\\\\", "\\"))
def prj_dimension_extension(t: Tables):
    e = F.col("event_id")
    ext = F.concat(
        F.expr("substring(props, 1, length(props) - 1)"), F.lit(',"elimination":"'), F.when(e % 3 == 0, "yes").otherwise("?"), F.lit('"'),
        F.when(e % 7 == 0, ',"extension":{}').otherwise(""), F.lit("}"))
    body = F.concat(
        F.lit('{"label":"L","kind":"'), "event_type", F.lit('","elimination":true,"category":{"label":{}'),
        F.when(e % 5 == 0, ',"more":1').otherwise(""), F.lit('},"extension":'), ext, F.lit("}"))
    found = dimensions.dimension_extension(F.try_parse_json(body))
    return t.events.select("event_id", found.alias("x")).select(
        "event_id", F.col("x.elimination").alias("elimination"),
        F.array_join(F.array_sort(F.filter(F.map_keys("x.extras"), lambda k: k != "extension")), ",").alias("extras"),
        F.element_at("x.extras", "k").try_cast("string").alias("k"), F.element_at("x.extras", "kind").try_cast("string").alias("kind"),
        F.col("x.nested_fault").alias("nested_fault"))


def doc_defaults(t: Tables):
    return t.documents.select(
        "doc_id", F.when(F.col("doc_id") % 2 == 0, F.array(F.lit("default"))).alias("note"),
        F.when(F.col("doc_id") % 3 == 0, F.col("source")).alias("subject_label"), F.lit(True).alias("official_statistics"),
        F.lit(None).cast(f"array<{schemas.CONTACT}>").alias("contact"),
        F.create_map(F.lit("lang"), F.col("lang").cast("variant"), F.lit("quality"), F.lit("none").cast("variant")).alias("extension"))


@query("prj_merge_defaults", sql="""
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'payload' WHEN d.doc_id % 2 = 0 THEN 'default' END AS note,
       CASE WHEN d.doc_id % 3 = 0 THEN source WHEN l.doc_id IS NOT NULL THEN 'Area' END AS subject_label,
       CASE WHEN l.doc_id IS NULL THEN true ELSE l.toxic = 1 END AS official_statistics,
       CASE WHEN l.doc_id IS NOT NULL THEN 'call' END AS contact, lang,
       CASE WHEN l.doc_id IS NULL THEN 'none' ELSE l.quality::varchar END AS quality,
       CASE WHEN l.doc_id IS NULL THEN 'lang,quality' ELSE 'lang,px,quality' END AS extension_keys
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def prj_merge_defaults(t: Tables):
    body = F.concat(
        F.lit('{"quality":'), F.col("quality").cast("string"), F.lit(',"contact":" call ","px":{"subject-area":"Area","official-statistics":'),
        F.col("toxic").cast("string"), F.lit("}}"))
    payload = t.labels.select(
        "doc_id", F.when(F.col("quality") == 1, F.try_parse_json(F.lit('"payload "'))).alias("note"), F.try_parse_json(body).alias("extension"))
    merged = enrich.merge_metadata(doc_defaults(t), payload, "doc_id")
    return merged.select(
        "doc_id", F.array_join("note", "|").alias("note"), "subject_label", "official_statistics",
        F.get("contact", F.lit(0))["raw"].alias("contact"), F.element_at("extension", "lang").try_cast("string").alias("lang"),
        F.element_at("extension", "quality").try_cast("string").alias("quality"),
        F.array_join(F.array_sort(F.map_keys("extension")), ",").alias("extension_keys"))


def basic_documents(t: Tables):
    return documents.dataset_doc(listed(t).withColumn("provider_code", F.lit("demo")))


@query("prj_dataset_doc", sql=f"""
SELECT 'demo' AS provider_code, {ORDER_ID} AS dataset_code, 'sv' AS language,
       CASE WHEN o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') END AS updated,
       CASE WHEN o_orderkey % 2 = 0 THEN year(o_orderdate)::varchar END AS first_period, year(o_orderdate)::varchar AS last_period,
       'https://www.example.org/pxweb/sv/table/' || {ORDER_ID} AS source_url FROM orders WHERE o_orderkey % 101 <> 0""")
def prj_dataset_doc(t: Tables):
    d = F.col("dataset")
    return basic_documents(t).select(
        *[d["identity"][c].alias(c) for c in ("provider_code", "dataset_code", "language")],
        *[d[c].alias(c) for c in ("updated", "first_period", "last_period", "source_url")])


def nested(t: Tables):
    return documents.nested_dimensions(*dimensions.dimensions_v2(dimensions.axes_v2(landed.metadata_v2(t.v2_bodies))))


def detail_candidates(t: Tables):
    none = F.lit(None)
    return landed.metadata_v2(t.v2_bodies).select(
        F.lit("demo").alias("provider_code"), "dataset_code", F.lit("sv").alias("language"), none.cast("string").alias("subject_code"),
        F.when(F.length("dataset_code") > 2, F.lit("Ämne")).alias("subject_label"),
        F.array(F.array(F.struct(F.lit("a").alias("code"), F.lit("A").alias("label")))).alias("paths"),
        none.cast("boolean").alias("official_statistics"), F.lit("SCB").alias("source"), none.cast("array<string>").alias("note"),
        F.concat(F.lit("https://x.org/å /"), "dataset_code").alias("metadata_url"), F.lit("pxweb_v2").alias("adapter"),
        F.concat(F.lit("https://x.org/d/"), "dataset_code").alias("data_url"), F.try_parse_json(F.lit('{"a":null}')).alias("extension"))


@query("prj_metadata_doc", AXES, sql="""
SELECT dataset_code, 'Typ,ContentsCode,Tid' AS axis_ids, 'Tid' AS time_role, 'ContentsCode' AS metric_role,
       CASE WHEN length(dataset_code) > 2 THEN 'Ämne' END AS subject_label, 'A' AS path, 'https://x.org/%C3%A5%20/' || dataset_code AS metadata_url,
       'pxweb_v2' AS retrieval_type, string_agg(cat_id, ',' ORDER BY ordinal) FILTER (WHERE dim_id = 'Typ') AS types,
       count(*) FILTER (WHERE dim_id = 'Tid')::bigint AS years FROM axis_rows GROUP BY dataset_code""")
def prj_metadata_doc(t: Tables):
    m = F.col("metadata")
    axis = F.element_at(m["dimension"], "Typ")["category"]
    return documents.metadata_doc(detail_candidates(t), nested(t)).select(
        "dataset_code", F.array_join(m["id"], ",").alias("axis_ids"), F.array_join(m["role"]["time"], ",").alias("time_role"),
        F.array_join(m["role"]["metric"], ",").alias("metric_role"), m["subject"]["label"].alias("subject_label"),
        m["paths"][0]["path"][0]["label"].alias("path"), m["metadata_url"].alias("metadata_url"), m["retrieval"]["type"].alias("retrieval_type"),
        F.array_join(F.map_keys(axis["index"]), ",").alias("types"),
        F.size(F.element_at(m["dimension"], "Tid")["category"]["label"]).cast("bigint").alias("years"))


@query("prj_json_pair", sql="""
SELECT event_id, '{"dataset":{"label":"' || event_type || '"' || CASE WHEN event_id % 2 = 0 THEN ',"discontinued":true' ELSE '' END
       || ',"extension":{"k":' || regexp_extract(props, '(\\d+)', 1) || ',"none":null}},"metadata":{"source":"s"}}' AS documents FROM events""".replace("\\\\", "\\"))
def prj_json_pair(t: Tables):
    props = F.concat(F.expr("substring(props, 1, length(props) - 1)"), F.lit(',"none":null}'))
    pairs = t.events.select(
        "event_id", F.struct(F.col("event_type").alias("label"), F.when(F.col("event_id") % 2 == 0, True).alias("discontinued"),
                             F.try_parse_json(props).alias("extension")).alias("dataset"),
        F.struct(F.lit("s").alias("source"), F.lit(None).cast("string").alias("note")).alias("metadata"))
    return documents.to_json_pair(pairs).select("event_id", "documents")


@query("prj_metadata_link", sql=r"""
SELECT url, CASE WHEN page_id % 4 = 1 THEN 'https://x.org/constructed'
            ELSE coalesce('/' || nullif(regexp_extract(html, '<li><a href="/([^"]*)">', 1), ''), 'https://x.org/constructed') END AS metadata_url FROM pages""")
def prj_metadata_link(t: Tables):
    """Navigation links of a page as listing links, language from the page's own address."""
    hrefs = F.regexp_extract_all("html", F.lit('<li><a href="(/[^"]*)">'), 1)
    lang = F.regexp_extract(fn.url_path(F.col("url")), "^/([^/]+)", 1)
    wrong = F.array(F.struct(F.lit("data").alias("rel"), lang.alias("hreflang"), F.lit("/no").alias("href")),
                    F.struct(F.lit("metadata").alias("rel"), F.lit("xx").alias("hreflang"), F.lit("/no").alias("href")))
    links = F.concat(wrong, F.transform(hrefs, lambda h: F.struct(
        F.when(F.col("page_id") % 4 == 1, "self").otherwise("metadata").alias("rel"), lang.alias("hreflang"), h.alias("href"))))
    return t.pages.select("url", documents.metadata_url(
        F.try_parse_json(F.to_json(links)), lang, F.lit("https://x.org/constructed")).alias("metadata_url"))


@query("prj_scopes", sql="""
SELECT 'p' || lpad(s_suppkey::varchar, 9, '0') AS provider_code, l.language, (s_suppkey % 7) / 10.0::double AS rate_limit,
       CASE WHEN s_suppkey % 3 = 2 THEN 'https://api.kolada.se/v3' ELSE 'https://api.example.org/' || s_suppkey END AS base_api_url,
       (CASE WHEN s_suppkey % 4 = 0 THEN s_suppkey + 1 ELSE 5000 END)::bigint AS cell_limit
FROM supplier JOIN (VALUES ('sv'), ('en')) l(language) ON l.language = 'sv' OR s_suppkey % 3 <> 2 WHERE s_suppkey % 10 <> 9""")
def prj_scopes(t: Tables):
    return documents.scopes(stored.providers(registry(t))).select(
        "provider_code", "language", "rate_limit", "base_api_url", F.col("cell_limit").cast("bigint"))


@query("prj_gender_dim", KPIS, sql="""
SELECT kpi_id, g.id AS cat_id, g.label, g.ordinal::bigint AS ordinal, true AS elimination
FROM kpis, (VALUES ('K', 'Kvinnor', 0), ('M', 'Män', 1), ('T', 'Totalt', 2)) g(id, label, ordinal) WHERE is_divided_by_gender""")
def prj_gender_dim(t: Tables):
    return dimensions.gender_dimension(kpis(t)).select("kpi_id", "cat_id", "label", F.col("ordinal").cast("bigint"), "elimination")


@query("prj_promote_px", sql="""
SELECT d.doc_id, CASE WHEN l.quality = 1 THEN 'Px' ELSE 'own' END AS description, CASE WHEN l.doc_id IS NOT NULL THEN 'A' || l.toxic ELSE 'code' END AS subject_code,
       'label' AS subject_label, CASE WHEN l.toxic = 1 THEN true WHEN l.toxic = 0 THEN false END AS official_statistics,
       CASE WHEN l.doc_id IS NOT NULL THEN 'sample' ELSE source END AS source, CASE WHEN l.doc_id IS NOT NULL THEN 'a|b' END AS note,
       CASE WHEN l.doc_id IS NOT NULL THEN 'description,official-statistics,subject-area,subject-code' END AS px_keys
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def prj_promote_px(t: Tables):
    px = F.concat(
        F.lit('{"heading":["x"],"stub":[],"description":'), F.when(F.col("quality") == 1, '"Px"').otherwise('" "'),
        F.lit(',"subject-code":"A'), F.col("toxic").cast("string"), F.lit('","subject-area":5,"official-statistics":"'),
        F.when(F.col("toxic") == 1, "Yes").otherwise("n"), F.lit('"}'))
    sample = t.labels.select("doc_id", F.try_parse_json(px).alias("px"), F.try_parse_json(F.lit('"sample"')).alias("source"),
                             F.try_parse_json(F.lit('["a ","","b"]')).alias("note"))
    docs = t.documents.select(
        "doc_id", "source", F.lit("own").alias("description"), F.lit("code").alias("subject_code"), F.lit("label").alias("subject_label"),
        F.lit(None).cast("boolean").alias("official_statistics"), F.lit(None).cast("array<string>").alias("note"))
    return enrich.promote_px(docs, sample, "doc_id").select(
        "doc_id", "description", "subject_code", "subject_label", "official_statistics", "source", F.array_join("note", "|").alias("note"),
        F.array_join(F.array_sort(F.map_keys("px")), ",").alias("px_keys"))


# --- filters -----------------------------------------------------------------------------------


@query("flt_usable_id", sql=r"""
SELECT doc_id, pos::bigint AS pos, length(ident)::bigint AS n, md5(ident) AS digest FROM (
  SELECT doc_id, unnest(w) AS ident, generate_subscripts(w, 1) - 1 AS pos FROM (SELECT doc_id, string_split(text, chr(10)) || [' ' || chr(9)] AS w FROM documents))
WHERE regexp_matches(ident, '[^\s\p{Z}]')""")
def flt_usable_id(t: Tables):
    """Every line of every text, and a blank one, as an id."""
    lines = F.concat(F.split("text", "\n"), F.array(F.lit(" \t")))
    return t.documents.select("doc_id", F.posexplode(lines).alias("pos", "ident")).filter(fn.has_id(F.col("ident"))).select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), F.length("ident").cast("bigint").alias("n"), F.md5("ident").alias("digest"))


@query("flt_unit_kpis", KPIS, sql="SELECT kpi_id, title FROM kpis WHERE has_ou_data")
def flt_unit_kpis(t: Tables):
    return kpi.with_unit_data(kpis(t)).select("kpi_id", "title")


@query("flt_live_values", sql="""
SELECT l_orderkey, l_linenumber::bigint AS l_linenumber, l_quantity FROM lineitem WHERE l_linestatus = 'O' AND (l_discount < 0.09::double OR l_tax = 0)""")
def flt_live_values(t: Tables):
    value = F.when(F.col("l_linestatus") == "O", F.col("l_quantity"))
    mark = F.when(F.col("l_tax") != 0, F.col("l_discount") >= 0.09)
    return t.lineitem.filter(is_live(value, mark)).select("l_orderkey", F.col("l_linenumber").cast("bigint"), "l_quantity")


@query("flt_within_root", sql=r"""
SELECT page_id, url FROM pages WHERE regexp_matches(url, '^https://[^/]*/(en|fr)/')""")
def flt_within_root(t: Tables):
    """Pages below their own site's English or French root, whatever the case."""
    host = fn.url_authority(F.col("url"))

    def root(lang):
        return F.concat(F.lit("HTTPS://"), F.upper(host), F.lit(f"/{lang}"))

    inside = fn.within_root(F.col("url"), root("EN")) | fn.within_root(F.col("url"), root("%46r/"))
    return t.pages.filter(inside).select("page_id", "url")


@query("flt_valid_ts", sql=f"""
SELECT {ORDER_ID} AS dataset_code, strftime(CASE WHEN o_orderkey % 3 = 0 THEN TIMESTAMP '2020-01-02 00:00:00' ELSE o_orderdate END, '%Y-%m-%d %H:%M:%S') AS stamp
FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 2 = 0)""")
def flt_valid_ts(t: Tables):
    k = F.col("o_orderkey")
    rows = t.orders.select(
        code("O", "o_orderkey").alias("dataset_code"), F.when(k % 3 == 0, "soon").otherwise(iso(F.col("o_orderdate"))).alias("updated"),
        F.when(k % 2 == 1, "2020-01-02").otherwise("2020-13-01").alias("published"))
    return catalog.valid_timestamp(rows).select("dataset_code", text_of(F.col("stamp")).alias("stamp"))


@query("flt_response_status", sql="""
SELECT event_id, CASE WHEN event_type = 'click' THEN 'ok' WHEN event_type IN ('error', 'view') AND user_id <> 0 THEN 'dropped' ELSE 'fatal' END AS class FROM events""")
def flt_response_status(t: Tables):
    kind = F.col("event_type")
    status = F.when(kind == "click", 200).when(kind == "error", 400).when(kind == "view", 404).when(kind == "signup", 429)
    rows = t.events.select("event_id", status.alias("status"), "user_id")
    parts = landed.split_responses(rows, F.col("user_id") == 0)
    tagged = [df.select("event_id", F.lit(name).alias("class")) for name, df in parts.items()]
    return tagged[0].unionByName(tagged[1]).unionByName(tagged[2])


@query("flt_compact_strings", sql=r"""
SELECT doc_id, len(l)::bigint AS n, l[1] AS first_item, l[-1] AS last_item
FROM (SELECT doc_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x, chr(9) || chr(10) || chr(13) || ' ')), lambda x: x <> '') AS l FROM documents)""")
def flt_compact_strings(t: Tables):
    items = fn.compact_strings(F.split("text", "\n"))
    return t.documents.select("doc_id", items.alias("l")).select(
        "doc_id", F.size("l").cast("bigint").alias("n"), F.try_element_at("l", F.lit(1)).alias("first_item"),
        F.try_element_at("l", F.lit(-1)).alias("last_item"))


# --- joins ---------------------------------------------------------------------------------------


@query("jon_candidate_state", CANDIDATES, STATE, SELECTION, sql="""
SELECT dataset_code, known, strftime(source_updated_at, '%Y-%m-%d %H:%M:%S') AS stored, coalesce(has_error, false) AS has_error FROM selection""")
def jon_candidate_state(t: Tables):
    return incremental.with_state(t.candidates, t.state).select(
        "dataset_code", "known", text_of(F.col("state_source_updated_at")).alias("stored"),
        F.coalesce("state_has_error", F.lit(False)).alias("has_error"))


@query("jon_kpi_groups", KPIS, GROUPS, sql="""
SELECT k.kpi_id, coalesce(string_agg(m.title || ' [' || m.group_id || ']', ', ' ORDER BY m.title, m.group_id), '') AS groups
FROM kpis k LEFT JOIN members m USING (kpi_id) GROUP BY k.kpi_id""")
def jon_kpi_groups(t: Tables):
    return kpi.with_groups(kpis(t), groups(t)).select(
        "kpi_id", F.array_join(F.transform("groups", lambda g: F.concat(g["title"], F.lit(" ["), g["group_id"], F.lit("]"))), ", ").alias("groups"))


@query("jon_unknown_members", KPIS, GROUPS, sql="""
SELECT group_id, kpi_id FROM members WHERE kpi_id NOT IN (SELECT kpi_id FROM kpis)""")
def jon_unknown_members(t: Tables):
    return kpi.unknown_members(groups(t), kpis(t)).select("group_id", "kpi_id")


FOLDER_META = f"""folder_meta AS (
  SELECT w.path_key, w.id_key, f.text AS title FROM web w JOIN folder f USING (path_key, id_key)
  WHERE w.id_key NOT IN (SELECT id_key FROM flat))"""


@query("jon_tiered_match", FLAT, WEB_CTE, FOLDER, FOLDER_META, sql="""
SELECT w.table_id, CASE WHEN e.id_key IS NOT NULL THEN 'exact' WHEN s.id_key IS NOT NULL THEN 'same_id' ELSE 'folder' END AS tier,
       coalesce(e.title, s.title, f.title, w.title) AS title,
       CASE WHEN e.id_key IS NOT NULL THEN e.updated WHEN s.id_key IS NOT NULL THEN s.updated ELSE '2022-02-02' END AS updated
FROM web w LEFT JOIN (SELECT * FROM flat WHERE copy = 0) e ON e.id_key = w.id_key AND e.path_key = w.path_key
LEFT JOIN (SELECT * FROM flat WHERE copy = 0) s ON s.id_key = w.id_key
LEFT JOIN folder_meta f ON f.id_key = w.id_key
WHERE s.id_key IS NOT NULL OR f.id_key IS NOT NULL""")
def jon_tiered_match(t: Tables):
    nav = catalog.web_only_metadata(t.web, t.flat, t.folder_entries)
    return catalog.match_metadata(t.web, t.flat, nav).select("table_id", "tier", "title", "updated")


@query("jon_web_only", FLAT, WEB_CTE, FOLDER, FOLDER_META, sql="SELECT path_key, id_key, title, '2022-02-02' AS updated FROM folder_meta")
def jon_web_only(t: Tables):
    return catalog.web_only_metadata(t.web, t.flat, t.folder_entries).select("path_key", "id_key", "title", "updated")


@query("jon_folder_match", """wanted AS (
  SELECT s_suppkey, CASE s_suppkey % 4 WHEN 0 THEN n_name WHEN 1 THEN lower(n_name) WHEN 2 THEN 'Nàtïon-' || n_nationkey ELSE 'none' END AS category_id, n_name
  FROM supplier JOIN nation ON s_nationkey = n_nationkey)""", sql="""
SELECT DISTINCT category_id, n_name AS folder_id,
       CASE WHEN category_id = n_name THEN 'exact' WHEN category_id = lower(n_name) THEN 'caseless' ELSE 'plain' END AS tier
FROM wanted WHERE category_id <> 'none'
AND (SELECT count(*) FROM nation n WHERE regexp_replace(strip_accents(lower(n.n_name)), '[^a-z0-9]', '', 'g')
     = regexp_replace(strip_accents(lower(category_id)), '[^a-z0-9]', '', 'g')) = 1""")
def jon_folder_match(t: Tables):
    """Folder ids asked for in another case, with accents, or not at all."""
    k = F.col("s_suppkey")
    wanted = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.lit("/").alias("parent_path"),
        F.when(k % 4 == 0, F.col("n_name")).when(k % 4 == 1, F.lower("n_name"))
        .when(k % 4 == 2, F.concat(F.lit("Nàtïon-"), F.col("n_nationkey").cast("string"))).otherwise("none").alias("category_id"))
    entries = t.nation.select(F.lit("/").alias("parent_path"), F.col("n_name").alias("id"), F.lower("n_name").alias("text"), F.lit("l").alias("type"))
    return catalog.match_folder(entries, wanted).select("category_id", "folder_id", "tier")


@query("jon_label_override", sql="""
SELECT DISTINCT 'r' || n_regionkey || '/N' || n_nationkey AS path,
       upper(r_name[1]) || lower(r_name[2:]) || '/' || n_name AS names
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey % 8 <> 7 AND r_name NOT LIKE '% %'
UNION SELECT DISTINCT 'r' || n_regionkey || '/N' || n_nationkey, 'Middle East/' || n_name
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE n_nationkey % 8 <> 7 AND r_name LIKE '% %'""")
def jon_label_override(t: Tables):
    """Customers' two-level paths, the region asked for in lower case."""
    paths = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.array(F.concat(F.lit("r"), F.col("n_regionkey").cast("string")), F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))).alias("category_ids"))
    return catalog.override_labels(paths, t.nav.filter("type = 'l'")).select(
        F.array_join("category_ids", "/").alias("path"), F.array_join(F.transform("categories", lambda c: c["name"]), "/").alias("names"))


@query("jon_unit_area", UNITS, AREAS, sql="""
SELECT u.ou_id, coalesce(x.area_id, '') AS area_id, coalesce(a.title, x.area_id, '') AS area_label
FROM (SELECT ou_id FROM units UNION ALL SELECT 'W' || s_suppkey FROM supplier WHERE s_suppkey % 10 = 0) u
LEFT JOIN units x USING (ou_id) LEFT JOIN areas a ON a.area_id = x.area_id""")
def jon_unit_area(t: Tables):
    known = units(t)
    strays = t.supplier.filter(F.col("s_suppkey") % 10 == 0).select(F.concat(F.lit("W"), F.col("s_suppkey").cast("string")).alias("ou_id"))
    return kpi.unit_area(known.select("ou_id").unionByName(strays), known, areas(t)).select("ou_id", "area_id", "area_label")


@query("jon_titles", OBS, AREAS, sql="""
SELECT DISTINCT entity AS cat_id, coalesce(a.title, entity) AS label FROM obs LEFT JOIN areas a ON a.area_id = entity AND a.type = 'K'""")
def jon_titles(t: Tables):
    """Labels for observed areas from a catalogue that lacks some of them."""
    ids = t.observations.select(F.col("entity").alias("cat_id")).distinct()
    ident = F.when(F.col("type") == "K", F.col("area_id")).otherwise(F.concat(F.lit("X"), "area_id"))
    return kpi.with_titles(ids, areas(t).select(ident.alias("area_id"), "title"))


@query("jon_kpi_kinds", KPIS, sql="""
SELECT kpi_id, k.kind, CASE WHEN k.kind = 'data' THEN kpi_id ELSE kpi_id || '_OU' END AS dataset_code
FROM kpis JOIN (VALUES ('data'), ('oudata')) k(kind) ON k.kind = 'data' OR has_ou_data""")
def jon_kpi_kinds(t: Tables):
    return kpi.kpi_kinds(kpis(t)).select("kpi_id", "kind", "dataset_code")


@query("jon_probe_areas", KPIS, AREAS, sql="""
SELECT kpi_id, area_id FROM kpis JOIN areas
ON scope_type = 'A' OR scope_type = type OR (scope_type = 'K' AND area_id = '0000')""")
def jon_probe_areas(t: Tables):
    return kpi.probe_areas(kpis(t), areas(t)).select("kpi_id", "area_id")


@query("jon_changed_semi", sql="""
SELECT 'K' || o_orderkey AS kpi_id, k.kind FROM orders, (VALUES ('data'), ('oudata')) k(kind)
WHERE EXISTS (SELECT 1 FROM events WHERE user_id = o_orderkey AND event_type = CASE WHEN k.kind = 'data' THEN 'click' ELSE 'view' END)""")
def jon_changed_semi(t: Tables):
    """Two feeds, one per kind; a change in one selects only that kind."""
    kinds = t.orders.select(F.concat(F.lit("K"), F.col("o_orderkey").cast("string")).alias("kpi_id"), F.lit(True).alias("has_ou_data"))
    feed = t.events.filter(F.col("event_type").isin("click", "view")).select(
        F.concat(F.lit("K"), F.col("user_id").cast("string")).alias("kpi_id"),
        F.when(F.col("event_type") == "click", "data").otherwise("oudata").alias("kind"))
    return incremental.changed(kpi.kpi_kinds(kinds), feed).select("kpi_id", "kind")


@query("jon_enrich", AXES, sql="""
SELECT dataset_code, dim_id, cat_id, 'Not' AS note, CASE WHEN dim_id = 'Typ' THEN 'map,show' ELSE 'show' END AS extra_keys,
       CASE WHEN dim_id = 'ContentsCode' AND ordinal < 2 AND block % 5 <> 4 THEN cat_id || '/kg' END AS unit
FROM axis_rows WHERE block % 5 <> 4
UNION ALL SELECT dataset_code, dim_id, cat_id, NULL, CASE WHEN dim_id = 'Typ' THEN 'map' ELSE '' END, NULL FROM axis_rows WHERE block % 5 = 4""")
def jon_enrich(t: Tables):
    """v1 dimensions with what their samples add."""
    dims, cats = dimensions.dimensions_v1(landed.metadata_v1(t.v1_bodies))
    sample = landed.sample_v1(t.sample_bodies).select(
        "dataset_code", F.struct(F.col("sample.id").alias("id"), F.lit(None).cast("string").alias("role"), F.col("sample.dimension").alias("dimension")).alias("payload"))
    axes = dimensions.axes_v2(sample)
    sampled, _ = dimensions.dimensions_v2(axes)
    keys = ["dataset_code", "dim_id"]
    dims = dims.withColumn("note", F.lit(None).cast("array<string>")).withColumn("link", F.lit(None).cast("variant"))
    sampled = sampled.withColumn("extras", F.map_filter("extras", lambda k, v: k != "extra"))
    rich = enrich.enrich_dimensions(dims, sampled, keys).select(
        *keys, F.array_join("note", "|").alias("note"), F.array_join(F.array_sort(F.map_keys("extras")), ",").alias("extra_keys"))
    details = dimensions.category_details(axes).select(*keys, "cat_id", "unit")
    return enrich.enrich_categories(cats, details, [*keys, "cat_id"]).join(rich, keys).select(
        *keys, "cat_id", "note", "extra_keys", fn.text_at(F.col("unit"), "$.label").alias("unit"))


@query("jon_placeholder", sql="""
SELECT p_partkey, CASE WHEN p_partkey % 3 <> 0 THEN 'kept' WHEN p_partkey % 2 = 0 THEN 'dropped' ELSE 'renamed' END AS placeholder,
       CASE WHEN p_partkey % 6 = 0 THEN 'Tid' ELSE 'Tid,ContentsCode' END AS ids,
       CASE WHEN p_partkey % 6 = 0 THEN NULL WHEN p_partkey % 3 <> 0 THEN '{"' || p_brand || '":0}'
            ELSE '{"' || p_type || '":0}' END AS contents_index,
       CASE WHEN p_partkey % 3 = 0 AND p_partkey % 2 = 1 THEN '{"' || p_type || '":{"label":"kg"}}' WHEN p_partkey % 3 <> 0 THEN '{"' || p_brand || '":{"label":"kg"}}' END AS contents_unit,
       CASE WHEN p_partkey % 30 = 0 THEN 'size' END AS fault FROM part""")
def jon_placeholder(t: Tables):
    k = F.col("p_partkey")
    marked = F.when(k % 3 == 0, "EliminatedValue").otherwise(F.col("p_brand"))
    axis = F.concat(F.lit('{"category":{"index":{"'), marked, F.lit('":0},"unit":{"'), marked, F.lit('":{"label":"kg"}}}}'))
    sample = F.struct(
        F.array(F.lit("Tid"), F.lit("ContentsCode")).alias("id"),
        F.array(F.lit(2), F.when(k % 30 == 0, 3).otherwise(1)).alias("size"),
        F.map_from_arrays(F.array(F.lit("Tid"), F.lit("ContentsCode")), F.array(F.lit("{}"), axis)).alias("dimension"))
    contents = F.when(k % 2 == 1, F.array("p_type"))
    fixed = enrich.fix_placeholder(t.part.select("p_partkey", sample.alias("sample"), contents.alias("contents")))
    text = F.try_element_at(F.col("sample.dimension"), F.lit("ContentsCode"))
    return fixed.select(
        "p_partkey", "placeholder", F.array_join("sample.id", ",").alias("ids"), F.get_json_object(text, "$.category.index").alias("contents_index"),
        F.get_json_object(text, "$.category.unit").alias("contents_unit"), "fault")


@query("jon_probe_batches", """numbered AS (
  SELECT c_nationkey, (row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1) // 25 AS batch_id, c_custkey FROM customer)""", sql="""
SELECT ('R' || c_nationkey) AS region, batch_id::bigint AS batch_id, y.b::bigint AS year_batch, count(*)::bigint AS n_areas,
       min('C' || lpad(c_custkey::varchar, 9, '0')) AS first_area, y.n::bigint AS n_years
FROM numbered, (VALUES (0, 25), (1, 25), (2, 10)) y(b, n) GROUP BY c_nationkey, batch_id, y.b, y.n""")
def jon_probe_batches(t: Tables):
    ids = t.customer.select(F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("region"), code("C", "c_custkey").alias("area_id"))
    from kartotek.operators.numbering import range_bounds

    plan = kpi.probe_batches(ids, 1970, 2029, group=("region",), bounds=range_bounds(ids, "area_id", 16))
    return plan.select(
        "region", F.col("batch_id").cast("bigint"), F.col("year_batch").cast("bigint"), F.size("area_ids").cast("bigint").alias("n_areas"),
        F.element_at("area_ids", 1).alias("first_area"), F.size("years").cast("bigint").alias("n_years"))
