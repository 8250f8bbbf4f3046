"""Aggregations, windows, order, sets and trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators import catalog, dimensions, incremental, kpi, numbering, presence, quality, sinks
from kartotek.plans.bindings import Tables
from kartotek.plans.oracle import (
    AREAS, AXES, CANDIDATES, CHAIN, FLAT, FOLDER, KPIS, LIVE, NAV, OBS, OCCURRENCES, OUTCOMES, SELECTION, STATE, WEB,
)
from kartotek.plans.q_projections import FOLDER_META, areas, groups, kpis
from kartotek.plans.registry import query
from kartotek.sources import landed

PRESENT = """present AS (SELECT DISTINCT kpi, 'year' AS dim_id, period::varchar AS cat_id FROM live
  UNION ALL SELECT DISTINCT kpi, 'municipality', entity FROM live)"""


def bigint(*names: str):
    return [F.col(n).cast("bigint").alias(n) for n in names]


@query("flagship_presence", OBS, LIVE, PRESENT, AREAS, sql="""
SELECT p.kpi, p.dim_id, p.cat_id, (row_number() OVER (PARTITION BY p.kpi, p.dim_id ORDER BY p.cat_id) - 1)::bigint AS ordinal,
       coalesce(a.title, p.cat_id) AS label FROM present p LEFT JOIN areas a ON a.area_id = p.cat_id""")
def flagship_presence(t: Tables):
    """Which periods and areas have live data for each KPI, as numbered, labelled categories."""
    titles = areas(t).select("area_id", "title")
    return presence.categories(presence.presence(t.observations), titles).select(
        "kpi", "dim_id", "cat_id", *bigint("ordinal"), "label")


@query("agg_presence", OBS, LIVE, sql="""
SELECT kpi, string_agg(DISTINCT period::varchar, ',' ORDER BY period::varchar) AS periods,
       string_agg(DISTINCT entity, ',' ORDER BY entity) AS entities FROM live GROUP BY kpi""")
def agg_presence(t: Tables):
    sets = presence.presence_sets(presence.presence(t.observations))
    return sets.select("kpi", F.array_join("periods", ",").alias("periods"), F.array_join("entities", ",").alias("entities"))


@query("agg_period_span", OBS, LIVE, sql="SELECT kpi, min(period) AS first_period, max(period) AS last_period FROM live GROUP BY kpi")
def agg_period_span(t: Tables):
    return presence.period_span(t.observations).select("kpi", *bigint("first_period", "last_period"))


@query("agg_empty_presence", KPIS, OBS, LIVE, sql="""
SELECT kpi_id FROM (SELECT kpi_id FROM kpis UNION ALL SELECT 'M' || p_partkey FROM part WHERE p_partkey % 10 = 0)
WHERE kpi_id NOT IN (SELECT kpi FROM live)""")
def agg_empty_presence(t: Tables):
    made_up = t.part.filter("p_partkey % 10 = 0").select(F.concat(F.lit("M"), F.col("p_partkey").cast("string")).alias("kpi_id"))
    return presence.require_presence(kpis(t).select("kpi_id").unionByName(made_up), presence.live(t.observations))


@query("agg_cell_count", AXES, sql="""
SELECT dataset_code, (CASE WHEN any_value(block) % 2 = 0 THEN product(n)::bigint::hugeint ELSE product(n)::bigint::hugeint * 94906267 * 94906267 END)::varchar AS cells
FROM (SELECT DISTINCT dataset_code, block, pos, n FROM axis_rows) GROUP BY dataset_code""")
def agg_cell_count(t: Tables):
    """Every second dataset gets two more axes, whose product is beyond what a DOUBLE holds."""
    sizes = dimensions.axis_sizes(t.axis_rows, ["dataset_code", "pos"])
    odd = F.expr("substring(dataset_code, 2) % 2 = 1")
    more = sizes.select("dataset_code").distinct().filter(odd).select(
        "dataset_code", F.explode(F.array(F.lit(3), F.lit(4))).alias("pos"), F.lit(94906267).cast("bigint").alias("n"))
    return dimensions.cell_count(sizes.unionByName(more), "dataset_code").select("dataset_code", F.col("cells").cast("string").alias("cells"))


FIRST_OCC = """first_occ AS (SELECT id, path, l_suppkey, l_partkey, max(l_shipdate) AS shipped, min(l_shipdate) AS shipped_first FROM occ
  GROUP BY id, path, l_suppkey, l_partkey)"""


@query("agg_collapse_paths", OCCURRENCES, FIRST_OCC, """kept AS (
  SELECT id FROM (SELECT id, l_partkey, row_number() OVER (PARTITION BY id ORDER BY path) AS r FROM first_occ) WHERE r = 1 AND l_partkey % 23 <> 0)""", sql="""
SELECT id AS dataset_code, (row_number() OVER (PARTITION BY id ORDER BY path) - 1)::bigint AS path_no, 's' || l_suppkey AS code, 'Gren s' || l_suppkey AS label
FROM first_occ JOIN kept USING (id) WHERE l_suppkey % 9 <> 0""")
def agg_collapse_paths(t: Tables):
    candidates, paths = catalog.collapse_occurrences(t.occurrences)
    node = F.element_at("categories", 1)
    return paths.join(candidates.select(F.col("dataset_code").alias("id")), "id", "left_semi").select(
        F.col("id").alias("dataset_code"), *bigint("path_no"), node["id"].alias("code"), node["name"].alias("label"))


@query("agg_changed_ids", sql="""
SELECT DISTINCT CASE WHEN event_type = 'view' THEN 'W' ELSE 'K' END || user_id AS kpi FROM events""")
def agg_changed_ids(t: Tables):
    """Ids over all batches of the feed, each once."""
    kind = F.when(F.col("event_type") == "view", "W").otherwise("K")
    feed = t.events.select(F.concat(kind, F.col("user_id").cast("string")).alias("kpi"))
    return feed.distinct()


@query("agg_reconcile", FLAT, WEB, FOLDER, FOLDER_META, """ids AS (
  SELECT coalesce(f.id_key, w.id_key) AS id_key, f.id_key IS NOT NULL AS f, w.id_key IS NOT NULL AS w
  FROM (SELECT DISTINCT id_key FROM flat) f FULL JOIN (SELECT DISTINCT id_key FROM web) w ON f.id_key = w.id_key)""", sql="""
SELECT count(*) FILTER (WHERE f AND NOT w)::bigint AS flat_only, count(*) FILTER (WHERE w AND NOT f)::bigint AS web_only,
       count(*) FILTER (WHERE w AND NOT f AND id_key IN (SELECT id_key FROM folder_meta))::bigint AS enriched,
       count(*) FILTER (WHERE w AND NOT f AND id_key NOT IN (SELECT id_key FROM folder_meta))::bigint AS unresolved FROM ids""")
def agg_reconcile(t: Tables):
    filled = catalog.web_only_metadata(t.web, t.flat, t.folder_entries)
    return catalog.reconcile_counts(
        t.flat.select(F.lower("id").alias("id_key")), t.web.select(F.lower("table_id").alias("id_key")), filled.select("id_key"))


@query("agg_outcomes", OUTCOMES, sql="""
SELECT run_id, count(*) FILTER (WHERE outcome = 'saved')::bigint AS saved, count(*) FILTER (WHERE outcome = 'failed')::bigint AS failed,
       count(*) FILTER (WHERE outcome = 'skipped')::bigint AS skipped FROM outcomes GROUP BY run_id""")
def agg_outcomes(t: Tables):
    return sinks.outcome_summary(t.outcomes, ["run_id"])


@query("agg_listing_complete", """pages_ AS (
  SELECT DISTINCT o_orderkey // 10000 AS s, (o_orderkey // 1000) % 10 + 1 AS p, (o_orderkey // 10000) % 4 = 2 AND (o_orderkey // 1000) % 10 = 7 AS bad FROM orders)""", sql="""
SELECT s::varchar AS scope, 10::bigint AS total_pages, count(*)::bigint AS landed_pages, count(*) FILTER (WHERE bad)::bigint AS bad_pages,
       (count(*) = 10 AND count(*) FILTER (WHERE bad) = 0) AS complete FROM pages_ GROUP BY s
UNION ALL SELECT 'never landed ' || n_nationkey, NULL, 0, 0, false FROM nation""")
def agg_listing_complete(t: Tables):
    """Scopes of orders; one more for each nation was to be listed, but has no page."""
    unlisted = t.nation.select(F.concat(F.lit("never landed "), F.col("n_nationkey").cast("string")).alias("scope"))
    scopes = t.listing_bodies.select("scope").unionByName(unlisted)
    return catalog.listing_complete(landed.listing_pages(t.listing_bodies), scopes).select(
        "scope", *bigint("total_pages", "landed_pages", "bad_pages"), "complete")


@query("agg_conflicts", sql="""
SELECT p_brand || '/' || (p_partkey // 100) AS group_id, 2::bigint AS copies FROM part
WHERE p_brand <> 'Brand#1' OR (p_partkey // 100) % 7 <> 6 GROUP BY 1, p_brand, p_partkey // 100 HAVING (p_partkey // 100) % 3 = 0""")
def agg_conflicts(t: Tables):
    """Each group twice; every third repeat has another title."""
    once = groups(t).filter("fault is null")
    block = F.element_at(F.split("group_id", "/"), -1).cast("int")
    twice = once.withColumn("title", F.when(block % 3 == 0, F.concat("title", F.lit("!"))).otherwise(F.col("title")))
    return kpi.conflicting_groups(once.unionByName(twice)).select("group_id", *bigint("copies"))


# --- windows ---------------------------------------------------------------------------------------


@query("win_ordinals", AXES, sql="SELECT dataset_code, dim_id, cat_id, ordinal FROM axis_rows")
def win_ordinals(t: Tables):
    bounds = numbering.range_bounds(t.axis_rows, "cat_id", 16)
    return numbering.ordinals(t.axis_rows, ["dataset_code", "dim_id"], ["cat_id"], "ordinal", bounds).select(
        "dataset_code", "dim_id", "cat_id", *bigint("ordinal"))


@query("win_first_dedup", sql="""
SELECT path, id_key, l_orderkey, l_linenumber::bigint AS l_linenumber FROM (
  SELECT '/s' || l_suppkey AS path, 't' || l_partkey AS id_key, l_orderkey, l_linenumber,
         row_number() OVER (PARTITION BY l_suppkey, l_partkey ORDER BY l_orderkey, l_linenumber) AS r FROM lineitem) WHERE r = 1""")
def win_first_dedup(t: Tables):
    rows = t.lineitem.select(F.concat(F.lit("/s"), F.col("l_suppkey").cast("string")).alias("path"),
                             F.lower(F.concat(F.lit("T"), F.col("l_partkey").cast("string"))).alias("id_key"), "l_orderkey", *bigint("l_linenumber"))
    return numbering.first_per(rows, ["path", "id_key"], [F.col("l_orderkey"), F.col("l_linenumber")])


@query("win_canonical", OCCURRENCES, sql="SELECT id, min(path) AS path FROM occ GROUP BY id")
def win_canonical(t: Tables):
    return catalog.canonical(t.occurrences).select("id", "path")


@query("win_bounded_attempts", CANDIDATES, STATE, SELECTION, """counted AS (
  SELECT *, coalesce(sum(should_fetch::int) OVER (PARTITION BY o_orderkey // 10000 ORDER BY o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM selection)""", sql="""
SELECT dataset_code, should_fetch, CASE WHEN should_fetch THEN before::bigint + 1 END AS attempt_no, should_fetch AND before >= 400 AS deferred FROM counted""")
def win_bounded_attempts(t: Tables):
    selection = incremental.select_by_timestamp(t.candidates, t.state).withColumn("scope", F.floor(F.col("o_orderkey") / 10_000))
    bounds = numbering.range_bounds(t.orders, "o_orderkey", 32)
    return incremental.bounded(selection, ["scope"], ["o_orderkey"], 400, bounds).select(
        "dataset_code", "should_fetch", *bigint("attempt_no"), "deferred")


@query("win_batches", sql="""
SELECT c_custkey, c_mktsegment AS scope, ((row_number() OVER (PARTITION BY c_mktsegment ORDER BY c_custkey) - 1) // 25)::bigint AS batch_id FROM customer""")
def win_batches(t: Tables):
    bounds = numbering.range_bounds(t.customer, "c_custkey", 32)
    rows = t.customer.select("c_custkey", F.col("c_mktsegment").alias("scope"))
    return numbering.batches(rows, ["scope"], ["c_custkey"], 25, bounds).select("c_custkey", "scope", *bigint("batch_id"))


@query("win_sample_selection", AXES, """sizes AS (SELECT DISTINCT dataset_code, block, pos, dim_id, n, least(n, 2) AS s FROM axis_rows)""", sql="""
SELECT a.dataset_code, a.dim_id, (CASE WHEN product(b.s) > 3 THEN 1 ELSE any_value(a.s) END)::bigint AS keep
FROM sizes a JOIN sizes b ON a.dataset_code = b.dataset_code AND b.pos <= a.pos GROUP BY a.dataset_code, a.dim_id""")
def win_sample_selection(t: Tables):
    sizes = dimensions.axis_sizes(t.axis_rows, ["dataset_code", "pos", "dim_id"])
    return dimensions.sample_selection(sizes, "dataset_code", 3).select("dataset_code", "dim_id", *bigint("keep"))


# --- order -----------------------------------------------------------------------------------------


@query("srt_catalog", FLAT, sql="SELECT id, path_key AS path, p_partkey FROM flat ORDER BY lower(id), lower(path_key)")
def srt_catalog(t: Tables):
    rows = t.flat.select(
        "id", fn.path_string(fn.path_tokens(F.col("path"))).alias("path"), "p_partkey")
    return catalog.sort_catalog(rows)


@query("srt_groups", sql="""
SELECT kpi_id, string_agg(title || ':' || g, ',' ORDER BY title, g) AS groups FROM (
  SELECT p_partkey AS kpi_id, p_type AS title, p_brand AS g FROM part UNION SELECT p_partkey, p_brand, p_type FROM part
  UNION SELECT p_partkey, p_type, 'A' || p_size FROM part) GROUP BY kpi_id""")
def srt_groups(t: Tables):
    def pair(a, b):
        return F.struct(a.alias("title"), b.alias("group_id"))

    kind, brand = F.col("p_type"), F.col("p_brand")
    own = F.array_sort(F.array(pair(kind, brand), pair(brand, kind), pair(kind, F.concat(F.lit("A"), F.col("p_size").cast("string")))))
    return t.part.select(F.col("p_partkey").alias("kpi_id"),
                         F.array_join(F.transform(own, lambda g: F.concat(g["title"], F.lit(":"), g["group_id"])), ",").alias("groups"))


@query("srt_top_categories", AXES, sql="SELECT dataset_code, dim_id, cat_id, ordinal FROM axis_rows WHERE ordinal < 2")
def srt_top_categories(t: Tables):
    _, cats = dimensions.dimensions_v2(dimensions.axes_v2(landed.metadata_v2(t.v2_bodies)))
    return dimensions.top_categories(cats, 2).select("dataset_code", "dim_id", "cat_id", *bigint("ordinal"))


@query("srt_periods", OBS, sql="""
SELECT kpi, string_agg(DISTINCT period::varchar, ',' ORDER BY period::varchar) AS years,
       string_agg(DISTINCT 'V' || (period - 1990), ',' ORDER BY 'V' || (period - 1990)) AS labels FROM obs GROUP BY kpi""")
def srt_periods(t: Tables):
    """Years by number, labels as text (V10 before V9)."""
    seen = t.observations.select("kpi", "period").distinct()
    label = F.concat(F.lit("V"), (F.col("period") - 1990).cast("string"))
    return seen.groupBy("kpi").agg(F.collect_list("period").alias("p"), F.collect_list(label).alias("l")).select(
        "kpi", F.array_join(presence.sort_periods(F.col("p")).cast("array<string>"), ",").alias("years"),
        F.array_join(presence.sort_periods(F.col("l")), ",").alias("labels"))


# --- sets --------------------------------------------------------------------------------------------


@query("set_union", sql="SELECT DISTINCT l_partkey, year(l_shipdate)::bigint AS period FROM lineitem")
def set_union(t: Tables):
    part = t.lineitem.select("l_partkey", F.year("l_shipdate").cast("bigint").alias("period"), "l_linenumber")
    first, second = (part.filter(f"l_linenumber % 2 = {i}").drop("l_linenumber") for i in (0, 1))
    return first.unionByName(second).distinct()


@query("set_except", FLAT, WEB, sql="""
SELECT 'flat' AS side, id_key FROM (SELECT id_key FROM flat EXCEPT SELECT id_key FROM web)
UNION ALL SELECT 'web', id_key FROM (SELECT id_key FROM web EXCEPT SELECT id_key FROM flat)""")
def set_except(t: Tables):
    flat, web = t.flat.select(F.lower("id").alias("id_key")), t.web.select(F.lower("table_id").alias("id_key"))
    side = [a.subtract(b).select(F.lit(n).alias("side"), "id_key") for n, a, b in (("flat", flat, web), ("web", web, flat))]
    return side[0].unionByName(side[1])


@query("set_intersect", FLAT, WEB, FOLDER, FOLDER_META, sql="""
SELECT id_key FROM (SELECT id_key FROM web EXCEPT SELECT id_key FROM flat) INTERSECT SELECT id_key FROM folder_meta""")
def set_intersect(t: Tables):
    flat, web = t.flat.select(F.lower("id").alias("id_key")), t.web.select(F.lower("table_id").alias("id_key"))
    return web.subtract(flat).intersect(catalog.web_only_metadata(t.web, t.flat, t.folder_entries).select("id_key"))


@query("set_equality", AXES, sql="""
SELECT dataset_code, block % 4 <> 3 AS same FROM (SELECT DISTINCT dataset_code, block FROM axis_rows)""")
def set_equality(t: Tables):
    """Axis ids against dimension keys; every fourth dataset has a stray axis."""
    p = F.col("payload")
    block = F.expr("cast(substring(dataset_code, 2) as int)")
    ids = F.when(block % 4 == 3, F.concat(p["id"], F.array(F.lit("Extra")))).otherwise(F.concat(p["id"], p["id"]))
    return landed.metadata_v2(t.v2_bodies).select("dataset_code", quality.same_set(ids, F.map_keys(p["dimension"])).alias("same"))


# --- trees and chains -----------------------------------------------------------------------------------


@query("rec_nav_walk", NAV, """folders AS (
  SELECT '/' AS parent, '/R' || r_regionkey AS path,
         CASE WHEN r_name LIKE '% %' THEN 'Middle East' ELSE upper(r_name[1]) || lower(r_name[2:]) END AS name FROM region
  UNION ALL SELECT '/R' || n_regionkey, '/R' || n_regionkey || '/N' || n_nationkey, n_name FROM nation WHERE n_nationkey % 8 <> 7)""", sql="""
SELECT c.path, c.id, CASE WHEN c.c_custkey % 9 <> 0 THEN c.c_name ELSE c.id END AS title, w.names AS categories
FROM nav_customer c JOIN (
  WITH RECURSIVE walk AS (
    SELECT path, name AS names FROM folders WHERE parent = '/'
    UNION ALL SELECT f.path, w.names || ' > ' || f.name FROM folders f JOIN walk w ON f.parent = w.path)
  SELECT * FROM walk) w ON w.path = c.path""")
def rec_nav_walk(t: Tables):
    return catalog.walk(t.nav).select(
        "path", "id", "title", F.array_join(F.transform("categories", lambda c: c["name"]), " > ").alias("categories"))


@query("rec_page_chain", CHAIN, """ok_end AS (
  SELECT a.conv_id, count(*) FILTER (WHERE conv_id % 5 = 2) AS endless FROM chain a GROUP BY a.conv_id)""", sql="""
SELECT c.conv_id::varchar AS feed, count(*)::bigint AS pages,
       count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM chain p WHERE p.conv_id = c.conv_id AND p.nxt = c.turn))::bigint AS heads,
       count(*) FILTER (WHERE nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM chain p WHERE p.conv_id = c.conv_id AND p.turn = c.nxt))::bigint AS missing,
       any_value(e.endless)::bigint AS endless,
       (count(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM chain p WHERE p.conv_id = c.conv_id AND p.nxt = c.turn)) = 1
        AND count(*) FILTER (WHERE nxt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM chain p WHERE p.conv_id = c.conv_id AND p.turn = c.nxt)) = 0
        AND any_value(e.endless) = 0) AS complete
FROM chain c JOIN ok_end e USING (conv_id) GROUP BY c.conv_id""")
def rec_page_chain(t: Tables):
    return catalog.chain_status(landed.page_links(t.chain)).select(
        "feed", *bigint("pages", "heads", "missing", "endless"), "complete")


@query("rec_child_edges", sql="""
SELECT 'D' || (c_custkey // 20) AS dataset_code, 'R' || n_regionkey AS parent, 'N' || c_nationkey AS child
FROM (SELECT DISTINCT c_custkey // 20 * 20 AS c_custkey, c_nationkey FROM customer) c JOIN nation ON c_nationkey = n_nationkey""")
def rec_child_edges(t: Tables):
    """Region to nation hierarchies of small customer spans."""
    span = F.concat(F.lit("D"), F.floor(F.col("c_custkey") / 20).cast("string"))
    pairs = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        span.alias("dataset_code"), F.concat(F.lit("R"), F.col("n_regionkey").cast("string")).alias("p"),
        F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("c")).distinct()
    axes = pairs.groupBy("dataset_code", "p").agg(F.collect_list("c").alias("cs")).groupBy("dataset_code").agg(
        F.map_from_entries(F.collect_list(F.struct("p", "cs"))).alias("child"))
    return dimensions.child_edges(axes).select("dataset_code", "parent", "child")
