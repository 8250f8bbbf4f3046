"""Rule tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from kartotek.operators import quality
from kartotek.plans.bindings import Tables, code, div, iso
from kartotek.plans.oracle import AXES, ORDER_ID, UNIT_ID
from kartotek.plans.registry import query
from kartotek.sources import landed


def rules(key: str, view: str, *rows: tuple[str, str, str]) -> str:
    """One SELECT per rule: (rule, path, condition)."""
    return " UNION ALL ".join(
        f"SELECT {key}, '{rule}' AS rule, '{path}' AS path FROM {view} WHERE {cond}" for rule, path, cond in rows)


IDENTITIES = """ids AS (
  SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'demo' WHEN 1 THEN 'Demo' WHEN 2 THEN 'demo_x1' ELSE '1demo' END AS provider_code,
         CASE WHEN c_custkey % 5 = 0 THEN ' ' ELSE c_name END AS dataset_code, CASE c_custkey % 3 WHEN 0 THEN 'sv' WHEN 1 THEN 'en' END AS language FROM customer)"""


def identities(t: Tables):
    k = F.col("c_custkey")
    return t.customer.select(
        "c_custkey", F.when(k % 4 == 0, "demo").when(k % 4 == 1, "Demo").when(k % 4 == 2, "demo_x1").otherwise("1demo").alias("provider_code"),
        F.when(k % 5 == 0, " ").otherwise(F.col("c_name")).alias("dataset_code"),
        F.when(k % 3 == 0, "sv").when(k % 3 == 1, "en").otherwise(F.when(k % 2 == 0, "fi")).alias("language"))


@query("val_identity", IDENTITIES, sql=rules(
    "c_custkey", "ids", ("pattern", "identity/provider_code", "c_custkey % 4 IN (1, 3)"), ("blank", "identity/dataset_code", "c_custkey % 5 = 0"),
    ("enum", "identity/language", "language IS NULL")))
def val_identity(t: Tables):
    return quality.check_identity(identities(t), ["c_custkey"])


@query("val_dataset", f"d AS (SELECT {ORDER_ID} AS dataset_code, o_orderkey AS k FROM orders)", sql=rules(
    "dataset_code", "d", ("blank", "label", "k % 11 = 0"), ("date", "updated", "k % 4 IN (2, 3)"), ("blank", "first_period", "k % 9 = 0"),
    ("url", "source_url", "k % 7 IN (1, 2, 4)"), ("unknown_field", "", "k % 13 = 0")))
def val_dataset(t: Tables):
    k = F.col("o_orderkey")
    urls = F.array(*[F.lit(u) for u in ("https://x.org/a", "ftp://x.org", "https://x.org/a b", None, "https://", "http://h:80/p", "HTTPS://u@h?q")])
    rows = t.orders.select(
        F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), F.lit("sv").alias("language"),
        F.when(k % 11 != 0, "Label").alias("label"),
        F.when(k % 4 == 0, iso(F.col("o_orderdate"))).when(k % 4 == 1, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .when(k % 4 == 2, "2024-13-01").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("updated"),
        F.lit("Annual").alias("time_unit"), F.when(k % 9 == 0, " ").alias("first_period"), F.lit(None).cast("string").alias("last_period"),
        F.get(urls, (k % 7).cast("int")).alias("source_url"), F.lit(None).cast("string").alias("doc_url"),
        F.when(k % 13 == 0, '{"label":"L","database_id":1}').otherwise('{"label":"L","identity":{}}').alias("body"))
    return quality.check_dataset(rows, ["dataset_code"], "body")


@query("val_axes", AXES, "d AS (SELECT DISTINCT dataset_code, block AS k FROM axis_rows)", sql=rules(
    "dataset_code", "d", ("empty", "id", "k % 5 = 4"), ("blank", "id", "k % 5 = 3"), ("duplicate", "id", "k % 5 = 1"),
    ("mismatch", "dimension", "k % 5 IN (2, 3, 4)")))
def val_axes(t: Tables):
    k, p = F.expr("cast(substring(dataset_code, 2) as int)"), F.col("payload")
    ids = (F.when(k % 5 == 1, F.concat(p["id"], F.array(F.lit("Tid")))).when(k % 5 == 2, F.slice(p["id"], 1, 2))
           .when(k % 5 == 3, F.concat(p["id"], F.array(F.lit(" ")))).when(k % 5 == 4, F.array().cast("array<string>")).otherwise(p["id"]))
    rows = landed.metadata_v2(t.v2_bodies).select("dataset_code", ids.alias("id"), F.map_keys(p["dimension"]).alias("dimension_keys"))
    return quality.check_axes(rows, ["dataset_code"])


def numbered(t: Tables):
    from kartotek.operators.numbering import ordinals

    return ordinals(t.axis_rows, ["dataset_code", "dim_id"], ["cat_id"])


@query("val_categories", AXES, """bad AS (
  SELECT dataset_code, dim_id, block, label, CASE WHEN block % 5 = 1 THEN ordinal + 1 WHEN block % 5 = 2 AND ordinal = 1 THEN 0 ELSE ordinal END AS o,
         block % 5 = 3 AND ordinal = 0 AS no_label FROM axis_rows)""", """facts AS (
  SELECT dataset_code, dim_id, count(*) AS n, count(DISTINCT o) AS d, min(o) AS lo, max(o) AS hi, bool_or(no_label) AS no_label FROM bad GROUP BY dataset_code, dim_id)""",
    sql=rules("dataset_code, dim_id", "facts", ("duplicate", "category/index", "d < n"), ("dense", "category/index", "lo <> 0 OR hi <> n - 1"), ("blank", "category/label", "no_label")))
def val_categories(t: Tables):
    b, o = F.col("block") % 5, F.col("ordinal")
    rows = numbered(t).withColumn("label", F.when((b == 3) & (o == 0), " ").otherwise(F.col("label"))).withColumn(
        "ordinal", F.when(b == 1, o + 1).when((b == 2) & (o == 1), 0).otherwise(o))
    return quality.check_categories(rows, ["dataset_code", "dim_id"])


@query("val_category_maps", """d AS (SELECT 'D' || (c_custkey // 20) AS dataset_code, 'c' || c_custkey AS cat_id, c_custkey AS k, c_mktsegment AS seg FROM customer)""",
       sql=rules("dataset_code, cat_id", "d", ("range", "coordinates/lon", "k % 400 > 380"), ("range", "coordinates/lat", "k % 200 > 190"),
                 ("enum", "unit/position", "seg NOT IN ('BUILDING', 'FURNITURE', 'MACHINERY')"), ("range", "unit/decimals", "k % 5 = 0"), ("unknown_category", "unit", "k % 17 = 0")))
def val_category_maps(t: Tables):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    details = t.customer.select(
        F.concat(F.lit("D"), div("c_custkey", 20).cast("string")).alias("dataset_code"), F.concat(F.lit("c"), k.cast("string")).alias("cat_id"),
        (k % 400 - 200).cast("double").alias("lon"), (k % 200 - 100).cast("double").alias("lat"),
        F.when(seg == "BUILDING", "start").when(seg == "FURNITURE", "end").when(seg != "MACHINERY", "middle").alias("position"),
        (k % 5 - 1).cast("int").alias("decimals"), k.alias("k"))
    details = details.withColumn("lon", F.when(F.col("lon") > 180, F.col("lon")).otherwise(F.greatest("lon", F.lit(-180.0)))).withColumn(
        "lat", F.when(F.col("lat") > 90, F.col("lat")).otherwise(F.greatest("lat", F.lit(-90.0))))
    known = details.select("dataset_code", F.when(F.col("k") % 17 == 0, F.concat(F.lit("x"), "cat_id")).otherwise(F.col("cat_id")).alias("cat_id"))
    ranges = quality.check_category_maps(details, ["dataset_code"])
    return ranges.unionByName(quality.unknown_keys(details, known, ["dataset_code"], "unit"))


@query("val_roles", AXES, "d AS (SELECT DISTINCT dataset_code, block AS k FROM axis_rows)", sql="""
SELECT dataset_code, 'metric' AS role_name, 'Typ' AS dim_id, 'order' AS rule, 'role' AS path FROM d WHERE k % 5 = 1
UNION ALL SELECT dataset_code, r.role, 'Tid', 'two_roles', 'role' FROM d, (VALUES ('geo'), ('time')) r(role) WHERE k % 5 = 2
UNION ALL SELECT dataset_code, 'geo', 'Nope', 'unknown_axis', 'role' FROM d WHERE k % 5 = 3
UNION ALL SELECT dataset_code, 'time', 'Tid', 'duplicate', 'role' FROM d WHERE k % 5 = 4""")
def val_roles(t: Tables):
    k = F.col("block") % 5

    def entry(role: str, pos: int, dim: str):
        return F.struct(F.lit(role).alias("role"), F.lit(pos).alias("role_pos"), F.lit(dim).alias("dim_id"))

    extra = (F.when(k == 1, entry("metric", 1, "Typ")).when(k == 2, entry("geo", 0, "Tid")).when(k == 3, entry("geo", 0, "Nope"))
             .when(k == 4, entry("time", 1, "Tid")))
    roles = F.array_compact(F.array(entry("time", 0, "Tid"), entry("metric", 0, "ContentsCode"), extra))
    rows = t.axes.filter("pos = 0").select("dataset_code", F.inline(roles))
    found = quality.check_roles(t.axes.select("dataset_code", "dim_id", "pos"), rows, "dataset_code")
    return found.withColumnRenamed("role", "role_name")


@query("val_pair", sql=f"""
SELECT {ORDER_ID} AS dataset_code, 'identity' AS rule, 'identity' AS path FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 10 = 0""")
def val_pair(t: Tables):
    def ident(language):
        return F.struct(F.lit("demo").alias("provider_code"), code("O", "o_orderkey").alias("dataset_code"), language.alias("language"))

    pairs = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        code("O", "o_orderkey").alias("dataset_code"), ident(F.lit("sv")).alias("left"),
        ident(F.when(F.col("c_custkey") % 10 == 0, "en").otherwise("sv")).alias("right"))
    return quality.check_pair(pairs, ["dataset_code"], F.col("left"), F.col("right"))


@query("val_discovery", sql="""
SELECT 'r' || (o_orderkey // 1000) AS run_id, 'D' || CASE WHEN o_orderkey % 25 = 24 THEN o_orderkey - 1 ELSE o_orderkey END AS dataset_code, 'outside_scope' AS rule FROM orders WHERE o_orderkey % 50 = 0
UNION ALL SELECT 'r' || (o_orderkey // 1000), 'D' || (o_orderkey - 1), 'duplicate' FROM orders WHERE o_orderkey % 25 = 24""")
def val_discovery(t: Tables):
    k = F.col("o_orderkey")
    run = F.concat(F.lit("r"), div("o_orderkey", 1000).cast("string"))
    cands = t.orders.select(
        run.alias("run_id"), F.when(k % 50 == 0, "other").otherwise("demo").alias("provider_code"), F.lit("sv").alias("language"),
        F.concat(F.lit("D"), F.when(k % 25 == 24, k - 1).otherwise(k).cast("string")).alias("dataset_code"))
    scopes = t.orders.select(run.alias("run_id"), F.lit("demo").alias("provider_code"), F.lit("sv").alias("language")).distinct()
    return quality.check_discovery(cands, scopes)


@query("val_metadata", f"d AS (SELECT {UNIT_ID} AS dataset_code, s_suppkey AS k FROM supplier)", sql=rules(
    "dataset_code", "d", ("empty", "subject", "k % 6 = 0"), ("blank", "subject/label", "k % 6 = 1"), ("empty", "paths", "k % 7 = 0"), ("blank", "paths/code", "k % 7 = 1"),
    ("blank", "paths/label", "k % 7 = 2"), ("enum", "retrieval/type", "k % 4 = 3"), ("required", "retrieval/config/data_url", "k % 4 IN (0, 1) AND k % 5 = 0"),
    ("unknown_field", "retrieval/config/data_url", "k % 4 = 2 AND k % 5 <> 0"), ("url", "metadata_url", "k % 9 = 0"), ("enum", "identity/language", "k % 4 = 2 AND k % 3 = 0")))
def val_metadata(t: Tables):
    k = F.col("s_suppkey")

    def node(c, label):
        return F.array(F.struct(c.alias("code"), label.alias("label")))

    a, none = F.lit("a"), F.lit(None).cast("string")
    path = F.when(k % 7 == 0, F.array().cast("array<struct<code:string,label:string>>")).when(k % 7 == 1, node(F.lit(" "), a)).when(k % 7 == 2, node(a, none)).otherwise(node(a, a))
    rows = t.supplier.select(
        code("V", "s_suppkey").alias("dataset_code"), F.when(k % 3 == 0, "en").otherwise("sv").alias("language"), (k % 6 != 5).alias("has_subject"),
        none.alias("subject_code"), F.when(k % 6 == 1, " ").when(k % 6 != 0, "Label").alias("subject_label"), F.array(path).alias("paths"),
        F.when(k % 4 == 0, "pxweb_v1").when(k % 4 == 1, "pxweb_v2").when(k % 4 == 2, "kolada").otherwise("other").alias("retrieval_type"),
        F.when(k % 5 != 0, "https://x.org/d").alias("data_url"), F.when(k % 9 == 0, "x.org").otherwise("https://x.org/m").alias("metadata_url"))
    return quality.check_metadata(rows, ["dataset_code"])


@query("val_inputs", "d AS (SELECT c_custkey, c_custkey AS k, c_mktsegment AS seg FROM customer)", sql=rules(
    "c_custkey", "d", ("enum", "adapter", "seg = 'MACHINERY'"), ("pattern", "provider_code", "k % 8 = 0"), ("enum", "language", "k % 6 = 5"),
    ("enum", "language", "seg = 'HOUSEHOLD' AND k % 6 <> 0"), ("range", "rate_limit", "k % 10 = 9"),
    ("required", "config/base_api_url", "seg IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') AND k % 7 = 0"),
    ("url", "config/base_api_url", "seg IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') AND k % 7 = 1"), ("unknown_field", "config/base_api_url", "seg = 'HOUSEHOLD' AND k % 7 <> 0"),
    ("required", "config/database_ids", "seg IN ('AUTOMOBILE', 'BUILDING') AND k % 5 = 0"), ("blank", "config/database_ids", "seg IN ('AUTOMOBILE', 'BUILDING') AND k % 5 = 1"),
    ("duplicate", "config/database_ids", "seg IN ('AUTOMOBILE', 'BUILDING') AND k % 5 = 2"), ("unknown_field", "config/database_ids", "seg NOT IN ('AUTOMOBILE', 'BUILDING') AND k % 5 <> 0"),
    ("positive", "config/extension/cell_limit", "k % 12 IN (1, 2)")))
def val_inputs(t: Tables):
    k, seg = F.col("c_custkey"), F.col("c_mktsegment")
    rows = t.customer.select(
        "c_custkey", F.when(seg.isin("AUTOMOBILE", "BUILDING"), "pxweb_v1").when(seg == "FURNITURE", "pxweb_v2").when(seg == "HOUSEHOLD", "kolada").otherwise("ftp").alias("adapter"),
        F.when(k % 8 == 0, "Bad Code").otherwise("demo").alias("provider_code"), F.when(k % 6 == 0, "sv").when(k % 6 == 5, "fi").otherwise("en").alias("language"),
        F.when(k % 10 == 9, -1.0).otherwise(0.5).alias("rate_limit"), F.when(k % 7 == 0, None).when(k % 7 == 1, "api.example.org").otherwise("https://api.example.org/x").alias("base_api_url"),
        F.when(k % 5 == 0, None).when(k % 5 == 1, F.array(F.lit("a"), F.lit(" "))).when(k % 5 == 2, F.array(F.lit("a"), F.lit("a"))).otherwise(F.array(F.lit("a"), F.lit("b"))).alias("database_ids"),
        F.when(k % 12 == 1, "0").when(k % 12 == 2, "many").when(k % 12 == 3, "5").alias("cell_limit"), F.lit(None).cast("string").alias("max_concurrency"))
    return quality.check_inputs(rows, ["c_custkey"])


@query("val_sample", AXES, "d AS (SELECT DISTINCT dataset_code, block AS k FROM axis_rows WHERE block % 5 <> 4)", sql=rules(
    "dataset_code", "d", ("axes", "id", "k % 7 = 1"), ("sizes", "size", "k % 7 = 2"), ("categories", "dimension/category/index", "k % 7 IN (2, 3)")))
def val_sample(t: Tables):
    """Samples against the selection; some selections ask for an axis, a third category or another id."""
    k = F.col("block") % 7
    ids = F.transform(F.slice("cats", 1, 2), lambda c: c["cat_id"])
    typ = F.col("dim_id") == "Typ"
    cats = F.when((k == 2) & typ, F.concat(ids, F.array(F.lit("more")))).when((k == 3) & typ, F.concat(F.slice(ids, 1, F.size(ids) - 1), F.array(F.lit("other")))).otherwise(ids)
    dims = F.when((k == 1) & typ, "Annan").otherwise(F.col("dim_id"))
    expected = t.axes.select("dataset_code", dims.alias("dim_id"), cats.alias("cat_ids"))
    return quality.check_sample(expected, landed.sample_v1(t.sample_bodies), "dataset_code")


STRUCTURE = """d AS (SELECT 'D' || (c_custkey // 20) AS dataset_code, CASE c_custkey % 20 WHEN 7 THEN ' ' WHEN 9 THEN 'd8' ELSE 'd' || (c_custkey % 20) END AS dim_id,
  c_custkey % 20 AS i, CASE WHEN c_custkey % 20 = 4 THEN 0 ELSE 2 END AS n FROM customer)"""


@query("val_structure", STRUCTURE, sql="""
SELECT dataset_code, dim_id, 'no_code' AS rule, 'code' AS path FROM d WHERE dim_id = ' '
UNION ALL SELECT dataset_code, dim_id, 'duplicate_code', 'code' FROM d WHERE dim_id <> ' ' GROUP BY dataset_code, dim_id HAVING count(*) > 1
UNION ALL SELECT dataset_code, dim_id, 'no_values', 'values' FROM d GROUP BY dataset_code, dim_id HAVING min(n) = 0
UNION ALL SELECT dataset_code, dim_id, 'empty_category', 'values' FROM d WHERE i = 2
UNION ALL SELECT dataset_code, dim_id, 'duplicate_category', 'values' FROM d WHERE i = 6""")
def val_structure(t: Tables):
    i = F.col("c_custkey") % 20
    dims = t.customer.select(
        F.concat(F.lit("D"), div("c_custkey", 20).cast("string")).alias("dataset_code"),
        F.when(i == 7, " ").when(i == 9, "d8").otherwise(F.concat(F.lit("d"), i.cast("string"))).alias("dim_id"),
        F.when(i == 4, 0).otherwise(2).alias("n_values"), i.alias("i"), F.col("c_custkey").alias("k"))
    values = F.when(F.col("i") == 2, F.array(F.lit("a"), F.lit(" "))).when(F.col("i") == 6, F.array(F.lit("a"), F.lit("a"))).when(
        F.col("n_values") > 0, F.array(F.concat(F.lit("a"), F.col("k").cast("string")), F.concat(F.lit("b"), F.col("k").cast("string"))))
    cats = dims.select("dataset_code", "dim_id", F.explode(values).alias("cat_id"))
    return quality.check_structure(dims, cats, "dataset_code")


@query("val_first", IDENTITIES, sql="""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'identity/dataset_code' WHEN language IS NULL THEN 'identity/language' ELSE 'identity/provider_code' END AS path,
       CASE WHEN c_custkey % 5 = 0 THEN 'blank' WHEN language IS NULL THEN 'enum' ELSE 'pattern' END AS rule,
       ((c_custkey % 5 = 0)::int + (language IS NULL)::int + (c_custkey % 4 IN (1, 3))::int)::bigint AS breaches
FROM ids WHERE c_custkey % 5 = 0 OR language IS NULL OR c_custkey % 4 IN (1, 3)""")
def val_first(t: Tables):
    return quality.first_violation(quality.check_identity(identities(t), ["c_custkey"]), ["c_custkey"])
