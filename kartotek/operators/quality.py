"""Data rules. Every breach is a row; nothing stops at the first one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.session import sorted_side

# Patterns of the contracts.
PROVIDER_CODE = r"^[a-z][a-z0-9]*(?:_[a-z0-9]+)*$"
HTTP_URL = r"^[hH][tT][tT][pP][sS]?://(?:[^/?#@]*@)?(?:\[[^\]]+\]|[^/?#:@]+)(?::[0-9]*)?(?:[/?#]|$)"
URI_CHARACTERS = r"^[A-Za-z0-9\-._~:/?#\[\]@!$&'()*+,;=%]*$"
COUNTRY_CODE = r"^[A-Z]{2}$"
LANGUAGES = ("sv", "en")
ADAPTERS = ("pxweb_v1", "pxweb_v2", "kolada")

Rule = tuple[str, str, Column]


def violations(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """One row per broken rule: (rule, field path, condition that is true when broken).
    A single pass: all rules are checked on the row and only breaches are exploded."""
    checks = [
        F.when(
            F.coalesce(broken, F.lit(False)),
            F.struct(F.lit(rule).alias("rule"), F.lit(path).alias("path")),
        )
        for rule, path, broken in rules
    ]
    return df.select(*keys, F.inline(F.array_compact(F.array(*checks))))


def blank(c: Column) -> Column:
    """Required text that is missing or blank."""
    return ~fn.has_id(c)


def present_but_blank(c: Column) -> Column:
    return c.isNotNull() & ~fn.has_id(c)


def bad_url(c: Column) -> Column:
    return c.isNotNull() & ~(c.rlike(HTTP_URL) & c.rlike(URI_CHARACTERS))


def identity_rules(prefix: str = "") -> list[Rule]:
    provider, code, language = (
        F.col(prefix + c) for c in ("provider_code", "dataset_code", "language")
    )
    return [
        ("pattern", "identity/provider_code", ~F.coalesce(provider.rlike(PROVIDER_CODE), F.lit(False))),
        ("blank", "identity/dataset_code", blank(code)),
        ("enum", "identity/language", ~F.coalesce(language.isin(*LANGUAGES), F.lit(False))),
    ]


def check_identity(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return violations(df, keys, identity_rules())


def bad_date(c: Column) -> Column:
    """Neither a calendar date nor a timestamp with a zone."""
    date = c.rlike(r"^\d{4}-\d{2}-\d{2}$")
    zoned = c.rlike(r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$")
    return c.isNotNull() & ~((date | zoned) & fn.parse_ts(F.upper(c)).isNotNull())


def dataset_rules() -> list[Rule]:
    return [
        ("blank", "label", blank(F.col("label"))),
        ("date", "updated", bad_date(F.col("updated"))),
        *[("blank", c, present_but_blank(F.col(c)))
          for c in ("time_unit", "first_period", "last_period")],
        *[("url", c, bad_url(F.col(c))) for c in ("source_url", "doc_url")],
    ]


def check_dataset(df: DataFrame, keys: Sequence[str], body: str | None = None) -> DataFrame:
    """Basic document rules; with ``body`` (the JSON text) also fields nobody knows."""
    rules = identity_rules() + dataset_rules()
    if "next_release" in df.columns:
        rules.append(("date", "next_release", bad_date(F.col("next_release"))))
    if body is not None:
        unknown = F.array_except(
            F.json_object_keys(body), F.array(*[F.lit(f) for f in DATASET_FIELDS])
        )
        rules.append(("unknown_field", "", F.size(unknown) > 0))
    return violations(df, keys, rules)


DATASET_FIELDS = (
    "identity", "label", "description", "updated", "next_release", "time_unit", "first_period",
    "last_period", "discontinued", "source_url", "doc_url", "extension",
)


def same_set(a: Column, b: Column) -> Column:
    """Equal as sets."""
    return F.array_sort(F.array_distinct(a)) == F.array_sort(F.array_distinct(b))


def check_axes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Axis list ``id`` against the keys of ``dimension`` (given as ``dimension_keys``)."""
    ids = F.col("id")
    return violations(
        df,
        keys,
        [
            ("empty", "id", F.coalesce(F.size(ids), F.lit(0)) == 0),
            ("blank", "id", F.exists(ids, lambda x: ~fn.has_id(x))),
            ("duplicate", "id", F.size(F.array_distinct(ids)) < F.size(ids)),
            ("mismatch", "dimension", ~same_set(ids, F.col("dimension_keys"))),
        ],
    )


def check_categories(cats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per axis: ordinals dense from zero and unique, labels present. Counts decide, so a
    long axis is reduced before the shuffle; duplicates show as too small a range."""
    n = F.count("*")
    facts = (
        cats.groupBy(*keys, "ordinal")
        .agg(n.alias("_n"), F.count_if(blank(F.col("label"))).alias("_blank"),
             F.count_if(blank(F.col("cat_id"))).alias("_no_id"))
        .groupBy(*keys)
        .agg(
            F.sum("_n").alias("_n"),
            F.count("*").alias("_distinct"),
            F.min("ordinal").alias("_min"),
            F.max("ordinal").alias("_max"),
            F.sum("_blank").alias("_blank"),
            F.sum("_no_id").alias("_no_id"),
        )
    )
    return violations(
        facts,
        keys,
        [
            ("duplicate", "category/index", F.col("_distinct") < F.col("_n")),
            ("dense", "category/index",
             (F.col("_min") != 0) | (F.col("_max") != F.col("_n") - 1)),
            ("blank", "category/label", F.col("_blank") > 0),
            ("blank", "category/index", F.col("_no_id") > 0),
        ],
    )


def unknown_keys(details: DataFrame, cats: DataFrame, keys: Sequence[str], path: str) -> DataFrame:
    """Side-map keys that name no category."""
    return (
        details.join(sorted_side(cats.select(*keys, "cat_id").distinct()), [*keys, "cat_id"], "left_anti")
        .select(*keys, "cat_id", F.lit("unknown_category").alias("rule"), F.lit(path).alias("path"))
    )


def check_category_maps(details: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coordinates in range, unit position and decimals allowed."""
    return violations(
        details,
        [*keys, "cat_id"],
        [
            ("range", "coordinates/lon", ~F.col("lon").between(-180, 180)),
            ("range", "coordinates/lat", ~F.col("lat").between(-90, 90)),
            ("enum", "unit/position", ~F.col("position").isin("start", "end")),
            ("range", "unit/decimals", F.col("decimals") < 0),
        ],
    )


def check_edges(edges: DataFrame, cats: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Hierarchy edges: both ends exist, no repeats, nobody is their own child."""
    counted = edges.groupBy(*keys, "parent", "child").agg(F.count("*").alias("_copies"))
    known = cats.select(*keys, "cat_id").distinct()

    def with_end(df: DataFrame, end: str) -> DataFrame:
        return df.join(
            known.select(*keys, F.col("cat_id").alias(end), F.lit(True).alias(f"_{end}_known")),
            [*keys, end],
            "left",
        )

    return violations(
        with_end(with_end(counted, "parent"), "child"),
        [*keys, "parent", "child"],
        [
            ("unknown_parent", "child", F.col("_parent_known").isNull()),
            ("unknown_child", "child", F.col("_child_known").isNull()),
            ("duplicate", "child", F.col("_copies") > 1),
            ("self", "child", F.col("parent") == F.col("child")),
        ],
    )


def check_roles(axes: DataFrame, roles: DataFrame, key: str) -> DataFrame:
    """Role rows (key, role, role_pos, dim_id) against axis positions: known axis, axis
    order kept, one role per axis, no repeats. Role lists are a document's few axes."""
    joined = roles.join(sorted_side(axes.select(key, "dim_id", "pos")), [key, "dim_id"], "left")
    in_role = Window.partitionBy(key, "role").orderBy("role_pos")
    per_axis = Window.partitionBy(key, "dim_id")
    marked = (
        joined.withColumn("_before", F.lag("pos").over(in_role))
        .withColumn("_roles", F.size(F.collect_set("role").over(per_axis)))
        .withColumn("_copies", F.count("*").over(Window.partitionBy(key, "dim_id", "role")))
    )
    return violations(
        marked,
        [key, "role", "dim_id"],
        [
            ("unknown_axis", "role", F.col("pos").isNull()),
            ("order", "role", F.col("pos") < F.col("_before")),
            ("two_roles", "role", F.col("_roles") > 1),
            ("duplicate", "role", F.col("_copies") > 1),
        ],
    ).distinct()


def check_pair(df: DataFrame, keys: Sequence[str], left: Column, right: Column) -> DataFrame:
    """Both documents, or the document and its candidate, carry the same identity."""
    return violations(df, keys, [("identity", "identity", ~left.eqNullSafe(right))])


def check_discovery(cands: DataFrame, scopes: DataFrame) -> DataFrame:
    """Candidates outside their run's scope, and codes found twice in one run."""
    keys = ["run_id", "provider_code", "language"]
    allowed = scopes.select(*keys).distinct()
    outside = cands.join(allowed, keys, "left_anti").select(
        "run_id", "dataset_code", F.lit("outside_scope").alias("rule")
    )
    twice = (
        cands.groupBy("run_id", "dataset_code")
        .agg(F.count("*").alias("_n"))
        .filter("_n > 1")
        .select("run_id", "dataset_code", F.lit("duplicate").alias("rule"))
    )
    return outside.unionByName(twice)


def metadata_rules() -> list[Rule]:
    """Detail document: subject, path nodes, retrieval and language."""
    kpi = F.col("retrieval_type") == "kolada"
    table = F.col("retrieval_type").isin("pxweb_v1", "pxweb_v2")
    return [
        ("empty", "subject", F.col("has_subject")
         & F.col("subject_code").isNull() & F.col("subject_label").isNull()),
        ("blank", "subject/code", present_but_blank(F.col("subject_code"))),
        ("blank", "subject/label", present_but_blank(F.col("subject_label"))),
        ("empty", "paths", F.exists("paths", lambda p: F.size(p) == 0)),
        ("blank", "paths/code", F.exists("paths", lambda p: F.exists(p, lambda n: blank(n["code"])))),
        ("blank", "paths/label", F.exists("paths", lambda p: F.exists(p, lambda n: blank(n["label"])))),
        ("enum", "retrieval/type", F.col("retrieval_type").isNotNull() & ~(kpi | table)),
        ("required", "retrieval/config/data_url", table & F.col("data_url").isNull()),
        ("unknown_field", "retrieval/config/data_url", kpi & F.col("data_url").isNotNull()),
        ("url", "retrieval/config/data_url", bad_url(F.col("data_url"))),
        ("url", "metadata_url", bad_url(F.col("metadata_url"))),
        ("enum", "identity/language", kpi & (F.col("language") != "sv")),
    ]


def check_metadata(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return violations(df, keys, metadata_rules())


def input_rules() -> list[Rule]:
    """Resolved inputs, by adapter."""
    adapter = F.col("adapter")
    v1, v2, kpi = (adapter == a for a in ADAPTERS)

    def bad_option(name: str) -> Column:
        number = F.col(name).try_cast("int")
        return F.col(name).isNotNull() & ~F.coalesce(number >= 1, F.lit(False))

    return [
        ("enum", "adapter", ~F.coalesce(adapter.isin(*ADAPTERS), F.lit(False))),
        ("pattern", "provider_code", ~F.coalesce(F.col("provider_code").rlike(PROVIDER_CODE), F.lit(False))),
        ("enum", "language", ~F.coalesce(F.col("language").isin(*LANGUAGES), F.lit(False))),
        ("enum", "language", kpi & (F.col("language") != "sv")),
        ("range", "rate_limit", F.col("rate_limit").isNull() | (F.col("rate_limit") < 0)),
        ("required", "config/base_api_url", (v1 | v2) & F.col("base_api_url").isNull()),
        ("url", "config/base_api_url", (v1 | v2) & bad_url(F.col("base_api_url"))),
        ("unknown_field", "config/base_api_url", kpi & F.col("base_api_url").isNotNull()),
        ("required", "config/database_ids",
         v1 & (F.coalesce(F.size("database_ids"), F.lit(0)) == 0)),
        ("blank", "config/database_ids", v1 & F.exists("database_ids", blank)),
        ("duplicate", "config/database_ids",
         v1 & (F.size(F.array_distinct("database_ids")) < F.size("database_ids"))),
        ("unknown_field", "config/database_ids", ~v1 & F.col("database_ids").isNotNull()),
        ("positive", "config/extension/cell_limit", bad_option("cell_limit")),
        ("positive", "config/extension/max_concurrency", bad_option("max_concurrency")),
    ]


def check_inputs(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return violations(df, keys, input_rules())


def check_providers(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Registry rows themselves: code, labels, country, website and configured languages."""
    h = F.col("harvest")

    def bad_labels(c: Column) -> Column:
        return (F.size(c) == 0) | F.exists(F.map_entries(c), lambda e: ~e["key"].isin(*LANGUAGES)
                                           | blank(e["value"]))

    return violations(
        df,
        keys,
        [
            ("pattern", "code", ~F.coalesce(F.col("code").rlike(PROVIDER_CODE), F.lit(False))),
            ("labels", "label", F.col("label").isNull() | bad_labels(F.col("label"))),
            ("labels", "description", bad_labels(F.col("description"))),
            ("pattern", "country_code", ~F.col("country_code").rlike(COUNTRY_CODE)),
            ("url", "website", bad_url(F.col("website"))),
            ("enum", "harvest/adapter", h.isNotNull()
             & ~F.coalesce(h["adapter"].isin(*ADAPTERS), F.lit(False))),
            ("languages", "harvest/languages", h.isNotNull() & (
                (F.coalesce(F.size(h["languages"]), F.lit(0)) == 0)
                | (F.size(F.array_distinct(h["languages"])) < F.size(h["languages"]))
                | F.exists(h["languages"], lambda x: ~x.isin(*LANGUAGES)))),
            ("languages", "harvest/languages", (h["adapter"] == "kolada")
             & F.exists(h["languages"], lambda x: x != "sv")),
            ("range", "harvest/rate_limit", h.isNotNull()
             & (h["rate_limit"].isNull() | (h["rate_limit"] < 0))),
        ],
    )


def check_sample(expected: DataFrame, samples: DataFrame, key: str) -> DataFrame:
    """Sample against what was asked for.

    ``expected``: one row per (key, dim_id) with the selected ``cat_ids``.
    ``samples``: one row per key with ``sample`` (ids, sizes, axis texts).
    """
    wanted = expected.groupBy(key).agg(
        F.collect_list(F.struct("dim_id", "cat_ids")).alias("_wanted")
    )
    s = F.col("sample")
    axis_ids = F.transform("_wanted", lambda w: w["dim_id"])
    wanted_cats = F.map_from_entries("_wanted")
    axis = "struct<category:struct<index:string,unit:map<string,variant>,note:map<string,variant>," \
           "coordinates:map<string,variant>>,extension:variant>"

    def parsed(d: Column) -> Column:
        return F.from_json(F.try_element_at(s["dimension"], d), axis)

    def index_ids(d: Column) -> Column:
        text = parsed(d)["category"]["index"]
        return F.when(
            F.trim(text).startswith("["), F.from_json(text, "array<string>")
        ).otherwise(F.map_keys(F.from_json(text, "map<string,int>")))

    def extra_ids(d: Column) -> Column:
        c = parsed(d)["category"]
        none = F.array().cast("array<string>")
        return F.flatten(F.array(*[F.coalesce(F.map_keys(c[f]), none)
                                   for f in ("unit", "note", "coordinates")]))

    sizes = F.transform(s["id"], lambda d: F.size(F.try_element_at(wanted_cats, d)))
    ids_ok = (
        same_set(s["id"], axis_ids)
        & (F.size(s["id"]) == F.size("_wanted"))
        & same_set(F.map_keys(s["dimension"]), axis_ids)
    )
    return violations(
        samples.join(sorted_side(wanted), key),
        [key],
        [
            ("axes", "id", ~F.coalesce(ids_ok, F.lit(False))),
            ("sizes", "size", ids_ok & ~F.coalesce(s["size"] == sizes, F.lit(False))),
            ("categories", "dimension/category/index", ids_ok & F.exists(
                axis_ids,
                lambda d: ~F.coalesce(same_set(index_ids(d), F.try_element_at(wanted_cats, d)),
                                      F.lit(False)))),
            ("unknown_category", "dimension/category", ids_ok & F.exists(
                axis_ids,
                lambda d: F.size(F.array_except(extra_ids(d), F.coalesce(
                    index_ids(d), F.array().cast("array<string>")))) > 0)),
            ("object", "dimension/extension", ids_ok & F.exists(
                axis_ids,
                lambda d: parsed(d)["extension"].isNotNull() & ~fn.is_object(parsed(d)["extension"]))),
        ],
    )


def check_structure(dims: DataFrame, cats: DataFrame, key: str) -> DataFrame:
    """Faults that make a payload unusable: an axis without code or values, a repeated
    code, an empty or repeated category id."""
    axes = dims.groupBy(key, "dim_id").agg(
        F.count("*").alias("_copies"), F.min("n_values").alias("_values")
    )
    axis_rows = violations(
        axes,
        [key, "dim_id"],
        [
            ("no_code", "code", blank(F.col("dim_id"))),
            ("duplicate_code", "code", ~blank(F.col("dim_id")) & (F.col("_copies") > 1)),
            ("no_values", "values", F.coalesce("_values", F.lit(0)) == 0),
        ],
    )
    ids = cats.groupBy(key, "dim_id", "cat_id").agg(F.count("*").alias("_copies"))
    category_rows = violations(
        ids,
        [key, "dim_id"],
        [
            ("empty_category", "values", blank(F.col("cat_id"))),
            ("duplicate_category", "values", ~blank(F.col("cat_id")) & (F.col("_copies") > 1)),
        ],
    ).distinct()
    return axis_rows.unionByName(category_rows)


def first_violation(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The breach a document would be refused for: first by field path."""
    return rows.groupBy(*keys).agg(
        F.min(F.struct("path", "rule")).alias("_first"), F.count("*").alias("breaches")
    ).select(*keys, "_first.path", "_first.rule", "breaches")
