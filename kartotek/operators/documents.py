"""Finished documents, their JSON form, and the scopes of the registry."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators.kpi import API_URL
from kartotek.session import sorted_side

DEFAULT_CELL_LIMIT = 5000


def identity(provider: Column, dataset: Column, language: Column) -> Column:
    return F.struct(
        provider.alias("provider_code"), dataset.alias("dataset_code"), language.alias("language")
    )


def iso_utc(ts: Column) -> Column:
    """Instant as ISO text in UTC, fraction only when there is one."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.concat(whole, F.when(fraction == ".000000", "").otherwise(fraction), F.lit("Z"))


def dataset_doc(candidates: DataFrame, spans: DataFrame | None = None,
                key: str = "dataset_code") -> DataFrame:
    """Basic document of each candidate; periods found in the payload fill those the
    listing lacks."""
    df = candidates
    if spans is not None:
        found = spans.select(key, F.col("first_period").cast("string").alias("_first"),
                             F.col("last_period").cast("string").alias("_last"))
        df = (
            df.join(sorted_side(found), key, "left")
            .withColumn("first_period", F.coalesce("first_period", "_first"))
            .withColumn("last_period", F.coalesce("last_period", "_last"))
        )
    doc = F.struct(
        identity(F.col("provider_code"), F.col(key), F.col("language")).alias("identity"),
        fn.first_truthy(F.col("label"), F.col(key)).alias("label"),
        F.col("description"),
        iso_utc(F.col("updated")).alias("updated"),
        F.coalesce("time_unit", fn.time_unit(F.col("first_period"), F.col("last_period"))).alias(
            "time_unit"
        ),
        fn.first_truthy(F.col("first_period")).alias("first_period"),
        fn.first_truthy(F.col("last_period")).alias("last_period"),
        F.col("discontinued"),
        fn.encoded_url(F.col("web_url")).alias("source_url"),
    )
    return df.select(key, doc.alias("dataset"))


def nested_dimensions(dims: DataFrame, cats: DataFrame, key: str = "dataset_code") -> DataFrame:
    """Axis ids, dimension objects and role lists of each dataset. Notes, links, open fields
    and category details are taken along where the rows have them.

    A document is one row by nature; both collects run on finished category rows, and
    each gathers one document's axis, never a table's group of raw rows."""
    details = [c for c in ("unit", "note", "coordinates") if c in cats.columns]
    row = F.struct("ordinal", "cat_id", "label", *details)
    entries = cats.groupBy(key, "dim_id").agg(
        F.array_sort(F.collect_list(row), lambda a, b: (a["ordinal"] - b["ordinal"]).cast("int")).alias("_cats")
    )

    def side(field: str) -> Column:
        return F.map_from_entries(F.transform("_cats", lambda c: F.struct(c["cat_id"], c[field])))

    def partial(field: str) -> Column:
        held = F.filter("_cats", lambda c: c[field].isNotNull())
        return F.when(
            F.size(held) > 0,
            F.map_from_entries(F.transform(held, lambda c: F.struct(c["cat_id"], c[field]))),
        )

    category = F.struct(
        side("ordinal").alias("index"), side("label").alias("label"),
        *[partial(d).alias(d) for d in details],
    )
    fixed = F.create_map(F.lit("elimination"), F.col("elimination").cast("variant"))
    open_fields = fn.overlay(F.col("extras"), fixed) if "extras" in dims.columns else fixed
    axis = F.struct(
        F.col("label").alias("label"), category.alias("category"),
        *[F.col(c) for c in ("note", "link") if c in dims.columns],
        open_fields.alias("extension"),
    )
    rows = dims.join(sorted_side(entries), [key, "dim_id"]).select(key, "pos", "dim_id", "role", axis.alias("axis"))
    ordered = rows.groupBy(key).agg(
        F.sort_array(F.collect_list(F.struct("pos", "dim_id", "role"))).alias("d"),
        F.map_from_entries(F.collect_list(F.struct("dim_id", "axis"))).alias("dimension"),
    )

    def role(name: str) -> Column:
        ids = F.transform(F.filter("d", lambda x: x["role"] == name), lambda x: x["dim_id"])
        return F.when(F.size(ids) > 0, ids).alias(name)

    has_role = F.exists("d", lambda x: x["role"].isNotNull())
    return ordered.select(
        key,
        F.transform("d", lambda x: x["dim_id"]).alias("id"),
        "dimension",
        F.when(has_role, F.struct(*[role(r) for r in fn.ROLES])).alias("role"),
    )


def subject(code: Column, label: Column) -> Column:
    """Subject object, present only when it says something."""
    code, label = fn.first_truthy(code), fn.first_truthy(label)
    return F.when(
        code.isNotNull() | label.isNotNull(), F.struct(code.alias("code"), label.alias("label"))
    )


def retrieval(adapter: Column, data_url: Column) -> Column:
    """How to fetch the data: an address for table services, nothing for KPIs."""
    url = F.when(adapter != "kolada", fn.encoded_url(data_url))
    return F.struct(adapter.alias("type"), F.struct(url.alias("data_url")).alias("config"))


def metadata_doc(candidates: DataFrame, nested: DataFrame, key: str = "dataset_code") -> DataFrame:
    """Detail document of each candidate whose dimensions are known."""
    doc = F.struct(
        identity(F.col("provider_code"), F.col(key), F.col("language")).alias("identity"),
        F.col("id"),
        F.col("dimension"),
        F.col("role"),
        subject(F.col("subject_code"), F.col("subject_label")).alias("subject"),
        F.transform("paths", lambda p: F.struct(p.alias("path"))).alias("paths"),
        F.col("official_statistics"),
        F.col("source"),
        F.col("note"),
        *([F.col("contact")] if "contact" in candidates.columns else []),
        fn.encoded_url(F.col("metadata_url")).alias("metadata_url"),
        retrieval(F.col("adapter"), F.col("data_url")).alias("retrieval"),
        F.col("extension"),
    )
    return candidates.join(sorted_side(nested), key).select(key, doc.alias("metadata"))


def to_json_pair(pairs: DataFrame) -> DataFrame:
    """Canonical JSON. Modelled NULLs vanish; NULLs inside a VARIANT extension stay."""
    return pairs.withColumn("documents", F.to_json(F.struct("dataset", "metadata")))


def metadata_url(links: Column, language: Column, fallback: Column) -> Column:
    """Address of the first metadata link in this language, else the constructed one."""
    listed = F.try_variant_get(links, "$", "array<struct<rel:string,hreflang:string,href:string>>")
    fitting = F.filter(
        listed,
        lambda x: (x["rel"] == "metadata") & (x["hreflang"] == language) & (x["href"] != ""),
    )
    return F.coalesce(F.try_element_at(fitting, F.lit(1))["href"], fallback)


def scopes(providers: DataFrame) -> DataFrame:
    """One resolved input per provider and configured language."""
    h = F.col("harvest")
    extension = h["config"]["extension"]
    return providers.filter(h.isNotNull()).select(
        F.col("code").alias("provider_code"),
        h["adapter"].alias("adapter"),
        F.explode(h["languages"]).alias("language"),
        h["rate_limit"].alias("rate_limit"),
        F.when(h["adapter"] == "kolada", F.lit(API_URL))
        .otherwise(h["config"]["base_api_url"])
        .alias("base_api_url"),
        extension["base_web_url"].alias("base_web_url"),
        F.coalesce(extension["cell_limit"].try_cast("int"), F.lit(DEFAULT_CELL_LIMIT)).alias(
            "cell_limit"
        ),
    )
