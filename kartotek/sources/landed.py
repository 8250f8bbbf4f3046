"""Readers for landed catalogue and metadata responses.

Each reader takes rows with a ``body`` and keeps the order of the source as
``(page_no, item_pos)``, because "first" means first in the listing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn


def _parsed(raw: DataFrame) -> DataFrame:
    return raw.withColumn("_v", F.try_parse_json("body"))


def _all_objects(items: Column) -> Column:
    return items.isNotNull() & F.forall(items, fn.is_object)


def quarantine(raw: DataFrame, accepted: Column, reason: str) -> DataFrame:
    """Bodies a reader cannot use, kept whole for inspection."""
    return raw.filter(~F.coalesce(accepted, F.lit(False))).withColumn("reason", F.lit(reason))


def split_responses(raw: DataFrame, is_root: Column) -> dict[str, DataFrame]:
    """Usable responses, tolerated gaps (a 400/404 below the root) and fatal ones."""
    usable = F.coalesce(F.col("status").between(200, 299), F.lit(False))
    gap = F.coalesce(F.col("status").isin(400, 404), F.lit(False)) & ~is_root
    return {
        "ok": raw.filter(usable),
        "dropped": raw.filter(~usable & gap),
        "fatal": raw.filter(~usable & ~gap),
    }


def response_class(status: Column, is_root: Column) -> Column:
    """The same three-way split as a column."""
    return (
        F.when(status.between(200, 299), "ok")
        .when(status.isin(400, 404) & ~is_root, "dropped")
        .otherwise("fatal")
    )


def listing_pages(raw: DataFrame) -> DataFrame:
    """One row per listing page: its number, the promised total and whether it is usable."""
    v = F.col("_v")
    number = F.coalesce(F.try_variant_get(v, "$.page.pageNumber", "int"), F.col("page_no"))
    total = F.coalesce(F.try_variant_get(v, "$.page.totalPages", "int"), number)
    tables = F.try_variant_get(v, "$.tables", "array<variant>")
    return _parsed(raw).select(
        "scope",
        "page_no",
        number.alias("page_number"),
        total.alias("total_pages"),
        tables.isNotNull().alias("usable"),
    )


def listing_v2(raw: DataFrame) -> DataFrame:
    """Table entries of the listing pages as JSON text, so that key order inside them
    survives; entries that are no objects are dropped."""
    tables = F.from_json("body", "struct<tables:array<string>>")["tables"]
    return raw.select(
        "scope", "page_no", F.posexplode(tables).alias("item_pos", "entry")
    ).filter(F.trim("entry").startswith("{"))


def paged_values(raw: DataFrame) -> DataFrame:
    """Entries of ``values[]`` envelopes, from pages whose values are all objects."""
    values = F.try_variant_get(F.col("_v"), "$.values", "array<variant>")
    return (
        _parsed(raw)
        .withColumn("_values", values)
        .filter(_all_objects(F.col("_values")))
        .select("feed", "url", "page_no", F.posexplode("_values").alias("item_pos", "value"))
    )


def page_links(raw: DataFrame) -> DataFrame:
    """One row per landed page with its resolved next link and its faults."""
    link = F.try_variant_get(F.col("_v"), "$.next_url", "variant")
    text = fn.string_only(link)
    values = F.try_variant_get(F.col("_v"), "$.values", "array<variant>")
    return (
        _parsed(raw)
        .withColumn("_link", link)
        .select(
            "feed",
            "url",
            F.when(fn.has_id(text), fn.url_join(F.col("url"), text)).alias("next_url"),
            F.when(~F.coalesce(_all_objects(values), F.lit(False)), "values")
            .when(~fn.is_json_null(F.col("_link")) & ~fn.has_id(text), "link")
            .alias("fault"),
        )
    )


def flat_catalog(raw: DataFrame) -> DataFrame:
    """Flat catalogue entries; an entry needs text for both id and path."""
    items = fn.as_array(F.col("_v"))
    entry = F.col("entry")
    score = F.try_variant_get(entry, "$.score", "double")
    return (
        _parsed(raw)
        .withColumn("_items", items)
        .filter(_all_objects(F.col("_items")))
        .select("scope", "page_no", F.posexplode("_items").alias("item_pos", "entry"))
        .select(
            "scope",
            "page_no",
            "item_pos",
            fn.string_only(F.try_variant_get(entry, "$.id", "variant")).alias("id"),
            fn.string_only(F.try_variant_get(entry, "$.path", "variant")).alias("path"),
            fn.text_at(entry, "$.title").alias("title"),
            fn.strip(fn.text_at(entry, "$.published")).alias("published"),
            fn.strip(fn.text_at(entry, "$.updated")).alias("updated"),
            score.alias("score"),
        )
    )


def flat_faults(entries: DataFrame) -> DataFrame:
    """Flat entries without text for id or path; any such row makes the list unusable."""
    return entries.filter(F.col("id").isNull() | F.col("path").isNull())


def nav_entries(raw: DataFrame) -> DataFrame:
    """Folder (``l``) and table (``t``) rows of landed folder listings. ``text`` is NULL when
    the entry has none, so that each use can fall back in its own way."""
    entry = F.col("entry")
    ident = fn.string_only(F.try_variant_get(entry, "$.id", "variant"))
    name = fn.string_only(F.try_variant_get(entry, "$.text", "variant"))
    return (
        _parsed(raw)
        .select(
            "parent_path",
            F.posexplode(fn.as_array(F.col("_v"))).alias("item_pos", "entry"),
        )
        .select(
            "parent_path",
            "item_pos",
            ident.alias("id"),
            fn.squeeze(name).alias("text"),
            fn.text_at(entry, "$.type").alias("type"),
            fn.strip(fn.text_at(entry, "$.updated")).alias("updated"),
        )
        .filter(F.col("type").isin("l", "t") & fn.has_id(F.col("id")))
    )


def metadata_v1(raw: DataFrame, key: str = "dataset_code") -> DataFrame:
    """Variables of v1 metadata payloads, one row each, as open objects."""
    variables = F.try_variant_get(F.col("_v"), "$.variables", "array<variant>")
    title = fn.string_only(F.try_variant_get(F.col("_v"), "$.title", "variant"))
    return _parsed(raw).select(
        key,
        fn.blank_to_null(title).alias("title"),
        F.posexplode(variables).alias("var_pos", "variable"),
    )


def metadata_v2(raw: DataFrame, key: str = "dataset_code") -> DataFrame:
    """JSON-stat2 metadata payloads. Axis objects stay JSON text so that the order of
    their keys survives."""
    return raw.select(
        key,
        F.from_json(
            "body",
            "struct<id:array<string>,role:string,dimension:map<string,string>,"
            "note:variant,extension:variant>",
        ).alias("payload"),
    )


def sample_v1(raw: DataFrame, key: str = "dataset_code") -> DataFrame:
    """Sample responses that are JSON-stat2 datasets of version 2.0."""
    parsed = raw.withColumn("sample", F.from_json("body", _SAMPLE))
    return parsed.filter(sample_accepted(F.col("sample"))).select(key, "sample")


def sample_rejects(raw: DataFrame) -> DataFrame:
    parsed = raw.withColumn("sample", F.from_json("body", _SAMPLE))
    return quarantine(parsed, sample_accepted(F.col("sample")), "not a JSON-stat2 dataset").drop(
        "sample"
    )


def sample_accepted(sample: Column) -> Column:
    return F.coalesce((sample["class"] == "dataset") & (sample["version"] == "2.0"), F.lit(False))


_SAMPLE = (
    "struct<class:string,version:string,id:array<string>,size:array<int>,"
    "dimension:map<string,string>,source:variant,note:variant,extension:variant>"
)
