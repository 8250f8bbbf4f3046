"""Readers for the KPI catalogue, its side tables and its observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek import schemas


def kpis(raw: DataFrame) -> DataFrame:
    """KPI records, cleaned; rows without an id are dropped."""
    k = F.col("k")
    description = fn.normalize_text(k["description"])
    return (
        raw.select(F.from_json("body", schemas.KPI).alias("k"))
        .filter(fn.has_id(k["id"]))
        .select(
            fn.strip(k["id"]).alias("kpi_id"),
            F.coalesce(fn.strip(k["title"]), F.lit("")).alias("title"),
            description.alias("description"),
            fn.truthy_variant(k["is_divided_by_gender"]).alias("is_divided_by_gender"),
            F.coalesce(fn.blank_to_null(k["municipality_type"]), F.lit("A")).alias("scope_type"),
            k["publication_date"].alias("publication_date"),
            k["prel_publication_date"].alias("prel_publication_date"),
            k["publ_period"].alias("publ_period"),
            fn.truthy_variant(k["has_ou_data"]).alias("has_ou_data"),
            fn.blank_to_null(k["operating_area"]).alias("operating_area"),
            fn.blank_to_null(k["perspective"]).alias("perspective"),
            fn.blank_to_null(k["auspice"]).alias("auspice"),
            F.when(k["description"] != description, k["description"]).alias("raw_description"),
        )
    )


def kpi_groups(raw: DataFrame) -> DataFrame:
    """KPI groups with their members trimmed, unique and sorted; ``fault`` names what makes
    a group unusable."""
    g = F.col("g")
    ident, title = (fn.string_only(F.try_variant_get(g, f"$.{k}", "variant")) for k in ("id", "title"))
    members = fn.as_array(F.try_variant_get(g, "$.members", "variant"))
    ids = F.transform(
        members, lambda m: fn.string_only(F.try_variant_get(m, "$.member_id", "variant"))
    )
    return raw.select(F.try_parse_json("body").alias("g")).select(
        fn.strip(ident).alias("group_id"),
        fn.strip(title).alias("title"),
        F.array_sort(F.array_distinct(F.transform(ids, fn.strip))).alias("member_ids"),
        F.when(~fn.has_id(ident), "id")
        .when(~fn.has_id(title) | members.isNull(), "shape")
        .when(~F.forall(ids, fn.has_id), "member")
        .alias("fault"),
    )


def areas(raw: DataFrame) -> DataFrame:
    a = F.col("a")
    return (
        raw.select(F.from_json("body", schemas.AREA).alias("a"))
        .filter(fn.has_id(a["id"]))
        .select(
            fn.strip(a["id"]).alias("area_id"),
            fn.strip(fn.first_truthy(a["title"], fn.strip(a["id"]))).alias("title"),
            F.coalesce(fn.strip(a["type"]), F.lit("")).alias("type"),
        )
    )


def units(raw: DataFrame) -> DataFrame:
    """Organisational units; both the unit and its owner must be named."""
    u = F.col("u")
    return (
        raw.select(F.from_json("body", schemas.UNIT).alias("u"))
        .filter(fn.has_id(u["id"]) & fn.has_id(u["municipality"]))
        .select(
            fn.strip(u["id"]).alias("ou_id"),
            fn.strip(fn.first_truthy(u["title"], fn.strip(u["id"]))).alias("title"),
            fn.strip(u["municipality"]).alias("area_id"),
        )
    )


def observations(raw: DataFrame, entity: str = "municipality") -> DataFrame:
    """Observation entries, one row per value. Entries without period or entity say nothing."""
    e = F.col("e")
    return (
        raw.select(F.explode(F.from_json("body", _PAGE)["values"]).alias("e"))
        .filter(e["period"].isNotNull() & e[entity].isNotNull())
        .select(
            e["kpi"].alias("kpi"),
            e["period"].alias("period"),
            e[entity].alias("entity"),
            F.inline(e["values"]),
        )
    )


_PAGE = f"struct<values:array<{schemas.OBSERVATION}>>"


def change_feed(raw: DataFrame, from_date: str) -> DataFrame:
    """KPIs named by change entries since a date. The date is compared in the column's own
    type, so the filter reaches the files and partitions."""
    kpi = fn.string_only(F.try_variant_get(F.try_parse_json("body"), "$.kpi", "variant"))
    return (
        raw.filter(F.col("changed_at") >= F.lit(from_date).cast(dict(raw.dtypes)["changed_at"]))
        .select(kpi.alias("kpi"))
        .filter(fn.has_id(F.col("kpi")))
        .distinct()
    )


def change_feed_faults(raw: DataFrame) -> DataFrame:
    """Change entries without a usable KPI id; any such row makes the feed unusable."""
    kpi = fn.string_only(F.try_variant_get(F.try_parse_json("body"), "$.kpi", "variant"))
    return raw.filter(~fn.has_id(kpi))
