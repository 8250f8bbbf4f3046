"""KPI catalogue: groups, dataset kinds, candidates and probe plans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators.numbering import batches
from kartotek.session import sorted_side

# Upstream codes and labels.
AREA_NODE = ("kolada:operating_area", "Verksamhetsområde")
GROUP_NODE = ("kolada:kpi_group", "Nyckeltalsgrupp")
NATIONAL_TOTAL = "0000"
SCOPE_TYPES = ("A", "K", "L")
API_URL = "https://api.kolada.se/v3"
WEB_URL = "https://kolada.se/verktyg/fri-sokning/"
FILTER_VALUES = 25


def members(groups: DataFrame) -> DataFrame:
    """(group, KPI) pairs, each once."""
    return (
        groups.filter("fault is null")
        .select("group_id", "title", F.explode("member_ids").alias("kpi_id"))
        .distinct()
    )


def with_groups(kpis: DataFrame, groups: DataFrame) -> DataFrame:
    """KPIs with their groups sorted by title and id. Members no KPI answers to fall out."""
    held = members(groups).groupBy("kpi_id").agg(
        F.array_sort(F.collect_set(F.struct("title", "group_id"))).alias("groups")
    )
    none = F.array().cast("array<struct<title:string,group_id:string>>")
    return kpis.join(sorted_side(held), "kpi_id", "left").withColumn("groups", F.coalesce("groups", none))


def unknown_members(groups: DataFrame, kpis: DataFrame) -> DataFrame:
    return members(groups).join(kpis.select("kpi_id").distinct(), "kpi_id", "left_anti")


def conflicting_groups(groups: DataFrame) -> DataFrame:
    """Group ids defined more than once with different content; equal repeats are fine."""
    content = F.sha2(F.to_json(F.struct("title", "member_ids")), 256)
    return (
        groups.groupBy("group_id")
        .agg(F.min(content).alias("_a"), F.max(content).alias("_b"), F.count("*").alias("copies"))
        .filter("_a <> _b")
        .drop("_a", "_b")
    )


def with_unit_data(kpis: DataFrame) -> DataFrame:
    return kpis.filter("has_ou_data")


def kpi_kinds(kpis: DataFrame) -> DataFrame:
    """One row per dataset kind of a KPI; the unit kind only where unit data exists."""
    kinds = F.when(F.col("has_ou_data"), F.array(F.lit("data"), F.lit("oudata"))).otherwise(
        F.array(F.lit("data"))
    )
    return kpis.withColumn("kind", F.explode(kinds)).withColumn(
        "dataset_code", fn.add_kind(F.col("kpi_id"), F.col("kind"))
    )


def candidates_kpi(kpis: DataFrame, year: int, api_url: str = API_URL) -> DataFrame:
    """Candidates of every KPI and kind; expects ``groups`` from :func:`with_groups`."""
    clause = fn.source_clause(F.col("description"), F.col("title"))
    retired = fn.retired_year(F.col("title"))
    subject = fn.subject_code(F.col("operating_area"))

    def node(code, label):
        return F.struct(code.alias("code"), label.alias("label"))

    area_path = F.when(
        subject.isNotNull(),
        F.array(
            node(F.lit(AREA_NODE[0]), F.lit(AREA_NODE[1])), node(subject, F.col("operating_area"))
        ),
    )
    group_paths = F.transform(
        "groups",
        lambda g: F.array(
            node(F.lit(GROUP_NODE[0]), F.lit(GROUP_NODE[1])), node(g["group_id"], g["title"])
        ),
    )
    paths = F.concat(F.array_compact(F.array(area_path)), group_paths)
    api = api_url.rstrip("/")
    return (
        kpis.withColumn("_clause", clause)
        .withColumn("_retired", retired)
        .transform(kpi_kinds)
        .select(
            "kpi_id",
            "kind",
            "dataset_code",
            F.lit("sv").alias("language"),
            F.col("title").alias("label"),
            "description",
            F.col("_clause.source").alias("source"),
            F.col("_clause.origin").alias("source_origin"),
            subject.alias("subject_code"),
            F.col("operating_area").alias("subject_label"),
            F.when(F.size(paths) > 0, paths).alias("paths"),
            F.col("_retired").alias("discontinued_year"),
            F.coalesce(F.col("_retired") <= year, F.lit(False)).alias("discontinued"),
            F.lit("Annual").alias("time_unit"),
            F.concat(F.lit(f"{api}/kpi/"), "kpi_id").alias("metadata_url"),
            F.concat(F.lit(f"{api}/"), "kind", F.lit("/kpi/"), "kpi_id").alias("data_url"),
            F.lit(WEB_URL).alias("web_url"),
            kpi_extension().alias("extension"),
        )
    )


def kpi_extension():
    """The KPI's own facts as an open object without NULLs."""
    return F.struct(
        "operating_area",
        "perspective",
        "auspice",
        F.col("scope_type").alias("municipality_type"),
        "has_ou_data",
        "is_divided_by_gender",
        "publ_period",
        "publication_date",
        "prel_publication_date",
        "raw_description",
        F.col("_clause.origin").alias("source_origin"),
        F.transform(
            "groups", lambda g: F.struct(g["group_id"].alias("id"), g["title"].alias("title"))
        ).alias("kpi_groups"),
        F.col("_retired").alias("discontinued_year"),
    )


def area_scopes(areas: DataFrame) -> DataFrame:
    """Which KPI scope types each area answers to: all for ``A``, its own type, and the
    national total for ``K`` as well."""
    scopes = F.array_distinct(
        F.array_compact(
            F.array(
                F.lit("A"),
                F.when(F.col("type").isin("K", "L"), F.col("type")),
                F.when(F.col("area_id") == NATIONAL_TOTAL, F.lit("K")),
            )
        )
    )
    return areas.select("area_id", F.explode(scopes).alias("scope_type"))


def probe_areas(kpis: DataFrame, areas: DataFrame) -> DataFrame:
    """Areas to ask for each KPI, an equality join on the scope type: every KPI meets only its
    own areas. A run joins :func:`area_scopes` where it needs them and never stores this."""
    scoped = area_scopes(areas)
    asked = kpis.filter(F.col("scope_type").isin(*SCOPE_TYPES)).select("kpi_id", "scope_type")
    return asked.join(scoped, "scope_type")


def unknown_scopes(kpis: DataFrame) -> DataFrame:
    return kpis.filter(~F.col("scope_type").isin(*SCOPE_TYPES)).select("kpi_id", "scope_type")


def year_batches(first: int, last: int, size: int = FILTER_VALUES) -> list[list[int]]:
    years = list(range(first, last + 1))
    return [years[i : i + size] for i in range(0, len(years), size)]


def probe_batches(
    areas: DataFrame,
    first_year: int,
    last_year: int,
    group: tuple[str, ...] = (),
    size: int = FILTER_VALUES,
    bounds: list | None = None,
) -> DataFrame:
    """Area batches times year batches. Years span a few decades, so each area batch simply
    explodes its handful of year batches."""
    base = areas if group else areas.withColumn("scope", F.lit("all"))
    keys = list(group) or ["scope"]
    numbered = batches(base, keys, ["area_id"], size, bounds)
    packed = numbered.groupBy(*keys, "batch_id").agg(
        F.array_sort(F.collect_list("area_id")).alias("area_ids")
    )
    spans = [
        F.struct(F.lit(i).alias("year_batch"), F.array(*[F.lit(y) for y in ys]).alias("years"))
        for i, ys in enumerate(year_batches(first_year, last_year, size))
    ]
    return packed.select("*", F.inline(F.array(*spans))) if spans else packed.filter(F.lit(False))


def with_titles(ids: DataFrame, titles: DataFrame, key: str = "cat_id") -> DataFrame:
    """Label of each category id; an unknown id labels itself."""
    names = titles.groupBy(F.col(titles.columns[0]).alias(key)).agg(
        F.max(titles.columns[1]).alias("_title")
    )
    return (
        ids.join(names, key, "left")
        .withColumn("label", F.coalesce("_title", key))
        .drop("_title")
    )


def unit_area(ids: DataFrame, units: DataFrame, areas: DataFrame) -> DataFrame:
    """Owner of each unit: an unknown unit has a blank owner, an unknown area is labelled by
    its own id."""
    owners = units.groupBy("ou_id").agg(F.max("area_id").alias("_area"))
    titles = areas.groupBy(F.col("area_id").alias("_area")).agg(F.max("title").alias("_label"))
    return (
        ids.join(owners, "ou_id", "left")
        .withColumn("_area", F.coalesce("_area", F.lit("")))
        .join(titles, "_area", "left")
        .withColumn("area_label", F.coalesce("_label", "_area"))
        .withColumnRenamed("_area", "area_id")
        .drop("_label")
    )
