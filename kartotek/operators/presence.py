"""Which periods and entities hold live values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek.operators.kpi import with_titles
from kartotek.operators.numbering import ordinals

PERIOD_DIM = "year"


def is_live(value: Column, isdeleted: Column) -> Column:
    """A value counts unless it is missing or marked deleted; no mark means not deleted."""
    return value.isNotNull() & ~F.coalesce(isdeleted, F.lit(False))


def live(observations: DataFrame) -> DataFrame:
    return observations.filter(is_live(F.col("value"), F.col("isdeleted")))


def presence(observations: DataFrame, entity_dim: str = "municipality") -> DataFrame:
    """Distinct categories with a live value: periods and entities are two separate sets.

    One scan: each live row offers both its categories, and the map-side half of the
    distinct drops repeats before anything is shuffled. The key holds the category, so a
    KPI with a third of all rows still spreads out.
    """
    offered = F.array(
        F.struct(F.lit(PERIOD_DIM).alias("dim_id"), F.col("period").cast("string").alias("cat_id")),
        F.struct(F.lit(entity_dim).alias("dim_id"), F.col("entity").alias("cat_id")),
    )
    return live(observations).select("kpi", F.inline(offered)).distinct()


def presence_sets(present: DataFrame, entity_dim: str = "municipality") -> DataFrame:
    """Both sets as sorted arrays, from already distinct rows (bounded by the catalogue)."""

    def collected(dim: str) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("dim_id") == dim, F.col("cat_id"))))

    return present.groupBy("kpi").agg(
        collected(PERIOD_DIM).alias("periods"), collected(entity_dim).alias("entities")
    )


def period_span(observations: DataFrame) -> DataFrame:
    """First and last live period."""
    return live(observations).groupBy("kpi").agg(
        F.min("period").alias("first_period"), F.max("period").alias("last_period")
    )


def label_span(labels: DataFrame, keys: list[str]) -> DataFrame:
    """First and last period of text labels, which compare as text."""
    return labels.groupBy(*keys).agg(
        F.min("label").alias("first_period"), F.max("label").alias("last_period")
    )


def sort_periods(periods: Column) -> Column:
    """Whole years by number, labels as text."""
    return F.array_sort(periods)


def require_presence(kpis: DataFrame, present: DataFrame) -> DataFrame:
    """KPIs without any live value; their datasets fail."""
    return kpis.join(present.select(F.col("kpi").alias("kpi_id")).distinct(), "kpi_id", "left_anti")


def categories(present: DataFrame, titles: DataFrame, bounds: list | None = None) -> DataFrame:
    """Category rows with dense ordinals in id order and labels.

    ``present`` is already distinct, so one dimension holds at most the catalogue's areas
    and the years on record, however many rows a KPI has. For long catalogues (units) give
    ``bounds``, which cut the ids into ranges."""
    numbered = ordinals(present, ["kpi", "dim_id"], ["cat_id"], "ordinal", bounds)
    return with_titles(numbered, titles)
