"""Role detection and role buckets."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartotek.functions.text import compact_strings, strip

# Role vocabularies (Swedish, English, Finnish).
TIME_WORDS = (
    "time",
    "tid",
    "år",
    "månad",
    "vecka",
    "kvartal",
    "period",
    "year",
    "quarter",
    "month",
    "vuosi",
    "time period",
)
GEO_WORDS = (
    "geo",
    "region",
    "land",
    "kommun",
    "county",
    "municipality",
    "country",
    "area",
    "location",
)
METRIC_WORDS = (
    "unit",
    "innehåll",
    "tabellinnehåll",
    "mått",
    "contents",
    "measure",
    "metric",
    "value",
    "contentscode",
    "content",
    "enhet",
)
ROLES = ("time", "geo", "metric")


def detect_role(code: Column, label: Column, is_time: Column) -> Column:
    """Time flag first, then metric, geo and time words in the code or the label."""
    code, label = F.lower(strip(code)), F.lower(strip(label))

    def known(words: tuple[str, ...]) -> Column:
        return code.isin(*words) | label.isin(*words)

    return (
        F.when(F.coalesce(is_time, F.lit(False)), "time")
        .when(known(METRIC_WORDS), "metric")
        .when(known(GEO_WORDS), "geo")
        .when(known(TIME_WORDS), "time")
    )


def normalize_role(v: Column) -> Column:
    """VARIANT role object -> struct of trimmed lists; a bucket without ids is NULL."""

    def bucket(name: str) -> Column:
        ids = compact_strings(F.try_variant_get(v, f"$.{name}", "array<string>"))
        return F.when(F.size(ids) > 0, ids).alias(name)

    return F.struct(*[bucket(r) for r in ROLES])


def role_conflicts(roles: Column) -> Column:
    """Ids that sit in more than one bucket."""
    none = F.array().cast("array<string>")
    t, g, m = (F.coalesce(roles[r], none) for r in ROLES)
    return F.array_sort(
        F.array_distinct(
            F.concat(F.array_intersect(t, g), F.array_intersect(t, m), F.array_intersect(g, m))
        )
    )
