"""The adapter seam: a name decides which reader turns landed rows into candidates."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn

Adapter = Callable[[DataFrame], DataFrame]
ADAPTERS: dict[str, Adapter] = {}


def register(name: str) -> Callable[[Adapter], Adapter]:
    """Add an adapter under a case-insensitive name."""

    def add(adapter: Adapter) -> Adapter:
        ADAPTERS[name.strip().lower()] = adapter
        return adapter

    return add


def get_adapter(name: str, adapters: Mapping[str, Adapter] | None = None) -> Adapter:
    known = ADAPTERS if adapters is None else adapters
    try:
        return known[name.strip().lower()]
    except KeyError:
        raise ValueError(f"unknown adapter {name!r}; known: {sorted(known)}") from None


def dispatch(rows: DataFrame, adapters: Mapping[str, Adapter] | None = None) -> DataFrame:
    """Send each row to the adapter it names and unite the candidates."""
    known = ADAPTERS if adapters is None else adapters
    name = F.lower(fn.strip(F.col("adapter")))
    result = None
    for key, adapter in known.items():
        part = adapter(rows.filter(name == key)).withColumn("adapter", F.lit(key))
        result = part if result is None else result.unionByName(part, allowMissingColumns=True)
    return result


def unknown_adapters(rows: DataFrame, adapters: Mapping[str, Adapter] | None = None) -> DataFrame:
    known = list(ADAPTERS if adapters is None else adapters)
    name = F.lower(fn.strip(F.col("adapter")))
    return rows.filter(~F.coalesce(name.isin(*known), F.lit(False)))


@register("pxweb_v2")
def _tables_v2(rows: DataFrame) -> DataFrame:
    text = F.col("entry")
    code = fn.strip(fn.text_at(text, "$.id"))
    return rows.filter(fn.has_id(code)).select(
        "scope",
        code.alias("dataset_code"),
        fn.first_truthy(fn.text_at(text, "$.label"), fn.text_at(text, "$.title"), code).alias("label"),
        fn.parse_ts(fn.string_only(F.try_variant_get(text, "$.updated", "variant"))).alias("updated"),
    )


@register("pxweb_v1")
def _tables_v1(rows: DataFrame) -> DataFrame:
    text = F.col("entry")
    code = fn.string_only(F.try_variant_get(text, "$.id", "variant"))
    stamp = F.coalesce(*[fn.parse_ts(fn.text_at(text, f"$.{k}")) for k in ("updated", "published")])
    tokens = fn.path_tokens(fn.text_at(text, "$.path"))
    return rows.filter(code.isNotNull() & stamp.isNotNull()).select(
        "scope",
        code.alias("dataset_code"),
        fn.first_truthy(fn.text_at(text, "$.title"), code).alias("label"),
        stamp.alias("updated"),
        F.try_element_at(tokens, F.lit(-1)).alias("subject_code"),
    )


@register("kolada")
def _kpis(rows: DataFrame) -> DataFrame:
    text = F.col("entry")
    code = fn.strip(fn.text_at(text, "$.id"))
    units = fn.truthy_variant(F.try_variant_get(text, "$.has_ou_data", "variant"))
    kinds = F.when(units, F.array(F.lit("data"), F.lit("oudata"))).otherwise(F.array(F.lit("data")))
    return rows.filter(fn.has_id(code)).withColumn("kind", F.explode(kinds)).select(
        "scope",
        fn.add_kind(code, F.col("kind")).alias("dataset_code"),
        fn.strip(fn.text_at(text, "$.title")).alias("label"),
        fn.subject_code(fn.blank_to_null(fn.text_at(text, "$.operating_area"))).alias("subject_code"),
    )
