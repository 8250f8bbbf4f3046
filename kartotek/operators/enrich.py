"""Sample responses and payload fields merged into what is already known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.session import sorted_side

# The synthetic contents axis and its placeholder category.
CONTENTS = "ContentsCode"
PLACEHOLDER = "EliminatedValue"

_MAP = "map<string,variant>"


def merge_metadata(candidates: DataFrame, payload: DataFrame, key: str) -> DataFrame:
    """Listing defaults with the payload's fields: note, official flag and contact of the
    payload win when present, the listing's subject label stays, and extensions are united
    with the payload on top, its ``contact`` left out.

    ``payload`` holds ``key``, ``note`` and ``extension`` (both VARIANT)."""
    p = payload.select(key, F.col("note").alias("_note"), fn.as_map(F.col("extension")).alias("_x"))
    px = fn.as_map(F.try_element_at("_x", F.lit("px")))
    area = F.try_element_at(px, F.lit("subject-area")).try_cast("string")
    official = F.try_element_at(px, F.lit("official-statistics"))
    contact = F.try_element_at("_x", F.lit("contact"))
    return (
        candidates.join(sorted_side(p), key, "left")
        .withColumn("note", F.coalesce(fn.normalize_note(F.col("_note")), "note"))
        .withColumn("subject_label", fn.first_truthy(F.col("subject_label"), area))
        .withColumn(
            "official_statistics",
            F.when(fn.is_json_null(official), F.col("official_statistics")).otherwise(
                fn.coerce_bool_variant(official)
            ),
        )
        .withColumn("contact", F.coalesce(fn.normalize_contact(contact), "contact"))
        .withColumn(
            "extension",
            fn.overlay(F.col("extension"), F.map_filter("_x", lambda k, v: k != "contact")),
        )
        .drop("_note", "_x")
    )


def promote_px(docs: DataFrame, sample: DataFrame, key: str) -> DataFrame:
    """Sample fields that overwrite the GET document: px facts, source and note. Texts that
    are blank or no text, and flags that cannot be read, are ignored.

    ``sample`` holds ``key``, ``px``, ``source`` and ``note`` (all VARIANT)."""
    s = sample.select(key, fn.as_map(F.col("px")).alias("_px"),
                      F.col("source").alias("_source"), F.col("note").alias("_note"))

    def text(name: str) -> Column:
        value = fn.string_only(F.try_element_at("_px", F.lit(name)))
        return F.when(fn.has_id(value), value)

    kept = F.map_filter("_px", lambda k, v: ~k.isin("heading", "stub"))
    return (
        docs.join(sorted_side(s), key, "left")
        .withColumn("description", F.coalesce(text("description"), "description"))
        .withColumn("subject_code", F.coalesce(text("subject-code"), "subject_code"))
        .withColumn("subject_label", F.coalesce(text("subject-area"), "subject_label"))
        .withColumn(
            "official_statistics",
            F.coalesce(
                fn.coerce_bool_variant(F.try_element_at("_px", F.lit("official-statistics"))),
                "official_statistics",
            ),
        )
        .withColumn("source", F.coalesce(fn.string_only(F.col("_source")), "source"))
        .withColumn("note", F.coalesce(fn.normalize_note(F.col("_note")), "note"))
        .withColumn("px", F.when(F.size(kept) > 0, kept))
        .drop("_px", "_source", "_note")
    )


def enrich_dimensions(dims: DataFrame, sampled: DataFrame, keys: list[str]) -> DataFrame:
    """Note and link come from the sample; inside the extension the GET document wins."""
    s = sampled.select(
        *keys, F.col("note").alias("_note"), F.col("link").alias("_link"),
        F.col("extras").alias("_extras"),
    )
    return (
        dims.join(sorted_side(s), keys, "left")
        .withColumn("note", F.coalesce("_note", "note"))
        .withColumn("link", F.coalesce("_link", "link"))
        .withColumn("extras", fn.overlay(F.col("_extras"), F.col("extras")))
        .drop("_note", "_link", "_extras")
    )


def enrich_categories(cats: DataFrame, details: DataFrame, keys: list[str]) -> DataFrame:
    """Unit, note and coordinates of the sampled categories."""
    fields = [c for c in details.columns if c not in keys]
    s = details.select(*keys, *[F.col(c).alias(f"_{c}") for c in fields])
    joined = cats.join(sorted_side(s), keys, "left")
    for c in fields:
        found = F.col(f"_{c}")
        joined = joined.withColumn(c, F.coalesce(found, c) if c in cats.columns else found)
    return joined.drop(*[f"_{c}" for c in fields])


def fix_placeholder(samples: DataFrame) -> DataFrame:
    """Synthetic contents axis of a sample: dropped when the GET document has none, renamed
    to the only real code when it has exactly one, else left to the checks.

    ``samples`` holds ``sample`` (ids, sizes, axis texts) and ``contents``: the real codes
    of the GET document's contents axis, NULL when it has none."""
    s = F.col("sample")
    axis = F.from_json(F.try_element_at(s["dimension"], F.lit(CONTENTS)), _MAP)
    category = fn.as_map(F.try_element_at(axis, F.lit("category")))
    index = F.to_json(F.try_element_at(category, F.lit("index")))
    marked = F.coalesce(
        index.isin('{"%s":0}' % PLACEHOLDER, '["%s"]' % PLACEHOLDER), F.lit(False)
    )
    drop = marked & F.col("contents").isNull()
    rename = marked & (F.size("contents") == 1)
    at = F.array_position(s["id"], F.lit(CONTENTS))
    real = F.element_at("contents", 1)

    def renamed(m: Column) -> Column:
        return F.to_variant_object(F.transform_keys(m, lambda k, v: real))

    side_maps = ("unit", "note", "coordinates")
    stray = F.exists(
        F.array(*[F.coalesce(F.map_keys(fn.as_map(F.try_element_at(category, F.lit(f)))),
                             F.array().cast("array<string>")) for f in side_maps]),
        lambda ks: F.exists(ks, lambda k: k != PLACEHOLDER),
    )
    new_category = F.transform_values(
        category,
        lambda k, v: F.when(
            k == "index",
            F.to_variant_object(F.map_from_arrays(F.array(real), F.array(F.lit(0)))),
        )
        .when(k.isin(*side_maps) & fn.is_object(v) & ~stray, renamed(fn.as_map(v)))
        .otherwise(v),
    )
    new_axis = F.to_json(
        F.to_variant_object(
            F.transform_values(
                axis,
                lambda k, v: F.when(k == "category", F.to_variant_object(new_category)).otherwise(v),
            )
        )
    )
    without = F.map_filter(s["dimension"], lambda k, v: k != CONTENTS)
    others = F.filter(
        F.arrays_zip(s["id"].alias("id"), s["size"].alias("size")), lambda z: z["id"] != CONTENTS
    )
    fixed = F.struct(
        F.when(drop, F.transform(others, lambda z: z["id"])).otherwise(s["id"]).alias("id"),
        F.when(drop, F.transform(others, lambda z: z["size"])).otherwise(s["size"]).alias("size"),
        F.when(drop, without)
        .when(rename, F.map_concat(without, F.map_from_arrays(F.array(F.lit(CONTENTS)), F.array(new_axis))))
        .otherwise(s["dimension"])
        .alias("dimension"),
    )
    return samples.withColumn(
        "placeholder",
        F.when(drop, "dropped").when(rename, "renamed").otherwise("kept"),
    ).withColumn(
        "fault",
        F.when(drop & (at > 0) & (F.try_element_at(s["size"], at.cast("int")) != 1), "size").when(
            rename & stray, "category"
        ),
    ).withColumn("sample", fixed)
