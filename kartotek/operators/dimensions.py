"""Dimension and category rows from metadata payloads, and the sample selection over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.session import sorted_side

# Keys with a meaning of their own; the rest goes to the extension.
V1_KEYS = ("code", "text", "values", "valueTexts", "time", "elimination")
V2_DIMENSION_KEYS = ("label", "category", "note", "extension", "link", "elimination")
CATEGORY_KEYS = ("index", "label", "child", "coordinates", "unit", "note")
UNIT_FIELDS = ("label", "symbol", "position", "decimals")
GENDERS = (("K", "Kvinnor"), ("M", "Män"), ("T", "Totalt"))
GENDER_DIM = ("gender", "Kön")

_MAP = "map<string,variant>"


def dimensions_v1(variables: DataFrame, key: str = "dataset_code") -> tuple[DataFrame, DataFrame]:
    """v1 variables -> dimension rows and category rows. Labels go with values by position;
    a value without one labels itself."""
    v = F.col("variable")
    code = fn.strip(fn.text_at(v, "$.code"))
    label = fn.strip(fn.first_truthy(fn.text_at(v, "$.text"), code))
    values = F.try_variant_get(v, "$.values", "array<string>")
    texts = F.try_variant_get(v, "$.valueTexts", "array<string>")
    is_time = fn.coerce_bool_variant(F.try_variant_get(v, "$.time", "variant"))
    elimination = fn.coerce_bool_variant(F.try_variant_get(v, "$.elimination", "variant"))
    extras = F.map_filter(fn.as_map(v), lambda k, x: ~k.isin(*V1_KEYS))
    dims = variables.select(
        key,
        F.col("var_pos").alias("pos"),
        code.alias("dim_id"),
        label.alias("label"),
        fn.detect_role(code, label, is_time).alias("role"),
        F.coalesce(elimination, F.lit(False)).alias("elimination"),
        extras.alias("extras"),
    )
    cats = (
        variables.select(
            key, F.col("var_pos").alias("pos"), code.alias("dim_id"), texts.alias("_texts"),
            F.posexplode(values).alias("ordinal", "_value"),
        )
        .withColumn("cat_id", fn.strip(F.col("_value")))
        .select(
            key,
            "pos",
            "dim_id",
            "cat_id",
            "ordinal",
            F.coalesce(F.get("_texts", F.col("ordinal")), "cat_id").alias("label"),
        )
    )
    return dims, cats


def v1_periods(dims: DataFrame, cats: DataFrame, key: str = "dataset_code") -> DataFrame:
    """First and last period: labels of the last time axis, compared as text."""
    last = (
        dims.filter("role = 'time'").groupBy(key).agg(F.max("pos").alias("pos"))
    )
    return (
        cats.filter(fn.has_id(F.col("label")))
        .join(sorted_side(last), [key, "pos"], "left_semi")
        .groupBy(key)
        .agg(F.min("label").alias("first_period"), F.max("label").alias("last_period"))
    )


def dimension_extension(v: Column) -> Column:
    """Open fields of a JSON-stat2 dimension: its extension, unknown keys laid over it, and
    unknown category keys under ``category``. ``elimination`` is always a boolean."""
    return fn.bind(fn.as_map(v), _open_fields)


def _open_fields(fields: Column) -> Column:
    empty = F.create_map().cast(_MAP)

    def part(name: str) -> Column:
        return F.coalesce(fn.as_map(F.try_element_at(fields, F.lit(name))), empty)

    def built(inner: Column) -> Column:
        raw = F.when(
            F.map_contains_key(inner, "elimination"), F.try_element_at(inner, F.lit("elimination"))
        ).otherwise(F.try_element_at(fields, F.lit("elimination")))
        loose = F.map_filter(fields, lambda k, x: ~k.isin(*V2_DIMENSION_KEYS))
        extra = F.map_filter(part("category"), lambda k, x: ~k.isin(*CATEGORY_KEYS))
        nested = fn.bind(
            extra,
            lambda m: F.when(
                F.size(m) > 0, F.create_map(F.lit("category"), F.to_variant_object(m))
            ).otherwise(empty),
        )
        kept = F.map_filter(inner, lambda k, x: k != "elimination")
        return F.struct(
            F.coalesce(fn.bind(raw, fn.coerce_bool_variant), F.lit(False)).alias("elimination"),
            fn.overlay(fn.overlay(kept, loose), nested).alias("extras"),
            F.map_contains_key(inner, "extension").alias("nested_fault"),
        )

    return fn.bind(part("extension"), built)


def category_entries(index: Column, labels: Column) -> Column:
    """Category index in any of its three forms -> array of (cat_id, ordinal, label).

    Takes JSON text: a map id -> ordinal, a list (position is the ordinal), or nothing
    (order of the label keys). ``map<string,string>`` keeps that order, VARIANT would not.
    """
    names = F.from_json(labels, "map<string,string>")
    mapped = F.transform(
        F.map_entries(F.from_json(index, "map<string,int>")),
        lambda e: F.struct(e["key"].alias("cat_id"), e["value"].alias("ordinal")),
    )

    def numbered(ids: Column) -> Column:
        return F.transform(ids, lambda x, i: F.struct(x.alias("cat_id"), i.alias("ordinal")))

    entries = (
        F.when(F.trim(index).startswith("{"), mapped)
        .when(F.trim(index).startswith("["), numbered(F.from_json(index, "array<string>")))
        .otherwise(numbered(F.map_keys(names)))
    )
    return F.transform(
        entries,
        lambda e: F.struct(
            e["cat_id"].alias("cat_id"),
            e["ordinal"].alias("ordinal"),
            F.coalesce(F.try_element_at(names, e["cat_id"]), e["cat_id"]).alias("label"),
        ),
    )


_AXIS = (
    "struct<label:string,note:variant,link:variant,category:struct<index:string,label:string,"
    "child:map<string,array<string>>,coordinates:map<string,array<double>>,"
    "unit:map<string,variant>,note:map<string,array<string>>>>"
)


def axes_v2(payloads: DataFrame, key: str = "dataset_code") -> DataFrame:
    """One row per axis of a JSON-stat2 payload, in ``id`` order, with its object parsed."""
    return (
        payloads.select(
            key, "payload.role", "payload.dimension",
            F.posexplode("payload.id").alias("pos", "_id"),
        )
        .withColumn("dim_id", fn.strip(F.col("_id")))
        .withColumn("axis_text", F.try_element_at("dimension", F.col("dim_id")))
        .withColumn("axis", F.from_json("axis_text", _AXIS))
        .drop("_id", "dimension")
    )


def dimensions_v2(axes: DataFrame, key: str = "dataset_code") -> tuple[DataFrame, DataFrame]:
    """JSON-stat2 axes -> dimension rows and category rows."""
    roles = fn.normalize_role(F.try_parse_json("role"))
    role = F.coalesce(
        *[F.when(F.array_contains(F.col("_roles")[r], F.col("dim_id")), r) for r in fn.ROLES]
    )
    dims = (
        axes.withColumn("_roles", roles)
        .withColumn("_open", dimension_extension(F.try_parse_json("axis_text")))
        .select(
            key,
            "pos",
            "dim_id",
            fn.first_truthy(F.col("axis.label"), F.col("dim_id")).alias("label"),
            role.alias("role"),
            fn.normalize_note(F.col("axis.note")).alias("note"),
            F.col("axis.link").alias("link"),
            F.col("_open.elimination").alias("elimination"),
            F.col("_open.extras").alias("extras"),
            F.col("_open.nested_fault").alias("nested_fault"),
        )
    )
    entries = category_entries(F.col("axis.category.index"), F.col("axis.category.label"))
    cats = axes.select(key, "pos", "dim_id", F.inline(entries))
    return dims, cats


def _unit(v: Column) -> Column:
    def built(parts: Column) -> Column:
        extension = F.create_map(F.lit("extension"), F.to_variant_object(parts["extension"]))
        whole = F.when(
            F.size(parts["extension"]) > 0, F.map_concat(parts["fields"], extension)
        ).otherwise(parts["fields"])
        return F.to_variant_object(whole)

    return F.when(
        v.isNotNull(), fn.bind(fn.split_extras(fn.as_map(v), UNIT_FIELDS), built)
    )


def category_details(axes: DataFrame, key: str = "dataset_code") -> DataFrame:
    """Unit, note and coordinates of single categories; unknown unit fields move to the
    unit's extension."""
    c = F.col("axis.category")
    unit, note, place = c["unit"], c["note"], c["coordinates"]
    ids = F.array_distinct(
        F.flatten(
            F.array(*[F.coalesce(F.map_keys(m), F.array().cast("array<string>"))
                      for m in (unit, note, place)])
        )
    )
    cat = F.col("cat_id")
    return (
        axes.withColumn("cat_id", F.explode(ids))
        .select(
            key, "dim_id", "cat_id",
            _unit(F.try_element_at(unit, cat)).alias("unit"),
            F.try_element_at(note, cat).alias("note"),
            F.try_element_at(place, cat).alias("coordinates"),
        )
    )


def gender_dimension(kpis: DataFrame) -> DataFrame:
    """The fixed gender categories of KPIs that are split by gender."""
    rows = [
        F.struct(F.lit(code).alias("cat_id"), F.lit(label).alias("label"),
                 F.lit(i).alias("ordinal"))
        for i, (code, label) in enumerate(GENDERS)
    ]
    return kpis.filter("is_divided_by_gender").select(
        "kpi_id",
        F.lit(GENDER_DIM[0]).alias("dim_id"),
        F.lit(GENDER_DIM[1]).alias("dim_label"),
        F.lit(True).alias("elimination"),
        F.inline(F.array(*rows)),
    )


def axis_sizes(cats: DataFrame, keys: list[str]) -> DataFrame:
    return cats.groupBy(*keys).agg(F.count("*").alias("n"))


def cell_count(sizes: DataFrame, key: str) -> DataFrame:
    """Cells of the cube each dataset describes: the exact product of its axis sizes (a
    document's few axes), NULL with ``overflow`` where 38 digits do not hold it."""
    wide = "decimal(38,0)"
    product = F.aggregate(
        "_sizes", F.lit(1).cast(wide),
        lambda x, n: F.try_multiply(x, n).try_cast(wide),
    )
    return sizes.groupBy(key).agg(F.collect_list(F.col("n").cast(wide)).alias("_sizes")).select(
        key, product.alias("cells"), product.isNull().alias("overflow"))


def top_categories(cats: DataFrame, k: int = 2) -> DataFrame:
    """First ``k`` categories of each axis. Ordinals are dense, so this is a filter."""
    return cats.filter(F.col("ordinal") < k)


def sample_selection(sizes: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """How many categories of each axis a sample asks for: two, cut to one from the last
    axis backwards until the product fits.

    Running products never fall, so the backward cut is the same as: one wherever the
    product up to and including this axis is above the limit. An axis list is short.
    """
    upto = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    doubles = F.sum(F.when(F.col("n") >= 2, 1).otherwise(0)).over(upto)
    return sizes.withColumn(
        "keep",
        F.least("n", F.lit(2)) if limit is None
        else F.when(F.pow(F.lit(2.0), doubles) > limit, 1).otherwise(F.least("n", F.lit(2))),
    )


def child_edges(axes: DataFrame, child: str = "child") -> DataFrame:
    """Parent/child pairs of category hierarchies; ``child`` maps a parent to its children."""
    others = [c for c in axes.columns if c != child]
    return axes.select(*others, F.explode(child).alias("parent", "_children")).select(
        *others, "parent", F.posexplode("_children").alias("child_pos", "child")
    )
