"""Open JSON values in their many upstream shapes, brought to one."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from kartotek.functions.text import bind, first_nonblank, strip

# Keys that may carry a node's id and its label, in order of preference.
NODE_ID_KEYS = ("id", "code", "key", "value", "name", "label", "title")
NODE_LABEL_KEYS = ("label", "title", "name", "text")
CONTACT_FIELDS = ("name", "organization", "mail", "phone", "raw")

_MAP = "map<string,variant>"


def as_map(v: Column) -> Column:
    """Fields of a JSON object; anything else gives NULL."""
    return F.try_variant_get(v, "$", _MAP)


def as_array(v: Column) -> Column:
    """Items of a JSON array; anything else gives NULL."""
    return F.try_variant_get(v, "$", "array<variant>")


def is_object(v: Column) -> Column:
    return as_map(v).isNotNull()


def is_array(v: Column) -> Column:
    return as_array(v).isNotNull()


def is_string(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v) == "STRING", F.lit(False))


def is_json_null(v: Column) -> Column:
    return v.isNull() | F.is_variant_null(v)


def text_at(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def string_only(v: Column) -> Column:
    """The text of a JSON string; any other JSON type gives NULL."""
    return F.when(is_string(v), F.try_variant_get(v, "$", "string"))


def drop_nulls(m: Column) -> Column:
    return F.map_filter(m, lambda k, v: ~is_json_null(v))


def overlay(base: Column, top: Column) -> Column:
    """Union of two maps; where both hold a key, ``top`` wins."""
    kept = F.map_filter(base, lambda k, v: ~F.map_contains_key(top, k))
    return F.when(top.isNull(), base).when(base.isNull(), top).otherwise(F.map_concat(kept, top))


def split_extras(m: Column, known: tuple[str, ...]) -> Column:
    """Known keys apart from the rest; the rest joins ``extension``. ``conflicts`` lists
    keys that appear both loose and inside ``extension`` with different values."""

    def built(x: Column) -> Column:
        filled, inner = x["filled"], x["inner"]
        loose = F.map_filter(filled, lambda k, v: ~k.isin(*known) & (k != "extension"))
        return F.struct(
            F.map_filter(filled, lambda k, v: k.isin(*known)).alias("fields"),
            bind(loose, lambda top: overlay(inner, top)).alias("extension"),
            F.array_sort(F.map_keys(F.map_filter(loose, lambda k, v: clash(inner, k, v)))).alias(
                "conflicts"
            ),
        )

    def clash(inner: Column, k: Column, v: Column) -> Column:
        return F.map_contains_key(inner, k) & (F.to_json(F.try_element_at(inner, k)) != F.to_json(v))

    inner = F.coalesce(
        as_map(F.try_element_at(m, F.lit("extension"))), F.create_map().cast(_MAP)
    )
    return bind(F.struct(drop_nulls(m).alias("filled"), inner.alias("inner")), built)


def _node(v: Column, fallback: Column) -> Column:
    """One path node: an object with some id, or a bare scalar used as both id and label."""
    taken = tuple(dict.fromkeys(NODE_ID_KEYS + NODE_LABEL_KEYS))
    empty = F.create_map().cast(_MAP)

    def from_object(fields: Column) -> Column:
        def pick(keys: tuple[str, ...], last: Column) -> Column:
            values = [F.try_element_at(fields, F.lit(k)).try_cast("string") for k in keys]
            return F.coalesce(first_nonblank(*values), last)

        def labelled(code: Column) -> Column:
            return F.struct(
                code.alias("code"),
                pick(NODE_LABEL_KEYS, code).alias("label"),
                F.map_filter(fields, lambda k, x: ~k.isin(*taken)).alias("extension"),
            )

        return bind(pick(NODE_ID_KEYS, fallback), labelled)

    def from_scalar(text: Column) -> Column:
        return F.when(
            text != "", F.struct(text.alias("code"), text.alias("label"), empty.alias("extension"))
        )

    def either(fields: Column) -> Column:
        return F.when(fields.isNotNull(), from_object(fields)).otherwise(
            bind(strip(F.try_variant_get(v, "$", "string")), from_scalar)
        )

    return F.when(~is_json_null(v), bind(as_map(v), either))


def _keyed_items(json_text: Column) -> Column:
    """``{"A": "label", "B": {...}}`` as node objects, in the text's key order."""

    def item(e: Column) -> Column:
        key = F.create_map(F.lit("id"), e["key"].cast("variant"))
        plain = F.map_concat(key, F.create_map(F.lit("label"), e["value"]))
        return F.to_variant_object(
            bind(
                as_map(e["value"]),
                lambda m: F.when(m.isNotNull(), overlay(key, m)).otherwise(plain),
            )
        )

    return F.transform(F.map_entries(F.from_json(json_text, _MAP)), item)


def _raw_sequences(json_text: Column, v: Column) -> Column:
    """The eight shapes as one list of node-item lists."""

    def inner(x: Column) -> Column:
        return F.coalesce(F.try_variant_get(x, "$.path", "array<variant>"), as_array(x))

    def has_path(x: Column) -> Column:
        return F.try_variant_get(x, "$.path", "array<variant>").isNotNull()

    def from_array(items: Column) -> Column:
        uniform = (F.size(items) > 0) & (F.forall(items, has_path) | F.forall(items, is_array))
        return F.when(uniform, F.transform(items, inner)).otherwise(F.array(items))

    def from_object(fields: Column) -> Column:
        listed = as_array(F.try_element_at(fields, F.lit("paths")))
        single = as_array(F.try_element_at(fields, F.lit("path")))
        named = F.map_contains_key(fields, "id") | F.map_contains_key(fields, "label")
        return (
            F.when(listed.isNotNull(), F.transform(listed, inner))
            .when(single.isNotNull(), F.array(single))
            .when(fields.isNull() | named, F.array(F.array(v)))
            .otherwise(F.array(_keyed_items(json_text)))
        )

    return bind(
        as_array(v),
        lambda items: F.when(items.isNotNull(), from_array(items)).otherwise(
            bind(as_map(v), from_object)
        ),
    )


def normalize_paths(json_text: Column) -> Column:
    """Any of the eight path shapes -> list of node lists, NULL when nothing is left."""

    def nodes(seq: Column) -> Column:
        return F.filter(
            F.transform(seq, lambda v, i: _node(v, i.cast("string"))), lambda n: n.isNotNull()
        )

    def paths(v: Column) -> Column:
        return F.filter(
            F.transform(_raw_sequences(json_text, v), nodes), lambda p: F.size(p) > 0
        )

    return bind(
        bind(F.try_parse_json(json_text), paths), lambda ps: F.when(F.size(ps) > 0, ps)
    )


def _contact_object(v: Column) -> Column:
    def built(parts: Column) -> Column:
        fields = [
            F.try_element_at(parts["fields"], F.lit(k)).try_cast("string").alias(k)
            for k in CONTACT_FIELDS
        ]
        return F.struct(*fields, parts["extension"].alias("extension"))

    return bind(split_extras(as_map(v), CONTACT_FIELDS), built)


def _contact_text(v: Column) -> Column:
    text = strip(F.try_variant_get(v, "$", "string"))
    fields = [(text if k == "raw" else F.lit(None).cast("string")).alias(k) for k in CONTACT_FIELDS]
    return F.struct(*fields, F.create_map().cast(_MAP).alias("extension"))


def normalize_contact(v: Column) -> Column:
    """Object, list or text -> contacts; objects come before texts; NULL when empty."""
    wrapped = F.try_variant_get(v, "$.contacts", "array<variant>")
    items = F.coalesce(as_array(v), wrapped, F.when(~is_json_null(v), F.array(v)))

    def contacts(found: Column) -> Column:
        objects = F.transform(F.filter(found, is_object), _contact_object)
        texts = F.transform(F.filter(found, lambda x: ~is_object(x)), _contact_text)
        return F.concat(objects, F.filter(texts, lambda c: c["raw"] != ""))

    return bind(bind(items, contacts), lambda cs: F.when(F.size(cs) > 0, cs))
