"""Text functions: every one is a Column expression unless it says otherwise."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from urllib.parse import unquote

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Source marker, and abbreviations whose full stop ends no sentence.
SOURCE_MARKER = "Käll(?:a|or)"
ABBREVIATIONS = (
    "t.ex",
    "bl.a",
    "m.fl",
    "m.m",
    "d.v.s",
    "s.k",
    "o.s.v",
    "resp",
    "inkl",
    "exkl",
    "ca",
    "fig",
    "nr",
)
FALLBACK_SOURCE = "Kolada"
TRUE_WORDS = ("true", "1", "yes", "y")
FALSE_WORDS = ("false", "0", "no", "n")
UNIT_SUFFIX = "_OU"
PIECE_LENGTH = 4000

# Java's \s with (?U) covers the Unicode spaces; \x1c-\x1f also count as blank here.
_BLANK = r"[\s\x1c-\x1f]"


def bind(value: Column, build: Callable[[Column], Column]) -> Column:
    """``build(value)`` with ``value`` computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), build), 1)


def strip(c: Column) -> Column:
    """Trim every kind of white space, not only the ASCII blank."""
    return F.regexp_replace(c, rf"(?U)^{_BLANK}+|{_BLANK}+\z", "")


def filled(c: Column) -> Column:
    """The value itself, NULL when it is the empty string."""
    return F.when(c != "", c)


def blank_to_null(c: Column) -> Column:
    return filled(strip(c))


def has_id(c: Column) -> Column:
    """Usable identifier: not NULL and not blank."""
    return F.coalesce(strip(c) != "", F.lit(False))


def squeeze(c: Column) -> Column:
    """Collapse each run of white space to one blank and trim."""
    return F.trim(F.regexp_replace(c, rf"(?U){_BLANK}+", " "))


def normalize_text(c: Column) -> Column:
    """As :func:`squeeze`, with a literal backslash-n counted as a blank."""
    return squeeze(F.replace(c, F.lit("\\n"), F.lit(" ")))


def first_nonblank(*cols: Column) -> Column:
    stripped = F.array(*[strip(c) for c in cols])
    return F.get(F.filter(stripped, lambda x: x != ""), F.lit(0))


def first_truthy(*cols: Column) -> Column:
    """First value that is neither NULL nor empty; blanks count as values."""
    return F.coalesce(*[filled(c) for c in cols])


def pieces(c: Column, n: int = PIECE_LENGTH) -> Column:
    """The whole text in pieces of ``n`` characters, for stores whose fields are short."""
    starts = F.sequence(F.lit(0), F.greatest(F.ceil(F.length(c) / n).cast("int") - 1, F.lit(0)))
    return F.transform(starts, lambda i: F.substring(c, i * n + 1, F.lit(n)))


def compact_strings(items: Column, trim: Callable[[Column], Column] = strip) -> Column:
    """Trimmed non-blank strings of an array; order kept. What ``trim`` leaves empty is blank."""
    return F.filter(F.transform(items, trim), lambda x: x.isNotNull() & (x != ""))


def note_from_text(c: Column) -> Column:
    """A plain string note as a one-element list, blank as NULL."""
    return F.when(has_id(c), F.array(strip(c)))


def normalize_note(v: Column, trim: Callable[[Column], Column] = strip) -> Column:
    """VARIANT string or list -> non-empty list of trimmed strings, else NULL."""

    def listed(x: Column) -> Column:
        text = F.when(F.schema_of_variant(x) == "STRING", F.try_variant_get(x, "$", "string"))
        single = F.when(text.isNotNull(), F.array(text))
        return compact_strings(F.coalesce(F.try_variant_get(x, "$", "array<string>"), single), trim)

    return bind(bind(v, listed), lambda n: F.when(F.size(n) > 0, n))


def coerce_bool(c: Column) -> Column:
    """Boolean from text."""
    word = F.lower(strip(c))
    return F.when(word.isin(*TRUE_WORDS), True).when(word.isin(*FALSE_WORDS), False)


def coerce_bool_variant(v: Column) -> Column:
    """Boolean from JSON: booleans, any whole number, or one of the known words."""
    return bind(F.struct(v.alias("v"), F.schema_of_variant(v).alias("kind")), _json_bool)


def _json_bool(x: Column) -> Column:
    return (
        F.when(x["kind"] == "BOOLEAN", F.try_variant_get(x["v"], "$", "boolean"))
        .when(x["kind"] == "BIGINT", F.try_variant_get(x["v"], "$", "bigint") != 0)
        .when(x["kind"] == "STRING", coerce_bool(F.try_variant_get(x["v"], "$", "string")))
    )


def truthy_variant(v: Column) -> Column:
    """JSON truth: NULL, false, 0 and the empty string are false."""
    kind = F.schema_of_variant(v)
    return F.coalesce(
        F.when(kind == "BOOLEAN", F.try_variant_get(v, "$", "boolean"))
        .when(kind == "BIGINT", F.try_variant_get(v, "$", "bigint") != 0)
        .when(kind == "STRING", F.try_variant_get(v, "$", "string") != ""),
        F.lit(False),
    )


def retired_year(title: Column) -> Column:
    """Year in a ``(-2024)`` mark of a title."""
    return F.regexp_extract(title, r"\(\s*-\s*(\d{4})\s*\)", 1).try_cast("int")


def _clause(text: Column, marker: str, abbreviations: tuple[str, ...]) -> Column:
    """Clause after the last marker, empty when there is none: one pattern, one pass."""
    words = "|".join(a.replace(".", r"\.") for a in abbreviations)
    stop = rf"(?:[!?]|(?<!\b(?:{words}|[A-ZÅÄÖ]))\.)(?=\s|$)"
    form = rf"(?isuU)^.*\b(?:{marker})\b\s*[:.]?\s*(.*?)(?:{stop}|\z)"
    found = F.regexp_extract(F.coalesce(normalize_text(text), F.lit("")), form, 1)
    return F.trim(F.regexp_replace(F.trim(found), r"\.+$", ""))


def source_clause(
    description: Column,
    title: Column,
    marker: str = SOURCE_MARKER,
    abbreviations: tuple[str, ...] = ABBREVIATIONS,
    fallback: str = FALLBACK_SOURCE,
) -> Column:
    """Text after the last source marker up to its sentence end, with where it was found."""
    clauses = F.array(
        _clause(description, marker, abbreviations), _clause(title, marker, abbreviations)
    )
    # The outer array binds both clauses, so each is computed once.
    return F.element_at(
        F.transform(
            F.array(clauses),
            lambda c: F.struct(
                F.when(c[0] != "", c[0]).when(c[1] != "", c[1]).otherwise(fallback).alias("source"),
                F.when(c[0] != "", "description").when(c[1] != "", "title").otherwise("fallback")
                .alias("origin"),
            ),
        ),
        1,
    )


def strip_id_prefix(name: Column, ident: Column) -> Column:
    """Drop a leading ``ID.`` / ``ID:`` / ``ID -`` from a label; empty becomes the id."""
    left = F.regexp_replace(name, rf"(?U)^{_BLANK}+", "")
    rest = F.substr(left, F.length(ident) + 1)
    mark = rf"(?U)^{_BLANK}*[.:\-–—]{_BLANK}*"
    cut = F.when(
        F.lower(left).startswith(F.lower(ident)) & rest.rlike(mark),
        F.regexp_replace(rest, mark, ""),
    ).otherwise(name)
    return first_truthy(strip(cut), ident)


def kind_of(code: Column) -> Column:
    return F.when(code.endswith(UNIT_SUFFIX), "oudata").otherwise("data")


def add_kind(code: Column, kind: Column) -> Column:
    return F.when(kind == "oudata", F.concat(code, F.lit(UNIT_SUFFIX))).otherwise(code)


def strip_kind(code: Column) -> Column:
    return F.regexp_replace(code, f"{UNIT_SUFFIX}$", "")


@F.pandas_udf(StringType())
def normalize_id(ids: pd.Series) -> pd.Series:
    """Accent- and punctuation-free key. Spark has no NFKD, hence the Arrow function;
    call it on distinct ids only."""

    def key(value: str | None) -> str | None:
        if value is None:
            return None
        plain = unicodedata.normalize("NFKD", unquote(value))
        return "".join(
            ch.casefold() for ch in plain if ch.isalnum() and not unicodedata.combining(ch)
        )

    return ids.map(key)
