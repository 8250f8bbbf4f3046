"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role are
merged into one block, and the blocks are concatenated; array functions do all of it. A block is
``<|im_start|>role\\n part <|im_sep|> part ... <|im_end|>\\n`` (without the blanks); the separator
keeps merged turns apart, so the input turns can be read back.

Control strings inside texts get a backslash after their first character (one more if there are
some already). That map is one-to-one, and afterwards no text holds a raw control string.

Defined results: null text and null role are empty text; turns are ordered by turn, role and text
with null turns first, so ties and repeated rows have one result; rows with a null conv_id form
one conversation; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Control strings of common chat templates and of this one.
CONTROL_STRINGS = (
    "<|im_start|>", "<|im_end|>", "<|im_sep|>", "<|endoftext|>",
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
)
START, END, SEPARATOR = "<|im_start|>", "<|im_end|>\n", "<|im_sep|>"
LEARNED_ROLE = "assistant"

_RESTS = "|".join(
    "".join("\\" + c if c in "|[]/<>" else c for c in s[1:]) for s in CONTROL_STRINGS
)
ESCAPE_PATTERN = rf"([<\[])(\\*)({_RESTS})"
UNESCAPE_PATTERN = rf"([<\[])\\(\\*)({_RESTS})"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPE_PATTERN, r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE_PATTERN, "$1$2$3")


def _escaped_role(role: Column) -> Column:
    flat = F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n"))
    return escaped(flat)


def _pieces(turns: Column) -> Column:
    """Each turn with what stands before and after it; only a change of role opens a block."""

    def piece(turn: Column, i: Column) -> Column:
        before, after = F.get(turns, i - 1), F.get(turns, i + 1)
        opens = before.isNull() | (before["role"] != turn["role"])
        closes = after.isNull() | (after["role"] != turn["role"])
        return F.struct(
            F.when(opens, F.concat(F.lit(START), _escaped_role(turn["role"]), F.lit("\n")))
            .otherwise(F.lit(SEPARATOR)).alias("head"),
            escaped(turn["text"]).alias("body"),
            F.when(closes, F.lit(END)).otherwise(F.lit("")).alias("tail"),
            (turn["role"] == LEARNED_ROLE).alias("learned"),
        )

    return F.transform(turns, piece)


def format_conversations(turns: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (start and length in code points of ``formatted``).

    One row per conversation, as the format asks; the collected group is one conversation."""
    rows = turns.select(
        F.col("conv_id"),
        F.struct(
            F.col("turn").alias("turn"),
            F.coalesce(F.col("role"), F.lit("")).alias("role"),
            F.coalesce(F.col("text"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    sorted_turns = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    pieces = sorted_turns.select("conv_id", _pieces(F.col("turns")).alias("pieces"))
    no_spans = F.struct(
        F.lit(1).cast("int").alias("at"),
        F.array().cast("array<struct<start:int,length:int>>").alias("spans"),
    )

    def place(state: Column, piece: Column) -> Column:
        start = state["at"] + F.length(piece["head"])
        size = F.length(piece["body"])
        span = F.array(F.struct(start.alias("start"), size.alias("length")))
        return F.struct(
            (start + size + F.length(piece["tail"])).alias("at"),
            F.when(piece["learned"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return pieces.select(
        "conv_id",
        F.concat_ws(
            "", F.transform("pieces", lambda p: F.concat(p["head"], p["body"], p["tail"]))
        ).alias("formatted"),
        F.aggregate("pieces", no_spans, place)["spans"].alias("loss_spans"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role and text), loss_text, formatted: all from the output."""
    literal = lambda s: "".join("\\" + c if c in "|<>" else c for c in s)
    blocks = F.slice(F.split("formatted", literal(START)), F.lit(2), F.size(F.split("formatted", literal(START))))

    def turns_of(block: Column) -> Column:
        whole = F.substring(block, F.lit(1), F.length(block) - len(END))
        role = F.substring_index(whole, "\n", 1)
        body = F.substring(whole, F.length(role) + 2, F.length(whole))
        plain_role = F.array_join(
            F.transform(F.split(unescaped(role), r"\\\\"), lambda x: F.replace(x, F.lit("\\n"), F.lit("\n"))), "\\")
        return F.transform(
            F.split(body, literal(SEPARATOR)),
            lambda part: F.struct(plain_role.alias("role"), unescaped(part).alias("text")),
        )

    loss = F.concat_ws("", F.transform(
        "loss_spans", lambda s: unescaped(F.substring(F.col("formatted"), s["start"], s["length"]))))
    return formatted.select(
        "conv_id",
        F.flatten(F.transform(blocks, turns_of)).alias("turns"),
        loss.alias("loss_text"),
        "formatted",
    )


def digest(formatted: DataFrame) -> DataFrame:
    """Counts and digests of what ``read_back`` gives."""
    joined = F.concat_ws("", F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read_back(formatted).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(joined, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
