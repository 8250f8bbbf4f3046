"""Chat formatting: exact round trip, merging, escapes, empty and odd rows."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kartotek.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, formatted string, turns int"


def formatted(spark, rows):
    return chat.format_conversations(spark.createDataFrame([(*r, "x", 0) for r in rows], SCHEMA))


def read(spark, rows):
    return {r.conv_id: r for r in chat.read_back(formatted(spark, rows)).collect()}


def test_adjacent_turns_of_one_role_share_a_block(spark):
    rows = [(1, 2, "assistant", "b"), (1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 3, "user", "r")]
    out = formatted(spark, rows).first()
    assert out.formatted == (
        "<|im_start|>user\nq<|im_end|>\n<|im_start|>assistant\na<|im_sep|>b<|im_end|>\n<|im_start|>user\nr<|im_end|>\n")
    assert [out.formatted[s.start - 1:s.start - 1 + s.length] for s in out.loss_spans] == ["a", "b"]


def test_nulls_ties_repeats_and_empty(spark):
    rows = [(1, 0, "user", None), (1, 0, "user", None), (1, None, None, "first"), (None, 0, "assistant", ""),
            (1, 0, "assistant", "tie")]
    got = read(spark, rows)
    assert [(t.role, t.text) for t in got[1].turns] == [("", "first"), ("assistant", "tie"), ("user", ""), ("user", "")]
    assert [(t.role, t.text) for t in got[None].turns] == [("assistant", "")]
    assert got[1].loss_text == "tie" and got[None].loss_text == ""
    assert read(spark, []) == {}


def test_a_long_conversation(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], "w" * 500 + "</s>" * (i % 3)) for i in range(600)]
    got = read(spark, rows)[1]
    assert [t.text for t in got.turns] == [r[3] for r in rows]
    assert got.loss_text == "".join(r[3] for r in rows[1::2])


PIECES = st.lists(st.sampled_from([*chat.CONTROL_STRINGS, "\\", "<", "[", "\n", "a", "é", "😀", "<\\s>", " "]), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(PIECES, PIECES), min_size=1, max_size=12))
def test_round_trip(spark, turns):
    rows = [(7, i, "".join(r) if i % 3 else "assistant", "".join(t)) for i, (r, t) in enumerate(turns)]
    out = formatted(spark, rows).first()
    for r in rows:
        assert not any(c in spark_escape(r[3]) for c in chat.CONTROL_STRINGS)
    got = read(spark, rows)[7]
    assert [(t.role, t.text) for t in got.turns] == [r[2:] for r in rows]
    assert got.loss_text == "".join(r[3] for r in rows if r[2] == "assistant")
    assert out.formatted.count(chat.START) == out.formatted.count(chat.END)


def spark_escape(text):
    import re

    return re.sub(chat.ESCAPE_PATTERN, r"\1\\\2\3", text)
