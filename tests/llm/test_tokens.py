"""Token counts against the library on whole texts."""

import random

import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from kartotek.llm import tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def counts(spark, texts):
    rows = [(i, t, "x", 0) for i, t in enumerate(texts)]
    got = tokens.token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string, n_bytes int"), PATH)
    return {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in got.collect()}


def expected(texts):
    want = {}
    for i, t in enumerate(texts):
        n = len(LIBRARY.encode(t or "", add_special_tokens=False).ids)
        want[i] = (len((t or "").encode()), n, n > tokens.LIMIT)
    return want


def test_odd_texts(spark):
    texts = [None, "", " ", "a", "a", "don't stop\n\n  now ", "<|endoftext|>", "x <|endoftext|><|endoftext|> y", "日本語 ñandú 😀",
             "tab\tand\x1cfile\x85next", "꟎ new letters \U00010942", "9" * 5000, "word " * 30_000, "été\r\n  1234abc", "‮x y"]
    assert counts(spark, texts) == expected(texts)


def test_texts_with_nul_characters(spark):
    texts = ["\0\0\0 tail of extraordinarily infrequent words", "a\0b c\0\0 d", "\0", " \0 \0\0 !\0?", "x \0y \0 incomprehensibility",
             "tail words, infrequent! incomprehensibility", *["!\0? a\0b"] * 5]
    assert counts(spark, texts) == expected(texts)


def test_random_texts(spark):
    rng = random.Random(3)
    letters = "abcéß '’.,\n\t 0123ЖЯ日本ñ　<|>endoftext😀‍"
    texts = ["".join(rng.choices(letters, k=rng.randrange(300))) for _ in range(400)]
    assert counts(spark, texts) == expected(texts)


def test_empty_table(spark):
    assert counts(spark, []) == {}


def test_a_small_cache_changes_nothing(spark, monkeypatch):
    texts = [f"w{i} x{i * 7} shared words" for i in range(300)]
    monkeypatch.setattr(tokens, "TABLE_SIZE", 5)
    assert counts(spark, texts) == expected(texts)


@pytest.mark.parametrize("start", range(0, 0x20000, 0x8000))
def test_engines_agree_where_texts_are_split_here(start):
    split, agreed = regex.compile(tokens.PRE_TOKEN).findall, regex.compile(f"[{tokens.AGREED}]").match
    for c in map(chr, range(start, start + 0x8000)):
        if agreed(c):
            s = f"a{c}b 1{c}2 {c} ,{c}. {c}{c}x"
            assert split(s) == [s[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(s)], hex(ord(c))
