"""Token counts of whole texts in one map pass.

First tier: a compact table of frequent pre-token lengths. One pass over all texts feeds a
frequent-items sketch of fixed size (only sketches are shuffled), its ``TABLE_SIZE`` most frequent
items are encoded once and broadcast; the table's size is bounded by its parameters and never
grows with the corpus. Second tier: pre-tokens that the table misses are encoded by the library in
batches and kept in a cache of the Python worker, dropped and rebuilt when it holds
``CACHE_SIZE`` entries. No pre-token is shuffled. Both tiers only save work: every length comes
from the library.

Texts with an added token's string, or with a character on which the two regular-expression
engines differ, go to the library whole.

Defined results: null text counts as empty (0 bytes, 0 tokens); repeated rows give repeated rows;
an empty table gives an empty result; further columns are ignored; texts of any length are whole.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries of the broadcast table (about 20 bytes each).
TABLE_SIZE = 20_000
#: Items that one task's sketch tracks.
TRACKED = 100_000
#: Pre-tokens in a worker's cache before it is dropped.
CACHE_SIZE = 400_000
LIMIT = 512

# Fixed value: how byte-level BPE of this vocabulary splits text before the merges.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Latin, Greek, Cyrillic, Hebrew, Arabic, Devanagari, punctuation, kana, Han, Hangul, pictographs.
AGREED = (
    "\\x00-\\x1b\\x20-\\x84\\x86-\u024f\u0300-\u036f\u0391-\u03a1\u03a3-\u03ff\u0400-\u0481\u05d0-\u05ea\u0621-\u064a"
    "\u0660-\u0669\u0905-\u0939\u1e00-\u1ef9\u2010-\u2027\u202f-\u205e\u20a0-\u20b0\u2100-\u2138\u2190-\u23cf\u2500-\u2767"
    "\u3000-\u303e\u3041-\u3096\u30a1-\u30fe\u4e00-\u9fa5\uac00-\ud7a3\uff01-\uff5e\U0001f300-\U0001f5ff\U0001f600-\U0001f64f"
)

OUT = "doc_id long, n_bytes long, n_tokens long"


@lru_cache(maxsize=2)
def _library(path: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task keeps to its own core
    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _lengths(path: str, texts: list[str]) -> list[int]:
    return [len(e.ids) for e in _library(path).encode_batch(texts, add_special_tokens=False)]


@lru_cache(maxsize=2)
def _whole_text_pattern(path: str):
    """Texts that must not be split here: they hold an added token, or a character outside the
    blocks on which the engines' tables are known to agree (a test compares all of these)."""
    import regex

    added = [regex.escape(t.content) for t in _library(path).get_added_tokens_decoder().values()]
    odd = f"[^{AGREED}]"
    return regex.compile("|".join([*added, odd]))


def frequent_pre_tokens(docs: DataFrame) -> list[str]:
    """Approximately the most frequent pre-tokens of all texts, from sketches of fixed size."""
    found = docs.select(
        F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(PRE_TOKEN), F.lit(0))).alias("p"))
    top = found.agg(F.expr(f"approx_top_k(p, {TABLE_SIZE}, {TRACKED})").alias("top")).first()["top"]
    return [r["item"] for r in top or [] if r["item"]]


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs``; ``vocabulary`` is the path
    of a byte-level BPE file that every executor has."""
    frequent = frequent_pre_tokens(docs)
    whole = _whole_text_pattern(vocabulary)
    frequent = [p for p in frequent if not whole.search(p)]
    lengths = _lengths(vocabulary, frequent)
    table = docs.sparkSession.sparkContext.broadcast(dict(zip(frequent, lengths, strict=True)))
    counts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        lambda batches: _count(batches, table, vocabulary), OUT)
    return counts.withColumn("over_limit", F.col("n_tokens") > LIMIT)


#: Caches of this Python worker, by vocabulary.
_CACHES: dict[str, dict[str, int]] = {}


def _count(batches: Iterator[pa.RecordBatch], table, vocabulary: str) -> Iterator[pa.RecordBatch]:
    import regex

    first = table.value
    split, whole = regex.compile(PRE_TOKEN).findall, _whole_text_pattern(vocabulary).search
    cache = _CACHES.setdefault(vocabulary, {})
    for batch in batches:
        texts = batch.column(1).to_pylist()
        totals: list[int] = []
        for text in texts:
            if whole(text):
                totals.append(_lengths(vocabulary, [text])[0])
                continue
            total, missed = 0, []
            for p in split(text):
                n = first.get(p)
                if n is None:
                    n = cache.get(p)
                    if n is None:
                        missed.append(p)
                        continue
                total += n
            if missed:
                new = list(dict.fromkeys(missed))
                if len(cache) + len(new) > CACHE_SIZE:
                    cache.clear()
                known = dict(zip(new, _lengths(vocabulary, new), strict=True))
                cache.update(known)
                total += sum(known[p] for p in missed)
            totals.append(total)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).cast(pa.int64()),
             pa.array([len(t.encode()) for t in texts], pa.int64()),
             pa.array(totals, pa.int64())],
            ["doc_id", "n_bytes", "n_tokens"])
