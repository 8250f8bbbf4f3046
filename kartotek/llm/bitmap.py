"""Bit tables of fixed size over hashed keys: a first sieve before an exact join.

A key sets the bit named by its highest bits. The table never grows, so it can be collected and
broadcast whatever the data; where it fills up it lets more rows through to the exact join behind
it, never fewer."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

#: log2 of the number of bits: 1 MB.
BITS = 23


def build(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """The table of a LONG column of hashes; null keys set nothing."""
    place = F.shiftrightunsigned(F.col(column), 64 - bits)
    rows = (
        keys.where(F.col(column).isNotNull())
        .groupBy(F.shiftright(place, 15).alias("bucket"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(32767)).alias("bitmap"))
        .collect()  # at most 2^(bits - 15) rows of 4 KB
    )
    out = np.zeros(1 << (bits - 3), np.uint8)
    for r in rows:
        out[r["bucket"] * 4096: r["bucket"] * 4096 + 4096] = np.frombuffer(bytes(r["bitmap"]), np.uint8)
    return out


def contains(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bits = (len(bitmap) * 8).bit_length() - 1
    place = keys.view(np.uint64) >> np.uint64(64 - bits)
    return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) > 0


def parted(rows: DataFrame, keys: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` whose ``column`` is surely none of ``keys``, and the others, which an exact join must
    tell apart: only these have to be shuffled. ``rows`` are read once for each part."""
    sieve = rows.sparkSession.sparkContext.broadcast(build(keys.select(F.xxhash64(column).alias("k")), "k"))

    @F.pandas_udf(BooleanType())
    def may_be(k: pd.Series) -> pd.Series:
        return pd.Series(contains(sieve.value, k.to_numpy()))

    found = may_be(F.xxhash64(column))
    return rows.where(~found), rows.where(found)
