"""Words and their 64-bit hashes from Arrow batches, on whole columns with numpy.

A word is ``[^\\x20\\x09-\\x0D]+``; these blanks are single bytes in UTF-8, so words are cut on
bytes. All hashes depend on content only: every task and every run gives a text the same ones.
Hash arithmetic is modulo 2^64.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Rows and bytes of text (but for one longer text) that are worked on at once; codes that are
#: hashed at once; bits of a shingle's hash.
SLICE, SLICE_BYTES, BLOCK, SET_BITS = 1024, 1 << 20, 1 << 18, 54

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


class _Table:
    """Powers of the base and its inverse, kept and grown."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def need(cls, n: int) -> None:
        if len(cls.up) < n:
            n = max(n, 2 * len(cls.up))
            cls.up, cls.down = _powers(_BASE, n), _powers(_INVERSE, n)


def range_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of ``codes[s:e]`` for each pair, by content and length. ``starts`` must not fall; the
    work is cut into blocks of about BLOCK codes, so the tables of powers stay small."""
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        low = int(starts[i])
        j = int(np.searchsorted(starts, low + BLOCK, "left"))
        j = max(j, i + 1)
        s, e = starts[i:j] - low, ends[i:j] - low
        part = codes[low:low + int(e.max())]
        _Table.need(len(part) + 1)
        sums = np.zeros(len(part) + 1, np.uint64)
        np.multiply(part, _Table.up[:len(part)], out=sums[1:])
        np.cumsum(sums, out=sums)
        out[i:j] = mix((sums[e] - sums[s]) * _Table.down[s] + (e - s).astype(np.uint64))
        i = j
    return out


@dataclass
class Words:
    """Words of the texts of one batch, in order."""

    data: np.ndarray  #: bytes of all texts
    text_starts: np.ndarray  #: byte offsets of the texts, one more than texts
    starts: np.ndarray  #: byte offset of each word
    ends: np.ndarray
    doc: np.ndarray  #: row of each word
    first: np.ndarray  #: index of each row's first word, one more than rows
    lowered: np.ndarray | None = None

    def hashes(self) -> np.ndarray:
        data = self.data if self.lowered is None else self.lowered
        out = np.empty(len(self.starts), np.uint64)
        for i in range(0, len(out), BLOCK):
            s, e = self.starts[i:i + BLOCK], self.ends[i:i + BLOCK]
            out[i:i + BLOCK] = range_hashes(_BYTE_CODES[data[s[0]:e[-1]]], s - s[0], e - s[0])
        return out

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


#: Bytes between words, and these with all ASCII punctuation.
BLANKS = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
BLANKS_AND_SIGNS = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def cut(texts: pa.Array, lower: bool = False, between: np.ndarray = BLANKS) -> Words:
    """``lower``: A-Z count as a-z; ``between``: the bytes that no word has."""
    texts = texts.fill_null("") if texts.null_count else texts
    texts = texts.cast(pa.large_binary())
    _, offsets, data = texts.buffers()
    n = len(texts)
    at = np.frombuffer(offsets, np.int64, n + 1, texts.offset * 8) if n else np.zeros(1, np.int64)
    base, end = int(at[0]), int(at[-1])
    data = np.frombuffer(data, np.uint8, end - base, base) if end > base else np.zeros(0, np.uint8)
    at = at - base
    blank = between[data]
    opens = np.empty(len(data), bool)
    closes = np.empty(len(data), bool)
    if len(data):
        opens[0], closes[-1] = True, True
        opens[1:] = blank[:-1]
        closes[:-1] = blank[1:]
        inner = at[1:-1]
        inner = inner[(inner > 0) & (inner < len(data))]
        opens[inner] = True
        closes[inner - 1] = True
        opens &= ~blank
        closes &= ~blank
    starts = np.flatnonzero(opens)
    ends = np.flatnonzero(closes) + 1
    first = np.searchsorted(starts, at)
    doc = np.repeat(np.arange(n), np.diff(first))
    lowered = None
    if lower:
        lowered = np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)
    return Words(data, at, starts, ends, doc, first, lowered)


def shingle_sets(words: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of the distinct ``size``-word shingles of each row, sorted by row and hash.

    Hashes have SET_BITS bits, so that row and hash sort as one integer: at most SLICE rows.
    A row with fewer words has its whole sequence as one shingle; a row without words has none."""
    h = words.hashes()
    counts = words.counts()
    rows = len(counts)
    grams = np.where(counts >= size, counts - size + 1, (counts > 0).astype(counts.dtype))
    row = np.repeat(np.arange(rows), grams)
    skipped = np.repeat(np.cumsum(grams) - grams, grams)
    start = words.first[:-1][row] + np.arange(len(row)) - skipped
    stop = start + np.minimum(size, counts[row])
    g = range_hashes(h, start, stop)
    key = (row.astype(np.uint64) << np.uint64(SET_BITS)) | (g >> np.uint64(64 - SET_BITS))
    key.sort()
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    key = key[fresh]
    return (key >> np.uint64(SET_BITS)).astype(np.int64), key & np.uint64((1 << SET_BITS) - 1)


def slices(batches, column: int = -1):
    """The batches in pieces of at most SLICE rows and about SLICE_BYTES of a text column (by
    default the last column of strings), so that the arrays stay small."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = column if column >= 0 else max(i for i, f in enumerate(batch.schema) if pa.types.is_string(f.type))
        texts = batch.column(at)
        sizes = np.diff(np.frombuffer(texts.buffers()[1], np.int32, len(texts) + 1, texts.offset * 4).astype(np.int64))
        piece = np.cumsum(sizes) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(piece)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, len(texts)], strict=True):
            for start in range(lo, hi, SLICE):
                yield batch.slice(start, min(SLICE, hi - start))
