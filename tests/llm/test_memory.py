"""Passes give their memory back when a partition ends."""

import re
import sys
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from kartotek.llm import ngram_join
from kartotek.llm.memory import tidy

PINNED = []


def held():
    return sum(map(int, re.findall(r"\nPss_Anon:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text()))) / 1024


def hungry(batches):
    """64 MB in small arrays, freed under one that stays."""
    for batch in batches:
        rooms = [np.ones(8000) for _ in range(1000)]
        PINNED.append(np.ones(8000))
        del rooms
        yield batch


@pytest.mark.skipif(sys.platform != "linux", reason="reads /proc")
def test_memory_is_given_back_at_the_end_of_a_partition():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2])], ["x"])
    before = held()
    assert list(tidy(hungry)(iter([batch] * 3))) == [batch] * 3
    assert held() - before < 20


def test_a_partition_that_is_left_early_gives_back_too(monkeypatch):
    from kartotek.llm import memory

    calls = []
    monkeypatch.setattr(memory, "give_back", lambda: calls.append(1))
    rows = tidy(lambda batches: (b for b in batches))(iter("abc"))
    assert next(rows) == "a" and not calls
    rows.close()
    assert calls == [1]


class Whole:
    """A bit table with all bits set, as a broadcast."""

    value = np.full(1 << 10, 255, np.uint8)


class Nothing:
    value = np.zeros(1 << 10, np.uint8)


def test_members_are_sifted_and_cut_in_one_pass():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 54, n)).tolist() for n in (3, 40, 300)] + [[]]
    batch = pa.RecordBatch.from_arrays(
        [pa.array([5, -6, 7, 8], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["cls", "grams"])
    out = list(ngram_join._member_postings(iter([batch, batch.slice(0, 0)]), 80, Whole, Whole))
    rows = pa.Table.from_batches(out).to_pylist()
    assert {(r["cls"], r["size"]) for r in rows} == {(5, 3), (-6, 40), (7, 300)}
    assert sum(x.num_rows for x in ngram_join._member_postings(iter([batch]), 80, Nothing, Whole)) == 0
