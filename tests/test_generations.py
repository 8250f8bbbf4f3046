"""A fact log that stays small, and selections that see what was saved a moment ago."""

from datetime import datetime

import pytest

from kartotek.operators import incremental
from kartotek.streaming import generations
from kartotek.streaming import outcomes as streams
from kartotek.streaming.generations import FactLog

T = datetime(2024, 5, 1)
OUT = "dataset_code string, seq int, ts timestamp, outcome string, source_updated_at timestamp"
STATE = "dataset_code string, source_updated_at timestamp, last_fetched_at timestamp, has_error boolean"
LISTING = "dataset_code string, updated timestamp"
KEYS = ["dataset_code"]


def facts(spark, *rows):
    return incremental.outcome_facts(spark.createDataFrame([(c, n, T, o, T) for c, n, o in rows], OUT), KEYS, ["seq"])


@pytest.mark.parametrize("fanout", [2, 8])
def test_folders_stay_few_over_a_thousand_batches(monkeypatch, fanout):
    monkeypatch.setattr(generations, "FANOUT", fanout)
    live, most = [], 0
    for batch in range(1000):
        live.append(f"0-{batch:012d}-{batch:012d}")
        while (due := generations.due_merge(live)) is not None:
            same, target = due
            live = [f for f in live if f not in same] + [target]
        most = max(most, len(live))
        spans = sorted(tuple(map(int, f.split("-")[1:])) for f in live)
        assert spans[0][0] == 0 and spans[-1][1] == batch  # every batch stands in exactly one folder
        assert all(a[1] + 1 == b[0] for a, b in zip(spans, spans[1:], strict=False))
    assert most <= {2: 10, 8: 28}[fanout]


def test_a_log_of_many_batches(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(generations, "FANOUT", 2)
    path = str(tmp_path / "log")
    log = FactLog(spark, path, KEYS)
    assert log.state() is None and streams.stored_state(spark, path, KEYS).collect() == []
    for n in range(6):
        log.add(facts(spark, ("A", n, "saved"), (f"D{n}", n, "failed")), n)
    log.add(facts(spark, ("Z", 99, "saved")), 3)  # a replay of a batch that is there
    assert log.live() == ["1-000000000004-000000000005", "2-000000000000-000000000003"]
    assert log.generations() == [3, 4, 5]
    stored = {p.name for p in (tmp_path / "log" / "facts").iterdir()}
    assert len(stored) <= 5 and stored >= set(log.live())
    state = {r.dataset_code: r.has_error for r in log.state().collect()}
    assert state == {"A": False} | {f"D{n}": True for n in range(6)}
    assert {r.dataset_code for r in log.state(4).collect()} == {"A"} | {f"D{n}" for n in range(5)}


def test_a_batch_that_was_killed_is_run_again(spark, tmp_path):
    log = FactLog(spark, str(tmp_path / "log"), KEYS)
    log.add(facts(spark, ("A", 1, "saved")), 0)
    facts(spark, ("B", 2, "saved")).limit(0).write.parquet(f"{log.path}/facts/0-000000000001-000000000001")  # half done, no generation
    assert {r.dataset_code for r in log.state().collect()} == {"A"}
    log.add(facts(spark, ("B", 2, "saved")), 1)
    assert {r.dataset_code for r in log.state().collect()} == {"A", "B"}


def test_what_is_saved_between_two_batches_is_skipped_in_the_second(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    log = FactLog(spark, str(tmp_path / "log"), KEYS)
    state = spark.createDataFrame([("OLD", T, T, False)], STATE)
    rows = "dataset_code string, updated timestamp, should_fetch boolean"

    def arrive(*codes):
        spark.createDataFrame([(c, T) for c in codes], LISTING).coalesce(1).write.mode("append").parquet(folder)
        source = spark.readStream.schema(LISTING).parquet(folder)
        streams.finish(streams.stream_select(source, state, out, str(tmp_path / "cp"), KEYS, log))
        got = streams.selected(spark, out, rows).collect()
        return sorted((r.dataset_code, r.should_fetch) for r in got)

    first = arrive("A", "OLD")
    assert first == [("A", True), ("OLD", False)]
    log.add(facts(spark, ("A", 1, "saved"), ("OLD", 1, "failed")), 0)
    assert sorted(arrive("A", "OLD", "B")) == sorted(first + [("A", False), ("B", True), ("OLD", True)])


def test_a_replay_takes_the_generation_it_noted(spark, tmp_path):
    log = FactLog(spark, str(tmp_path / "log"), KEYS)
    log.add(facts(spark, ("A", 1, "saved")), 0)
    assert streams._noted(spark, str(tmp_path / "g"), log) == 0
    log.add(facts(spark, ("A", 2, "failed")), 1)
    assert streams._noted(spark, str(tmp_path / "g"), log) == 0 and streams._noted(spark, str(tmp_path / "h"), log) == 1
    empty = FactLog(spark, str(tmp_path / "none"), KEYS)
    assert streams._noted(spark, str(tmp_path / "i"), empty) == -1 and empty.facts(-1) is None
