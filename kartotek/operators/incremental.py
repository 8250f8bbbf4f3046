"""What to fetch next, and what a run leaves behind."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kartotek import functions as fn
from kartotek.operators.numbering import running_total
from kartotek.operators.presence import presence
from kartotek.session import cut_lineage, sorted_side

IDENTITY = ("provider_code", "dataset_code", "language")
_STATE_FIELDS = ("source_updated_at", "last_fetched_at", "has_error")


def with_state(candidates: DataFrame, state: DataFrame, keys: Sequence[str] = IDENTITY) -> DataFrame:
    """Candidates with their stored state; ``known`` tells a missing row from an empty one."""
    stored = state.select(
        *keys, *[F.col(c).alias(f"state_{c}") for c in _STATE_FIELDS], F.lit(True).alias("known")
    )
    return candidates.join(sorted_side(stored), list(keys), "left").withColumn(
        "known", F.coalesce("known", F.lit(False))
    )


def never_settled() -> Column:
    """Unseen, never fetched, or failed last time."""
    return (
        ~F.col("known")
        | F.col("state_last_fetched_at").isNull()
        | F.coalesce("state_has_error", F.lit(False))
    )


def select_by_timestamp(
    candidates: DataFrame,
    state: DataFrame,
    force: bool = False,
    keys: Sequence[str] = IDENTITY,
) -> DataFrame:
    """Fetch when the source's date differs from the stored one in either direction, or
    when either is missing."""
    updated, stored = F.col("updated"), F.col("state_source_updated_at")
    changed = updated.isNull() | stored.isNull() | (updated != stored)
    return with_state(candidates, state, keys).withColumn(
        "should_fetch", F.lit(force) | never_settled() | F.coalesce(changed, F.lit(True))
    )


def full_run(force: Column, checkpoint: Column, started_at: Column) -> Column:
    """A run looks at everything when forced, at first, or when the last complete run
    started before the change window opens."""
    return force | checkpoint.isNull() | (checkpoint < fn.window_start(started_at))


def changed(candidates: DataFrame, feed: DataFrame) -> DataFrame:
    """Candidates named in the change feed of their own kind. ``feed`` is (kpi_id, kind)."""
    return candidates.join(feed.select("kpi_id", "kind").distinct(), ["kpi_id", "kind"], "left_semi")


def select_by_window(
    candidates: DataFrame,
    state: DataFrame,
    feed: DataFrame,
    started_at: Column,
    checkpoint: Column,
    force: Column | None = None,
    keys: Sequence[str] = IDENTITY,
) -> DataFrame:
    """Selection for sources without dates of their own. The stored source date stays out
    of it; a KPI is due when unsettled, older than thirty days, or in its change feed."""
    force = F.lit(False) if force is None else force
    named = feed.select("kpi_id", "kind", F.lit(True).alias("in_feed")).distinct()
    due = (
        never_settled()
        | (F.col("state_last_fetched_at") < fn.stale_before(started_at))
        | F.coalesce("in_feed", F.lit(False))
    )
    return (
        with_state(candidates, state, keys)
        .join(sorted_side(named), ["kpi_id", "kind"], "left")
        .withColumn("should_fetch", full_run(force, checkpoint, started_at) | due)
        .drop("in_feed")
    )


def bounded(
    selection: DataFrame, group: Sequence[str], order: Sequence[str], n: int | None,
    bounds: list | None = None,
) -> DataFrame:
    """Every row, with ``attempt_no`` (from 1; NULL for skips) in its scope and ``deferred`` for
    what lies beyond the n-th attempt: such rows keep their place for the next run."""
    attempts = F.col("should_fetch").cast("int")
    if bounds:
        selection = cut_lineage(selection)  # read twice below; the joins run once
    counted = running_total(selection, group, order, attempts, "_before", bounds)
    beyond = F.lit(False) if n is None else F.col("should_fetch") & (F.col("_before") >= n)
    return counted.withColumn(
        "attempt_no", F.when(F.col("should_fetch"), F.col("_before") + 1)
    ).withColumn("deferred", beyond).drop("_before")


def advance_checkpoint(runs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Latest start among complete, unbounded, error-free runs."""
    clean = F.col("listing_complete") & F.col("limit_n").isNull() & F.col("error").isNull()
    return runs.groupBy(*keys).agg(
        F.max(F.when(clean, F.col("started_at"))).alias("checkpoint"),
        F.count("*").alias("runs"),
        F.count_if(clean).alias("clean_runs"),
    )


def outcome_facts(outcomes: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Per dataset, the last save and the last attempt. Both are maxima, so facts of parts
    (runs, micro-batches, replays) can be merged in any order and any number of times."""
    at = [F.col(c) for c in order]
    saved = F.struct(*at, F.col("source_updated_at"), F.col("ts").alias("fetched_at"))
    attempt = F.struct(*at, F.col("outcome"))
    return outcomes.filter(F.col("outcome").isin("saved", "failed")).groupBy(*keys).agg(
        F.max(F.when(F.col("outcome") == "saved", saved)).alias("saved"),
        F.max(attempt).alias("attempt"),
    )


def merge_facts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(
        F.max("saved").alias("saved"), F.max("attempt").alias("attempt")
    )


def state_from_facts(facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    return facts.select(
        *keys,
        F.col("saved.source_updated_at").alias("source_updated_at"),
        F.col("saved.fetched_at").alias("last_fetched_at"),
        (F.col("attempt.outcome") == "failed").alias("has_error"),
    )


def next_state(
    state: DataFrame, outcomes: DataFrame | None, keys: Sequence[str], order: Sequence[str],
    facts: DataFrame | None = None,
) -> DataFrame:
    """State after a run: a save replaces both dates and clears the error, a failure sets
    the error and keeps the last good dates, a skip changes nothing. ``facts``: those of the
    outcomes, where they are at hand."""
    facts = outcome_facts(outcomes, keys, order) if facts is None else facts
    news = state_from_facts(facts, keys).select(
        *keys, *[F.col(c).alias(f"new_{c}") for c in _STATE_FIELDS]
    )
    saved = F.col("new_last_fetched_at").isNotNull()
    return state.join(news, list(keys), "full_outer").select(
        *keys,
        F.when(saved, F.col("new_source_updated_at")).otherwise(F.col("source_updated_at")).alias(
            "source_updated_at"
        ),
        F.coalesce("new_last_fetched_at", "last_fetched_at").alias("last_fetched_at"),
        F.coalesce("new_has_error", "has_error").alias("has_error"),
    )


def rebuild(stored: DataFrame, observations: DataFrame, keys: DataFrame) -> DataFrame:
    """Dimensions after a fetch: the fetched KPIs' categories come from current
    observations alone, so vanished ones are gone; a KPI whose values all vanished fails
    and keeps its last good rows; the others keep theirs."""
    fetched = keys.select("kpi").distinct()
    # Reduced to distinct categories first: raw rows are never shuffled by their KPI.
    fresh = presence(observations).join(fetched, "kpi", "left_semi")
    kept = stored.join(fresh.select("kpi").distinct(), "kpi", "left_anti")
    return kept.unionByName(fresh)
