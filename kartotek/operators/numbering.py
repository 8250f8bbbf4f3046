"""First-of-group, positions and running totals that stay even when one group is huge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row of each group. An aggregate, not a window: rows are reduced before the
    shuffle, so a hot key never gathers in one task."""
    return _pick(df, keys, order, F.min_by)


def last_per(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    return _pick(df, keys, order, F.max_by)


def _pick(df, keys, order, pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    chosen = pick(F.struct(*[F.col(c) for c in rest]), F.struct(*order))
    return df.groupBy(*keys).agg(chosen.alias("_row")).select(*keys, "_row.*")


def range_bounds(df: DataFrame, column: str, n: int = 64) -> list:
    """About ``n`` cut points of a column, from a sample of some thousand of its values.
    They only decide how rows are spread; any choice gives the same, whole result."""
    values = df.select(column)
    share = min(1.0, 32.0 * n / max(values.count(), 1))
    picked = sorted(
        r[0] for r in values.sample(share, seed=7).distinct().collect() if r[0] is not None
    )
    return picked[:: max(1, len(picked) // n)][1:]


def running_total(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    value: Column,
    name: str,
    bounds: Sequence | None = None,
) -> DataFrame:
    """Sum of ``value`` over the rows before this one in its group.

    With ``bounds`` on the first order column, each group is cut into ranges: range sums
    give every range its start, and the window then runs inside (group, range) only. The
    input is then read twice, so hand in a stored table where it is costly to compute.
    """
    if not bounds:
        before = (
            Window.partitionBy(*group)
            .orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    cuts = F.array(*[F.lit(b) for b in bounds])
    split = df.withColumn("_range", F.size(F.filter(cuts, lambda b: b <= F.col(order[0]))))
    keys = [*group, "_range"]
    earlier = (
        Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        split.groupBy(*keys)
        .agg(F.sum(value).alias("_sum"))
        .select(*keys, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        split.join(starts, keys)
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(value).over(inside), F.lit(0)))
        .drop("_range", "_start")
    )


def ordinals(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "ordinal",
    bounds: Sequence | None = None,
) -> DataFrame:
    """Dense zero-based position of each row in its group."""
    return running_total(df, group, order, F.lit(1), name, bounds)


def batches(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    size: int = 25,
    bounds: Sequence | None = None,
) -> DataFrame:
    """Fixed-size batches in the given order."""
    numbered = ordinals(df, group, order, "_pos", bounds)
    return numbered.withColumn("batch_id", F.floor(F.col("_pos") / size)).drop("_pos")
