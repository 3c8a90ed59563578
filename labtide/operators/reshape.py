"""Pivot and transpose. Pivot values always come from parameters, never from a collected distinct list."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pivot_sum(
    df: DataFrame,
    rows: Sequence[str],
    pivot: str,
    values: Sequence[str],
    measure: str,
    *,
    fill: int | None = 0,
) -> DataFrame:
    """Rows by pivot values, summing ``measure``; missing cells become ``fill``.

    One sum for each value, all in one aggregate: ``pivot`` would aggregate and exchange by cell first, and hold both in a task.
    """
    sums = [F.sum(F.when(F.col(pivot) == v, F.col(measure))).alias(str(v)) for v in values]
    wide = df.groupBy(*rows).agg(*sums)
    return wide if fill is None else wide.na.fill(fill, subset=list(values))


def pivot_count(df: DataFrame, rows: Sequence[str], pivot: str, values: Sequence[str]) -> DataFrame:
    """Rows by pivot values with row counts; a cell without rows stays null."""
    return df.groupBy(*rows).pivot(pivot, list(values)).agg(F.count(F.lit(1)))


def long_metrics(frames: dict[str, DataFrame]) -> DataFrame:
    """Several frames of one shape as one long frame with a ``metric`` column (in place of chained outer joins)."""
    out = None
    for name, frame in frames.items():
        tagged = frame.withColumn("metric", F.lit(name))
        out = tagged if out is None else out.unionByName(tagged)
    return out


def transpose(
    df: DataFrame, keep: Sequence[str], across: str, values: Sequence[str], metrics: Sequence[str]
) -> DataFrame:
    """Metrics become rows and the values of ``across`` become columns."""
    texts = [F.col(m).cast("string").alias(m) for m in metrics]
    long = df.select(*keep, across, *texts).unpivot([*keep, across], list(metrics), "metric", "value")
    return long.groupBy(*keep, "metric").pivot(across, list(values)).agg(F.max("value"))
