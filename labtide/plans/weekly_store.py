"""Kept activity sums per metric, day and user, from which weekly reports are made without reading old logs again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.sources import readers

SUMS = "metric string, fullname string, n bigint, sec bigint, frac bigint, day date, week_start date"
MONDAY = 0


def update(rows: DataFrame, path: str, start: dt.date, end: dt.date) -> None:
    """Put the sums of the weeks from ``start`` on and before ``end`` into the store; both are Mondays.

    ``rows`` (metric, day, fullname, n, sec, frac) come from a log that is bounded to these local days. Weeks that have rows are
    replaced as a whole, all others stay, so taking the same weeks again changes nothing, and late rows count once their
    week is taken again.
    """
    if start.weekday() != MONDAY or end.weekday() != MONDAY:
        raise ValueError(f"{start} and {end} must be Mondays")
    week = F.date_trunc("week", "day").cast("date")
    shown = [F.col(c).cast(kind).alias(c) for c, kind in (f.split() for f in SUMS.split(", ")[:-1])]
    weeks = rows.select(*shown, week.alias("week_start")).repartition("week_start")
    weeks.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("week_start").parquet(path)


def sums(spark: SparkSession, path: str, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """The kept sums of the weeks that begin from ``start`` on and before ``end``; only their folders are read."""
    kept = readers.empty_or(spark, path, SUMS)
    if start is not None:
        kept = kept.where(F.col("week_start") >= F.lit(start))
    kept = kept if end is None else kept.where(F.col("week_start") < F.lit(end))
    return kept.drop("week_start")
