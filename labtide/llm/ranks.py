"""Places of rows in an order within a key, however many rows a key has."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labtide.llm.staging import staged

RUN = 250_000
IN_PART = 33


def ordered(rows: DataFrame, keys: Sequence[str], run: int = RUN) -> DataFrame:
    """``rows`` with ``at``, a number that grows with ``keys`` (nulls first), written out in ranges of about ``run`` rows.

    The ranges follow the keys in order, so a value that holds a third of the first key is spread by the keys after it.
    ``at`` is the range's number times 2 ** 33 plus the row's place in it; equal rows get different numbers.
    """
    order = [F.col(k).asc_nulls_first() for k in keys]
    parts = max(1, -(-rows.count() // run))
    split = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return staged(split.withColumn("at", F.monotonically_increasing_id()), "ordered")


def ranked(rows: DataFrame, key: str, order: Sequence[str], run: int = RUN) -> DataFrame:
    """``rows`` with ``rank`` (from 0, by ``order`` within ``key``) and ``n``, the rows of the key. The key has no nulls.

    ``rows`` is read twice and should be staged. Only the counts of each key in each range meet in a window: a row for
    every ``run`` rows of a key.
    """
    placed = ordered(rows, [key, *order], run)
    part = F.shiftright("at", IN_PART)
    runs = placed.groupBy(F.col(key).alias("run_key"), part.alias("run_part")).agg(F.count("*").alias("held"), F.min("at").alias("first"))
    whole = Window.partitionBy("run_key")
    before = whole.orderBy("run_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = runs.select(
        "run_key",
        "run_part",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(whole).alias("n"),
    )
    met = (F.col(key) == F.col("run_key")) & (part == F.col("run_part"))
    return placed.join(starts, met).select(*rows.columns, (F.col("at") + F.col("shift")).alias("rank"), "n")
