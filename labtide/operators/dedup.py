"""One row per key.

``row_number() = 1`` is planned with a group limit before the exchange, so each map task sends at most one row per key
and a key that holds a third of the table never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def top_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of every key under ``order``, which should be total so that reruns agree."""
    ranked = df.withColumn(_RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(_RANK) <= n).drop(_RANK)


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, keys, [F.col(c).asc_nulls_last() for c in order])


def last_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    return top_per_key(df, keys, [F.col(c).desc_nulls_last() for c in order])


def ever(df: DataFrame, key: str, condition: Column, name: str) -> DataFrame:
    """One row per key: did any of its rows meet the condition? Partial aggregation absorbs hot keys."""
    return df.groupBy(key).agg(F.max(F.coalesce(condition, F.lit(False))).alias(name))


def whole_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()
