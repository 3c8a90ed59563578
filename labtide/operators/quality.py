"""Row and column quality rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.operators.columns import search


def drop_empty_rows(df: DataFrame) -> DataFrame:
    return df.dropna(how="all")


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns without a single value. One row of counts comes back to choose the columns."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]).first()
    return df.select([F.col(f"`{c}`") for c in df.columns if counts[c]])


def require(df: DataFrame, terms: str | Sequence[str]) -> DataFrame:
    """Drop rows lacking a value in any column whose name contains one of the terms."""
    names = search(df, terms)
    return df.dropna(how="any", subset=[f"`{c}`" for c in names]) if names else df


def at_least(df: DataFrame, n: int) -> DataFrame:
    """Keep rows with at least ``n`` values."""
    return df.dropna(thresh=n)


def split_bad(df: DataFrame, bad: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, quarantined rows); a null test counts as good."""
    flag = F.coalesce(bad, F.lit(False))
    return df.where(~flag), df.where(flag)
