"""Null-safe access to structs and arrays of structs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.functions.time import col


def first_of(arr: Column | str) -> Column:
    """First element; null for an empty or missing array."""
    return F.try_element_at(col(arr), F.lit(1))


def last_of(arr: Column | str) -> Column:
    return F.try_element_at(col(arr), F.lit(-1))


def association_id(arr: Column | str) -> Column:
    """``id`` of the first associated object."""
    return first_of(arr).getField("id")


def explode_results(pages: DataFrame, results: str = "results") -> DataFrame:
    """One row per object of a landed API page, with the object's fields as columns."""
    return pages.select(F.explode(F.col(results)).alias("item")).select("item.*")
