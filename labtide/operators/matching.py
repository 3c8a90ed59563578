"""Membership, lookups and row appends."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.operators import dedup


def family(tree: DataFrame, root: int, *, id: str = "id", parent: str = "parent_distributor_id") -> DataFrame:
    """Ids of one node and its direct children."""
    return tree.where((F.col(id) == root) | (F.col(parent) == root)).select(id)


def present(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows with a partner in ``keys``."""
    return df.join(keys, [df[a] == keys[b] for a, b in on.items()], "left_semi")


def absent(df: DataFrame, keys: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows without a partner in ``keys``. Null keys in the list are ignored; they do not empty the result."""
    known = keys.select(*[F.col(b).alias(f"__{b}") for b in on.values()]).dropna()
    return df.join(known, [df[a] == known[f"__{b}"] for a, b in on.items()], "left_anti")


def looked_up(df: DataFrame, table: DataFrame, key: str, value: str, error: str) -> DataFrame:
    """Rows with their looked-up value and an ``error`` text where there is none, in one pass."""
    found = df.join(table.select(key, value), key, "left")
    return found.withColumn("error", F.when(F.col(value).isNull(), F.lit(error)))


def lookup_or_error(
    df: DataFrame, table: DataFrame, key: str, value: str, error: str
) -> tuple[DataFrame, DataFrame]:
    """(rows with their looked-up value, rows that found none with an ``error`` text)."""
    found = looked_up(df, table, key, value, error)
    return found.where(F.col("error").isNull()).drop("error"), found.where(F.col("error").isNotNull()).drop(value)


def append(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; a column missing from one frame is null there."""
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame, allowMissingColumns=True)
    return out


def with_new(old: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``old`` plus one row for each unseen key of ``candidates``: the least one by its other columns, in their order."""
    firsts = dedup.first_per_key(candidates, [key], [c for c in candidates.columns if c != key] or [key])
    return append(old, absent(firsts, old, {key: key}))


def segments(df: DataFrame, rules: Mapping[str, Column], name: str = "segment") -> DataFrame:
    """One copy of a row for every segment whose rule it meets, so all slices are written by one job."""
    marks = F.array(*[F.when(F.coalesce(rule, F.lit(False)), F.lit(label)) for label, rule in rules.items()])
    return df.withColumn(name, F.explode(F.array_compact(marks)))


def result_mode(df: DataFrame, mode: str = "", result: str = "Result", term: str = "Positive") -> DataFrame:
    """``P`` keeps positives, ``N`` omits them, anything else keeps all; a missing result is not positive."""
    positive = F.coalesce(F.contains(F.col(result), F.lit(term)), F.lit(False))
    if "P" in mode:
        df = df.where(positive)
    if "N" in mode:
        df = df.where(~positive)
    return df


def count_all(groups: DataFrame, rows: DataFrame, key: str, name: str = "n") -> DataFrame:
    """Row count of every listed group, with zeros."""
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias(name))
    return groups.select(key).join(counts, key, "left").na.fill(0, subset=[name])


def union_names(frames: Sequence[DataFrame], column: str) -> DataFrame:
    out = frames[0].select(column)
    for frame in frames[1:]:
        out = out.union(frame.select(column))
    return out.distinct()
