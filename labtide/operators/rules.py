"""Row rules as data: one pass gives every row the list of rules it breaks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

REASONS = "reasons"


@dataclass(frozen=True)
class Rule:
    """A named test; a row for which ``broken`` is true breaks the rule, a null test does not."""

    name: str
    broken: Column


def with_reasons(df: DataFrame, rules: Sequence[Rule], name: str = REASONS) -> DataFrame:
    """The rows with the names of the rules they break, in the order of the rules; sound rows have an empty list."""
    if not rules:
        return df.withColumn(name, F.array().cast("array<string>"))
    marks = [F.when(F.coalesce(r.broken, F.lit(False)), F.lit(r.name)) for r in rules]
    return df.withColumn(name, F.array_compact(F.array(*marks)))


def observed(df: DataFrame, rules: Sequence[Rule], name: str = REASONS) -> tuple[DataFrame, Observation]:
    """The rows, and the counts that the next write of them gives: ``rows``, ``held`` and one for each rule.

    The counts come with the write itself; there is no second pass.
    """
    seen = Observation("row rules")
    held = F.count_if(F.size(name) > 0).alias("held")
    each = [F.count_if(F.array_contains(name, r.name)).alias(r.name) for r in rules]
    return df.observe(seen, F.count(F.lit(1)).alias("rows"), held, *each), seen


def counts(df: DataFrame, by: str, name: str = REASONS) -> DataFrame:
    """Rows per group and reason. A row that breaks several rules counts for each of them."""
    each = df.select(by, F.explode(name).alias("reason"))
    return each.groupBy(by, "reason").agg(F.count(F.lit(1)).alias("n"))


def filled_values(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """How many of the row's columns have a value, apart from ``without``."""
    held = [F.col(f"`{c}`").isNotNull().cast("int") for c in df.columns if c not in without]
    return sum(held[1:], held[0]) if held else F.lit(0)
