"""Column selection driven by names and types. Only schema metadata is touched, never data."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def search(df: DataFrame, terms: str | Sequence[str]) -> list[str]:
    """Columns whose lower-cased name contains any of the terms."""
    terms = [terms] if isinstance(terms, str) else list(terms)
    return [c for c in df.columns if any(t in c.lower() for t in terms)]


def keep_present(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The listed columns that exist, in the frame's own order."""
    return df.select([c for c in df.columns if c in set(names)])


def of_type(df: DataFrame, kind: type[T.DataType], *, exclude: bool = False) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, kind) != exclude]


def leading(df: DataFrame, n: int) -> DataFrame:
    return df.select(df.columns[:n])


def rename_all(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return df.toDF(*names)


def rename_where(df: DataFrame, rule: Callable[[str], str]) -> DataFrame:
    return df.withColumnsRenamed({c: rule(c) for c in df.columns if rule(c) != c})


def strip_prefix(df: DataFrame, prefix: str) -> DataFrame:
    return rename_where(df, lambda c: c.removeprefix(prefix))


def copy_group(df: DataFrame, targets: Sequence[str], sources: Sequence[str]) -> DataFrame:
    """Copy one group of columns into another, pairwise."""
    return df.withColumns({t: F.col(f"`{s}`") for t, s in zip(targets, sources, strict=True)})


def flatten(df: DataFrame, struct: str, names: Mapping[str, str] | None = None) -> DataFrame:
    """Lift the fields of a struct column to the top level, renaming some of them."""
    fields = [f.name for f in df.schema[struct].dataType.fields]
    names = names or {}
    lifted = [F.col(f"`{struct}`.`{f}`").alias(names.get(f, f)) for f in fields]
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != struct], *lifted)
