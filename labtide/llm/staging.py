"""Frames written to the shared scratch folder, which cuts their lineage and survives a lost executor."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.session import scratch_dir


def staged(frame: DataFrame, label: str) -> DataFrame:
    """The frame, written once below ``spark.checkpoint.dir`` and read again."""
    spark = frame.sparkSession
    folder = scratch_dir(spark, label)
    frame.write.parquet(folder)
    return spark.read.schema(frame.schema).parquet(folder)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A test table, through Spark's reader."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def literal_rows(spark: SparkSession, values: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A small table that is part of the plan."""
    rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip(row, names)]) for row in values]
    return spark.range(1).select(F.inline(F.array(*rows)))


def body() -> Column:
    """Hash of a row's text, which with doc_id tells rows apart."""
    return F.xxhash64(F.col("text").cast("string"))


def unused(name: str, columns: Sequence[str]) -> str:
    """``name``, with underscores added while one of ``columns`` has it; Spark's names ignore case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not among ``gone`` (doc_id, body); null ids are compared as values."""
    key, gone_id, gone_body = (unused(n, docs.columns) for n in ("key_", "gone_id", "gone_body"))
    gone = gone.select(F.col("doc_id").alias(gone_id), F.col("body").alias(gone_body))
    rows = docs.withColumn(key, body())
    same = F.col("doc_id").cast("bigint").eqNullSafe(F.col(gone_id)) & F.col(key).eqNullSafe(F.col(gone_body))
    return rows.join(gone, same, "left_anti").select(docs.columns)
