"""Readers: tables, delimited text, landed JSON, id lists and file globs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtide.config.settings import Dialect
from labtide.functions import time
from labtide.operators import quality


def table(spark: SparkSession, root: str, name: str, schema: str | None = None) -> DataFrame:
    """A parquet table below ``root``; filters and columns are pushed into the scan.

    A declared schema saves the job that reads file footers to find one.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{root.rstrip('/')}/{name}.parquet")


def jdbc_table(
    spark: SparkSession, url: str, name: str, *, split_on: str, low: int, high: int, parts: int, options: Mapping[str, str] | None = None
) -> DataFrame:
    """A database table read by ``parts`` parallel range queries on a numeric column."""
    reader = spark.read.format("jdbc").options(
        url=url, dbtable=name, partitionColumn=split_on, lowerBound=low, upperBound=high, numPartitions=parts
    )
    return reader.options(**(options or {})).load()


def query(spark: SparkSession, sql: str, tables: Mapping[str, DataFrame], **args) -> DataFrame:
    """SQL over DataFrames with bound parameters; ``{name}`` stands for a table and ``:name`` for a parameter."""
    return spark.sql(sql, args=args or None, **tables)


def empty_or(spark: SparkSession, path: str, schema: str | T.StructType, fmt: str = "parquet") -> DataFrame:
    """Files at ``path``, or no rows before the first write."""
    try:
        return spark.read.format(fmt).schema(schema).load(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


def sheet(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """A spreadsheet tab saved as text: empty rows and empty columns are dropped."""
    reader = spark.read.option("header", True)
    rows = (reader.schema(schema) if schema else reader).csv(path)
    return quality.drop_empty_columns(quality.drop_empty_rows(rows))


def delimited(spark: SparkSession, path: str, schema: str, *, sep: str = ",", header: bool = True) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=header, sep=sep)


def all_text(spark: SparkSession, path: str, *, sep: str = ",") -> DataFrame:
    """Delimited files with every column as text."""
    return spark.read.csv(path, header=True, sep=sep, inferSchema=False)


def id_list(spark: SparkSession, path: str) -> DataFrame:
    """A one-column list of ids without header; a byte-order mark on the first line is ignored."""
    rows = spark.read.schema("id string").csv(path)
    return rows.select(F.regexp_replace("id", "^﻿", "").cast("bigint").alias("id"))


def region_of_file() -> Column:
    """Region code at the start of the file name."""
    return F.regexp_extract("_metadata.file_name", "^([A-Z]{2})_", 1)


def region_files(spark: SparkSession, path: str, *, pattern: str = "*.csv") -> DataFrame:
    """Region files of one layout as one all-text table with a ``state`` column."""
    rows = spark.read.csv(path, header=True, pathGlobFilter=pattern, recursiveFileLookup=True)
    return rows.select(region_of_file().alias("state"), "*")


def json_objects(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Landed JSON lines with a declared schema."""
    return spark.read.schema(schema).json(path)


def watermark(spark: SparkSession, path: str, default) -> Column:
    """The last export time, or ``default`` on the first run, as a one-value subquery."""
    seen = empty_or(spark, path, "last_export timestamp_ntz")
    return seen.agg(F.coalesce(F.max("last_export"), time.ntz(default)).alias("last_export")).scalar()


def region_file(spark: SparkSession, path: str, regions: Sequence[str], schema: str, dialect: Dialect, key: str = "file_state") -> DataFrame:
    """Files of regions that share a dialect, as plain delimited text with the region as a column. Regions without files give no rows."""
    base, found = path.rstrip("/"), None
    whole = f"{schema}, {key} string, file int"
    for region in regions:
        try:
            part = spark.read.schema(whole).option("basePath", base).csv(f"{base}/{key}={region}", sep=dialect.sep, header=dialect.header)
        except AnalysisException as error:
            if "PATH_NOT_FOUND" not in str(error):
                raise
            continue
        found = part if found is None else found.unionAll(part)
    return (spark.createDataFrame([], whole) if found is None else found).drop("file")
