"""Taking in region files as they arrive, each file once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labtide.operators import matching
from labtide.session import scratch_dir
from labtide.sources import readers, writers

LINES = "state string, file string, value string, batch bigint"
FILES = "state string, file string, bytes bigint, arrived timestamp, n bigint, batch bigint"


def region_of(path: Column, name: Column) -> Column:
    """The region of a file: from its folder ``file_state=...``, else the two capitals before the first underscore of its name."""
    folder = F.regexp_extract(path, "file_state=([^/]+)", 1)
    return F.when(folder != "", folder).otherwise(F.nullif(F.regexp_extract(name, "^([A-Z]{2})_", 1), F.lit("")))


def read_files(spark: SparkSession, path: str, *, files_per_batch: int = 1000, pattern: str = "*") -> DataFrame:
    """Lines of all files below ``path`` as a stream, with the file they stand in."""
    reader = spark.readStream.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    lines = reader.option("maxFilesPerTrigger", files_per_batch).text(path)
    at, name = F.col("_metadata.file_path"), F.col("_metadata.file_name")
    # Parts of one region that a task wrote have one name in folders of their own.
    return lines.select(
        region_of(at, name).alias("state"),
        F.concat(F.regexp_extract(at, "(file=[0-9]+/)[^/]*$", 1), name).alias("file"),
        "value",
        F.col("_metadata.file_size").alias("bytes"),
        F.col("_metadata.file_modification_time").alias("arrived"),
    )


def take(lines: DataFrame, batch: int, out: str) -> None:
    """Add a batch's lines and a row for each of its files.

    A file is known by region and name: one that an earlier batch has taken, under whatever path, is left out. A batch
    owns its partition of both tables and compares against the others only, so one that comes again changes nothing. Empty files
    have no lines and are not noted. No file is gathered: its lines may be read by many tasks.
    """
    spark = lines.sparkSession
    lines = writers.kept(lines, scratch_dir(spark, "intake"))
    files = lines.groupBy("state", "file").agg(F.max("bytes").alias("bytes"), F.max("arrived").alias("arrived"), F.count(F.lit(1)).alias("n"))
    known = readers.empty_or(spark, f"{out}/files", FILES).where(F.col("batch") != batch)
    key = F.concat_ws("/", F.coalesce("state", F.lit("")), "file")
    taken = known.select(key.alias("taken"))
    fresh = matching.absent(files.withColumn("key", key), taken, {"key": "taken"}).drop("key")
    fresh = writers.kept(fresh, scratch_dir(spark, "intake-files"))
    rows = matching.present(lines.withColumn("key", key), fresh.select(key.alias("fresh")), {"key": "fresh"})
    for table, part in ((rows.select("state", "file", "value"), "lines"), (fresh, "files")):
        writer = table.withColumn("batch", F.lit(batch).cast("bigint")).write.mode("overwrite")
        writer.option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/{part}")


def run(lines: DataFrame, out: str, checkpoint: str, *, first_batch: int = 0) -> StreamingQuery:
    """Take in what is there and stop; a later run goes on from the checkpoint.

    Where a checkpoint was lost, ``first_batch`` sets the new stream's batches apart from those that are there.
    """
    return (
        lines.writeStream.foreachBatch(lambda rows, batch: take(rows, first_batch + batch, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
