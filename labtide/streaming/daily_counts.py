"""Daily event counts over an append-only event log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from labtide.session import scratch_dir
from labtide.sources import readers, writers


def read_events(spark: SparkSession, path: str, schema, *, files_per_batch: int = 1000) -> DataFrame:
    """``path`` may be a folder, or a glob such as ``.../events.parquet*`` for a single file."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def daily_counts(events: DataFrame, ts: str = "ts", kind: str = "event_type") -> DataFrame:
    """Events per UTC day and type, of all days seen so far.

    There is no watermark: state is one counter per day and type, which the calendar bounds, so late rows always count and
    the result does not depend on how files fall into batches. Windows need TIMESTAMP; the UTC wall time is read as an
    instant, which the session time zone UTC keeps exact.
    """
    timed = events.select(F.col(ts).cast("timestamp").alias("at"), F.col(kind).alias("kind"))
    return (
        timed.groupBy(F.window("at", "1 day").alias("w"), "kind")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("day_start"), F.col("w.end").alias("day_end"), "kind", "n")
    )


TABLE = "day_start timestamp, day_end timestamp, kind string, n bigint, day date"


def replace_days(updated: DataFrame, out: str) -> None:
    """Put new totals (day_start, day_end, kind, n) into the table of days, which is partitioned by ``day``.

    Only the days of ``updated`` are read and rewritten, each with all its kinds, by Spark's dynamic partition overwrite: other
    days' files stay as they are, and readers find every day at any time. Totals replace totals, so the same ones written again
    change nothing. The list of days comes to the driver.
    """
    spark = updated.sparkSession
    new = writers.kept(updated.withColumn("day", F.col("day_start").cast("date")), scratch_dir(spark, "days"))
    days = [r.day for r in new.select("day").distinct().collect()]
    if not days:
        return
    old = readers.empty_or(spark, out, TABLE).where(F.col("day").isin(days))
    rest = old.join(new.select("day", "kind"), ["day", "kind"], "left_anti")
    merged = writers.kept(rest.unionByName(new), scratch_dir(spark, "merged"))
    writer = merged.repartition("day").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("day").parquet(out)


def run(counts: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Process what is there and stop; a later run continues from the checkpoint.

    A batch hands over the totals that it has changed, and rewrites the days they belong to.
    """
    return (
        counts.writeStream.outputMode("update")
        .foreachBatch(lambda table, _: replace_days(table, out))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
