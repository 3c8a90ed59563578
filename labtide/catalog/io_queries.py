"""Streaming forms, run to completion over the files that are there."""

from pyspark.sql import functions as F

from labtide import standins
from labtide.catalog.registry import query
from labtide.session import scratch_dir
from labtide.streaming import daily_counts as daily
from labtide.streaming import ledger_stream


@query(
    """
    SELECT strftime(date_trunc('day', ts), '%m/%d/%Y') AS day, event_type AS kind, count(*) AS n FROM events
    GROUP BY 1, 2
    """
)
def stream_daily_counts(t):
    """All days of the event stream."""
    events = daily.read_events(t.spark, f"{t.root}/events.parquet*", t.raw("events").schema)
    out, checkpoint = scratch_dir(t.spark, "daily"), scratch_dir(t.spark, "daily-checkpoint")
    daily.run(daily.daily_counts(events), out, checkpoint).awaitTermination()
    rows = t.spark.read.schema(daily.TABLE).parquet(out)
    return rows.select(F.date_format("day_start", "MM/dd/yyyy").alias("day"), "kind", "n")


@query(
    """
    SELECT DISTINCT user_id AS report_id, user_id AS patient_user_id, 'report_marked_state_reported' AS event_type,
           CAST(7 AS BIGINT) AS user_id, '02/01/2024' AS marked_on
    FROM events
    """
)
def stream_ledger(t):
    """Reports of the event stream, each marked once."""
    events = daily.read_events(t.spark, f"{t.root}/events.parquet*", t.raw("events").schema)
    reports = events.select(F.col("user_id").alias("id"), F.col("user_id").alias("patient_user_id"))
    path, checkpoint = scratch_dir(t.spark, "ledger"), scratch_dir(t.spark, "ledger-checkpoint")
    ledger_stream.run(reports, path, checkpoint, as_of=standins.AS_OF, user_id=7).awaitTermination()
    rows = ledger_stream.store_at(t.spark, path).rows()
    return rows.select(
        "report_id", "patient_user_id", "event_type", "user_id", F.date_format("created_at", "MM/dd/yyyy").alias("marked_on")
    )
