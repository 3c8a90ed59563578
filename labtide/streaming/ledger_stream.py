"""Marking reports from a stream, each report once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from labtide.plans.ledger import ledger_rows
from labtide.sources.ledger_store import BUCKETS, LedgerStore

LEDGER_SCHEMA = """
patient_user_id bigint, report_id bigint, event_type string, agent_type string, user_id bigint, domain string,
created_at timestamp_ntz
"""
COMPACT_EVERY = 50


def store_at(reports_or_session, path: str, buckets: int = BUCKETS) -> LedgerStore:
    spark = getattr(reports_or_session, "sparkSession", reports_or_session)
    return LedgerStore(spark, path, LEDGER_SCHEMA, buckets)


def mark_batch(reports: DataFrame, batch: int, path: str, *, as_of, user_id: int, buckets: int = BUCKETS) -> LedgerStore:
    """Add the batch's unmarked reports to the ledger; a batch that comes again changes nothing.

    Every ``COMPACT_EVERY`` batches, those before the last are put together: a batch that begins ends all earlier ones.
    """
    store = store_at(reports, path, buckets)
    store.add(ledger_rows(reports, as_of=as_of, user_id=user_id), batch)
    if batch and batch % COMPACT_EVERY == 0:
        store.compact(batch - 1)
    return store


def run(reports: DataFrame, path: str, checkpoint: str, *, as_of, user_id: int, buckets: int = BUCKETS) -> StreamingQuery:
    """``reports`` is a stream of (id, patient_user_id)."""

    def mark(batch_rows: DataFrame, batch: int) -> None:
        mark_batch(batch_rows, batch, path, as_of=as_of, user_id=user_id, buckets=buckets)

    return (
        reports.writeStream.foreachBatch(mark)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
