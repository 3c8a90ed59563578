"""The "already reported" ledger: which reports to mark, and the rows that mark them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import MARKED_EVENT
from labtide.functions import time
from labtide.operators import matching
from labtide.plans.state_export import ExportTables, eligible_reports, usable_samples


def marked(event_logs: DataFrame, since=None) -> DataFrame:
    """Report ids the ledger already holds."""
    keep = F.col("event_type") == MARKED_EVENT
    if since is not None:
        keep = keep & (F.col("created_at") >= time.ntz(since))
    return event_logs.where(keep & F.col("report_id").isNotNull()).select("report_id").distinct()


def unreported(reports: DataFrame, event_logs: DataFrame, since=None, key: str = "id") -> DataFrame:
    return matching.absent(reports, marked(event_logs, since), {key: "report_id"})


def to_mark(
    t: ExportTables, event_logs: DataFrame, *, root: int, start=None, end=None, states=None, since=None, **rules
) -> DataFrame:
    """Eligible reports of the window that have a usable specimen, a patient address and no ledger row."""
    reports = eligible_reports(t, root=root, start=start, end=end, **rules)
    places = t.locations.where(F.col("state").isNotNull())
    if states is not None:
        places = places.where(F.col("state").isin(*states))
    reports = matching.present(reports, usable_samples(t), {"kit_id": "kit_id"})
    reports = matching.present(reports, places, {"patient_user_id": "patient_user_id"})
    return unreported(reports, event_logs, since).select("id", "patient_user_id")


def window_of(exported: DataFrame, ts: str):
    """(first, last + 60 s) of an exported file, as one-value subqueries for the window form of marking."""
    first = exported.agg(F.min(ts)).scalar()
    last = exported.agg(F.max(ts) + F.expr("interval 60 seconds")).scalar()
    return first, last


def ledger_rows(marks: DataFrame, *, as_of, user_id: int) -> DataFrame:
    """One ledger row per report."""
    return marks.select(
        F.col("patient_user_id"),
        F.col("id").alias("report_id"),
        F.lit(MARKED_EVENT).alias("event_type"),
        F.lit("human").alias("agent_type"),
        F.lit(user_id).cast("bigint").alias("user_id"),
        F.lit("script").alias("domain"),
        time.ntz(as_of).alias("created_at"),
    )


def rows_for_exported(exported: DataFrame, event_logs: DataFrame, *, as_of, user_id: int) -> DataFrame:
    """Ledger rows for exactly the reports of an export; reports the ledger holds add none."""
    ids = exported.select(F.col("report_id").alias("id"), F.col("`Patient ID`").alias("patient_user_id"))
    return ledger_rows(unreported(ids.dropDuplicates(["id"]), event_logs), as_of=as_of, user_id=user_id)


def mark_manifest(states: DataFrame, exported: DataFrame, marks: DataFrame, key: str = "file_state") -> DataFrame:
    """Newly marked reports per region, zero included, with the notification text."""
    reports = exported.select(key, "report_id").distinct()
    new = matching.present(reports, marks.select(F.col("report_id").alias("marked_id")), {"report_id": "marked_id"})
    counted = matching.count_all(states, new, key)
    told = F.concat(F.col("n").cast("string"), F.lit(" reports marked state reported from "), F.col(key))
    return counted.withColumn(
        "message", F.when(F.col("n") > 0, told).otherwise(F.concat(F.lit("No reports from "), F.col(key)))
    )
