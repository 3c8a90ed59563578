"""Whole runs: the steps a schedule starts. Each shared frame is written once and read by the steps after it."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.config.settings import ACCESSIONING_GROUPS, DATA_ENTRY_GROUPS, FileNames, LabIdentity
from labtide.functions import codes, time
from labtide.operators import matching, reshape, rules
from labtide.plans import activity, cleanse, funnel, ledger, shift, state_export, template, trackers, turnaround, weekly_store
from labtide.plans.journal import Journal, Run
from labtide.session import require_utc, sized
from labtide.sources import readers, writers
from labtide.sources.ledger_store import LedgerStore
from labtide.sources.versions import VersionedTable


def dashboards(facts: DataFrame, out: str, segments: Mapping[str, Column], *, term: str = "COVID") -> None:
    """Funnel by start and event day, turnaround per segment with the overall mean, positives, and the turnaround of all other
    tests in days. The source tables are read once."""
    spark = require_utc(facts.sparkSession)
    with sized(spark, facts):
        facts.write.mode("overwrite").parquet(f"{out}/facts")
        facts = spark.read.parquet(f"{out}/facts")
        for day in ("start_day", "event_day"):
            writers.publish(funnel.funnel(facts, day=day, term=term), f"{out}/events_by_{day}")
        rows = turnaround.clean_tracking(turnaround.with_average(turnaround.turnaround(facts, term=term, clean=False)))
        shown = rows.select(*turnaround.published(rows).columns, turnaround.AVERAGE)
        writers.publish(matching.segments(shown, segments), f"{out}/turnaround", by="segment", sort=["sent_day"])
        writers.publish(turnaround.positives(rows), f"{out}/positives", sort=["sent_day"])
        genomics = turnaround.published(turnaround.turnaround(facts, term=term, genomics=True))
        writers.publish(matching.segments(genomics, segments), f"{out}/genomics", by="segment", sort=["sent_day"])


def refresh_trackers(
    rows: DataFrame, landed: DataFrame, table_path: str, out: str, *, full_load: bool = False
) -> VersionedTable:
    """Take landed tracker records into the tracker table, and restart the turnaround of tracked kits at delivery.

    ``rows`` are turnaround rows with a tracking number, ``landed`` raw tracker records. Of several records of a number the one
    updated last counts, however they arrive; readers of the table keep their version meanwhile. Published are
    the table by number, the tracked turnaround and the numbers that no tracker is known for yet.
    """
    spark = require_utc(rows.sparkSession)
    with sized(spark, rows, landed):
        table = VersionedTable(spark, table_path, "tracking_number", ["updated_at", "easypost_id"])
        table.upsert(trackers.normalise(landed, full_load=full_load))
        known = table.read()
        writers.publish(known, f"{out}/trackers", sort=["tracking_number"])
        # The tracked rows are written before their range filter and hold every number, so ``rows`` is worked out once.
        every = turnaround.tracked(rows, known)
        writers.publish(turnaround.in_range(every), f"{out}/tracked", sort=["sent_date"])
        writers.publish(turnaround.unseen_tracking(every, known), f"{out}/unseen", sort=["tracking_number"])
    return table


def shift_reports(
    tables: Mapping[str, DataFrame], out: str, week: dt.date, *, tz: str = time.EST
) -> None:
    """Data-entry and accessioning reports of the week that starts on the Monday ``week``.

    What several reports show is worked out once and kept in ``out/shared``.
    """
    spark = require_utc(tables["staff"].sparkSession)
    with sized(spark, *tables.values()):
        span = {"start": week, "end": week + dt.timedelta(days=7), "tz": tz}
        staff, log = tables["staff"], tables["event_logs"]
        tickets = activity.ticket_metric(tables["tickets"], staff, **span)
        entry = activity.event_metrics(log, tables["kits"], staff, **span).unionByName(
            reshape.long_metrics({"tickets_created": tickets})
        )
        accession = reshape.long_metrics(
            {
                "pages_scanned": activity.scan_metric(tables["scans"], staff, **span),
                "samples_accessioned": activity.accession_metric(tables["reports"], log, staff, **span),
                "tickets_created": tickets,
            }
        )
        matrix = writers.kept(shift.event_matrix(log, staff, **span), f"{out}/shared/events")
        by_category = writers.kept(shift.ticket_matrix(tables["tickets"], staff, **span), f"{out}/shared/tickets")
        for name, rows, groups in (
            ("data_entry", entry, DATA_ENTRY_GROUPS),
            ("accessioning", accession, ACCESSIONING_GROUPS),
        ):
            metrics = {
                "data_entry": DATA_ENTRY_METRICS,
                "accessioning": ["pages_scanned", "samples_accessioned", "tickets_created"],
            }[name]
            rows = writers.kept(rows, f"{out}/shared/{name}")
            daily = activity.by_day(rows, ["metric"])
            writers.publish(shift.user_grid(rows, metrics), f"{out}/{name}/users", sort=["week_start", "fullname"])
            writers.publish(shift.daily_table(daily, metrics, week=week), f"{out}/{name}/daily")
            writers.publish(matrix.where(F.col("event_group").isin(*groups)), f"{out}/{name}/events", by="event_group")
            writers.publish(by_category, f"{out}/{name}/tickets")


def weekly_activity(tables: Mapping[str, DataFrame], store: str, start: dt.date, end: dt.date, *, tz: str = time.EST) -> DataFrame:
    """Take the weeks from ``start`` on and before ``end``, both Mondays, into the store of data-entry sums, and give the user grid
    of every week the store knows. Only the log of these weeks is read."""
    spark = require_utc(tables["staff"].sparkSession)
    with sized(spark, *tables.values()):
        span = {"start": start, "end": end, "tz": tz}
        tickets = activity.ticket_metric(tables["tickets"], tables["staff"], **span)
        entry = activity.event_metrics(tables["event_logs"], tables["kits"], tables["staff"], **span)
        weekly_store.update(entry.unionByName(reshape.long_metrics({"tickets_created": tickets})), store, start, end)
        return shift.user_grid(weekly_store.sums(spark, store), DATA_ENTRY_METRICS)


DATA_ENTRY_METRICS = ["entries", "reviews", "scans_assigned_to_kits", "tickets_created"]
ACCESSION = "Specimen ID / Accession Number"
HELD_SCHEMA = "report_id bigint, file_state string, since_run bigint, reasons array<string>"


@dataclass(frozen=True)
class Reporting:
    """Where and how the public-health export runs; places are folders.

    ``root`` is the distributor, ``states`` the regions to report to (all unless given). ``templates`` has the forms of regions that want columns
    of their own, all others get the export's columns.
    """

    lab: LabIdentity
    root: int
    ledger_path: str
    watermark_path: str
    deliveries_path: str
    states: Sequence[str] = tuple(codes.REGIONS)
    journal_path: str | None = None
    report_type_ids: Sequence[int] | None = None
    templates: Mapping[str, template.Template] = field(default_factory=dict)
    catalogue: Mapping[int, str] = field(default_factory=dict)
    names: FileNames = field(default_factory=FileNames)
    mode: str = ""
    user_id: int = 0
    tz: str = time.EST
    ledger_buckets: int = 64

    @property
    def journal(self) -> str:
        return self.journal_path or f"{self.watermark_path.rstrip('/')}_journal"


def state_reporting(
    spark: SparkSession,
    t: state_export.ExportTables,
    event_logs: DataFrame,
    lab: LabIdentity,
    out: str,
    *,
    end: dt.datetime,
    first_start: dt.datetime,
    test_run: bool = False,
    **settings,
) -> DataFrame:
    """Export everything since the last run, write the region files, mark the reports, move the watermark.

    ``end``, ``first_start`` and the watermark are local times; ``settings`` are those of ``Reporting``. A run covers reports
    sent from the watermark on and before ``end``, so one sent exactly at ``end`` goes out with the next run only.

    A report with a row that breaks a rule (``cleanse.export_rules``) is held back whole: its rows go to ``out/quarantine``
    with their reasons, it is in no file, not counted and not marked. It is looked at again by every later run, however
    old it is, until it is marked. Files hold cleansed rows, in the columns of the region's form where it has one and in
    the region's dialect.

    Every step is noted in a journal. A run that died goes on, when called again, where it stopped and over the window it had,
    before a new window is begun. Run twice over the same window, it marks no report and logs no delivery a second time.

    The manifest is returned. A test run keeps six rows per region and writes files only: it marks and holds nothing, and
    leaves journal and watermark alone.
    """
    how = Reporting(lab=lab, **settings)
    with sized(require_utc(spark), t.reports, t.samples, t.locations, t.patient_users, event_logs):
        journal = Journal(spark, how.journal)
        if test_run:
            start = _watermark(spark, how, first_start)
            return _export_window(spark, t, event_logs, how, out, Run(journal, 0, start, end), test_run=True)
        manifest, left = None, journal.unfinished()
        if left is not None:
            manifest = _export_window(spark, t, event_logs, how, out, left)
        if left is None or left.end < end:
            start = _watermark(spark, how, first_start)
            manifest = _export_window(spark, t, event_logs, how, out, journal.begin(start, end))
        return manifest


def _watermark(spark: SparkSession, how: Reporting, first_start: dt.datetime) -> dt.datetime:
    return spark.range(1).select(readers.watermark(spark, how.watermark_path, first_start)).first()[0]


def _export_window(
    spark: SparkSession,
    t: state_export.ExportTables,
    event_logs: DataFrame,
    how: Reporting,
    out: str,
    run: Run,
    *,
    test_run: bool = False,
) -> DataFrame:
    step = (lambda _, action: action()) if test_run else run.step
    # The window is local; what is printed and stored is made from the same instants in UTC.
    utc_end = spark.range(1).select(time.local_bound(run.end, how.tz)).first()[0]
    store = LedgerStore(spark, how.ledger_path, LEDGER_SCHEMA, how.ledger_buckets)
    last = run.journal.last_finished()
    held_path = f"{how.journal}/held"
    held = spark.createDataFrame([], HELD_SCHEMA)
    if last is not None:
        held = readers.empty_or(spark, f"{held_path}/run={last.number}", HELD_SCHEMA)

    waiting = held.select("report_id")
    if not held.isEmpty():
        waiting = store.fresh(ledger.unreported(waiting, event_logs, key="report_id"), run.number)
    due = state_export.due(t.reports, waiting, time.local_bound(run.start, how.tz), time.ntz(utc_end))
    rows = state_export.export_rows(
        replace(t, reports=due), how.lab, root=how.root, as_of=utc_end, report_type_ids=how.report_type_ids, tz=how.tz
    ).where(F.col("file_state").isin(*how.states))
    done = state_export.finish(rows, mode=how.mode, limit_per_state=6 if test_run else None, tz=how.tz)
    tests = cleanse.export_rules(done, "file_state", ACCESSION)
    judged = rules.with_reasons(done.dropDuplicates(), tests)

    def export() -> None:
        counted, seen = rules.observed(judged, tests)
        written = writers.stage(counted, f"{out}/checked")
        # Where there are no rows, Spark plans the counters away as well.
        found = {} if written.isEmpty() else seen.get
        totals = [(name, int(found.get(name, 0))) for name in ("rows", "held", *[r.name for r in tests])]
        writers.publish(spark.createDataFrame(totals, "rule string, n bigint").coalesce(1), f"{out}/row_rules")

    step("export", export)
    checked = spark.read.schema(judged.schema).parquet(f"{out}/checked")
    unfit = checked.where(F.size(rules.REASONS) > 0)

    def split() -> None:
        ids = unfit.select(F.col("report_id").alias("unfit_id")).distinct()
        writers.stage(matching.absent(checked, ids, {"report_id": "unfit_id"}).drop(rules.REASONS), f"{out}/staged")
        writers.publish(matching.present(checked, ids, {"report_id": "unfit_id"}), f"{out}/quarantine")
        writers.publish(rules.counts(unfit, "file_state"), f"{out}/reasons", sort=["file_state", "reason"])

    step("split", split)
    staged = spark.read.schema(done.schema).parquet(f"{out}/staged")
    quarantined = spark.read.schema(judged.schema).parquet(f"{out}/quarantine")

    def hold() -> None:
        new = quarantined.groupBy("report_id").agg(
            F.min("file_state").alias("file_state"), F.sort_array(F.array_distinct(F.flatten(F.collect_set(rules.REASONS)))).alias("reasons")
        )
        # What was held and is neither sound nor marked stays held, also when the export does not show it now.
        again = held.select(F.col("report_id").alias("old_id"), F.col("file_state").alias("old_state"), "since_run", F.col("reasons").alias("old_reasons"))
        both = new.join(again, F.col("report_id") == F.col("old_id"), "full").select(
            F.coalesce("report_id", "old_id").alias("report_id"),
            F.coalesce("file_state", "old_state").alias("file_state"),
            F.coalesce("since_run", F.lit(run.number)).cast("bigint").alias("since_run"),
            F.coalesce("reasons", "old_reasons").alias("reasons"),
        )
        rest = matching.absent(both, staged.select(F.col("report_id").alias("sound_id")), {"report_id": "sound_id"})
        rest = store.fresh(ledger.unreported(rest, event_logs, key="report_id"), run.number)
        writers.publish(rest, f"{held_path}/run={run.number}")

    if not test_run:
        step("hold", hold)

    def files() -> None:
        writers.region_files(_all_lines(staged, how, run.end), f"{out}/files", staged=True)

    step("files", files)
    regions = spark.createDataFrame([(s,) for s in how.states], "file_state string")
    manifest = state_export.manifest(regions, staged)
    if test_run:
        return manifest

    def mark() -> None:
        # The marks are fixed before the ledger changes: counting them afterwards would find none.
        new = ledger.rows_for_exported(staged, event_logs, as_of=utc_end, user_id=how.user_id)
        store.fresh(new, run.number).write.mode("overwrite").parquet(f"{out}/marks")
        writers.publish(ledger.mark_manifest(regions, staged, spark.read.schema(LEDGER_SCHEMA).parquet(f"{out}/marks")), f"{out}/marked")

    step("marks", mark)
    fixed = spark.read.schema(LEDGER_SCHEMA).parquet(f"{out}/marks")
    step("ledger", lambda: store.add(fixed, run.number))
    delivered = writers.delivery_manifest(manifest, how.names, run.end.date())
    step("deliveries", lambda: writers.log_deliveries(spark, delivered, how.deliveries_path))
    step("watermark", lambda: writers.write_watermark(spark, how.watermark_path, run.end))
    run.finish()
    return manifest


def _all_lines(staged: DataFrame, how: Reporting, end: dt.datetime) -> DataFrame:
    """Lines of every region: forms first, then cleansing, then the dialect. Each form reads its own region's rows only."""
    here = F.col("file_state")
    parts = [staged.where(~here.isin(*how.templates))] if how.templates else [staged]
    for region, form in how.templates.items():
        own = staged.where(here == region)
        for name in cleanse.dialect_of(region).required:
            own = own.where(F.col(f"`{name}`").isNotNull())
        parts.append(
            template.transform(own, form, how.catalogue, default_phone=how.lab.phone, as_of=end, keep=("report_id", "file_state"))
        )
    lined = [writers.lines(cleanse.repaired(part, "file_state").drop(cleanse.BAD_PHONE)) for part in parts]
    return functools.reduce(DataFrame.unionAll, lined)


LEDGER_SCHEMA = """
patient_user_id bigint, report_id bigint, event_type string, agent_type string, user_id bigint, domain string,
created_at timestamp_ntz
"""
