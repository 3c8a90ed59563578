"""Whole runs over the test tables: two export windows, region files read back, held rows by reason, tracker refreshes."""

import datetime as dt
from dataclasses import replace

from pyspark.sql import functions as F

from labtide import standins
from labtide.catalog.event_queries import report_facts
from labtide.catalog.registry import query
from labtide.catalog.report_queries import TRACKER_SQL
from labtide.catalog.sql_tables import TAT
from labtide.catalog.state_queries import EXPORT_SQL, EXPORT_TABLES, FINISHED_SQL, ROOT, finished_rows
from labtide.operators import rules
from labtide.plans import cleanse, runs, trackers, turnaround
from labtide.session import scratch_dir
from labtide.sources import readers, writers

NATIONS = [f"NATION_{i}" for i in range(25)]
FIRST, MIDDLE, LAST = dt.datetime(1990, 1, 1), dt.datetime(1998, 6, 17), dt.datetime(2003, 1, 1)

# Five hours lie between the local bounds of the windows and the sent dates, which are UTC.
WINDOWS_SQL = f"""
    {EXPORT_SQL},
    seen AS (
      SELECT DISTINCT report_id, "Patient ID" AS pid, "Patient Phone" AS phone,
             CASE WHEN "Result Date and Time" < TIMESTAMP '{MIDDLE}' + INTERVAL 5 HOUR THEN 1 ELSE 2 END AS due
      FROM export),
    judged AS (
      SELECT report_id, due, contains(phone, ',') OR pid % 7 = 0 AS bad_first,
             (contains(phone, ',') AND pid % 14 <> 7) OR pid % 14 = 7 AS bad_later FROM seen)
"""


@query(
    f"""
    WITH {WINDOWS_SQL}
    SELECT report_id, CASE WHEN due = 1 AND NOT bad_first THEN 1 WHEN NOT bad_later THEN 2 END AS marked_by,
           CASE WHEN bad_later AND NOT (due = 1 AND NOT bad_first) THEN due END AS held_since,
           CASE WHEN bad_later AND NOT (due = 1 AND NOT bad_first) THEN 'bad_phone' END AS reasons
    FROM judged
    """,
    *EXPORT_TABLES,
)
def export_two_windows(t):
    """Two runs of the export, each over its window. Phones of some patients are broken in the first run and mended for half of
    them before the second, which reports what the first one held."""
    base = scratch_dir(t.spark, "two-windows")
    place = {n: f"{base}/{n}" for n in ("ledger_path", "watermark_path", "deliveries_path", "journal_path")}
    tables, pid = t.export_tables, F.col("id")
    log = t.ledger.limit(0)
    marks = []
    for end, broken in ((MIDDLE, F.pmod(pid, F.lit(7)) == 0), (LAST, F.pmod(pid, F.lit(14)) == 7)):
        patients = tables.patient_users.withColumn("phone", F.when(broken, F.lit("12")).otherwise(F.col("phone")))
        out = f"{base}/until-{end:%Y}"
        runs.state_reporting(
            t.spark, replace(tables, patient_users=patients), log, standins.LAB, out, end=end, first_start=FIRST,
            root=ROOT, states=NATIONS, **place,
        )
        marks.append(t.spark.read.schema(runs.LEDGER_SCHEMA).parquet(f"{out}/marks"))
    held = t.spark.read.schema(runs.HELD_SCHEMA).parquet(f"{place['journal_path']}/held/run=2")
    done = [m.select("report_id", F.lit(i + 1).alias("marked_by")) for i, m in enumerate(marks)]
    rows = done[0].unionByName(done[1]).withColumns(
        {"held_since": F.lit(None).cast("int"), "reasons": F.lit(None).cast("string")}
    )
    left = held.select(
        "report_id", F.lit(None).cast("int").alias("marked_by"), F.col("since_run").cast("int").alias("held_since"),
        F.array_join("reasons", ",").alias("reasons"),
    )
    return rows.unionByName(left)


# Four nations stand for the regions whose files have a dialect of their own.
CODES = {"NATION_0": "NY", "NATION_1": "IL", "NATION_2": "PA", "NATION_3": "AR"}
CODE_SQL = "CASE file_state " + " ".join(f"WHEN '{n}' THEN '{c}'" for n, c in CODES.items()) + " ELSE file_state END"


def _coded(t):
    """Finished rows under region codes; some patients of AR have no first name, which AR's file asks for."""
    rows = finished_rows(t)
    code = F.col("file_state")
    for nation, region in CODES.items():
        code = F.when(F.col("file_state") == nation, region).otherwise(code)
    rows = rows.withColumn("file_state", code)
    missing = (F.col("file_state") == "AR") & (F.pmod("Patient ID", F.lit(3)) == 0)
    return rows.withColumn("Patient First Name", F.when(~missing, F.col("`Patient First Name`")))


@query(
    f"""
    WITH {EXPORT_SQL}, done AS ({FINISHED_SQL} FROM export),
    coded AS (SELECT * REPLACE ({CODE_SQL} AS file_state) FROM done)
    SELECT CAST(COLUMNS(* EXCLUDE (report_id)) AS VARCHAR) FROM coded WHERE file_state <> 'AR' OR "Patient ID" % 3 <> 0
    """,
    *EXPORT_TABLES,
)
def sink_roundtrip_dialects(t):
    """Write the export as region files, each region in its dialect, and read every file back by its own rules."""
    path = f"{scratch_dir(t.spark, 'regions')}/files"
    rows = _coded(t)
    files = writers.region_files(writers.lines(rows), path)
    schema = ", ".join(f"`{c}` string" for c in rows.columns if c not in ("file_state", "report_id"))
    back = None
    for dialect in dict.fromkeys(cleanse.dialect_of(r) for r in files):
        own = [r for r in files if cleanse.dialect_of(r) == dialect]
        part = readers.region_file(t.spark, path, own, schema, dialect)
        back = part if back is None else back.unionByName(part)
    return back if back is not None else t.spark.createDataFrame([], f"{schema}, file_state string")


SHOWN = ["Patient Sex", "Result", "Provider Last Name", "Patient Zip", "Provider NPI"]
FILLED_SQL = " + ".join(f'CASE WHEN "{c}" IS NULL THEN 0 ELSE 1 END' for c in SHOWN)


@query(
    f"""
    WITH {EXPORT_SQL},
    judged AS (
      SELECT file_state, unnest([CASE WHEN report_id % 5 = 0 THEN 'no_accession' END,
                                 CASE WHEN contains("Patient Phone", ',') THEN 'bad_phone' END,
                                 CASE WHEN {FILLED_SQL} < 5 THEN 'few_values' END]) AS reason FROM export)
    SELECT file_state, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY 1, 2
    """,
    *EXPORT_TABLES,
)
def held_rows_by_reason(t):
    """Rows of the export that break a rule, per region and reason; accession numbers of some are taken away."""
    number = F.when(F.pmod("report_id", F.lit(5)) != 0, F.col(f"`{runs.ACCESSION}`"))
    rows = finished_rows(t).withColumn(runs.ACCESSION, number)
    few = rules.Rule("few_values", rules.filled_values(rows.select(*[f"`{c}`" for c in SHOWN])) < len(SHOWN))
    tests = [r for r in cleanse.export_rules(rows, "file_state", runs.ACCESSION) if r.name != few.name]
    return rules.counts(rules.with_reasons(rows, [*tests, few]), "file_state")


@query(
    f"""
    WITH {TRACKER_SQL},
    twice AS (
      SELECT easypost_id, tracking_number, tracking_status, '2024-01-02T00:00:00Z' AS updated_at FROM tracker_table
      UNION ALL
      SELECT easypost_id, tracking_number, CASE WHEN weight % 3 = 0 THEN 'returned' ELSE 'stale' END,
             CASE WHEN weight % 3 = 0 THEN '2024-01-03T00:00:00Z' ELSE '2024-01-01T00:00:00Z' END
      FROM tracker_table WHERE weight % 3 < 2),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY tracking_number ORDER BY updated_at DESC, easypost_id DESC) AS place FROM twice)
    SELECT easypost_id, tracking_number, tracking_status, updated_at FROM ranked WHERE place = 1
    """
)
def tracker_refresh_twice(t):
    """The tracker table after two refreshes. The second brings newer records of some numbers and stale ones of others; some
    numbers belong to several trackers."""
    base = scratch_dir(t.spark, "trackers")
    rows = turnaround.turnaround(report_facts(t), term="")
    runs.refresh_trackers(rows, t.trackers, f"{base}/table", f"{base}/one")
    newer = F.pmod("weight", F.lit(3)) == 0
    later = t.trackers.where(F.pmod("weight", F.lit(3)) < 2).withColumns(
        {
            "status": F.when(newer, "returned").otherwise("stale"),
            "updated_at": F.when(newer, "2024-01-03T00:00:00Z").otherwise("2024-01-01T00:00:00Z"),
        }
    )
    runs.refresh_trackers(rows, later, f"{base}/table", f"{base}/two")
    table = t.spark.read.parquet(f"{base}/two/trackers")
    return table.select("easypost_id", "tracking_number", "tracking_status", "updated_at")


@query(
    f"""
    , {TRACKER_SQL}
    SELECT DISTINCT tracking_number FROM tat_rows
    WHERE hundredths > 600 AND hundredths < 20000 AND raw_number IS DISTINCT FROM 'N/A' AND tracking_number IS NOT NULL
      AND tracking_number NOT IN (SELECT tracking_number FROM tracker_table WHERE tracking_number % 2 = 0)
    """,
    *TAT,
)
def trackers_to_fetch(t):
    """Tracking numbers that a refresh with half of the trackers leaves without one."""
    base = scratch_dir(t.spark, "trackers")
    rows = turnaround.turnaround(report_facts(t), term="")
    some = t.trackers.where(F.pmod(F.expr("try_cast(tracking_code AS bigint)"), F.lit(2)) == 0)
    runs.refresh_trackers(rows, some, f"{base}/table", f"{base}/out")
    return t.spark.read.schema("tracking_number bigint").parquet(f"{base}/out/unseen")
