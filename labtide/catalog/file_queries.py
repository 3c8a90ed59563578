"""Readers and sinks over files that are written from the test tables and read back."""

import datetime as dt

from pyspark.sql import functions as F

from labtide.catalog.activity_queries import DATA_ENTRY, ELAPSED, TICKET_ROWS, _grid_sql
from labtide.catalog.registry import query
from labtide.catalog.report_queries import TRACKER_SQL
from labtide.catalog.run_queries import CODE_SQL, _coded
from labtide.catalog.state_queries import EXPORT_SQL, EXPORT_TABLES
from labtide.config.settings import FileNames
from labtide.functions import time
from labtide.operators import columns
from labtide.plans import activity, crm, runs, trackers
from labtide.session import scratch_dir
from labtide.sources import readers, writers
from labtide.streaming import file_intake


@query(
    """
    SELECT CAST(s_suppkey AS VARCHAR) AS id, CASE WHEN s_acctbal > 0 THEN s_name END AS name FROM supplier
    WHERE s_nationkey % 3 = 0
    """
)
def sheet_scan(t):
    """A sheet saved as text, with a column and rows that are empty throughout."""
    path, shown = scratch_dir(t.spark, "sheet"), F.pmod("s_nationkey", F.lit(3)) == 0
    name = F.when(shown & (F.col("s_acctbal") > 0), F.col("s_name"))
    sheet = t.raw("supplier").select(F.when(shown, F.col("s_suppkey")).alias("id"), name.alias("name"), F.lit(None).cast("string").alias("none"))
    sheet.write.option("header", True).csv(path)
    return readers.sheet(t.spark, path)


@query("SELECT o_orderkey AS id FROM orders WHERE o_orderpriority = '1-URGENT'")
def id_list_scan(t):
    """A list of ids without header."""
    path = scratch_dir(t.spark, "ids")
    t.raw("orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey").write.csv(path)
    return readers.id_list(t.spark, path)


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 8, '0') AS code, c_name AS name, CAST(c_nationkey AS VARCHAR) AS nation FROM customer")
def all_text_scan(t):
    """Delimited text whose leading zeros stay, since every column is read as text."""
    path = scratch_dir(t.spark, "text")
    rows = t.raw("customer").select(
        F.lpad(F.col("c_custkey").cast("string"), 8, "0").alias("code"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation")
    )
    rows.write.option("header", True).option("sep", "|").csv(path)
    return readers.all_text(t.spark, path, sep="|")


@query(
    f"""
    WITH {TRACKER_SQL}
    SELECT easypost_id, tracking_status, origin, destination, picked_up_city, picked_up_state, tracking_number, weight
    FROM tracker_table
    """
)
def tracker_json_scan(t):
    """Tracker records landed as JSON lines, read with their nested schema."""
    path = scratch_dir(t.spark, "trackers")
    t.trackers.write.json(path)
    return trackers.normalise(readers.json_objects(t.spark, path, trackers.SCHEMA)).select(
        "easypost_id", "tracking_status", "origin", "destination", "picked_up_city", "picked_up_state", "tracking_number", "weight"
    )


@query(
    """
    SELECT id, strftime(sent_date, '%m/%d/%Y %H:%M') AS sent FROM reports
    WHERE sent_date >= (SELECT max(o_orderdate) FROM orders WHERE o_custkey % 2 = 0)
    """,
    "reports",
)
def watermark_round_trip(t):
    """Reports sent since the last of several exports, which were noted out of order."""
    path = scratch_dir(t.spark, "watermark")
    days = t.raw("orders").agg(F.min("o_orderdate").alias("low"), F.max(F.when(F.col("o_custkey") % 2 == 0, F.col("o_orderdate"))).alias("high")).first()
    for day in (days.low, days.high, days.low + dt.timedelta(days=1)):
        writers.write_watermark(t.spark, path, day)
    writers.write_watermark(t.spark, path, days.high + dt.timedelta(days=99), test_run=True)
    mark = readers.watermark(t.spark, path, "1990-01-01")
    return t.reports.where(F.col("sent_date") >= mark).select("id", F.date_format("sent_date", time.MINUTE_FORMAT).alias("sent"))


@query("SELECT o_orderpriority AS segment, o_orderkey AS id, o_totalprice AS price FROM orders WHERE o_custkey % 2 = 0")
def published_segments(t):
    """A dashboard in segments, replaced once: the second data set is what readers find."""
    path = scratch_dir(t.spark, "dash")
    rows = t.raw("orders").select(F.col("o_orderpriority").alias("segment"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"), "o_custkey")
    writers.publish(rows.drop("o_custkey"), path, by="segment", sort=["id"])
    writers.publish(rows.where("o_custkey % 2 = 0").drop("o_custkey"), path, by="segment", sort=["id"])
    return t.spark.read.schema("segment string, id bigint, price double").parquet(path)


@query("SELECT state, CAST(DATE '2024-02-01' AS DATE) AS day, state || '_2024_02_01.csv' AS file, count(*) AS n FROM homes GROUP BY 1", "homes")
def deliveries_logged_once(t):
    """The log of deliveries after the same files were noted in two steps and then again."""
    path, day = scratch_dir(t.spark, "sent"), dt.date(2024, 2, 1)
    homes = t.locations.where(F.col("patient_user_id").isNotNull()).withColumnRenamed("state", "file_state")
    counts = homes.groupBy("file_state").agg(F.count(F.lit(1)).alias("n"))
    manifest = writers.delivery_manifest(counts, FileNames(), day)
    for part in (manifest.where("n % 2 = 0"), manifest, manifest):
        writers.log_deliveries(t.spark, part, path)
    return t.spark.read.schema(manifest.schema).parquet(path)


@query("SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount FROM lineitem")
def leading_columns(t):
    """The first seven columns by position."""
    return columns.leading(t.raw("lineitem"), 7)


@query(
    """
    WITH x AS (
      SELECT CAST(e.created_at - INTERVAL 5 HOUR AS DATE) AS day, coalesce(u.fullname, ' ') AS fullname
      FROM lab_events e JOIN event_kits k ON k.id = e.kit_id LEFT JOIN staff u ON u.user_id = e.user_id
      WHERE e.event_type = 'kit_data_review_complete')
    SELECT day, fullname, count(*) AS n FROM x GROUP BY 1, 2
    """,
    "lab_events",
    "event_kits",
    "staff",
)
def review_users_left_join(t):
    """Kit reviews per day and user; those of unknown users stay, under a blank name."""
    log = t.lab_events.where(F.col("event_type") == "kit_data_review_complete")
    return activity.by_user(activity.since_received(log, t.event_kits, t.staff, how="left"))


WEEK = dt.date(2024, 1, 8)


def _week(column):
    return f"{column} >= TIMESTAMP '{WEEK} 05:00:00' AND {column} < TIMESTAMP '{WEEK + dt.timedelta(days=7)} 05:00:00'"


@query(
    f"""
    WITH {ELAPSED.replace("'scan_assigned_to_kit'))", "'scan_assigned_to_kit') AND " + _week("e.created_at") + ")")}
    SELECT metric, day, fullname, count(*) AS n FROM x GROUP BY ALL
    """,
    "lab_events",
    "event_kits",
    "staff",
)
def entries_one_week(t):
    """Entries, reviews and scans of one week; the bounds reach the scan of the log."""
    span = {"start": WEEK, "end": WEEK + dt.timedelta(days=7)}
    return activity.by_user(activity.event_metrics(t.lab_events, t.event_kits, t.staff, **span), ["metric"])


@query(
    f"""
    WITH {ELAPSED},
    long_rows AS (
      SELECT metric, day, fullname, count(*) AS n FROM x GROUP BY ALL
      UNION ALL SELECT metric, CAST(moment AS DATE), fullname, count(*) FROM ({TICKET_ROWS}) GROUP BY ALL)
    """
    + _grid_sql(DATA_ENTRY),
    "lab_events",
    "event_kits",
    "staff",
    "tickets",
)
def weekly_grid_from_store(t):
    """The grid of all weeks after the log was taken into the store in three windows, the last one twice."""
    store = scratch_dir(t.spark, "weekly")
    tables = {"event_logs": t.lab_events, "kits": t.event_kits, "staff": t.staff, "tickets": t.tickets}
    bounds = [dt.date(1990, 1, 1), dt.date(1997, 3, 3), dt.date(2024, 1, 15), dt.date(2030, 1, 7)]
    grid = None
    for i in (0, 1, 2, 2):
        grid = runs.weekly_activity(tables, store, bounds[i], bounds[i + 1])
    return grid


OBJECT = """asked string, paging struct<next: struct<after: string>>, results array<struct<id: string,
    properties: struct<name: string>, associations: struct<{0}: struct<results: array<struct<id: string>>>>>>"""


def _landed(t, kind, key, rows, name, parent=None, size=500):
    """Pages of 500 numbers each, landed as JSON; every page but the last names the next one."""
    group = crm.ASSOCIATION.get(kind, ("none", ""))[0]
    number, last = F.call_function("div", key, F.lit(size)), rows.agg(F.max(F.call_function("div", key, F.lit(size))).alias("last")).first()["last"]
    owner = F.lit(None).cast("string") if parent is None else parent.cast("string")
    item = F.struct(
        key.cast("string").alias("id"),
        F.struct(name.alias("name")).alias("properties"),
        F.struct(F.struct(F.array(F.struct(owner.alias("id"))).alias("results")).alias(group)).alias("associations"),
    )
    pages = rows.groupBy(number.alias("page")).agg(F.collect_list(item).alias("results"))
    after = F.when(F.col("page") < last, (F.col("page") + 1).cast("string"))
    asked = F.when(F.col("page") > 0, F.col("page").cast("string"))
    path = scratch_dir(t.spark, f"landed-{kind}")
    pages.select(asked.alias("asked"), F.struct(F.struct(after.alias("after")).alias("next")).alias("paging"), "results").write.json(path)
    return readers.json_objects(t.spark, path, OBJECT.format(group))


def _all_landed(t):
    customers, parts, orders = t.raw("customer"), t.raw("part"), t.raw("orders")
    urgent = orders.where("o_orderstatus <> 'P' OR o_orderkey % 500 = 0")
    return {
        "companies": _landed(t, "companies", F.col("c_custkey"), customers, F.col("c_name")),
        "products": _landed(t, "products", F.col("p_partkey"), parts, F.col("p_name")),
        "deals": _landed(t, "deals", F.col("o_orderkey"), orders, F.col("o_orderpriority"), F.col("o_custkey")),
        "line_items": _landed(t, "line_items", F.col("o_orderkey"), urgent, F.col("o_orderstatus"), F.col("o_orderkey")),
    }


@query(
    """
    SELECT 'companies' AS kind, CAST(c_custkey AS VARCHAR) AS id, c_name AS name, NULL::VARCHAR AS parent FROM customer
    UNION ALL SELECT 'products', CAST(p_partkey AS VARCHAR), p_name, NULL FROM part
    UNION ALL SELECT 'deals', CAST(o_orderkey AS VARCHAR), o_orderpriority, CAST(o_custkey AS VARCHAR) FROM orders
    UNION ALL SELECT 'line_items', CAST(o_orderkey AS VARCHAR), o_orderstatus, CAST(o_orderkey AS VARCHAR) FROM orders
              WHERE o_orderstatus <> 'P' OR o_orderkey % 500 = 0
    """
)
def object_refresh(t):
    """Four kinds of objects from their landed pages, with what they belong to."""
    tables = crm.refresh_objects(_all_landed(t), scratch_dir(t.spark, "objects"))
    out = None
    for kind, table in tables.items():
        rows = table.read()
        owner = F.col(crm.ASSOCIATION[kind][1]) if kind in crm.ASSOCIATION else F.lit(None).cast("string")
        part = rows.select(F.lit(kind).alias("kind"), "id", "name", owner.alias("parent"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """
    WITH pages AS (SELECT DISTINCT o_orderkey // 500 AS page FROM orders),
    kept AS (SELECT page FROM pages WHERE page % 5 <> 3)
    SELECT CAST(p.page AS VARCHAR) AS cursor, 'missing' AS fault FROM pages p WHERE page % 5 = 3 AND page - 1 IN (SELECT page FROM kept)
    UNION ALL SELECT CAST(page AS VARCHAR), 'unasked' FROM kept WHERE page > 0 AND page - 1 NOT IN (SELECT page FROM kept)
    """
)
def page_chain_faults(t):
    """Every fifth page of the deals did not land: which pages are missing, and which ones nothing leads to."""
    pages = _all_landed(t)["deals"]
    number = F.coalesce(F.col("asked").cast("bigint"), F.lit(0))
    return crm.page_faults(pages.where(F.pmod(number, F.lit(5)) != 3))


@query(
    f"""
    WITH {EXPORT_SQL},
    coded AS (SELECT report_id, "Patient ID" AS pid, {CODE_SQL} AS state FROM export),
    kept AS (SELECT * FROM coded WHERE state <> 'AR' OR pid % 3 <> 0)
    SELECT state, count(*) + CASE WHEN state IN ('NY', 'PA') THEN 0 ELSE 1 END AS n FROM kept GROUP BY state
    """,
    *EXPORT_TABLES,
)
def file_intake_counts(t):
    """Region files taken in as a stream, ten at a time, and the whole folder offered a second time: lines per region."""
    base = scratch_dir(t.spark, "intake")
    writers.region_files(writers.lines(_coded(t)), f"{base}/files")
    for checkpoint in ("first", "again"):
        lines = file_intake.read_files(t.spark, f"{base}/files", files_per_batch=10, pattern="*.txt")
        # The second stream starts anew and numbers its batches from 0, as one whose checkpoint was lost.
        offset = 0 if checkpoint == "first" else 1_000
        file_intake.run(lines, f"{base}/out", f"{base}/{checkpoint}", first_batch=offset).awaitTermination()
    return t.spark.read.schema(file_intake.FILES).parquet(f"{base}/out/files").groupBy("state").agg(F.sum("n").alias("n"))
