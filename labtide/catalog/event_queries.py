"""Event funnel, event order and event flags."""

from pyspark.sql import functions as F

from labtide.catalog.registry import query
from labtide.catalog.sql_tables import FACTS
from labtide.config.settings import EVENT_CATEGORIES
from labtide.functions import text, time
from labtide.operators import dedup, sequence
from labtide.plans import activity, funnel

TERM = "SMALL"

CATEGORY_SQL = """
    CASE WHEN contains(event_type, 'rolled') THEN 'Rolled Back to Awaiting Results'
         WHEN contains(event_type, 'cancelled') THEN 'Cancelled'
         WHEN contains(event_type, 'report_requested') THEN 'Report Requested'
         WHEN contains(event_type, 'generated') THEN 'Report Generated'
         WHEN contains(event_type, 'result_updated') THEN 'Result Updated'
         WHEN contains(event_type, 'linked') THEN 'Accessioned'
         WHEN contains(event_type, '_approved') THEN 'Approved'
         WHEN contains(event_type, 'review') THEN 'Review'
         WHEN contains(event_type, 'report_sent') THEN 'Sent' END
"""
LABELS = [label for _, label in EVENT_CATEGORIES]
CELLS_SQL = ",\n".join(f"       nullif(count(*) FILTER (category = '{x}'), 0) AS \"{x}\"" for x in LABELS)


@query(
    f"""
    WITH firsts AS (
      SELECT report_id, {CATEGORY_SQL} AS category, min(created_at - INTERVAL 5 HOUR) AS event_at
      FROM lab_events GROUP BY 1, 2)
    SELECT strftime(event_at, '%m/%d/%Y') AS event_day,
    {CELLS_SQL}
    FROM firsts WHERE category IS NOT NULL GROUP BY 1
    """,
    "lab_events",
)
def event_funnel_by_day(t):
    return funnel.by_day(funnel.event_days(funnel.first_events(t.lab_events)), "event_day")


def _funnel_sql(day: str) -> str:
    return f"""
    WITH tested AS (SELECT * FROM timed_facts WHERE contains(test, '{TERM}')),
    firsts AS (
      SELECT report_id, {CATEGORY_SQL} AS category, min(created_at - INTERVAL 5 HOUR) AS event_at
      FROM report_events GROUP BY 1, 2),
    daily AS (
      SELECT f.category, strftime(f.event_at, '%m/%d/%Y') AS event_day, x.start_day
      FROM firsts f JOIN tested x ON x.id = f.report_id WHERE f.category IS NOT NULL),
    wide AS (SELECT {day} AS day, {CELLS_SQL} FROM daily GROUP BY 1),
    got AS (SELECT receive_day, count(*) AS "Received" FROM tested WHERE receive_day IS NOT NULL GROUP BY 1)
    SELECT wide.* EXCLUDE (day), got.* FROM wide JOIN got ON wide.day = got.receive_day
    """


def report_facts(t):
    from labtide.plans import turnaround

    return turnaround.report_facts(
        t.reports, t.clinics, t.distributors, t.report_types, t.kits, t.samples, t.report_events
    )


@query(_funnel_sql("event_day"), *FACTS)
def event_funnel_with_received(t):
    return funnel.funnel(report_facts(t), day="event_day", term=TERM)


@query(_funnel_sql("start_day"), *FACTS)
def event_funnel_by_start_day(t):
    return funnel.funnel(report_facts(t), day="start_day", term=TERM)


@query(f"SELECT id, event_type, {CATEGORY_SQL} AS category FROM lab_events", "lab_events")
def category_last_match_wins(t):
    return t.lab_events.select("id", "event_type", text.last_match("event_type", EVENT_CATEGORIES).alias("category"))


@query(
    """
    WITH l AS (SELECT id, created_at - INTERVAL 5 HOUR AS moment FROM event_log)
    SELECT id, strftime(moment, '%m/%d/%Y') AS day, strftime(moment, '%H:%M:%S') AS time_of_day,
           strftime(moment, '%m/%d/%Y %H:%M') AS minute_text, strftime(moment, '%Y%m%d') AS compact_day,
           CAST(hour(moment) AS INTEGER) AS hour, strftime(moment, '%A') AS weekday, strftime(moment, '%B') AS month,
           CAST(date_trunc('day', moment) AS DATE) AS day_start, CAST(date_trunc('week', moment) AS DATE) AS week_start,
           CAST(date_trunc('week', moment) AS DATE) + 6 AS week_end
    FROM l
    """,
    "event_log",
)
def local_time_columns(t):
    at = F.col("created_at")
    local = time.localize(t.event_log.select("id", "created_at"))
    return local.select(
        "id",
        time.day_text(at).alias("day"),
        time.time_text(at).alias("time_of_day"),
        F.date_format(at, time.MINUTE_FORMAT).alias("minute_text"),
        F.date_format(at, "yyyyMMdd").alias("compact_day"),
        F.hour(at).alias("hour"),
        F.date_format(at, "EEEE").alias("weekday"),
        F.date_format(at, "MMMM").alias("month"),
        F.date_trunc("day", at).cast("date").alias("day_start"),
        time.week_start(at).alias("week_start"),
        F.date_add(time.week_start(at), 6).alias("week_end"),
    )


@query(
    """
    SELECT report_id, bool_or(event_type = 'report_marked_redraw') AS redraw FROM report_events GROUP BY 1
    """,
    "report_events",
)
def redraw_flag(t):
    return dedup.ever(t.report_events, "report_id", F.col("event_type") == "report_marked_redraw", "redraw")


@query(
    """
    SELECT id, report_id, event_type, user_id FROM (
      SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY created_at DESC, id DESC) AS rn FROM event_log)
    WHERE rn = 1
    """,
    "event_log",
)
def last_event_per_report(t):
    last = dedup.last_per_key(t.event_log, ["report_id"], ["created_at", "id"])
    return last.select("id", "report_id", "event_type", "user_id")


@query(
    """
    SELECT id, report_id, event_type FROM (
      SELECT *, row_number() OVER (PARTITION BY report_id, event_type ORDER BY created_at, id) AS rn FROM event_log)
    WHERE rn = 1
    """,
    "event_log",
)
def first_event_per_type(t):
    return dedup.first_per_key(t.event_log, ["report_id", "event_type"], ["created_at", "id"]).select(
        "id", "report_id", "event_type"
    )


@query(
    """
    SELECT e.id, e.report_id, e.next_user_id, s.fullname AS next_fullname FROM (
      SELECT *, lead(user_id) OVER (PARTITION BY report_id ORDER BY created_at, id) AS next_user_id FROM event_log) e
    LEFT JOIN staff s ON s.user_id = e.next_user_id
    """,
    "event_log",
    "staff",
)
def next_event_actor(t):
    ahead = sequence.neighbour(t.event_log, "report_id", "created_at", "id", ["user_id"])
    names = activity.staff_names(t.staff).withColumnsRenamed({"actor": "next_user_id", "fullname": "next_fullname"})
    return ahead.join(names, "next_user_id", "left").select("id", "report_id", "next_user_id", "next_fullname")


@query(
    """
    SELECT id, report_id, event_type, date_sub('microsecond', created_at,
           lead(created_at) OVER (PARTITION BY report_id ORDER BY created_at, id)) AS micros_in_stage
    FROM event_log
    """,
    "event_log",
)
def time_in_stage(t):
    return funnel.time_in_stage(t.event_log).select("id", "report_id", "event_type", "micros_in_stage")


@query(
    """
    WITH m AS (SELECT *, date_trunc('minute', created_at) AS minute FROM event_log),
    n AS (SELECT *, lead(minute) OVER w AS nx, lag(minute) OVER w AS pv FROM m
          WINDOW w AS (PARTITION BY report_id ORDER BY created_at, id))
    SELECT id, report_id, minute >= nx - INTERVAL 1 MINUTE AS nextmatch, minute <= pv + INTERVAL 1 MINUTE AS lastmatch
    FROM n WHERE event_type = 'signup'
    """,
    "event_log",
)
def neighbor_within_minute(t):
    return activity.next_event_check(t.event_log, "signup").drop("created_at")


@query(
    """
    SELECT e.id, e.event_type, strftime(e.created_at - INTERVAL 5 HOUR, '%H:%M:%S') AS local_time, s.fullname
    FROM event_log e JOIN staff s ON s.user_id = e.user_id
    WHERE s.fullname LIKE '%0000%' AND CAST(e.created_at AS DATE) = DATE '2024-01-17'
    """,
    "event_log",
    "staff",
)
def user_events_of_day(t):
    """Events of users with a matching name on one UTC day; the day is a range on the bare column, so it is pushed down."""
    day = t.event_log.where((F.col("created_at") >= time.ntz("2024-01-17")) & (F.col("created_at") < time.ntz("2024-01-18")))
    names = activity.staff_names(t.staff).where(F.col("fullname").like("%0000%")).withColumnRenamed("actor", "user_id")
    return day.join(names, "user_id").select(
        "id", "event_type", time.time_text(time.to_local("created_at")).alias("local_time"), "fullname"
    )


@query(
    """
    SELECT id, report_id, event_type, date_sub('microsecond', created_at,
           lead(created_at) OVER (PARTITION BY report_id ORDER BY created_at, id)) AS micros_in_stage
    FROM event_log
    """,
    "event_log",
)
def time_in_stage_hot_reports(t):
    """The same figures with reports above 50 events treated as hot and cut into time slices."""
    return funnel.time_in_stage(t.event_log, hot_rows=50).select("id", "report_id", "event_type", "micros_in_stage")
