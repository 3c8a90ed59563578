"""Weekly activity: calendar, counts, mean times and matrices."""

from pyspark.sql import functions as F

from labtide.catalog.registry import query
from labtide.config.settings import EVENT_GROUPS
from labtide.functions import time
from labtide.operators import reshape
from labtide.plans import activity, shift

HMS = "printf('%02d:%02d:%02d', s // 3600 % 24, s // 60 % 60, s % 60)"
LISTED = "('Critical Missing Information', 'Missing Information', 'Redraw', 'Other Error', 'Medical Records')"


def _weekday_cells(name: str = "{d}", value: str = "n", test: str = "") -> str:
    cells = []
    for i, d in enumerate(time.WEEKDAYS, start=1):
        cells.append(
            f"CAST(coalesce(sum({value}) FILTER (isodow(day) = {i}{test}), 0) AS BIGINT) AS {name.format(d=d)}"
        )
    return ",\n       ".join(cells)


@query(
    """
    WITH counts AS (SELECT CAST(created_at - INTERVAL 5 HOUR AS DATE) AS day, count(*) AS n FROM tickets GROUP BY 1),
    spine AS (
      SELECT CAST(unnest(generate_series(CAST(date_trunc('week', lo) AS TIMESTAMP),
                                         CAST(date_trunc('week', hi) AS TIMESTAMP) + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT min(day) AS lo, max(day) AS hi FROM counts))
    SELECT spine.day, coalesce(n, 0) AS n, CAST(date_trunc('week', spine.day) AS DATE) AS week_start
    FROM spine LEFT JOIN counts ON counts.day = spine.day
    """,
    "tickets",
)
def week_spine_counts(t):
    return shift.spine_counts(t.tickets)


@query(
    """
    SELECT e.event_type, CAST(e.created_at - INTERVAL 5 HOUR AS DATE) AS day, coalesce(s.fullname, ' ') AS fullname,
           count(*) AS n
    FROM event_log e LEFT JOIN staff s ON s.user_id = e.user_id GROUP BY 1, 2, 3
    """,
    "event_log",
    "staff",
)
def activity_by_day_user(t):
    counts = activity.time_of_day(t.event_log, t.staff, how="left", by=["event_type"])
    return activity.by_user(counts, ["event_type"])


def _mean(rows: str) -> str:
    return f"""
    SELECT *, {HMS} AS mean_time FROM (
      SELECT *, CAST(floor(mean_seconds) AS BIGINT) AS s FROM ({rows}))
    """


SUMS = """(CAST(sum(us // 1000000) AS DOUBLE) + CAST(sum(us % 1000000) AS DOUBLE) / 1000000) / CAST(count(*) AS DOUBLE)"""


def _with_time(daily):
    return daily.withColumns({"mean_time": time.hms(F.col("mean_seconds")), "s": F.floor("mean_seconds")})


@query(
    """
    WITH x AS (SELECT s.created_at - INTERVAL 5 HOUR AS moment FROM scans s JOIN staff u ON u.user_id = s.user_id
               WHERE s.file_name IS NOT NULL),
    y AS (SELECT CAST(moment AS DATE) AS day, date_sub('microsecond', date_trunc('day', moment), moment) AS us FROM x)
    """
    + _mean(f"SELECT day, count(*) AS n, {SUMS} AS mean_seconds FROM y GROUP BY day"),
    "scans",
    "staff",
)
def activity_mean_time_of_day(t):
    return _with_time(activity.by_day(activity.scan_metric(t.scans, t.staff)))


ELAPSED = """
    x AS (
      SELECT CASE e.event_type WHEN 'kit_accessioning_complete' THEN 'entries' WHEN 'kit_data_review_complete' THEN 'reviews'
                  ELSE 'scans_assigned_to_kits' END AS metric,
             CAST(e.created_at - INTERVAL 5 HOUR AS DATE) AS day, date_sub('microsecond', k.received_at, e.created_at) AS us,
             u.fullname
      FROM lab_events e JOIN event_kits k ON k.id = e.kit_id JOIN staff u ON u.user_id = e.user_id
      WHERE e.event_type IN ('kit_accessioning_complete', 'kit_data_review_complete', 'scan_assigned_to_kit'))
"""


@query(
    f"WITH {ELAPSED}"
    + _mean(
        """
        SELECT metric, day, count(*) AS n,
               CAST(sum(us) AS DOUBLE) / 1000000 / CAST(count(*) AS DOUBLE) AS mean_seconds
        FROM x GROUP BY metric, day
        """
    ).replace("SELECT *, printf", "SELECT metric, day, n, round(mean_seconds, 3) AS mean_seconds, s, printf"),
    "lab_events",
    "event_kits",
    "staff",
)
def activity_elapsed_since_received(t):
    daily = activity.by_day(activity.event_metrics(t.lab_events, t.event_kits, t.staff), ["metric"])
    return _with_time(daily).withColumn("mean_seconds", F.round("mean_seconds", 3))


def _data_entry(t):
    events = activity.event_metrics(t.lab_events, t.event_kits, t.staff)
    tickets = activity.ticket_metric(t.tickets, t.staff)
    return events.unionByName(reshape.long_metrics({"tickets_created": tickets}))


def _accessioning(t):
    return reshape.long_metrics(
        {
            "pages_scanned": activity.scan_metric(t.scans, t.staff),
            "samples_accessioned": activity.accession_metric(t.reports, t.report_events, t.staff),
            "tickets_created": activity.ticket_metric(t.tickets, t.staff),
        }
    )


DATA_ENTRY = ["entries", "reviews", "scans_assigned_to_kits", "tickets_created"]
ACCESSIONING = ["pages_scanned", "samples_accessioned", "tickets_created"]


def _grid_sql(names):
    cells = [
        f"CAST(coalesce(sum(n) FILTER (metric = '{m}' AND isodow(day) = {i}), 0) AS BIGINT) AS {d}_{m}"
        for m in names
        for i, d in enumerate(time.WEEKDAYS, start=1)
    ]
    return (
        "SELECT CAST(date_trunc('week', day) AS DATE) AS week_start, fullname,\n       "
        + ",\n       ".join(cells)
        + "\nFROM long_rows GROUP BY 1, 2"
    )


TICKET_ROWS = f"""
    SELECT 'tickets_created' AS metric, t.created_at - INTERVAL 5 HOUR AS moment, s.fullname
    FROM tickets t JOIN staff s ON s.user_id = t.user_id WHERE t.category IN {LISTED}
"""


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
def shift_report_user_grid(t):
    return shift.user_grid(_data_entry(t), DATA_ENTRY)


ACCESSION_ROWS = f"""
    ahead AS (
      SELECT *, lead(user_id) OVER (PARTITION BY report_id ORDER BY created_at, id) AS next_user FROM report_events),
    linked AS (
      SELECT a.report_id, a.created_at - INTERVAL 5 HOUR AS moment, s.fullname,
             row_number() OVER (PARTITION BY a.report_id ORDER BY a.created_at, a.id) AS rn
      FROM ahead a JOIN staff s ON s.user_id = a.next_user
      WHERE a.event_type = 'first_sample_data_source_linked_to_report'),
    rows_all AS (
      SELECT 'samples_accessioned' AS metric, l.moment, l.fullname FROM linked l JOIN orders o ON o.o_orderkey = l.report_id
      WHERE l.rn = 1
      UNION ALL SELECT 'pages_scanned', s.created_at - INTERVAL 5 HOUR, u.fullname
      FROM scans s JOIN staff u ON u.user_id = s.user_id WHERE s.file_name IS NOT NULL
      UNION ALL {TICKET_ROWS})
"""


@query(
    f"""
    WITH {ACCESSION_ROWS},
    long_rows AS (SELECT metric, CAST(moment AS DATE) AS day, fullname, count(*) AS n FROM rows_all GROUP BY ALL)
    """
    + _grid_sql(ACCESSIONING),
    "report_events",
    "staff",
    "scans",
    "tickets",
)
def shift_report_accessioning_grid(t):
    return shift.user_grid(_accessioning(t), ACCESSIONING)


def _transposed_sql():
    parts = []
    for m in ACCESSIONING:
        parts.append(f"SELECT day, '{m}' AS metric, CAST(coalesce(n, 0) AS VARCHAR) AS value FROM filled WHERE m = '{m}'")
        parts.append(f"SELECT day, 'average_{m}_time', coalesce({HMS}, '') FROM filled WHERE m = '{m}'")
    cells = [f"max(value) FILTER (isodow(day) = {i}) AS {d}" for i, d in enumerate(time.WEEKDAYS, start=1)]
    return f"""
    WITH {ACCESSION_ROWS},
    days AS (
      SELECT metric, CAST(moment AS DATE) AS day, count(*) AS n,
             CAST(floor({SUMS}) AS BIGINT) AS s
      FROM (SELECT *, date_sub('microsecond', date_trunc('day', moment), moment) AS us FROM rows_all) GROUP BY 1, 2),
    spine AS (
      SELECT CAST(unnest(generate_series(CAST(date_trunc('week', lo) AS TIMESTAMP),
                                         CAST(date_trunc('week', hi) AS TIMESTAMP) + INTERVAL 6 DAY, INTERVAL 1 DAY)) AS DATE) AS day
      FROM (SELECT min(day) AS lo, max(day) AS hi FROM days)),
    filled AS (
      SELECT spine.day, k.m, days.n, days.s
      FROM spine CROSS JOIN (VALUES ('pages_scanned'), ('samples_accessioned'), ('tickets_created')) k(m)
      LEFT JOIN days ON days.day = spine.day AND days.metric = k.m),
    long_rows AS ({" UNION ALL ".join(parts)})
    SELECT CAST(date_trunc('week', day) AS DATE) AS week_start, metric, {", ".join(cells)} FROM long_rows GROUP BY 1, 2
    """


@query(_transposed_sql(), "report_events", "staff", "scans", "tickets")
def shift_report_daily_transposed(t):
    return shift.daily_table(activity.by_day(_accessioning(t), ["metric"]), ACCESSIONING)


GROUP_CASE = "CASE " + " ".join(
    f"WHEN event_type IN ({', '.join(repr(x) for x in types)}) THEN '{group}'" for group, types in EVENT_GROUPS.items()
) + " END"


@query(
    f"""
    WITH x AS (
      SELECT {GROUP_CASE} AS event_group, CAST(e.created_at - INTERVAL 5 HOUR AS DATE) AS day,
             coalesce(s.fullname, ' ') AS fullname, 1 AS n
      FROM lab_events e LEFT JOIN staff s ON s.user_id = e.user_id)
    SELECT event_group, CAST(date_trunc('week', day) AS DATE) AS week_start, fullname,
           {_weekday_cells()}
    FROM x WHERE event_group IS NOT NULL GROUP BY 1, 2, 3
    """,
    "lab_events",
    "staff",
)
def event_group_week_matrix(t):
    return shift.event_matrix(t.lab_events, t.staff)


@query(
    f"""
    WITH x AS (SELECT CAST(moment AS DATE) AS day, fullname, 1 AS n FROM ({TICKET_ROWS}))
    SELECT CAST(date_trunc('week', day) AS DATE) AS week_start, fullname, {_weekday_cells()} FROM x GROUP BY 1, 2
    """,
    "tickets",
    "staff",
)
def ticket_category_matrix(t):
    return shift.ticket_matrix(t.tickets, t.staff)


@query(
    """
    WITH x AS (
      SELECT strftime(l_shipdate, '%-m/%-d/%Y') AS "Day", (l_linenumber * 60 + 30) * 60 AS secs, l_quantity AS packages,
             CAST(l_suppkey AS DOUBLE) AS samples
      FROM lineitem WHERE l_linenumber < 7),
    y AS (
      SELECT "Day", count(*) AS total_deliveries, avg(secs * packages) AS product_mean,
             sum(secs * packages) / sum(packages) AS weighted_mean, sum(packages) AS packages, sum(samples) AS samples
      FROM x GROUP BY 1)
    SELECT "Day", total_deliveries, product_mean, weighted_mean, packages, samples,
           printf('%02d:%02d:%02d', s // 3600 % 24, s // 60 % 60, s % 60) AS weighted_average_time
    FROM (SELECT *, CAST(floor(product_mean) AS BIGINT) AS s FROM y)
    """
)
def delivery_weighted_time(t):
    hour = F.col("l_linenumber") + 7
    clock = F.when(hour < 12, F.concat(hour.cast("string"), F.lit(":30 AM"))).when(
        hour == 12, F.lit("12:30 PM")
    ).otherwise(F.concat((hour - 12).cast("string"), F.lit(":30 PM")))
    sheet = t.raw("lineitem").select(
        F.date_format("l_shipdate", "M/d/yyyy").alias("Day"),
        F.when(F.col("l_linenumber") < 7, clock).alias("Time"),
        F.col("l_quantity").alias("Packages"),
        F.col("l_suppkey").cast("double").alias("Samples"),
    )
    return shift.delivery_log(sheet)


@query(
    """
    WITH ahead AS (
      SELECT *, lead(user_id) OVER (PARTITION BY report_id ORDER BY created_at, id) AS next_user FROM report_events),
    linked AS (
      SELECT a.report_id, a.created_at - INTERVAL 5 HOUR AS moment, s.fullname,
             row_number() OVER (PARTITION BY a.report_id ORDER BY a.created_at, a.id) AS rn
      FROM ahead a JOIN staff s ON s.user_id = a.next_user
      WHERE a.event_type = 'first_sample_data_source_linked_to_report')
    SELECT CAST(l.moment AS DATE) AS day, l.fullname, count(*) AS n
    FROM linked l JOIN orders o ON o.o_orderkey = l.report_id WHERE l.rn = 1 GROUP BY 1, 2
    """,
    "report_events",
    "staff",
)
def accessions_by_next_user(t):
    return activity.by_user(activity.accession_metric(t.reports, t.report_events, t.staff))


@query(
    """
    WITH ahead AS (
      SELECT *, lead(user_id) OVER (PARTITION BY report_id ORDER BY created_at, id) AS next_user FROM report_events
      WHERE created_at >= TIMESTAMP '1995-11-06 05:00:00'),
    linked AS (
      SELECT a.report_id, a.created_at - INTERVAL 5 HOUR AS moment, s.fullname,
             row_number() OVER (PARTITION BY a.report_id ORDER BY a.created_at, a.id) AS rn
      FROM ahead a JOIN staff s ON s.user_id = a.next_user
      WHERE a.event_type = 'first_sample_data_source_linked_to_report'
        AND a.created_at < TIMESTAMP '1995-11-13 05:00:00')
    SELECT CAST(l.moment AS DATE) AS day, l.fullname, count(*) AS n
    FROM linked l JOIN orders o ON o.o_orderkey = l.report_id WHERE l.rn = 1 GROUP BY 1, 2
    """,
    "report_events",
    "staff",
)
def accessions_one_week(t):
    """One local week: linking events inside it, credited to the next event even where that lies beyond the week."""
    week = {"start": "1995-11-06 00:00:00", "end": "1995-11-13 00:00:00"}
    return activity.by_user(activity.accession_metric(t.reports, t.report_events, t.staff, **week))


@query(
    """
    SELECT DISTINCT fullname FROM (
      SELECT s.fullname FROM scans c JOIN staff s ON s.user_id = c.user_id WHERE c.file_name IS NOT NULL
      UNION ALL SELECT s.fullname FROM tickets t JOIN staff s ON s.user_id = t.user_id
      WHERE t.category IN """
    + LISTED
    + ")",
    "scans",
    "tickets",
    "staff",
)
def union_user_names(t):
    from labtide.operators import matching

    frames = [activity.scan_metric(t.scans, t.staff), activity.ticket_metric(t.tickets, t.staff)]
    return matching.union_names(frames, "fullname")
