"""Turnaround dashboard, segments, trackers and delivery."""

from pyspark.sql import functions as F

from labtide.catalog.event_queries import TERM, report_facts
from labtide.catalog.registry import query
from labtide.catalog.sql_tables import FACTS, TAT
from labtide.functions import text
from labtide.operators import columns, matching
from labtide.plans import trackers, turnaround

STAMP = "MM/dd/yyyy HH:mm:ss"


def _shown(rows):
    """Timestamps as text, for the side-by-side check."""
    stamps = [c for c in rows.columns if dict(rows.dtypes)[c].startswith("timestamp")]
    return rows.withColumns({c: F.date_format(c, STAMP) for c in stamps})


@query(
    """
    SELECT id, result, expedited, redraw, clinic, distributor, test, tracking_number, sent_day, start_day, sent_time,
           start_time, receive_day, CAST(hour(start_date) AS INTEGER) AS start_hour,
           CAST(hour(created_at) AS INTEGER) AS create_hour, timedelta,
           strftime(collection_date, '%m/%d/%Y %H:%M:%S') AS collection_date
    FROM timed_facts
    """,
    *FACTS,
)
def report_base_fact(t):
    return _shown(report_facts(t)).select(
        "id", "result", "expedited", "redraw", "clinic", "distributor", "test", "tracking_number", "sent_day",
        "start_day", "sent_time", "start_time", "receive_day", "start_hour", "create_hour", "timedelta", "collection_date",
    )


KEPT = f"WHERE contains(test, '{TERM}') AND hundredths > 600 AND hundredths < 20000"
PUBLISHED = """
    id, collection_date, sample_received_at, receive_day, sent_day, start_time, sent_time, weekday, expedited, result,
    clinic, distributor, redraw, timedelta, test, tracking_number, start_date_type, month
"""


@query(
    f"""
    SELECT {PUBLISHED}, CAST(hundredths AS DOUBLE) / 100 AS "TAT", goal,
           CASE WHEN hundredths < goal * 100 THEN 0 ELSE 1 END AS goal_missed,
           CASE WHEN result = 'Positive' THEN 1 ELSE 0 END AS positive,
           (SELECT CAST(sum(hundredths) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 100 FROM tat_rows {KEPT}) AS "Average Turnaround"
    FROM tat_rows {KEPT} AND raw_number IS DISTINCT FROM 'N/A'
    """,
    *TAT,
)
def turnaround_dash(t):
    every = turnaround.turnaround(report_facts(t), term=TERM, clean=False)
    rows = turnaround.clean_tracking(turnaround.with_average(every))
    return _shown(rows).select(*turnaround.published(rows).columns, turnaround.AVERAGE)


@query(
    f"""
    SELECT {PUBLISHED}, days AS "TAT" FROM tat_rows
    WHERE NOT contains(test, '{TERM}') AND days < 1500 AND raw_number IS DISTINCT FROM 'N/A'
    """,
    *TAT,
)
def turnaround_days_genomics(t):
    return _shown(turnaround.published(turnaround.turnaround(report_facts(t), term=TERM, genomics=True)))


@query(
    f"""
    SELECT id, receive_day, sent_day, expedited, result, redraw, test, weekday, distributor, 1 AS positive, clinic
    FROM tat_rows {KEPT} AND raw_number IS DISTINCT FROM 'N/A' AND result = 'Positive'
    """,
    *TAT,
)
def positive_mode_filter(t):
    rows = turnaround.positives(turnaround.turnaround(report_facts(t), term=TERM))
    return matching.result_mode(rows, "P", result="result")


@query(
    """
    WITH marked AS (
      SELECT id, clinic, distributor, unnest([x FOR x IN [
        'all',
        CASE WHEN clinic = 'Supplier#000000003/Site 3' THEN 'clinic Supplier#000000003/Site 3' END,
        CASE WHEN distributor = 'NATION_7' THEN 'distributor NATION_7' END,
        CASE WHEN contains(distributor, 'NATION_1') THEN 'distributors with NATION_1' END,
        CASE WHEN contains(clinic, 'Site 2') THEN 'clinics with Site 2' END] IF x IS NOT NULL]) AS segment
      FROM timed_facts)
    SELECT id, clinic, distributor, segment FROM marked
    """,
    *FACTS,
)
def segment_slices(t):
    rules = turnaround.segment_rules(
        ["Supplier#000000003/Site 3"], ["NATION_7"], distributor_has=["NATION_1"], clinic_has=["Site 2"]
    )
    return matching.segments(report_facts(t), rules).select("id", "clinic", "distributor", "segment")


@query(
    """
    WITH d AS (SELECT id, tracking_number, regexp_replace(tracking_number, '[^0-9]', '', 'g') AS num FROM kits)
    SELECT id, CASE WHEN length(num) > 0 AND CAST(num AS BIGINT) > 1000 THEN CAST(num AS BIGINT) END AS tracking_number
    FROM d WHERE tracking_number IS DISTINCT FROM 'N/A'
    """,
    "kits",
)
def tracking_number_clean(t):
    return turnaround.clean_tracking(t.kits).select("id", "tracking_number")


TRACKER_SQL = """
    tracker_rows AS (
      SELECT 'trk_' || doc_id AS easypost_id, CASE WHEN n_chars % 2 = 0 THEN 'delivered' ELSE 'in_transit' END AS tracking_status,
             lang AS destination, source AS origin, CAST(n_chars AS DOUBLE) AS weight,
             'https://track.example/' || doc_id AS public_url,
             CASE lang WHEN 'de' THEN '`' || doc_id WHEN 'fr' THEN '8' || lpad(CAST(doc_id AS VARCHAR), 11, '0')
                  WHEN 'es' THEN 'N/A' ELSE lpad(CAST(doc_id AS VARCHAR), 12, '7') END AS num,
             CASE WHEN source <> 'src3' THEN [x FOR x IN string_split(text, chr(10)) IF length(x) > 0] ELSE [] END AS lines
      FROM documents),
    tracker_table AS (
      SELECT easypost_id, tracking_status, destination, origin, weight, public_url, CAST(num AS BIGINT) AS tracking_number,
             split_part(lines[1], ' ', 1) AS picked_up_city, CAST(length(lines[1]) AS VARCHAR) AS picked_up_state,
             CASE WHEN len(lines) > 0 THEN TIMESTAMP '2024-01-01 08:30:00' + to_days(CAST((len(lines) - 1) % 28 AS INTEGER))
                  END AS delivery_at
      FROM tracker_rows WHERE origin <> 'src7' AND num <> 'N/A' AND num NOT LIKE '`%' AND length(num) < 17)
"""


@query(
    f"""
    WITH {TRACKER_SQL}
    SELECT easypost_id, 'carrier' AS carrier, tracking_status, origin, destination, picked_up_city, picked_up_state,
           strftime(delivery_at, '%m/%d/%Y %H:%M:%S') AS delivery_datetime, tracking_number, weight, public_url,
           CASE WHEN tracking_status = 'delivered' THEN strftime(delivery_at, '%Y-%m-%dT%H:%M:%SZ') END AS delivery_date
    FROM tracker_table
    """,
)
def tracker_first_last(t):
    return _shown(trackers.normalise(t.trackers)).select(
        "easypost_id", "carrier", "tracking_status", "origin", "destination", "picked_up_city", "picked_up_state",
        "delivery_datetime", "tracking_number", "weight", "public_url", "delivery_date",
    )


@query(
    f"""
    , {TRACKER_SQL},
    timed AS (
      SELECT r.id, r.tracking_number, k.public_url, k.picked_up_city, k.delivery_at, r.start_date_type AS before, r.goal,
             CASE WHEN k.delivery_at IS NULL OR r.sent_date < k.delivery_at THEN r.start_date ELSE k.delivery_at END AS begin_at,
             r.sent_date
      FROM tat_rows r LEFT JOIN tracker_table k ON k.tracking_number = r.tracking_number
      WHERE r.hundredths > 600 AND r.hundredths < 20000 AND r.raw_number IS DISTINCT FROM 'N/A'),
    counted AS (
      SELECT *, date_sub('microsecond', begin_at, sent_date) + 18000000 AS us,
             (us - ((us % 36000000) + 36000000) % 36000000) // 36000000 AS hundredths FROM timed)
    SELECT id, tracking_number, public_url, picked_up_city, date_sub('second', begin_at, sent_date) AS timedelta,
           CAST(hundredths AS DOUBLE) / 100 AS "TAT",
           CASE WHEN delivery_at IS NOT NULL THEN 'delivery_date' ELSE before END AS start_date_type,
           CASE WHEN hundredths >= goal * 100 THEN 1 ELSE 0 END AS goal_missed,
           (SELECT CAST(sum(hundredths) AS DOUBLE) / CAST(count(*) AS DOUBLE) / 100 FROM counted) AS "Average Turnaround"
    FROM counted WHERE hundredths > 600 AND hundredths < 2000000
    """,
    *TAT,
)
def tracker_enrichment(t):
    rows = turnaround.turnaround(report_facts(t), term="")
    enriched = turnaround.with_trackers(rows, trackers.normalise(t.trackers), high=20_000)
    return enriched.select(
        "id", "tracking_number", "public_url", "picked_up_city", "timedelta", "TAT", "start_date_type", "goal_missed",
        "Average Turnaround",
    )


@query(
    f"""
    , {TRACKER_SQL}
    SELECT DISTINCT tracking_number FROM tat_rows
    WHERE hundredths > 600 AND hundredths < 20000 AND raw_number IS DISTINCT FROM 'N/A' AND tracking_number IS NOT NULL
      AND tracking_number NOT IN (SELECT tracking_number FROM tracker_table)
    """,
    *TAT,
)
def unseen_tracking_numbers(t):
    rows = turnaround.turnaround(report_facts(t), term="")
    return turnaround.unseen_tracking(rows, trackers.normalise(t.trackers))


@query(
    """
    SELECT event_id AS id, CAST(props ->> '$.k' AS BIGINT) AS k, event_type AS name, user_id AS dealid FROM events
    """
)
def json_flatten(t):
    """Landed JSON lines of CRM line items, parsed with a declared schema and flattened."""
    from labtide.plans import crm

    schema = """id bigint, properties struct<k: bigint, name: string>,
                associations struct<deals: struct<results: array<struct<id: bigint>>>>"""
    line = F.concat(
        F.lit('{"id": '), F.col("event_id"), F.lit(', "properties": {"name": "'), F.col("event_type"), F.lit('", '),
        F.substr("props", F.lit(2)), F.lit(', "associations": {"deals": {"results": [{"id": '), F.col("user_id"), F.lit("}]}}}"),
    )
    objects = t.raw("events").select(F.from_json(line, schema).alias("object")).select("object.*")
    return crm.flatten_objects(objects, "line_items")


@query(
    """
    SELECT doc_id, ([x FOR x IN string_split(text, ' ') IF contains(x, 'tion')])[1] AS word FROM documents
    """
)
def first_list_match(t):
    words = F.split("text", " ")
    return t.raw("documents").select("doc_id", text.first_containing(words, "tion").alias("word"))


@query(
    """
    WITH old AS (SELECT c_custkey, c_name, NULL AS c_acctbal FROM customer WHERE c_mktsegment = 'BUILDING')
    SELECT c_custkey, c_name, CAST(c_acctbal AS DOUBLE) AS c_acctbal FROM old
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM old)
    """
)
def union_append_dims(t):
    customers = t.raw("customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    old = customers.where(F.col("c_mktsegment") == "BUILDING").select("c_custkey", "c_name")
    return matching.with_new(old, columns.keep_present(customers, ["c_custkey", "c_name", "c_acctbal"]), "c_custkey")


@query("SELECT DISTINCT l_suppkey AS id FROM lineitem INTERSECT SELECT o_custkey FROM orders")
def intersect_keys(t):
    users = t.raw("orders").select("o_custkey")
    return t.raw("lineitem").select(F.col("l_suppkey").alias("id")).intersect(users)
