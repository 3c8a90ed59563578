"""SQL definitions of the stand-in tables, for the side-by-side check."""

LINE_ID = """(l_orderkey * 8 + l_linenumber) * 1000000000
           + (l_partkey * 1000003 + l_suppkey * 10007 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE)) * 31
              + CAST(round(l_extendedprice * 100) AS BIGINT)) % 1000000000"""

TABLES = {
    "reports": """
    SELECT o.o_orderkey AS id, o.o_orderkey AS kit_id, l.high_supp AS clinic_id, l.low_supp AS provider_clinic_id,
           l.part AS report_type_id, o.o_custkey AS patient_user_id, CAST(l.low_supp % 25 AS INTEGER) AS cached_distributor_id,
           o.o_orderdate + to_seconds(CAST(floor(o.o_totalprice / 2) AS BIGINT) % 86400) AS created_at,
           o.o_orderdate + to_seconds(CAST(floor(o.o_totalprice) AS BIGINT) % 86400) AS start_date,
           CASE WHEN o.o_orderstatus <> 'P'
                THEN l.last_ship + to_seconds((o.o_custkey * 61) % 86400) + INTERVAL 3 DAY END AS sent_date,
           CASE o.o_orderpriority WHEN '1-URGENT' THEN 'approved' WHEN '2-HIGH' THEN 'sent'
                WHEN '3-MEDIUM' THEN 'sent_to_patient' WHEN '4-NOT SPECIFIED' THEN 'consultation_pending'
                ELSE 'draft' END AS status,
           CASE o.o_orderstatus WHEN 'F' THEN 'Positive' WHEN 'O' THEN 'Negative' END AS result,
           o.o_orderpriority = '1-URGENT' AS expedited
    FROM orders o LEFT JOIN (
        SELECT l_orderkey, min(l_partkey) AS part, min(l_suppkey) AS low_supp, max(l_suppkey) AS high_supp,
               max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_orderkey) l ON o.o_orderkey = l.l_orderkey
    """,
    "kits": """
    SELECT o_orderkey AS id,
           CASE o_orderpriority WHEN '5-LOW' THEN 'N/A' WHEN '4-NOT SPECIFIED' THEN NULL
                WHEN '3-MEDIUM' THEN 'TRK ' || CAST(o_custkey AS VARCHAR)
                ELSE '8' || lpad(CAST(o_orderkey AS VARCHAR), 11, '0') || '-A' END AS tracking_number,
           o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT) % 86400) AS received_at
    FROM orders
    """,
    "samples": f"""
    SELECT id, kit_id, received_at, received_at - INTERVAL 36 HOUR AS collection_date, collection_type,
           'S' || CAST(id AS VARCHAR) AS barcode
    FROM (SELECT {LINE_ID} AS id,
                 l_orderkey AS kit_id,
                 l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT) % 86400) AS received_at,
                 CASE l_returnflag WHEN 'A' THEN 'Saliva' WHEN 'N' THEN 'Swab' WHEN 'R' THEN 'Blood' END AS collection_type
          FROM lineitem)
    """,
    "sample_data_sources": f"""
    SELECT {LINE_ID} AS sample_id,
           CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN 'rejected'
                WHEN l_linestatus = 'O' THEN 'further_review' ELSE 'qc_approved' END AS status
    FROM lineitem
    """,
    "report_events": f"""
    SELECT {LINE_ID} AS id,
           l_orderkey AS report_id, l_orderkey AS kit_id, l_suppkey AS user_id,
           CASE WHEN l_linenumber = 1 THEN 'report_requested'
                WHEN l_linenumber = 2 THEN 'first_sample_data_source_linked_to_report'
                WHEN l_linenumber = 3 THEN 'report_transitioned_to_awaiting_review'
                WHEN l_linenumber = 4 AND l_returnflag = 'A' THEN 'report_result_updated'
                WHEN l_linenumber = 4 AND l_returnflag = 'N' THEN 'report_marked_redraw'
                WHEN l_linenumber = 4 THEN 'report_generated'
                WHEN l_linenumber = 5 AND l_returnflag = 'A' THEN 'report_electronically_signed_and_approved'
                WHEN l_linenumber = 5 AND l_returnflag = 'N' THEN 'report_review_approved'
                WHEN l_linenumber = 5 THEN 'report_cancelled'
                WHEN l_linenumber = 6 AND l_returnflag = 'A' THEN 'report_sent'
                WHEN l_linenumber = 6 AND l_returnflag = 'N' THEN 'report_sent_to_patient'
                WHEN l_linenumber = 6 THEN 'report_rolled_back_to_awaiting_results'
                ELSE 'kit_received' END AS event_type,
           l_shipdate + to_seconds((l_partkey * 37) % 86400) AS created_at
    FROM lineitem
    """,
    "event_log": """
    SELECT event_id AS id, user_id AS report_id, CAST(props ->> '$.k' AS BIGINT) AS kit_id,
           CAST(props ->> '$.k' AS BIGINT) AS user_id, event_type, ts AS created_at, value
    FROM events
    """,
    "lab_events": """
    SELECT event_id AS id, user_id AS report_id, CAST(props ->> '$.k' AS BIGINT) AS kit_id,
           CAST(props ->> '$.k' AS BIGINT) AS user_id, ts AS created_at,
           CASE event_type
             WHEN 'signup' THEN CASE WHEN value < 20 THEN 'first_sample_data_source_linked_to_report'
                                     WHEN value < 60 THEN 'kit_received' ELSE 'kit_accessioning_complete' END
             WHEN 'view' THEN CASE WHEN value < 20 THEN 'report_transitioned_to_awaiting_review'
                                   WHEN value < 60 THEN 'kit_data_review_complete' ELSE 'report_generated' END
             WHEN 'click' THEN CASE WHEN value < 20 THEN 'report_result_updated'
                                    WHEN value < 60 THEN 'scan_assigned_to_kit' ELSE 'scan_created' END
             WHEN 'purchase' THEN CASE WHEN value < 20 THEN 'report_sent'
                                       WHEN value < 60 THEN 'report_electronically_signed_and_approved'
                                       ELSE 'report_sent_to_patient' END
             WHEN 'error' THEN CASE WHEN value < 20 THEN 'report_marked_redraw' WHEN value < 60 THEN 'report_cancelled'
                                    ELSE 'report_rolled_back_to_awaiting_results' END
           END AS event_type
    FROM events
    """,
    "event_kits": """
    SELECT CAST(props ->> '$.k' AS BIGINT) AS id, min(ts) AS received_at FROM events GROUP BY 1
    """,
    "staff": """
    SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN -c_custkey ELSE c_custkey END AS user_id,
           CASE WHEN c_acctbal >= 0 THEN split_part(c_name, '#', 1) ELSE '' END || ' ' || split_part(c_name, '#', 2) AS fullname
    FROM customer
    """,
    "tickets": """
    SELECT o_orderkey AS id, o_custkey AS user_id,
           CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical Missing Information' WHEN '2-HIGH' THEN 'Missing Information'
                WHEN '3-MEDIUM' THEN 'Redraw' WHEN '4-NOT SPECIFIED' THEN 'Other Error' ELSE 'Billing' END AS category,
           o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT) % 86400) AS created_at
    FROM orders
    """,
    "scans": """
    SELECT l_suppkey AS user_id, CASE WHEN l_returnflag <> 'R' THEN 'page.pdf' END AS file_name,
           l_shipdate + to_seconds(CAST(floor(l_extendedprice) AS BIGINT) % 86400) AS created_at
    FROM lineitem
    """,
    "clinics": """
    SELECT s_suppkey AS id, s_name || '/Site ' || CAST(s_nationkey AS VARCHAR) AS name, s_nationkey AS distributor_id,
           CASE WHEN s_suppkey % 3 <> 0 THEN 1000000000 + s_suppkey * 2 + 1 END AS main_location_id,
           CASE WHEN s_acctbal >= 2000
                THEN '201-555-' || lpad(CAST(s_suppkey % 10000 AS VARCHAR), 4, '0') || ',ext 1' END AS phone
    FROM supplier
    """,
    "distributors": """
    SELECT n_nationkey AS id, n_name AS name, n_regionkey AS parent_distributor_id,
           CASE WHEN n_nationkey % 2 = 1 THEN '99D' || lpad(CAST(n_nationkey AS VARCHAR), 7, '0') END AS clia_number
    FROM nation
    """,
    "report_types": "SELECT p_partkey AS id, p_type || ' ' || p_name AS name FROM part",
    "patients": """
    SELECT c_custkey AS id, split_part(c_name, '#', 1) AS first_name, split_part(c_name, '#', 2) AS last_name,
           CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 25000 AS INTEGER) AS DATE) AS birth_date,
           CASE c_mktsegment WHEN 'MACHINERY' THEN 'male' WHEN 'BUILDING' THEN 'female' WHEN 'FURNITURE' THEN 'other' END AS gender,
           CASE WHEN c_acctbal >= 1000
                THEN '201' || lpad(CAST((c_custkey * 7919 + 12345) % 10000000 AS VARCHAR), 7, '2') || ',home' END AS phone
    FROM customer
    """,
    "practitioners": """
    SELECT s_suppkey AS id, split_part(s_name, '#', 1) AS first_name, split_part(s_name, '#', 2) AS last_name,
           'MD' AS title, lpad(CAST(s_suppkey AS VARCHAR), 10, '1') AS npi
    FROM supplier
    """,
    "homes": """
    SELECT c.c_custkey AS patient_user_id, CAST(c.c_custkey AS VARCHAR) || ' Home Street' AS address_1,
           CASE WHEN k.nth = 1 THEN 'Unit 2' END AS address_2, c.c_mktsegment AS city, n.n_name AS state,
           CAST(c.c_custkey AS VARCHAR) AS zip,
           CASE WHEN c.c_nationkey < 10 THEN 'US' WHEN c.c_nationkey < 20 THEN 'USA' ELSE 'CA' END AS country
    FROM customer c JOIN (VALUES (0), (1)) k(nth) ON k.nth = 0 OR c.c_acctbal > 5000
    JOIN nation n ON n.n_nationkey = (c.c_nationkey + k.nth) % 25
    """,
    "sites": """
    SELECT 1000000000 + s.s_suppkey * 2 + k.nth AS id, s.s_suppkey AS clinic_id,
           CASE WHEN s.s_acctbal <= 8000 THEN CAST(s.s_suppkey AS VARCHAR) || ' Clinic Way' END AS address_1,
           CASE WHEN s.s_acctbal <= 8000 AND k.nth = 1 THEN 'Floor 1' END AS address_2,
           'Clinicville' AS city, n.n_name AS state, lpad(CAST(s.s_suppkey AS VARCHAR), 5, '0') AS zip
    FROM supplier s CROSS JOIN (VALUES (0), (1)) k(nth) JOIN nation n ON n.n_nationkey = s.s_nationkey
    """,
    "races": """
    SELECT patient_user_id, string_agg(DISTINCT coalesce(name, ' '), ',' ORDER BY coalesce(name, ' ')) AS races
    FROM (SELECT CASE WHEN c.c_mktsegment = 'HOUSEHOLD' THEN -c.c_custkey ELSE c.c_custkey END AS patient_user_id,
                 CASE r.r_name WHEN 'AFRICA' THEN 'African' WHEN 'AMERICA' THEN 'Latin American'
                      WHEN 'ASIA' THEN 'East Asian' WHEN 'EUROPE' THEN 'European' END AS name
          FROM customer c JOIN region r
            ON r.r_regionkey = c.c_nationkey % 5 OR (c.c_acctbal < 0 AND r.r_regionkey = 3))
    GROUP BY patient_user_id
    """,
    "ledger": """
    SELECT CASE WHEN o_orderkey > 0 THEN o_orderkey END AS report_id, o_orderdate AS created_at
    FROM orders WHERE o_orderpriority = '1-URGENT'
    """,
    "facts": """
    SELECT r.id, r.result, r.expedited, e.redraw, c.name AS clinic, d.name AS distributor, t.name AS test, k.tracking_number,
           r.created_at - INTERVAL 5 HOUR AS created_at, r.start_date - INTERVAL 5 HOUR AS start_date,
           r.sent_date - INTERVAL 5 HOUR AS sent_date, s.received_at - INTERVAL 5 HOUR AS sample_received_at,
           s.collection_date - INTERVAL 5 HOUR AS collection_date
    FROM reports r
    JOIN (SELECT report_id, bool_or(event_type = 'report_marked_redraw') AS redraw FROM report_events GROUP BY 1) e
      ON e.report_id = r.id
    JOIN (SELECT kit_id, max_by(received_at, id) AS received_at, max_by(collection_date, id) AS collection_date
          FROM samples GROUP BY 1) s ON s.kit_id = r.kit_id
    JOIN kits k ON k.id = r.kit_id
    JOIN clinics c ON c.id = r.clinic_id
    JOIN distributors d ON d.id = c.distributor_id
    JOIN report_types t ON t.id = r.report_type_id
    """,
    "timed_facts": """
    SELECT *, strftime(sent_date, '%m/%d/%Y') AS sent_day, strftime(start_date, '%m/%d/%Y') AS start_day,
           strftime(sent_date, '%H:%M:%S') AS sent_time, strftime(start_date, '%H:%M:%S') AS start_time,
           strftime(sample_received_at, '%m/%d/%Y') AS receive_day, date_sub('second', sample_received_at, sent_date) AS timedelta,
           date_sub('microsecond', sample_received_at, sent_date) AS elapsed_us
    FROM facts
    """,
    "tat_rows": """
    SELECT id, strftime(collection_date, '%m/%d/%Y %H:%M:%S') AS collection_date,
           strftime(sample_received_at, '%m/%d/%Y %H:%M:%S') AS sample_received_at, receive_day, sent_day, start_time,
           sent_time, strftime(start_date, '%A') AS weekday, strftime(start_date, '%B') AS month, expedited, result,
           clinic, distributor, redraw, timedelta, test, start_date, sent_date,
           CASE WHEN hour(created_at) = hour(start_date) THEN 'report_created' ELSE 'sample_created' END AS start_date_type,
           CASE WHEN length(regexp_replace(tracking_number, '[^0-9]', '', 'g')) > 0
                 AND CAST(regexp_replace(tracking_number, '[^0-9]', '', 'g') AS BIGINT) > 1000
                THEN CAST(regexp_replace(tracking_number, '[^0-9]', '', 'g') AS BIGINT) END AS tracking_number,
           tracking_number AS raw_number,
           (elapsed_us + 18000000 - (((elapsed_us + 18000000) % 36000000) + 36000000) % 36000000) // 36000000 AS hundredths,
           (elapsed_us - ((elapsed_us % 86400000000) + 86400000000) % 86400000000) // 86400000000 AS days,
           CASE WHEN expedited THEN 24 ELSE 72 END AS goal
    FROM timed_facts WHERE sent_day IS NOT NULL
    """,
}

FACTS = ("reports", "kits", "samples", "report_events", "clinics", "distributors", "report_types", "facts", "timed_facts")
TAT = (*FACTS, "tat_rows")
