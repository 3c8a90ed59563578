"""Text cleansing: phones, zips, codes, dates and row gates."""

from pyspark.sql import functions as F

from labtide import standins
from labtide.catalog.registry import query
from labtide.functions import text, time
from labtide.operators import quality
from labtide.plans import cleanse, template

PHONE_IN_TEXT = "\\+1 \\(\\d{3}\\) \\d{3}-\\d{4}"


@query(
    """
    WITH found AS (
      SELECT doc_id, unnest(regexp_extract_all(text, '\\+1 \\(\\d{3}\\) \\d{3}-\\d{4}')) AS phone FROM documents),
    d AS (SELECT doc_id, phone, substr(regexp_replace(phone, '[^0-9]', '', 'g'), 2) AS num FROM found)
    SELECT doc_id, phone, substr(num, 1, 3) || '-' || substr(num, 4, 3) || '-' || substr(num, 7) AS dashes, num AS nodashes,
           '(' || substr(num, 1, 3) || ') ' || substr(num, 4, 3) || '-' || substr(num, 7) AS "national",
           substr(num, 1, 3) AS area_code, substr(num, 4) AS rest
    FROM d
    """
)
def phone_normalize(t):
    """Every phone in every whole text, in the three layouts."""
    found = t.raw("documents").select(
        "doc_id", F.explode(F.regexp_extract_all("text", F.lit(PHONE_IN_TEXT), F.lit(0))).alias("phone")
    )
    plain = text.phone_format("phone", "nodashes")
    return found.select(
        "doc_id",
        "phone",
        text.phone_format("phone", "dashes").alias("dashes"),
        plain.alias("nodashes"),
        text.phone_format("phone", "national").alias("national"),
        text.area_code(plain).alias("area_code"),
        text.without_area_code(plain).alias("rest"),
    )


@query(
    """
    WITH p AS (
      SELECT c_custkey, substr(lpad(CAST((c_custkey * 7919 + 12345) % 1000000000000 AS VARCHAR), 13, '13'),
                               1, CAST(6 + c_custkey % 7 AS INTEGER)) AS phone
      FROM customer),
    f AS (
      SELECT *, length(phone) AS n,
             CASE WHEN length(phone) = 11 AND phone LIKE '1%' THEN substr(phone, 2) WHEN length(phone) = 11 THEN substr(phone, 1, 10)
                  WHEN length(phone) = 8 THEN phone || '0' WHEN length(phone) < 8 OR length(phone) > 11 THEN NULL
                  ELSE phone END AS fixed FROM p)
    SELECT c_custkey, phone, substr(fixed, 1, 3) || '-' || substr(fixed, 4, 3) || '-' ||
           substr(fixed, 7, CASE WHEN length(fixed) = 10 THEN 4 ELSE 3 END) AS repaired, fixed IS NULL AS bad
    FROM f
    """
)
def phone_repair(t):
    raw = F.lpad(F.pmod(F.col("c_custkey") * 7919 + 12_345, F.lit(1_000_000_000_000)).cast("string"), 13, "13")
    length = (F.pmod(F.col("c_custkey"), F.lit(7)) + 6).cast("int")
    phones = t.raw("customer").select("c_custkey", F.substr(raw, F.lit(1), length).alias("phone"))
    value, bad = text.phone_repair("phone", pad=True)
    return phones.select("c_custkey", "phone", value.alias("repaired"), bad.alias("bad"))


@query(
    """
    SELECT c_custkey, CASE WHEN length(z) < 4 THEN NULL WHEN length(z) = 4 THEN '0' || z ELSE z END AS zip
    FROM (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS z FROM customer)
    """
)
def zip_repair(t):
    keys = t.raw("customer").select("c_custkey", F.col("c_custkey").cast("string").alias("zip"), F.lit("ZZ").alias("state"))
    return keys.select("c_custkey", text.zip_repair("zip", "state").alias("zip"))


@query(
    """
    SELECT id, race, CASE WHEN race = 'U' THEN 'U' ELSE 'NH' END AS ethnicity, CASE WHEN race = 'U' THEN 'U' ELSE 'N' END AS ethnicity_mo
    FROM (SELECT p.id, CASE split_part(coalesce(x.races, ' '), ',', 1) WHEN 'European' THEN 'W' WHEN 'Latin American' THEN 'W'
                 WHEN 'East Asian' THEN 'A' WHEN 'African' THEN 'B' ELSE 'U' END AS race
          FROM patients p LEFT JOIN races x ON x.patient_user_id = p.id)
    """,
    "patients",
    "races",
)
def code_map_race_ethnicity(t):
    from labtide.plans import state_export

    races = state_export.race_lists(t.export_tables)
    named = t.patient_users.select("id").join(races, F.col("id") == F.col("patient_user_id"), "left")
    race = text.race_code(text.blank_to_null(text.before("races", ",")))
    coded = named.select("id", race.alias("race"))
    return coded.select(
        "id",
        "race",
        text.ethnicity_code(F.col("race")).alias("ethnicity"),
        text.ethnicity_code(F.col("race"), "MO").alias("ethnicity_mo"),
    )


@query(
    """
    SELECT id, CAST(2024 - year(birth_date) - CASE WHEN strftime(birth_date, '%m%d') > '0201' THEN 1 ELSE 0 END AS INTEGER) AS age
    FROM patients
    """,
    "patients",
)
def age_years(t):
    return t.patient_users.select("id", time.age_years("birth_date", time.ntz(standins.AS_OF)).alias("age"))


@query(
    """
    SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS order_date, strftime(o_orderdate + INTERVAL 1 DAY, '%Y%m%d') AS due_dt,
           strftime(o_orderdate + to_seconds(CAST(floor(o_totalprice) AS BIGINT) % 86400), '%Y%m%d %H:%M') AS date_time_taken,
           o_orderpriority AS priority
    FROM orders
    """
)
def role_based_dates(t):
    """Columns named as dates are reformatted whatever form their text has."""
    taken = F.timestamp_add("SECOND", F.pmod(F.floor("o_totalprice"), F.lit(86_400)).cast("int"), F.col("o_orderdate"))
    rows = t.raw("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("order_date"),
        F.date_add("o_orderdate", 1).alias("due_dt"),
        F.date_format(taken, "yyyy-MM-dd HH:mm:ss").alias("date_time_taken"),
        F.col("o_orderpriority").alias("priority"),
    )
    return template.format_dates(rows, "yyyyMMdd", template.date_columns(rows))


@query(
    """
    SELECT DISTINCT l_returnflag AS state, CASE WHEN l_linenumber < 7 THEN CAST(l_orderkey AS VARCHAR) END AS accession_number,
           l_linestatus AS c1, CAST(l_linenumber AS VARCHAR) AS c2, CASE WHEN l_quantity > 25 THEN 'x' END AS c3,
           l_returnflag AS c4, l_returnflag AS c5, l_linestatus AS c6
    FROM lineitem WHERE l_linenumber < 7 AND l_quantity > 25
    """
)
def row_quality_gate(t):
    rows = t.raw("lineitem").select(
        F.col("l_returnflag").alias("state"),
        F.when(F.col("l_linenumber") < 7, F.col("l_orderkey").cast("string")).alias("accession_number"),
        F.col("l_linestatus").alias("c1"),
        F.col("l_linenumber").cast("string").alias("c2"),
        F.when(F.col("l_quantity") > 25, F.lit("x")).alias("c3"),
        F.col("l_returnflag").alias("c4"),
        F.col("l_returnflag").alias("c5"),
        F.col("l_linestatus").alias("c6"),
    )
    return cleanse.gate(rows)


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal < 0 THEN 'owes' END AS note FROM customer
    WHERE c_nationkey <> 3 OR c_acctbal < 0
    """
)
def drop_empty_columns(t):
    """Rows of one nation are blanked, and so is one column; both disappear."""
    keep = F.col("c_nationkey") != 3
    owes = F.when(F.col("c_acctbal") < 0, F.lit("owes"))
    rows = t.raw("customer").select(
        F.when(keep | owes.isNotNull(), F.col("c_custkey").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("unused"),
        owes.alias("note"),
    )
    return quality.drop_empty_columns(quality.drop_empty_rows(rows))


REGION_CODES = "PA OH KS WV NJ NM AZ NY TX IL AR MO ID MD CA WA OR NV UT CO MT WY ND SD NE".split()


@query(
    f"""
    WITH base AS (
      SELECT {REGION_CODES!r}[CAST(c_nationkey AS INTEGER) + 1] AS state,
             CASE WHEN c_acctbal > -900 THEN 'A' || c_custkey END AS accession_number,
             CAST(DATE '2020-01-01' + CAST(c_custkey % 700 AS INTEGER) AS TIMESTAMP) AS day,
             substr(lpad(CAST((c_custkey * 7919 + 12345) % 1000000000000 AS VARCHAR), 13, '13'),
                    1, CAST(6 + c_custkey % 7 AS INTEGER)) AS phone,
             CAST(c_custkey AS VARCHAR) AS zip, c_name AS name, c_mktsegment AS note,
             CASE WHEN c_acctbal > 0 THEN 'x' END AS extra
      FROM customer),
    gated AS (
      SELECT *, CASE WHEN state IN ('PA', 'OH', 'AZ', 'NJ', 'NM') THEN strftime(day, '%Y%m%d') ELSE strftime(day, '%m/%d/%Y')
                END AS shown FROM base
      WHERE accession_number IS NOT NULL),
    fixed AS (
      SELECT *, CASE WHEN length(phone) = 11 AND phone LIKE '1%' THEN substr(phone, 2) WHEN length(phone) = 11 THEN substr(phone, 1, 10)
                     WHEN length(phone) = 8 THEN phone || '0' WHEN length(phone) < 8 OR length(phone) > 11 THEN NULL
                     ELSE phone END AS p,
             CASE WHEN state IN ('PA', 'OH') THEN '' ELSE '-' END AS mark
      FROM gated)
    SELECT state, accession_number, shown AS collected_date,
           CASE WHEN state = 'WV' THEN strftime(day, '%Y-%m-%d') ELSE shown END AS shipped_dt,
           shown || strftime(day + INTERVAL 90 MINUTE, ' %H:%M') AS report_date_time,
           CASE WHEN state = 'KS' OR p IS NULL THEN phone
                ELSE substr(p, 1, 3) || mark || substr(p, 4, 3) || mark || substr(p, 7, CASE WHEN length(p) = 10 THEN 4 ELSE 3 END)
           END AS home_phone,
           CASE WHEN length(zip) < 4 THEN NULL WHEN length(zip) = 4 THEN '0' || zip ELSE zip END AS zip_code, name, note, extra,
           state <> 'KS' AND p IS NULL AS quarantined
    FROM fixed
    """
)
def cleanse_region_files(t):
    """All-text rows of 25 regions through the whole cleansing: rows to quarantine carry a flag."""
    key = F.col("c_custkey")
    raw = F.lpad(F.pmod(key * 7919 + 12_345, F.lit(1_000_000_000_000)).cast("string"), 13, "13")
    day = F.date_add(F.lit("2020-01-01").cast("date"), F.pmod(key, F.lit(700)).cast("int")).cast("timestamp_ntz")
    rows = t.raw("customer").select(
        F.element_at(F.array(*[F.lit(c) for c in REGION_CODES]), F.col("c_nationkey") + 1).alias("state"),
        F.when(F.col("c_acctbal") > -900, F.concat(F.lit("A"), key.cast("string"))).alias("accession_number"),
        F.date_format(day, "MM/dd/yyyy").alias("collected_date"),
        F.date_format(day, "yyyy-MM-dd").alias("shipped_dt"),
        F.date_format(day + F.expr("interval 90 minutes"), "MM/dd/yyyy HH:mm").alias("report_date_time"),
        F.substr(raw, F.lit(1), (F.pmod(key, F.lit(7)) + 6).cast("int")).alias("home_phone"),
        key.cast("string").alias("zip_code"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("note"),
        F.when(F.col("c_acctbal") > 0, F.lit("x")).alias("extra"),
    )
    return cleanse.flagged(rows, pad=True).withColumnRenamed(cleanse.BAD_PHONE, "quarantined")
