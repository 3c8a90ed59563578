"""Public-health export, templates, ledger and delivery."""

import datetime as dt

from pyspark.sql import functions as F

from labtide import standins
from labtide.catalog.registry import query
from labtide.config.settings import FileNames
from labtide.functions import time
from labtide.operators import dedup, matching
from labtide.plans import ledger, template
from labtide.plans import state_export as export_plan
from labtide.sources import readers, writers

ROOT = 1
EXTRA_REGIONS = ["TERRITORY_A", "TERRITORY_B"]
EXPORT_TABLES = (
    "reports", "samples", "sample_data_sources", "clinics", "distributors", "report_types", "patients", "practitioners",
    "homes", "sites", "races",
)
LAB = standins.LAB

ELIGIBLE_SQL = """
    eligible AS (
      SELECT * FROM reports WHERE status IN ('approved', 'sent', 'sent_to_patient', 'consultation_pending')
        AND sent_date IS NOT NULL
        AND cached_distributor_id IN (SELECT id FROM distributors WHERE id = 1 OR parent_distributor_id = 1)),
    usable AS (
      SELECT * FROM samples WHERE collection_type IN ('Saliva', 'Swab')
        AND id IN (SELECT sample_id FROM sample_data_sources
                   WHERE status IN ('qc_pending', 'qc_hold', 'qc_approved', 'vc_complete', 'further_review')))
"""

EXPORT_SQL = f"""
    {ELIGIBLE_SQL},
    places AS (
      SELECT c.id AS clinic_id, c.phone AS provider_phone,
             coalesce(s.address_1, '') || ' ' || coalesce(s.address_2, '') AS address, s.city, s.state, s.zip
      FROM clinics c LEFT JOIN (SELECT clinic_id, min(id) AS low FROM sites GROUP BY 1) m ON m.clinic_id = c.id
      JOIN sites s ON s.id = coalesce(c.main_location_id, m.low)),
    export AS (
      SELECT DISTINCT r.id AS report_id, h.state AS file_state,
        '{LAB.application}' AS "Sending Application", NULL::VARCHAR AS "Sending Application ID",
        TIMESTAMP '{standins.AS_OF}' AS "Message Date and Time", NULL::VARCHAR AS "Receiving Application",
        '{LAB.name}' AS "Lab Name", coalesce(d.clia_number, '{LAB.clia}') AS "Lab CLIA",
        '{LAB.address}' AS "Lab Address", '{LAB.city}' AS "Lab City", '{LAB.state}' AS "Lab State", '{LAB.zip}' AS "Lab Zip",
        '{LAB.phone}' AS "Lab Phone", r.report_type_id AS "Test Code", t.name AS "Test Name",
        CASE s.collection_type WHEN 'Saliva' THEN '95425-5' WHEN 'Swab' THEN '94533-7' END AS "LOINC Code",
        CASE s.collection_type
          WHEN 'Saliva' THEN 'SARS-CoV-2 (COVID19) N gene [Presence] in Saliva (oral fluid) by NAA with probe detection'
          WHEN 'Swab' THEN 'SARS-CoV-2 (COVID-19) N gene [Presence] in Respiratory specimen by NAA with probe detection'
        END AS "LOINC Description",
        '{LAB.instrument}' AS "Test Instrument", r.result AS "Result", NULL::VARCHAR AS "Result Status Code (NYS)",
        r.sent_date AS "Result Date and Time", p.id AS "Patient ID", p.first_name AS "Patient First Name",
        p.last_name AS "Patient Last Name", p.birth_date AS "Patient Date of Birth",
        CASE p.gender WHEN 'male' THEN 'M' WHEN 'female' THEN 'F' ELSE 'U' END AS "Patient Sex",
        coalesce(split_part(x.races, ',', 1), ' ') AS "Patient Race", NULL::VARCHAR AS "Patient Ethnicity",
        coalesce(h.address_1, '') || ' ' || coalesce(h.address_2, '') AS "Patient Street Address",
        h.city AS "Patient City", h.state AS "Patient State", h.zip AS "Patient Zip", NULL::VARCHAR AS "Patient County",
        CASE WHEN h.country IN ('US', 'USA') THEN 'United States of America' ELSE h.country END AS "Patient Country",
        CASE WHEN p.phone IS NOT NULL THEN split_part(p.phone, ',', 1) WHEN a.provider_phone IS NOT NULL THEN a.provider_phone
             WHEN c.phone IS NOT NULL THEN split_part(c.phone, ',', 1) ELSE '{LAB.phone}' END AS "Patient Phone",
        split_part(c.name, '/', 1) AS "Ordering Facility",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.address}' ELSE a.address END AS "Ordering Facility Address",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.city}' ELSE a.city END AS "Ordering Facility City",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.state}' ELSE a.state END AS "Ordering Facility State",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.zip}' ELSE a.zip END AS "Ordering Facility Zip",
        CASE WHEN c.phone IS NOT NULL THEN split_part(c.phone, ',', 1)
             WHEN a.provider_phone IS NOT NULL THEN split_part(a.provider_phone, ',', 1) ELSE '{LAB.phone}' END AS "Ordering Facility Phone",
        f.first_name AS "Provider First Name", f.last_name AS "Provider Last Name", f.title AS "Provider Name Suffix",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.address}' ELSE a.address END AS "Provider Address",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.city}' ELSE a.city END AS "Provider City",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.state}' ELSE a.state END AS "Provider State",
        CASE WHEN a.address IS NULL OR a.address = ' ' THEN '{LAB.zip}' ELSE a.zip END AS "Provider Zip",
        CASE WHEN a.provider_phone IS NOT NULL THEN split_part(a.provider_phone, ',', 1)
             WHEN c.phone IS NOT NULL THEN split_part(c.phone, ',', 1) ELSE '{LAB.phone}' END AS "Provider Phone",
        f.npi AS "Provider NPI", s.barcode AS "Specimen ID / Accession Number", s.collection_date AS "Collection Date and Time",
        s.collection_type AS "Specimen Type",
        CASE s.collection_type WHEN 'Saliva' THEN 'Mouth' WHEN 'Swab' THEN 'Nasopharynx' END AS "Specimen Source/Site",
        NULL::VARCHAR AS "Notes", NULL::VARCHAR AS "Previous Test Exists (Y/N)", NULL::VARCHAR AS "Healthcare Worker (Y/N)",
        NULL::VARCHAR AS "Symptom Onset Date", NULL::VARCHAR AS "Hospitalized (Y/N)",
        NULL::VARCHAR AS "Congregate Care Resident (Y/N)", NULL::VARCHAR AS "Pregnant (Y/N)",
        CAST(2024 - year(p.birth_date)
             - CASE WHEN strftime(p.birth_date, '%m%d') > '0201' THEN 1 ELSE 0 END AS INTEGER) AS "Patient Age",
        'L' AS "L", 'U' AS "U", 'UNK' AS "UNK", NULL::VARCHAR AS "NULLCOLUMN"
      FROM eligible r JOIN distributors d ON d.id = r.cached_distributor_id
      JOIN patients p ON p.id = r.patient_user_id JOIN report_types t ON t.id = r.report_type_id
      LEFT JOIN races x ON x.patient_user_id = p.id JOIN homes h ON h.patient_user_id = p.id
      LEFT JOIN places a ON a.clinic_id = r.provider_clinic_id JOIN clinics c ON c.id = r.clinic_id
      LEFT JOIN practitioners f ON f.id = p.id JOIN usable s ON s.kit_id = r.kit_id)
"""

FINISHED_SQL = """
    SELECT * REPLACE (
      strftime("Message Date and Time" - INTERVAL 5 HOUR, '%m/%d/%Y %H:%M') AS "Message Date and Time",
      strftime("Result Date and Time" - INTERVAL 5 HOUR, '%m/%d/%Y %H:%M') AS "Result Date and Time",
      strftime("Collection Date and Time" - INTERVAL 5 HOUR, '%m/%d/%Y %H:%M') AS "Collection Date and Time")
"""


def _export(t):
    return export_plan.export_rows(t.export_tables, LAB, root=ROOT, as_of=standins.AS_OF)


def finished_rows(t, **kwargs):
    return export_plan.finish(_export(t), **kwargs)


@query(f"WITH {EXPORT_SQL} {FINISHED_SQL} FROM export", *EXPORT_TABLES)
def state_export(t):
    return finished_rows(t)


@query(
    f"""
    WITH {EXPORT_SQL}
    {FINISHED_SQL} FROM (
      SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY file_state ORDER BY report_id, "Specimen ID / Accession Number",
                                     "Patient Street Address") AS rn
        FROM export WHERE "Result" NOT LIKE '%Positive%' OR "Result" IS NULL) WHERE rn <= 6)
    """,
    *EXPORT_TABLES,
)
def per_state_sample_n(t):
    return finished_rows(t, mode="N", limit_per_state=6)


def _regions(t):
    extra = t.spark.createDataFrame([(r,) for r in EXTRA_REGIONS], "file_state string")
    return t.raw("nation").select(F.col("n_name").alias("file_state")).union(extra)


@query(
    f"""
    WITH {EXPORT_SQL},
    regions AS (SELECT n_name AS file_state FROM nation
                UNION ALL SELECT * FROM (VALUES ('TERRITORY_A'), ('TERRITORY_B')) v(file_state)),
    counted AS (SELECT g.file_state, count(e.report_id) AS n FROM regions g LEFT JOIN export e ON e.file_state = g.file_state
                GROUP BY 1)
    SELECT file_state, n, CASE WHEN n > 0 THEN n || ' reports exported from ' || file_state
                               ELSE 'No reports from ' || file_state END AS message
    FROM counted
    """,
    *EXPORT_TABLES,
)
def state_manifest_zero_filled(t):
    return export_plan.manifest(_regions(t), _export(t))


@query(
    """
    SELECT id, cached_distributor_id FROM reports
    WHERE cached_distributor_id IN (SELECT id FROM distributors WHERE id = 1 OR parent_distributor_id = 1)
    """,
    "reports",
    "distributors",
)
def sub_distributor_semi(t):
    family = matching.family(t.distributors, ROOT).withColumnRenamed("id", "root_id")
    return matching.present(t.reports, family, {"cached_distributor_id": "root_id"}).select("id", "cached_distributor_id")


@query(
    """
    SELECT id, status FROM reports r
    WHERE NOT EXISTS (SELECT 1 FROM ledger g WHERE g.report_id = r.id AND g.created_at >= TIMESTAMP '1996-01-01')
    """,
    "reports",
    "ledger",
)
def unreported_anti(t):
    return ledger.unreported(t.reports, t.ledger, since="1996-01-01").select("id", "status")


@query(
    f"""
    WITH {ELIGIBLE_SQL},
    bounds AS (SELECT min(sent_date) AS lo, max(sent_date) + INTERVAL 60 SECOND AS hi FROM eligible)
    SELECT DISTINCT r.patient_user_id, r.id AS report_id, 'report_marked_state_reported' AS event_type,
           'human' AS agent_type, CAST(7 AS BIGINT) AS user_id, 'script' AS domain, '02/01/2024 12:00' AS created_at
    FROM eligible r, bounds b
    WHERE r.sent_date >= b.lo AND r.sent_date <= b.hi AND r.kit_id IN (SELECT kit_id FROM usable)
      AND r.patient_user_id IN (SELECT patient_user_id FROM homes)
      AND NOT EXISTS (SELECT 1 FROM ledger g WHERE g.report_id = r.id)
    """,
    "reports",
    "distributors",
    "samples",
    "sample_data_sources",
    "homes",
    "ledger",
)
def ledger_mark_window(t):
    tables = t.export_tables
    exported = export_plan.eligible_reports(tables, root=ROOT)
    first, last = ledger.window_of(exported, "sent_date")
    marks = ledger.to_mark(tables, t.ledger, root=ROOT, since=None)
    window = exported.where((F.col("sent_date") >= first) & (F.col("sent_date") <= last))
    rows = ledger.ledger_rows(matching.present(marks, window.select(F.col("id").alias("rid")), {"id": "rid"}), as_of=standins.AS_OF, user_id=7)
    return rows.withColumn("created_at", F.date_format("created_at", time.MINUTE_FORMAT))


@query(
    """
    SELECT id, strftime(sent_date, '%m/%d/%Y %H:%M') AS sent FROM reports
    WHERE sent_date >= (SELECT coalesce(max(created_at), TIMESTAMP '1990-01-01') - INTERVAL 365 DAY FROM ledger)
    """,
    "reports",
    "ledger",
)
def incremental_window(t):
    """Reports sent since a watermark that Spark reads from the ledger as a one-value subquery."""
    mark = t.ledger.agg(
        (F.coalesce(F.max("created_at"), time.ntz("1990-01-01")) - F.expr("interval 365 days")).alias("mark")
    ).scalar()
    sent = t.reports.where(F.col("sent_date") >= mark)
    return sent.select("id", F.date_format("sent_date", time.MINUTE_FORMAT).alias("sent"))


@query(
    """
    WITH contacts AS (
      SELECT n.n_name AS state, min(s.s_suppkey) AS contact FROM supplier s JOIN nation n ON n.n_nationkey = s.s_nationkey
      WHERE s.s_acctbal > 6000 GROUP BY 1),
    files AS (SELECT state, count(*) AS n FROM homes GROUP BY 1)
    SELECT f.state, f.n, c.contact, CASE WHEN c.contact IS NULL THEN 'no contact' END AS error
    FROM files f LEFT JOIN contacts c ON c.state = f.state
    """,
    "homes",
)
def error_rows_unmatched_lookup(t):
    files = t.locations.where(F.col("patient_user_id").isNotNull()).groupBy("state").agg(F.count(F.lit(1)).alias("n"))
    able = t.raw("supplier").where(F.col("s_acctbal") > 6000).groupBy("s_nationkey").agg(F.min("s_suppkey").alias("contact"))
    contacts = able.join(t.raw("nation"), F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("n_name").alias("state"), "contact"
    )
    good, bad = matching.lookup_or_error(files, contacts, "state", "contact", "no contact")
    return matching.append(good, bad)


PHONE_DASHES = "regexp_replace(regexp_replace({0}, '[^0-9]', '', 'g'), '^1?(\\d{{3}})(\\d{{3}})(\\d{{4}})$', '\\1-\\2-\\3')"
PHONE_PLAIN = "regexp_replace(regexp_replace({0}, '[^0-9]', '', 'g'), '^1(\\d{{10}})$', '\\1')"
RACE_SQL = """CASE coalesce("Patient Race", ' ') WHEN 'European' THEN 'W' WHEN 'Latin American' THEN 'W' WHEN 'East Asian' THEN 'A'
              WHEN 'African' THEN 'B' WHEN 'Other' THEN 'O' ELSE 'U' END"""


def _phone(column: str, form: str) -> str:
    return form.format(f"coalesce(\"{column}\", '{LAB.phone}')")


@query(
    f"""
    WITH {EXPORT_SQL}, done AS ({FINISHED_SQL} FROM export)
    SELECT report_id, "Lab Name" AS "Lab", "Patient Last Name" AS "Patient_Last_Name", "Patient First Name" AS "Patient_First_Name",
      strftime("Patient Date of Birth", '%m/%d/%Y') AS "Patient_DOB", "Patient Sex" AS "Patient_Gender",
      "Patient Street Address" AS "Patient_Address_1", NULL::VARCHAR AS "Patient_Address_2", "Patient City" AS "Patient_City",
      "Patient State" AS "Patient_State", "Patient Zip" AS "Patient_Zip",
      substr({_phone("Patient Phone", PHONE_PLAIN)}, 1, 3) AS "Patient_Area_Code",
      substr({_phone("Patient Phone", PHONE_PLAIN)}, 4) AS "Patient_Phone",
      "Ordering Facility" AS "Ordering_Facility", "Ordering Facility Address" AS "Ordering_Facility_Address_1",
      NULL::VARCHAR AS "Ordering_Facility_Address_2", "Ordering Facility City" AS "Ordering_Facility_City",
      "Ordering Facility State" AS "Ordering_Facility_State", "Ordering Facility Zip" AS "Ordering_Facility_Zip",
      substr({_phone("Ordering Facility Phone", PHONE_PLAIN)}, 1, 3) AS "Ordering_Facility_Area_Code",
      substr({_phone("Ordering Facility Phone", PHONE_PLAIN)}, 4) AS "Ordering_Facility_Phone",
      "Provider Last Name" AS "Ordering_Provider_LName", "Provider First Name" AS "Ordering_Provider_Fname",
      "Specimen ID / Accession Number" AS "Accession_Number",
      substr("Collection Date and Time", 1, 10) AS "Specimen_Collection_Date", 'OT' AS "Specimen_Source",
      substr("Result Date and Time", 1, 10) AS "Test_Date", "LOINC Description" AS "Test_Performed", "Result",
      {RACE_SQL} AS "Race", CASE WHEN {RACE_SQL} = 'U' THEN 'U' ELSE 'N' END AS "Ethnicity"
    FROM done
    """,
    *EXPORT_TABLES,
)
def template_select(t):
    """Every export row in the MO form."""
    return _in_form(t, "MO")


def _in_form(t, region):
    catalogue, form = template.packaged_catalogue(), template.packaged_template(region)
    return template.transform(
        finished_rows(t), form, catalogue, default_phone=LAB.phone, as_of=standins.AS_OF, keep=("report_id",)
    )


TX_SQL = """
    "Lab Name" AS "Reporting_Facility_Name", "Lab CLIA" AS "CLIA_Number", "Lab Name" AS "Performing_Organization_Name",
    "Lab Address" AS "Performing_Organization_Address", "Lab City" AS "Performing_Organization_City",
    "Lab Zip" AS "Performing_Organization_Zip", "Lab State" AS "Performing_Organization_State",
    "Test Instrument" AS "Device_Identifier", "Test Name" AS "Ordered_Test_Name", "LOINC Code" AS "LOINC_Code",
    "LOINC Description" AS "LOINC_Text", "Result", NULL::VARCHAR AS "Result_Units", NULL::VARCHAR AS "Reference_Range",
    substr("Result Date and Time", 1, 10) AS "Date_Test_Performed", substr("Result Date and Time", 1, 10) AS "Test_Result_Date",
    "Patient First Name" AS "Pt_Fname", NULL::VARCHAR AS "Pt_Middle_Initial", "Patient Last Name" AS "Pt_Lname",
    strftime("Patient Date of Birth", '%m/%d/%Y') AS "Date_of_Birth", "Patient Age" AS "Patient_Age", "Patient Sex" AS "Sex",
    "Patient Street Address" AS "Pt_Str", "Patient City" AS "Pt_City", "Patient State" AS "Pt_ST", "Patient Zip" AS "Pt_Zip",
    NULL::VARCHAR AS "Pt_County", "Specimen ID / Accession Number" AS "Accession_Number",
    "Ordering Facility" AS "Ordering_Facility", "Ordering Facility Address" AS "Ordering_Facility_Address",
    "Ordering Facility City" AS "Ordering_Facility_City", "Ordering Facility State" AS "Ordering_Facility_State",
    "Ordering Facility Zip" AS "Ordering_Facility_Zip", "Provider Last Name" AS "Ordering_Provider_Last_Name",
    "Provider First Name" AS "Ordering_Provider_First_Name", "Provider NPI" AS "Ordering_Provider_NPI",
    "Provider Address" AS "Ordering_Provider_Street_Address", "Provider City" AS "Ordering_Provider_City",
    "Provider State" AS "Ordering_Provider_State", "Provider Zip" AS "Ordering_Provider_Zip",
    "Specimen ID / Accession Number" AS "Specimen_ID", "Specimen Type" AS "Specimen_Type",
    substr("Collection Date and Time", 1, 10) AS "Date_Test_Ordered",
    substr("Collection Date and Time", 1, 10) AS "Date_Specimen_Collected", NULL::VARCHAR AS "Medical_Record_Number",
    "U" AS "Employed_in_healthcare", "U" AS "Symptomatic_per_cdc", NULL::VARCHAR AS "Date_of_Symptom_Onset",
    "U" AS "Hospitalized", "U" AS "ICU", "U" AS "Resident_in_Congregate_Care", "U" AS "Pregnant"
"""


@query(
    f"""
    WITH {EXPORT_SQL}, done AS ({FINISHED_SQL} FROM export)
    SELECT report_id, {TX_SQL}, {RACE_SQL} AS "Pt_Race",
           CASE WHEN {RACE_SQL} = 'U' THEN 'U' ELSE 'NH' END AS "Pt_Ethnicity",
           {_phone("Patient Phone", PHONE_DASHES)} AS "Pt_Phone", {_phone("Provider Phone", PHONE_DASHES)} AS "Ordering_Provider_Phone"
    FROM done
    """,
    *EXPORT_TABLES,
)
def template_select_tx(t):
    """Every export row in the TX form."""
    return _in_form(t, "TX")


OK_SQL = """
    "Patient ID" AS "Patient_ID", "Sending Application" AS "Patient_ID_assigner", "Patient Last Name" AS "Patient_last_name",
    "Patient First Name" AS "Patient_first_name", strftime("Patient Date of Birth", '%m/%d/%Y') AS "Patient_DOB",
    "Patient Age" AS "Patient_age", "Patient Sex" AS "Patient_gender", "Patient Street Address" AS "Patient_street",
    "Patient City" AS "Patient_city", "Patient State" AS "Patient_state", "Patient Zip" AS "Patient_zip_code",
    "Provider Last Name" AS "Ordering_provider_last_name", "Provider First Name" AS "Ordering_provider_first_name",
    "Provider Address" AS "Ordering_provider_street", "Provider City" AS "Ordering_provider_city",
    "Provider State" AS "Ordering_provider_state", "Provider Zip" AS "Ordering_provider_zip_code",
    "Ordering Facility" AS "Ordering_facility_name", "Ordering Facility Address" AS "Ordering_facility_street",
    "Ordering Facility City" AS "Ordering_facility_city", "Ordering Facility State" AS "Ordering_facility_state",
    "Ordering Facility Zip" AS "Ordering_facility_zip_code", "LOINC Description" AS "Ordered_test_description",
    substr("Collection Date and Time", 1, 10) AS "Order_test_date",
    "Collection Date and Time" AS "Specimen_collection_date_time", "Specimen Type" AS "Specimen_type_description",
    "Specimen Source/Site" AS "Specimen_source_site_descrip", "Specimen ID / Accession Number" AS "Submitter_unique_sample_ID",
    "Result Date and Time" AS "Specimen_received_date_time", "Specimen ID / Accession Number" AS "Testing_lab_specimen_ID",
    "Specimen ID / Accession Number" AS "Testing_lab_accession_number", substr("Result Date and Time", 1, 10) AS "Test_date",
    substr("Result Date and Time", 1, 10) AS "Date_result_released", "LOINC Code" AS "Ordered_test_code",
    "L" AS "Ordered_test_code_system", "Provider NPI" AS "Ordering_provider_ID", "LOINC Code" AS "Specimen_type_code",
    "L" AS "Specimen_type_code_system", "LOINC Code" AS "Test_result_coded", "L" AS "Test_result_code_system",
    "LOINC Code" AS "Test_performed_code", "L" AS "Test_performed_code_system", 'Patient Internal' AS "Patient_ID_type",
    "Lab Name" AS "Testing_lab_name", "Lab CLIA" AS "Testing_lab_ID", "Lab Address" AS "Testing_lab_street",
    "Lab City" AS "Testing_lab_city", "Lab State" AS "Testing_lab_state", "Lab Zip" AS "Testing_lab_zip_code",
    "Lab CLIA" AS "Reporting_facility_ID", "Lab Name" AS "Reporting_facility_name",
    "Sending Application" AS "Report_facil_data_source_app", '02/01/2024' AS "File_created_date",
    'V2024-02-01_Results' AS "flatfile_version_no", NULL::VARCHAR AS "Patient_county"
"""
OK_EMPTY = """
Patient_ID_2 Patient_ID_2_assigner Patient_middle_name Patient_suffix Patient_age_units Patient_street2 Pregnant First_test
Employed_in_healthcare Symptomatic_for_disease Illness_onset_date Hospitalized ICU Ordering_provider_street2
Ordering_provider_county Ordering_facility_street_2 Ordering_facility_county Specimen_type_free_text Test_performed_number
Test_performed_description Test_Result_free_text Test_result_description Test_result_comparator Test_result_number
Test_result_number_separator Test_result_number2 Test_result_units Reference_range Abnormal_flag Test_result_status Comments
Employed_in_high_risk_setting Patient_occupation Disease_symptoms Patient_location Resident_congregate_setting
Patient_residency_type Patient_death_date Patient_died Public_health_case_ID Travel_history Test_kit_EUA_ID
Test_kit_instance_ID Test_kit_model_ID Test_kit_model_name Instrument_instance_ID Instrument_model_ID Instrument_model_name
Order_result_status Link_test_to_parent_result Link_test_to_parent_accession Specimen_source_site_code
Specimen_source_site_code_sys Test_method_description Result_format Test_result_sub_ID Submitter_sample_ID_assigner
Patient_ID_2_type Testing_lab_street2 Testing_lab_county
""".split()


@query(
    f"""
    WITH {EXPORT_SQL}, done AS ({FINISHED_SQL} FROM export)
    SELECT report_id, {OK_SQL}, {", ".join(f'NULL::VARCHAR AS "{c}"' for c in OK_EMPTY)}, {RACE_SQL} AS "Patient_race",
           CASE WHEN {RACE_SQL} = 'U' THEN 'U' ELSE 'NH' END AS "Patient_ethnicity",
           {_phone("Patient Phone", PHONE_DASHES)} AS "Patient_phone_number",
           {_phone("Provider Phone", PHONE_DASHES)} AS "Ordering_provider_phone",
           {_phone("Ordering Facility Phone", PHONE_DASHES)} AS "Ordering_facility_phone_number"
    FROM done
    """,
    *EXPORT_TABLES,
)
def template_select_ok(t):
    """Every export row in the OK form."""
    return _in_form(t, "OK")


@query(
    f"""
    WITH {EXPORT_SQL}
    SELECT e.report_id, h2.state AS file_state, e."Patient State", e."Specimen ID / Accession Number"
    FROM export e JOIN (SELECT DISTINCT patient_user_id, state FROM homes) h2 ON h2.patient_user_id = e."Patient ID"
    """,
    *EXPORT_TABLES,
)
def state_export_all_locations(t):
    """The variant that sends all addresses of a patient to every region where the patient has one."""
    rows = export_plan.export_rows(t.export_tables, LAB, root=ROOT, as_of=standins.AS_OF, all_locations=True)
    return rows.select("report_id", "file_state", "Patient State", "Specimen ID / Accession Number")


@query(
    """
    WITH counted AS (SELECT state, count(*) AS n FROM homes GROUP BY 1)
    SELECT state, CASE state WHEN 'NATION_2' THEN 'Sample Laboratory_20240201.csv' WHEN 'NATION_3' THEN 'SampleLaboratory_20240201_1.csv'
                             ELSE state || '_2024_02_01.csv' END AS file, n
    FROM counted WHERE state NOT IN (SELECT n_name FROM nation WHERE n_regionkey = 4)
    """,
    "homes",
)
def undelivered_files(t):
    """Files of the day that the delivery log does not hold; two recipients want names of their own."""
    names = FileNames({"NATION_2": "Sample Laboratory_{day}.csv", "NATION_3": "SampleLaboratory_{day}_1.csv"})
    day = dt.date(2024, 2, 1)
    homes = t.locations.where(F.col("patient_user_id").isNotNull()).withColumnRenamed("state", "file_state")
    manifest = writers.delivery_manifest(homes.groupBy("file_state").agg(F.count(F.lit(1)).alias("n")), names, day)
    sent = t.raw("nation").where(F.col("n_regionkey") == 4).select(
        F.col("n_name").alias("state"), F.lit(day).alias("day"), F.concat("n_name", F.lit("_2024_02_01.csv")).alias("file")
    )
    return writers.undelivered(manifest, sent).select("state", "file", "n")


@query("SELECT count(*) AS n, count(DISTINCT report_id) AS reports FROM (SELECT id AS report_id FROM reports)", "reports")
def sql_query_scan(t):
    """A report written in SQL over named DataFrames."""
    return readers.query(
        t.spark, "SELECT count(*) AS n, count(DISTINCT id) AS reports FROM {reports}", {"reports": t.reports}
    )


@query(
    """
    SELECT DISTINCT patient_user_id, status FROM reports WHERE status IN ('approved', 'sent')
    """,
    "reports",
)
def distinct_rows(t):
    rows = t.reports.where(F.col("status").isin("approved", "sent")).select("patient_user_id", "status")
    return dedup.whole_rows(rows)
