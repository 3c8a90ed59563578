"""Public-health export: eligible reports, the 64-column export row, post-processing and the manifest.

One job covers every region: the region is a column, not a query parameter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import LabIdentity
from labtide.functions import codes, text, time
from labtide.operators import dedup, matching


@dataclass(frozen=True)
class ExportTables:
    """Source tables of the export."""

    reports: DataFrame
    distributors: DataFrame
    clinics: DataFrame
    locations: DataFrame
    report_types: DataFrame
    samples: DataFrame
    sample_data_sources: DataFrame
    patient_users: DataFrame
    ethnicities: DataFrame
    ethnicities_patient_users: DataFrame
    practitioners: DataFrame


def eligible_reports(
    t: ExportTables,
    *,
    root: int,
    start=None,
    end=None,
    report_type_ids: Sequence[int] | None = None,
    tz: str = time.EST,
) -> DataFrame:
    """Sent reports of a distributor and its direct children, in the window and in an exportable status."""
    keep = F.col("status").isin(*codes.REPORT_STATUSES) & F.col("sent_date").isNotNull()
    keep = keep & time.in_window("sent_date", start, end, tz=tz, closed=True)
    if report_type_ids is not None:
        keep = keep & F.col("report_type_id").isin(*report_type_ids)
    family = matching.family(t.distributors, root).withColumnRenamed("id", "__root")
    return matching.present(t.reports.where(keep), family, {"cached_distributor_id": "__root"})


def due(reports: DataFrame, waiting: DataFrame, start: Column, end: Column) -> DataFrame:
    """Reports sent from ``start`` on and before ``end``, and those of ``waiting`` (report_id) that were sent before.

    The window reaches the scan as it is; waiting reports are found by their ids, and are few.
    """
    sent = F.col("sent_date")
    older = matching.present(reports.where(sent < start), waiting.select(F.col("report_id").alias("waiting_id")), {"id": "waiting_id"})
    return reports.where((sent >= start) & (sent < end)).unionAll(older)


def usable_samples(t: ExportTables) -> DataFrame:
    """Samples of an exported collection type with at least one usable data source."""
    sources = t.sample_data_sources.where(F.col("status").isin(*codes.SPECIMEN_STATUSES)).select("sample_id")
    samples = t.samples.where(F.col("collection_type").isin(*codes.COLLECTION_TYPES))
    return matching.present(samples, sources, {"id": "sample_id"})


def provider_addresses(t: ExportTables) -> DataFrame:
    """One address block per clinic: its main location, else its lowest location id."""
    own = t.locations.where(F.col("clinic_id").isNotNull())
    lowest = own.groupBy(F.col("clinic_id").alias("provider_clinic_id")).agg(F.min("id").alias("lowest_id"))
    chosen = t.clinics.select(
        F.col("id").alias("provider_clinic_id"), "main_location_id", F.col("phone").alias("provider_phone")
    ).join(lowest, "provider_clinic_id", "left")
    places = t.locations.select(
        F.col("id").alias("location_id"),
        _address("address_1", "address_2").alias("provider_address"),
        F.col("city").alias("provider_city"),
        F.col("state").alias("provider_state"),
        F.col("zip").alias("provider_zip"),
    )
    return (
        chosen.withColumn("location_id", F.coalesce("main_location_id", "lowest_id"))
        .join(places, "location_id")
        .drop("location_id", "main_location_id", "lowest_id")
    )


def patient_addresses(locations: DataFrame, *, all_locations: bool = False) -> DataFrame:
    """Distinct patient addresses with the region whose file they go to.

    By default an address goes to its own region's file; ``all_locations`` sends all addresses of a patient to every
    region where the patient has one.
    """
    own = locations.where(F.col("patient_user_id").isNotNull() & F.col("state").isNotNull())
    rows = own.select("patient_user_id", "address_1", "address_2", "city", "state", "zip", "country").distinct()
    if not all_locations:
        return rows.withColumn("file_state", F.col("state"))
    files = own.select("patient_user_id", F.col("state").alias("file_state")).distinct()
    everywhere = locations.where(F.col("patient_user_id").isNotNull())
    rows = everywhere.select("patient_user_id", "address_1", "address_2", "city", "state", "zip", "country").distinct()
    return rows.join(files, "patient_user_id")


def race_lists(t: ExportTables) -> DataFrame:
    """Distinct ethnicity names per patient, sorted and joined by commas; the set is bounded by the name table."""
    named = t.ethnicities_patient_users.join(
        t.ethnicities.select(F.col("id").alias("ethnicity_id"), "name"), "ethnicity_id", "left"
    )
    names = F.sort_array(F.collect_set(F.coalesce("name", F.lit(" "))))
    return named.groupBy("patient_user_id").agg(F.array_join(names, ",").alias("races"))


def _address(first: str, second: str) -> Column:
    return text.full_name(first, second)


def _first_part(c: str) -> Column:
    return text.before(c, ",")


def export_rows(
    t: ExportTables,
    lab: LabIdentity,
    *,
    root: int,
    as_of,
    start=None,
    end=None,
    report_type_ids: Sequence[int] | None = None,
    all_locations: bool = False,
    tz: str = time.EST,
) -> DataFrame:
    """The export: ``report_id``, ``file_state`` and 64 named columns, one row per report, address and specimen."""
    reports = eligible_reports(
        t, root=root, start=start, end=end, report_type_ids=report_type_ids, tz=tz
    ).select(
        F.col("id").alias("report_id"),
        "patient_user_id",
        "kit_id",
        "clinic_id",
        "provider_clinic_id",
        "cached_distributor_id",
        "report_type_id",
        "result",
        "sent_date",
    )
    specimens = usable_samples(t).select("kit_id", "barcode", "collection_date", "collection_type").distinct()
    addresses = patient_addresses(t.locations, all_locations=all_locations)
    patients = t.patient_users.select(
        F.col("id").alias("patient_user_id"),
        F.col("first_name").alias("patient_first"),
        F.col("last_name").alias("patient_last"),
        "birth_date",
        "gender",
        F.col("phone").alias("patient_phone"),
        "practitioner_id",
    )
    practitioners = t.practitioners.select(
        F.col("id").alias("practitioner_id"),
        F.col("first_name").alias("provider_first"),
        F.col("last_name").alias("provider_last"),
        "title",
        "npi",
    )
    # Everything about a patient is joined before the reports come in: one exchange of the reports per key, and AQE can
    # split a patient who holds a large share of them.
    patient = (
        patients.join(race_lists(t), "patient_user_id", "left")
        .join(addresses, "patient_user_id")
        .join(practitioners, "practitioner_id", "left")
    )
    clinics = t.clinics.select(
        F.col("id").alias("clinic_id"), F.col("name").alias("clinic_name"), F.col("phone").alias("clinic_phone")
    )
    joined = (
        reports.join(specimens, "kit_id")
        .join(patient, "patient_user_id")
        .join(clinics, "clinic_id")
        .join(provider_addresses(t), "provider_clinic_id", "left")
        .join(
            t.distributors.select(F.col("id").alias("cached_distributor_id"), "clia_number"), "cached_distributor_id"
        )
        .join(t.report_types.select(F.col("id").alias("report_type_id"), F.col("name").alias("test_name")), "report_type_id")
    )
    return joined.select("report_id", "file_state", *[c.alias(n) for n, c in _output(lab, as_of).items()])


def _output(lab: LabIdentity, as_of) -> dict[str, Column]:
    now = time.ntz(as_of)
    none = F.lit(None).cast("string")
    no_address = F.col("provider_address").isNull() | (F.col("provider_address") == " ")

    def place(ours: str, theirs: str) -> Column:
        return F.when(no_address, F.lit(ours)).otherwise(F.col(theirs))

    clinic_phone, provider_phone = _first_part("clinic_phone"), _first_part("provider_phone")
    facility_phone = F.coalesce(clinic_phone, provider_phone, F.lit(lab.phone))
    office_phone = F.coalesce(provider_phone, clinic_phone, F.lit(lab.phone))
    # The provider's phone is the one fallback that keeps its text after the comma.
    home_phone = F.coalesce(_first_part("patient_phone"), F.col("provider_phone"), clinic_phone, F.lit(lab.phone))
    address = place(lab.address, "provider_address")
    city, state, zip_ = (
        place(lab.city, "provider_city"),
        place(lab.state, "provider_state"),
        place(lab.zip, "provider_zip"),
    )
    return {
        "Sending Application": F.lit(lab.application),
        "Sending Application ID": none,
        "Message Date and Time": now,
        "Receiving Application": none,
        "Lab Name": F.lit(lab.name),
        "Lab CLIA": F.coalesce("clia_number", F.lit(lab.clia)),
        "Lab Address": F.lit(lab.address),
        "Lab City": F.lit(lab.city),
        "Lab State": F.lit(lab.state),
        "Lab Zip": F.lit(lab.zip),
        "Lab Phone": F.lit(lab.phone),
        "Test Code": F.col("report_type_id"),
        "Test Name": F.col("test_name"),
        "LOINC Code": codes.lookup("collection_type", codes.LOINC_CODE),
        "LOINC Description": codes.lookup("collection_type", codes.LOINC_TEXT),
        "Test Instrument": F.lit(lab.instrument),
        "Result": F.col("result"),
        "Result Status Code (NYS)": none,
        "Result Date and Time": F.col("sent_date"),
        "Patient ID": F.col("patient_user_id"),
        "Patient First Name": F.col("patient_first"),
        "Patient Last Name": F.col("patient_last"),
        "Patient Date of Birth": F.col("birth_date"),
        "Patient Sex": codes.sex_code("gender"),
        "Patient Race": F.coalesce("races", F.lit(" ")),
        "Patient Ethnicity": none,
        "Patient Street Address": _address("address_1", "address_2"),
        "Patient City": F.col("city"),
        "Patient State": F.col("state"),
        "Patient Zip": F.col("zip"),
        "Patient County": none,
        "Patient Country": codes.country_name("country"),
        "Patient Phone": home_phone,
        "Ordering Facility": text.before("clinic_name", "/"),
        "Ordering Facility Address": address,
        "Ordering Facility City": city,
        "Ordering Facility State": state,
        "Ordering Facility Zip": zip_,
        "Ordering Facility Phone": facility_phone,
        "Provider First Name": F.col("provider_first"),
        "Provider Last Name": F.col("provider_last"),
        "Provider Name Suffix": F.col("title"),
        "Provider Address": address,
        "Provider City": city,
        "Provider State": state,
        "Provider Zip": zip_,
        "Provider Phone": office_phone,
        "Provider NPI": F.col("npi"),
        "Specimen ID / Accession Number": F.col("barcode"),
        "Collection Date and Time": F.col("collection_date"),
        "Specimen Type": F.col("collection_type"),
        "Specimen Source/Site": codes.lookup("collection_type", codes.SPECIMEN_SITE),
        "Notes": none,
        "Previous Test Exists (Y/N)": none,
        "Healthcare Worker (Y/N)": none,
        "Symptom Onset Date": none,
        "Hospitalized (Y/N)": none,
        "Congregate Care Resident (Y/N)": none,
        "Pregnant (Y/N)": none,
        "Patient Age": time.age_years("birth_date", now),
        "L": F.lit("L"),
        "U": F.lit("U"),
        "UNK": F.lit("UNK"),
        "NULLCOLUMN": none,
    }


def finish(export: DataFrame, *, mode: str = "", limit_per_state: int | None = None, tz: str = time.EST) -> DataFrame:
    """Local ``MM/dd/yyyy HH:mm`` times, first race only, positive/negative mode and the test-run row limit."""
    rows = time.localize(export, time.MINUTE_FORMAT, tz=tz).withColumn("Patient Race", text.before("Patient Race", ","))
    rows = matching.result_mode(rows, mode)
    if limit_per_state is not None:
        order = [F.col("report_id"), F.col("`Specimen ID / Accession Number`"), F.col("`Patient Street Address`")]
        rows = dedup.top_per_key(rows, ["file_state"], order, limit_per_state)
    return rows


def manifest(states: DataFrame, export: DataFrame, key: str = "file_state") -> DataFrame:
    """Rows per region, zero included, with the run's notification text."""
    counted = matching.count_all(states, export, key)
    told = F.when(F.col("n") > 0, F.concat(F.col("n").cast("string"), F.lit(" reports exported from "), F.col(key)))
    return counted.withColumn("message", told.otherwise(F.concat(F.lit("No reports from "), F.col(key))))
