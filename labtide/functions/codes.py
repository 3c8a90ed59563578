"""Code maps of the public-health export. Every table below is made of fixed values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from labtide.functions.time import col

# Laboratory codes by collection type.
LOINC_CODE = {"Saliva": "95425-5", "Swab": "94533-7"}
LOINC_TEXT = {
    "Saliva": "SARS-CoV-2 (COVID19) N gene [Presence] in Saliva (oral fluid) by NAA with probe detection",
    "Swab": "SARS-CoV-2 (COVID-19) N gene [Presence] in Respiratory specimen by NAA with probe detection",
}
SPECIMEN_SITE = {"Saliva": "Mouth", "Swab": "Nasopharynx"}
COLLECTION_TYPES = ["Saliva", "Swab"]

# Report and specimen statuses that may be exported.
REPORT_STATUSES = ["approved", "sent", "sent_to_patient", "consultation_pending"]
SPECIMEN_STATUSES = ["qc_pending", "qc_hold", "qc_approved", "vc_complete", "further_review"]

# Regions of the nationwide export.
REGIONS = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DC", "DE", "FL", "GA", "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA",
    "ME", "MD", "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ", "NM", "NY", "NC", "ND", "OH", "OK", "OR",
    "PA", "RI", "SC", "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]


def lookup(c: Column | str, table: dict[str, str]) -> Column:
    """CASE over a fixed table; unknown values give null."""
    chain = None
    for key, value in table.items():
        chain = (F if chain is None else chain).when(col(c) == key, F.lit(value))
    return chain


def sex_code(c: Column | str) -> Column:
    return F.when(col(c) == "male", "M").when(col(c) == "female", "F").otherwise("U")


def country_name(c: Column | str) -> Column:
    return F.when(col(c).isin("US", "USA"), F.lit("United States of America")).otherwise(col(c))
