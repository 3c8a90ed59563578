"""Parameters of the reports. Values about people and places are supplied by the caller, not kept in code."""

from __future__ import annotations

from dataclasses import dataclass, field

# Event-name terms and the chart category they stand for. A later match wins over an earlier one.
EVENT_CATEGORIES = [
    ("report_sent", "Sent"),
    ("review", "Review"),
    ("_approved", "Approved"),
    ("linked", "Accessioned"),
    ("result_updated", "Result Updated"),
    ("generated", "Report Generated"),
    ("report_requested", "Report Requested"),
    ("cancelled", "Cancelled"),
    ("rolled", "Rolled Back to Awaiting Results"),
]

# Event groups of the weekly matrix.
EVENT_GROUPS = {
    "Reviews": ["kit_data_review_complete"],
    "Entries": ["kit_accessioning_complete"],
    "Scans Assigned to Kit": ["scan_assigned_to_kit"],
    "Accessioned": ["kit_received"],
    "Sent": ["report_sent", "report_sent_to_patient"],
    "Samples QC Approved": ["sample_qc_approved"],
    "Reports Approved": ["report_approved", "report_electronically_signed_and_approved"],
    "Ticket Created": ["ticket_created"],
    "Ticket Event Recorded": ["ticket_event_recorded"],
    "Ticket Closed": ["ticket_closed"],
    "Curation Assignments Completed": ["curation_assignment_completed"],
    "Plates Created": ["plate_created"],
    "Curation Created": ["curation_filter_created"],
    "Scans Created": ["scan_created"],
}
ACCESSIONING_GROUPS = ["Accessioned", "Scans Created"]
DATA_ENTRY_GROUPS = ["Reviews", "Entries", "Scans Assigned to Kit"]

# Ticket categories that count as missing information.
TICKET_CATEGORIES = [
    "Critical Missing Information",
    "Missing Information",
    "Redraw",
    "Other Error",
    "Medical Records",
]

# Event names the reports look for.
REDRAW_EVENT = "report_marked_redraw"
FIRST_LINK_EVENT = "first_sample_data_source_linked_to_report"
MARKED_EVENT = "report_marked_state_reported"

# Weekly activity metrics that are read from single event types.
ACTIVITY_EVENTS = {
    "entries": "kit_accessioning_complete",
    "reviews": "kit_data_review_complete",
    "scans_assigned_to_kits": "scan_assigned_to_kit",
}

# Columns published by the turnaround and the positives dashboards.
TURNAROUND_COLUMNS = [
    "id", "delivery_datetime", "collection_date", "sample_received_at", "receive_day", "sent_day", "start_time",
    "sent_time", "weekday", "TAT", "goal", "goal_missed", "expedited", "result", "clinic", "distributor", "redraw",
    "timedelta", "test", "tracking_number", "start_date_type", "positive", "month", "public_url", "picked_up_city",
    "picked_up_state",
]
POSITIVE_COLUMNS = [
    "id", "receive_day", "sent_day", "expedited", "result", "redraw", "test", "weekday", "distributor", "positive",
    "clinic",
]


@dataclass(frozen=True)
class LabIdentity:
    """The sending laboratory, as printed on every exported row and used where an address or phone is missing."""

    application: str
    name: str
    clia: str
    address: str
    city: str
    state: str
    zip: str
    phone: str
    instrument: str


@dataclass(frozen=True)
class Dialect:
    """Output form of one region's file."""

    sep: str = ","
    header: bool = True
    required: tuple[str, ...] = ()


# Regions whose file differs from comma-separated text with a header.
DIALECTS = {
    "NY": Dialect(sep="|", header=False),
    "IL": Dialect(sep="~"),
    "PA": Dialect(header=False),
    "AR": Dialect(required=("Patient First Name",)),
}

# Regions that take compact dates, unseparated phones, and phones split from their area code.
COMPACT_DATE_REGIONS = ["PA", "OH", "AZ", "NJ", "NM"]
PLAIN_PHONE_REGIONS = ["PA", "OH"]
SPLIT_PHONE_REGIONS = ["KS", "MO"]


@dataclass(frozen=True)
class FileNames:
    """Recipient-specific file names; ``{day}`` is yyyyMMdd."""

    by_region: dict[str, str] = field(default_factory=dict)
    default: str = "{region}_{date}.csv"
