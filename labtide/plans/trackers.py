"""Shipment trackers as a flat table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.functions import nested, time

# Landed tracker JSON.
SCHEMA = """
id string, carrier string, status string, status_detail string, created_at string, est_delivery_date string,
public_url string, signed_by string, tracking_code string, updated_at string, weight double,
carrier_detail struct<origin_location: string, destination_location: string, initial_delivery_attempt: string>,
tracking_details array<struct<datetime: string, tracking_location: struct<city: string, state: string>>>
"""

# Raw tracker columns, in output order, and the names four of them take.
COLUMNS = [
    "id", "carrier", "status", "status_detail", "created_at", "est_delivery_date", "destination", "origin",
    "delivery_datetime", "delivery_date", "initial_delivery_attempt", "public_url", "signed_by", "tracking_code",
    "updated_at", "picked_up_city", "picked_up_state", "weight",
]
RENAMED = {
    "id": "easypost_id",
    "status": "tracking_status",
    "status_detail": "tracking_status_detail",
    "tracking_code": "tracking_number",
}


def derive(trackers: DataFrame) -> DataFrame:
    """Origin, pickup and delivery of each tracker, from its own carrier detail and tracking steps.

    ``delivery_datetime`` is the time of the last step whatever the status; ``delivery_date`` only counts once delivered.
    """
    first, last = nested.first_of("tracking_details"), nested.last_of("tracking_details")
    steps_end = last.getField("datetime")
    delivered = F.coalesce(F.col("status") == "delivered", F.lit(False))
    return trackers.withColumns(
        {
            "origin": F.col("carrier_detail.origin_location"),
            "destination": F.col("carrier_detail.destination_location"),
            "initial_delivery_attempt": F.col("carrier_detail.initial_delivery_attempt"),
            "picked_up_city": first.getField("tracking_location").getField("city"),
            "picked_up_state": first.getField("tracking_location").getField("state"),
            "delivered": delivered,
            "delivery_datetime": time.parse_iso_z(steps_end),
            "delivery_date": F.when(delivered, steps_end),
        }
    )


def normalise(trackers: DataFrame, *, full_load: bool = False) -> DataFrame:
    """The 18 published columns for usable tracking numbers; a full load keeps return shipments (leading 8) only."""
    table = derive(trackers).select(*[F.col(c).alias(RENAMED.get(c, c)) for c in COLUMNS])
    number = F.col("tracking_number")
    keep = (
        F.col("origin").isNotNull()
        & number.isNotNull()
        & ~F.startswith(number, F.lit("`"))
        & (F.length(number) < 17)
        & (number != "N/A")
    )
    if full_load:
        keep = keep & F.startswith(number, F.lit("8"))
    return table.where(keep).withColumn("tracking_number", number.try_cast("bigint"))
