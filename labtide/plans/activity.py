"""Activity metrics: counts per day and user, and mean time per day.

Rows are reduced to (day, user) before any name is joined, and to (kit, day, user) before kits are joined, so neither a
busy user nor a busy kit puts its rows into one task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import ACTIVITY_EVENTS, FIRST_LINK_EVENT, TICKET_CATEGORIES
from labtide.functions import text, time
from labtide.operators import dedup, sequence

MICROS = 1_000_000


def staff_names(staff: DataFrame, key: str = "user_id") -> DataFrame:
    return staff.select(F.col(key).alias("actor"), text.full_name("first_name", "last_name").alias("fullname"))


def _daily(log: DataFrame, ts: str, by: Sequence[str], tz: str) -> DataFrame:
    local = log.withColumn("__at", time.to_local(ts, tz))
    sec, frac = time.day_parts("__at")
    return local.groupBy(*by, F.col("__at").cast("date").alias("day")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(sec).alias("sec"), F.sum(frac).alias("frac")
    )


def _named(pre: DataFrame, names: DataFrame, how: str, by: Sequence[str]) -> DataFrame:
    joined = pre.join(names, "actor", how)
    return joined.groupBy(*by, "day", "fullname").agg(
        F.sum("n").alias("n"), F.sum("sec").alias("sec"), F.sum("frac").alias("frac")
    )


def time_of_day(
    log: DataFrame,
    staff: DataFrame,
    *,
    ts: str = "created_at",
    actor: str = "user_id",
    staff_key: str = "user_id",
    how: str = "inner",
    by: Sequence[str] = (),
    tz: str = time.EST,
) -> DataFrame:
    """Per (day, user): rows and summed time of day. With ``how="left"`` rows of unknown users have the name " "."""
    pre = _daily(log.withColumn("actor", F.col(actor)), ts, [*by, "actor"], tz)
    out = _named(pre, staff_names(staff, staff_key), how, by)
    return out.withColumn("fullname", F.coalesce("fullname", F.lit(" "))) if how == "left" else out


def since_received(
    log: DataFrame,
    kits: DataFrame,
    staff: DataFrame,
    *,
    ts: str = "created_at",
    actor: str = "user_id",
    how: str = "inner",
    by: Sequence[str] = (),
    tz: str = time.EST,
) -> DataFrame:
    """Per (day, user): rows and summed time since the kit was received.

    With ``how="left"`` rows of unknown users have the name " ", as the kit-review times want it. The sum over a kit is ``n * (midnight - received) + sum(time of day)``, which needs only the reduced rows.
    """
    pre = _daily(log.withColumn("actor", F.col(actor)), ts, [*by, "actor", "kit_id"], tz)
    arrived = kits.where(F.col("received_at").isNotNull()).select(
        F.col("id").alias("kit_id"), time.to_local("received_at", tz).alias("received")
    )
    gap = time.micros_between("received", F.col("day").cast("timestamp_ntz"))
    summed = (
        pre.join(arrived, "kit_id")
        .withColumns(
            {
                "sec": F.col("sec") + F.col("n") * time.floor_div(gap, MICROS),
                "frac": F.col("frac") + F.col("n") * F.pmod(gap, F.lit(MICROS)),
            }
        )
        .groupBy(*by, "day", "actor")
        .agg(F.sum("n").alias("n"), F.sum("sec").alias("sec"), F.sum("frac").alias("frac"))
    )
    out = _named(summed, staff_names(staff), how, by)
    return out.withColumn("fullname", F.coalesce("fullname", F.lit(" "))) if how == "left" else out


def by_user(activity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return activity.select(*by, "day", "fullname", "n")


def by_day(activity: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Per day: rows and the mean time in seconds."""
    sums = activity.groupBy(*by, "day").agg(
        F.sum("n").alias("n"), F.sum("sec").alias("sec"), F.sum("frac").alias("frac")
    )
    return sums.select(*by, "day", "n", time.mean_seconds(F.col("sec"), F.col("frac"), F.col("n")).alias("mean_seconds"))


def event_metrics(
    event_logs: DataFrame,
    kits: DataFrame,
    staff: DataFrame,
    metrics: Mapping[str, str] = ACTIVITY_EVENTS,
    *,
    start=None,
    end=None,
    tz: str = time.EST,
) -> DataFrame:
    """All metrics that are single event types, from one scan of the log."""
    metric = text.map_values("event_type", {v: k for k, v in metrics.items()})
    log = event_logs.where(F.col("event_type").isin(*metrics.values()) & time.in_window("created_at", start, end, tz=tz))
    return since_received(log.withColumn("metric", metric), kits, staff, by=["metric"], tz=tz)


def ticket_metric(
    tickets: DataFrame,
    staff: DataFrame,
    categories: Sequence[str] = TICKET_CATEGORIES,
    *,
    start=None,
    end=None,
    tz: str = time.EST,
) -> DataFrame:
    log = tickets.where(F.col("category").isin(*categories) & time.in_window("created_at", start, end, tz=tz))
    return time_of_day(log, staff, tz=tz)


def scan_metric(scans: DataFrame, staff: DataFrame, *, start=None, end=None, tz: str = time.EST) -> DataFrame:
    log = scans.where(F.col("file_name").isNotNull() & time.in_window("created_at", start, end, tz=tz))
    return time_of_day(log, staff, actor="distributor_user_id", staff_key="id", tz=tz)


def accession_metric(
    reports: DataFrame,
    event_logs: DataFrame,
    staff: DataFrame,
    *,
    event: str | Column = FIRST_LINK_EVENT,
    start=None,
    end=None,
    tz: str = time.EST,
    hot_rows: int | None = sequence.HOT_ROWS,
) -> DataFrame:
    """First linking event per report, credited to the user of the report's next event.

    A report's last event has no next one, and an unknown user has no name; both are left out, as are blank names. The
    next event may lie beyond ``end``: only the linking event is held to it.
    """
    started = reports.where(F.col("start_date").isNotNull()).select(F.col("id").alias("report_id"))
    # Every event goes through the window, so its name is left behind.
    log = event_logs.where(time.in_window("created_at", start, tz=tz)).select(
        "id", "report_id", "user_id", (F.col("event_type") == event).alias("links"), "created_at"
    )
    ahead = sequence.neighbour(log, "report_id", "created_at", "id", ["user_id"], hot_rows=hot_rows)
    linked = ahead.where(F.col("links") & F.col("next_user_id").isNotNull())
    linked = linked.where(time.in_window("created_at", end=end, tz=tz))
    named = staff_names(staff).where(F.trim("fullname") != "").select(F.col("actor").alias("next_user_id"))
    known = linked.join(named, "next_user_id", "left_semi")
    firsts = dedup.first_per_key(known, ["report_id"], ["created_at", "id"])
    credited = firsts.join(started, "report_id", "left_semi")
    return time_of_day(credited, staff, actor="next_user_id", tz=tz)


def next_event_check(event_logs: DataFrame, event: str = FIRST_LINK_EVENT, *, hot_rows=sequence.HOT_ROWS) -> DataFrame:
    """For each linking event: was the report's next, or previous, event within a minute of it?

    Times are cut to whole minutes first.
    """
    rows = event_logs.select("id", "report_id", "event_type", "created_at").withColumn(
        "minute", F.date_trunc("minute", "created_at").cast("timestamp_ntz")
    )
    both = sequence.neighbours(rows, "report_id", "created_at", "id", ["minute"], hot_rows=hot_rows)
    one = F.expr("interval 1 minute")
    return both.where(F.col("event_type") == event).select(
        "id",
        "report_id",
        "created_at",
        (F.col("minute") >= F.col("next_minute") - one).alias("nextmatch"),
        (F.col("minute") <= F.col("last_minute") + one).alias("lastmatch"),
    )
