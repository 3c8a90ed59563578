"""Event funnel per day and time in stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import EVENT_CATEGORIES
from labtide.functions import text, time
from labtide.operators import reshape, sequence

FIRST_TIMES = "first_times"
RECEIVED = "Received"


def first_events(
    event_logs: DataFrame, categories: Sequence[tuple[str, str]] = EVENT_CATEGORIES, *, tz: str = time.EST
) -> DataFrame:
    """First local time of every (report, category); events outside the categories are dropped.

    Only the minimum is needed, so this is a plain hash aggregate that shrinks each report before the exchange. The
    uncategorised rest, one group per report, is dropped after it: a filter before it would match every term twice.
    """
    return (
        event_logs.select("report_id", _category(categories).alias("category"), time.to_local("created_at", tz).alias("event_at"))
        .groupBy("report_id", "category")
        .agg(F.min("event_at").alias("event_at"), F.count("category").alias("categorised"))
        .where(F.col("categorised") > 0)
        .drop("categorised")
    )


def by_day(events: DataFrame, day: str, categories: Sequence[tuple[str, str]] = EVENT_CATEGORIES) -> DataFrame:
    """Days by categories with counts; a category that did not occur on a day is null."""
    return reshape.pivot_count(events, [day], "category", [label for _, label in categories])


def event_days(events: DataFrame) -> DataFrame:
    return events.withColumn("event_day", time.day_text("event_at"))


def _category(categories: Sequence[tuple[str, str]]) -> Column:
    return text.last_match("event_type", categories)


def first_time_columns(categories: Sequence[tuple[str, str]], tz: str) -> list[Column]:
    """First local time per category, as aggregates over a log that has a ``category`` column."""
    at = time.to_local("created_at", tz)
    return [F.min(F.when(F.col("category") == label, at)).alias(label) for _, label in categories]


def report_events(
    event_logs: DataFrame,
    flag: Column,
    name: str,
    categories: Sequence[tuple[str, str]] = EVENT_CATEGORIES,
    *,
    tz: str = time.EST,
) -> DataFrame:
    """One row per report from one pass over the log: did any event meet ``flag``, and the first time of every category.

    The first times travel as one struct, ``first_times``.
    """
    tagged = event_logs.withColumn("category", _category(categories))
    firsts = first_time_columns(categories, tz)
    seen = F.max(F.coalesce(flag, F.lit(False))).alias(name)
    rows = tagged.groupBy("report_id").agg(seen, *firsts)
    labels = [F.col(f"`{label}`") for _, label in categories]
    return rows.select("report_id", name, F.struct(*labels).alias(FIRST_TIMES))


def funnel(
    facts: DataFrame,
    *,
    day: str = "event_day",
    term: str = "COVID",
    categories: Sequence[tuple[str, str]] = EVENT_CATEGORIES,
) -> DataFrame:
    """Daily categories, by ``event_day`` or the report's ``start_day``, beside the reports received that day.

    A report's row carries its first times and its receive day, so both counts come from a single pass over the facts.
    Days without a received report, and days with nothing but received reports, are left out.
    """
    labels = [label for _, label in categories]
    tested = facts.where(text.contains("test", term)).select("start_day", "receive_day", FIRST_TIMES)

    def cell(on: Column, label: str) -> Column:
        return F.struct(on.alias("day"), F.lit(label).alias("category"))

    cells = [cell(F.col("receive_day"), RECEIVED)]
    for label in labels:
        first = F.col(FIRST_TIMES)[label]
        on = time.day_text(first) if day == "event_day" else F.when(first.isNotNull(), F.col(day))
        cells.append(cell(on, label))
    long = tested.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*").where(F.col("day").isNotNull())
    wide = reshape.pivot_count(long, ["day"], "category", [*labels, RECEIVED])
    some_event = F.coalesce(*[F.col(f"`{label}`") for label in labels]).isNotNull()
    return wide.where(F.col(RECEIVED).isNotNull() & some_event).withColumnRenamed("day", "receive_day")


def time_in_stage(event_logs: DataFrame, *, hot_rows: int | None = sequence.HOT_ROWS) -> DataFrame:
    """Microseconds until the next event of the same report; null after the last."""
    rows = event_logs.select("id", "report_id", "event_type", "created_at")
    ahead = sequence.neighbour(rows, "report_id", "created_at", "id", ["created_at"], hot_rows=hot_rows)
    return ahead.withColumn("micros_in_stage", time.micros_between("created_at", "next_created_at"))
