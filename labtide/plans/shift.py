"""Weekly shift reports, event and ticket matrices and the delivery log.

Every report covers all weeks of its input at once, one row group per Monday; bounds on the input select one week. The
pivot columns are the seven weekdays, a fixed list, so empty days show without joining days to names.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import EVENT_GROUPS, TICKET_CATEGORIES
from labtide.functions import text, time
from labtide.operators import columns, reshape
from labtide.plans import activity
from labtide.session import scratch_dir
from labtide.sources import writers


def _weekly(df: DataFrame, day: str = "day") -> DataFrame:
    return df.withColumns({"week_start": time.week_start(day), "weekday": time.weekday_key(day)})


def spine_counts(log: DataFrame, ts: str = "created_at", *, tz: str = time.EST) -> DataFrame:
    """Rows per local day on the full calendar, zero on empty days."""
    counts = log.groupBy(time.to_local(ts, tz).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    spine = time.weeks_spanning(counts, "day")
    filled = spine.join(counts, "day", "left").na.fill(0, subset=["n"])
    return filled.withColumn("week_start", time.week_start("day"))


def user_grid(metrics: DataFrame, names: Sequence[str]) -> DataFrame:
    """Users by weekday and metric, from the long frame (metric, day, fullname, n); no activity is 0."""
    cells = _weekly(metrics).withColumn("cell", F.concat_ws("_", F.col("weekday"), F.col("metric")))
    wanted = [f"{d}_{m}" for d in time.WEEKDAYS for m in names]
    return reshape.pivot_sum(cells, ["week_start", "fullname"], "cell", wanted, "n")


def daily_table(daily: DataFrame, names: Sequence[str], *, week: dt.date | None = None) -> DataFrame:
    """Metrics by weekday, from the long frame (metric, day, n, mean_seconds).

    Counts are 0 on empty days; mean times are HH:MM:SS, or blank. ``week`` fixes the calendar to one week; otherwise it
    runs from the first to the last week with activity; the days are written to the scratch folder first, since they are
    read for the calendar and for its cells.
    """
    wide = daily.groupBy("day").pivot("metric", list(names)).agg(
        F.sum("n").alias("n"), F.max("mean_seconds").alias("mean")
    )
    if week is not None:
        spine = time.days_from(daily.sparkSession, week)
    else:
        wide = writers.kept(wide, scratch_dir(daily.sparkSession, "days"))
        spine = time.weeks_spanning(wide, "day")
    joined = _weekly(spine).join(wide, "day", "left").na.fill(0, subset=[f"{m}_n" for m in names])
    shown = joined.select(
        "week_start",
        "weekday",
        *[F.col(f"{m}_n").alias(m) for m in names],
        *[time.hms(F.col(f"{m}_mean")).alias(f"average_{m}_time") for m in names],
    )
    rows = [c for c in shown.columns if c not in ("week_start", "weekday")]
    return reshape.transpose(shown, ["week_start"], "weekday", time.WEEKDAYS, rows)


def event_matrix(
    event_logs: DataFrame,
    staff: DataFrame,
    groups: Mapping[str, Sequence[str]] = EVENT_GROUPS,
    *,
    start=None,
    end=None,
    tz: str = time.EST,
) -> DataFrame:
    """Per event group and week: users by weekday. All groups come from one scan; unknown users have the name " "."""
    types = {t: g for g, ts in groups.items() for t in ts}
    log = event_logs.where(F.col("event_type").isin(*types) & time.in_window("created_at", start, end, tz=tz))
    grouped = log.withColumn("event_group", text.map_values("event_type", types))
    counts = activity.time_of_day(grouped, staff, how="left", by=["event_group"], tz=tz)
    return reshape.pivot_sum(_weekly(counts), ["event_group", "week_start", "fullname"], "weekday", time.WEEKDAYS, "n")


def ticket_matrix(
    tickets: DataFrame,
    staff: DataFrame,
    categories: Sequence[str] = TICKET_CATEGORIES,
    *,
    start=None,
    end=None,
    tz: str = time.EST,
) -> DataFrame:
    """Missing-information tickets: users by weekday."""
    counts = activity.ticket_metric(tickets, staff, categories, start=start, end=end, tz=tz)
    return reshape.pivot_sum(_weekly(counts), ["week_start", "fullname"], "weekday", time.WEEKDAYS, "n")


def delivery_log(sheet: DataFrame, anchor: str = "7:00 AM") -> DataFrame:
    """Per day: deliveries, packages, samples, and time after ``anchor`` weighted by packages.

    ``product_mean`` is the mean of time times packages, the figure of the shift report; ``weighted_mean`` divides by
    all packages instead.
    """
    log = columns.leading(sheet.dropna(subset=["Day", "Time"]), 7)
    elapsed = time.seconds_between(
        time.parse_day_time("Day", F.lit(anchor)), time.parse_day_time("Day", "Time")
    )
    log = log.withColumn("__product", elapsed * F.col("Packages"))
    out = log.groupBy("Day").agg(
        F.count(F.lit(1)).alias("total_deliveries"),
        F.avg("__product").alias("product_mean"),
        (F.sum("__product") / F.sum("Packages")).alias("weighted_mean"),
        F.sum("Packages").alias("packages"),
        F.sum("Samples").alias("samples"),
    )
    return out.withColumn("weighted_average_time", time.hms(F.col("product_mean")))
