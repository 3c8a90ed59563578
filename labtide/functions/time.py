"""Time expressions. Timestamps are TIMESTAMP_NTZ holding UTC; local time is a fixed offset unless told otherwise."""

from __future__ import annotations

import datetime as dt
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EST = "-05:00"
DAY_FORMAT = "MM/dd/yyyy"
TIME_FORMAT = "HH:mm:ss"
MINUTE_FORMAT = "MM/dd/yyyy HH:mm"
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ntz(value: dt.datetime | dt.date | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    if isinstance(value, dt.datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def _fixed_offset(tz: str) -> Column | None:
    """A zone such as ``-05:00`` as an interval; null for zones with clock changes."""
    found = re.fullmatch(r"([+-])(\d{2}):(\d{2})", tz)
    if not found:
        return None
    minutes = int(found[2]) * 60 + int(found[3])
    return F.expr(f"interval '{found[1]}{minutes}' minute")


def to_local(c: Column | str, tz: str = EST) -> Column:
    """UTC wall time to local wall time; the result stays TIMESTAMP_NTZ.

    A fixed offset is a plain addition, several times cheaper per row than a zone lookup.
    """
    offset = _fixed_offset(tz)
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(c)) if offset is None else col(c) + offset


def local_bound(value: dt.datetime | str, tz: str = EST) -> Column:
    """A local-time bound expressed in UTC.

    Shifting the literal instead of the column leaves the column bare, so the comparison reaches the parquet scan.
    """
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz(value))


def in_window(c: Column | str, start=None, end=None, *, tz: str = EST, closed: bool = False) -> Column:
    """``start <= c < end`` in local time (``<= end`` when ``closed``); a missing bound is open."""
    keep = F.lit(True)
    if start is not None:
        keep = keep & (col(c) >= local_bound(start, tz))
    if end is not None:
        upper = local_bound(end, tz)
        keep = keep & ((col(c) <= upper) if closed else (col(c) < upper))
    return keep


def timestamp_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType))]


def localize(df: DataFrame, fmt: str | None = None, *, tz: str = EST) -> DataFrame:
    """Every timestamp column to local time, rendered with ``fmt`` when one is given."""
    changed = {}
    for name in timestamp_columns(df):
        local = to_local(F.col(name).cast("timestamp_ntz"), tz)
        changed[name] = F.date_format(local, fmt) if fmt else local
    return df.withColumns(changed) if changed else df


def day_text(c: Column | str) -> Column:
    return F.date_format(col(c), DAY_FORMAT)


def time_text(c: Column | str) -> Column:
    return F.date_format(col(c), TIME_FORMAT)


def week_start(c: Column | str) -> Column:
    """Monday of the week of a date."""
    day = col(c).cast("date")
    return F.date_sub(day, F.weekday(day))


def weekday_key(c: Column | str) -> Column:
    """``mon`` .. ``sun``: the fixed pivot values of every weekly matrix."""
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.weekday(col(c).cast("date")) + 1)


def micros(c: Column | str) -> Column:
    """Microseconds since 1970; with the session zone UTC the wall time is the instant."""
    return F.unix_micros(col(c).cast("timestamp"))


def micros_between(start: Column | str, end: Column | str) -> Column:
    return micros(end) - micros(start)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Whole seconds, cut towards zero."""
    return F.call_function("div", micros_between(start, end), F.lit(1_000_000))


def floor_div(n: Column, divisor: int) -> Column:
    """Exact floor division of BIGINTs; a double quotient would lose the last digits of long intervals."""
    return F.call_function("div", n - F.pmod(n, F.lit(divisor)), F.lit(divisor))


def hundredth_hours(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours times 100, rounded half up, as BIGINT: sums of it are exact in any order."""
    return floor_div(micros_between(start, end) + F.lit(18_000_000), 36_000_000)


def hours(start: Column | str, end: Column | str) -> Column:
    """Elapsed hours with two decimals."""
    return hundredth_hours(start, end).cast("double") / F.lit(100.0)


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Elapsed whole days, rounded towards minus infinity."""
    return floor_div(micros_between(start, end), 86_400_000_000)


def day_parts(c: Column | str) -> tuple[Column, Column]:
    """Time of day as (whole seconds, leftover microseconds).

    The two parts are summed apart: one BIGINT sum of microseconds overflows beyond 10^8 rows a day.
    """
    since_midnight = F.pmod(micros(c), F.lit(86_400_000_000))
    return floor_div(since_midnight, 1_000_000), F.pmod(since_midnight, F.lit(1_000_000))


def mean_seconds(sec_sum: Column, frac_sum: Column, n: Column) -> Column:
    return (sec_sum.cast("double") + frac_sum.cast("double") / F.lit(1e6)) / n.cast("double")


def hms(seconds: Column) -> Column:
    """Duration as HH:MM:SS without its days part; null gives an empty string."""
    whole = F.pmod(F.floor(seconds), F.lit(86_400))
    text = F.format_string(
        "%02d:%02d:%02d",
        floor_div(whole, 3600),
        F.pmod(floor_div(whole, 60), F.lit(60)),
        F.pmod(whole, F.lit(60)),
    )
    return F.when(seconds.isNull(), F.lit("")).otherwise(text)


def age_years(birth: Column | str, as_of: Column) -> Column:
    """Completed years; someone born on 29 February turns a year older on 1 March."""
    birth, as_of = col(birth).cast("date"), as_of.cast("date")
    not_yet = F.date_format(as_of, "MMdd") < F.date_format(birth, "MMdd")
    return F.year(as_of) - F.year(birth) - not_yet.cast("int")


# Text forms accepted where a date arrives as a string.
TEXT_DATE_FORMATS = ["MM/dd/yyyy HH:mm", "MM/dd/yyyy", "yyyyMMdd HH:mm", "yyyyMMdd"]


def parse_text(c: Column | str, formats: list[str] | None = None) -> Column:
    """Date text to TIMESTAMP_NTZ: ISO first, then the listed forms; anything else is null."""
    tries = [F.when(~col(c).rlike(r"^\d+$"), col(c)).try_cast("timestamp_ntz")]
    tries += [F.try_to_timestamp(col(c), F.lit(f)).cast("timestamp_ntz") for f in formats or TEXT_DATE_FORMATS]
    return F.coalesce(*tries)


def parse_day_time(day: Column | str, time: Column | str) -> Column:
    """``1/12/2021`` and ``9:30 AM`` to one timestamp."""
    return F.try_to_timestamp(F.concat_ws(" ", col(day), col(time)), F.lit("M/d/yyyy h:mm a")).cast("timestamp_ntz")


def parse_iso_z(c: Column | str) -> Column:
    """``2021-01-12T09:30:00Z`` exactly; other shapes are null."""
    exact = col(c).rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.when(exact, col(c)).try_cast("timestamp_ntz")


def days_from(spark: SparkSession, start: dt.date, days: int = 7) -> DataFrame:
    """Calendar spine of a fixed number of days."""
    return spark.range(days).select(F.date_add(F.lit(start), F.col("id").cast("int")).alias("day"))


def expand_weeks(bounds: DataFrame) -> DataFrame:
    """Every day of every week from ``lo`` to ``hi``: the one row of bounds is expanded, nothing passes the driver."""
    first, last = week_start("lo"), F.date_add(week_start("hi"), 6)
    return bounds.where(F.col("lo").isNotNull()).select(F.explode(F.sequence(first, last)).alias("day"))


def weeks_spanning(df: DataFrame, day: str) -> DataFrame:
    """Calendar of the weeks between the first and last day of a frame that has one row per day.

    Bounds are taken over whole rows: this use and the later join of the frame then need the same columns and share
    its exchanges.
    """
    row = F.struct(day, *[c for c in df.columns if c != day])
    ends = df.agg(F.min(row).alias("first"), F.max(row).alias("last"))
    return expand_weeks(ends.select(F.col(f"first.{day}").alias("lo"), F.col(f"last.{day}").alias("hi")))
