"""Report turnaround: base facts, the turnaround dashboard, tracker enrichment and the positives extract."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from labtide.config.settings import EVENT_CATEGORIES, POSITIVE_COLUMNS, REDRAW_EVENT, TURNAROUND_COLUMNS
from labtide.functions import text, time
from labtide.operators import columns, matching
from labtide.plans import funnel
from labtide.session import scratch_dir
from labtide.sources import writers


def report_facts(
    reports: DataFrame,
    clinics: DataFrame,
    distributors: DataFrame,
    report_types: DataFrame,
    kits: DataFrame,
    samples: DataFrame,
    event_logs: DataFrame,
    *,
    start=None,
    tz: str = time.EST,
    categories: Sequence[tuple[str, str]] = EVENT_CATEGORIES,
) -> DataFrame:
    """One row per report that has at least one event and one sample.

    Events and samples are reduced to one row per report and per kit before they are joined. The row-level join of
    reports, events and samples would multiply rows, and would put a busy report into a single task. Sample columns
    come from the highest sample id of the kit. The redraw flag and the funnel's first times come from the same pass
    over the event log; a consumer that uses only one of them does not pay for the other.
    """
    base = reports.where(F.col("start_date").isNotNull() & time.in_window("start_date", start, tz=tz))
    # Two flat max_by keep this a hash aggregate; one over a struct would sort every sample.
    last_sample = samples.groupBy("kit_id").agg(
        F.max_by("received_at", "id").alias("sample_received_at"),
        F.max_by("collection_date", "id").alias("collection_date"),
    )
    events = funnel.report_events(event_logs, F.col("event_type") == REDRAW_EVENT, "redraw", categories, tz=tz)
    # Dimensions are joined to each other first, so the reports are exchanged once per key and AQE can split a hot key.
    kit = last_sample.join(kits.select(F.col("id").alias("kit_id"), "tracking_number"), "kit_id")
    clinic = clinics.select(F.col("id").alias("clinic_id"), F.col("name").alias("clinic"), "distributor_id").join(
        distributors.select(F.col("id").alias("distributor_id"), F.col("name").alias("distributor")), "distributor_id"
    )
    test = report_types.select(F.col("id").alias("report_type_id"), F.col("name").alias("test"))
    joined = (
        base.join(events, base["id"] == events["report_id"])
        .drop("report_id")
        .join(kit, "kit_id")
        .join(clinic, "clinic_id")
        .join(test, "report_type_id")
    )
    return with_local_parts(time.localize(joined, tz=tz))


def with_local_parts(facts: DataFrame) -> DataFrame:
    """Day, time and hour columns of the local timestamps."""
    return facts.withColumns(
        {
            "sent_day": time.day_text("sent_date"),
            "start_day": time.day_text("start_date"),
            "sent_time": time.time_text("sent_date"),
            "start_time": time.time_text("start_date"),
            "receive_day": time.day_text("sample_received_at"),
            "start_hour": F.hour("start_date"),
            "create_hour": F.hour("created_at"),
            "timedelta": time.seconds_between("sample_received_at", "sent_date"),
        }
    )


def turnaround(
    facts: DataFrame,
    *,
    term: str = "COVID",
    genomics: bool = False,
    low: float = 6,
    high: float | None = None,
    clean: bool = True,
) -> DataFrame:
    """Turnaround rows before publishing.

    Without ``clean``, rows with the "N/A" tracking marker stay: the overall mean is taken over them as well.

    The main branch keeps tests whose name contains ``term`` with ``low < TAT < high`` hours (200 unless given); the
    genomics branch keeps all other tests with a turnaround in whole days below ``high`` (1500 unless given).
    """
    rows = facts.where(F.col("sent_day").isNotNull())
    same_hour = F.coalesce(F.col("create_hour") == F.col("start_hour"), F.lit(False))
    rows = rows.withColumns(
        {
            "start_date_type": F.when(same_hour, "report_created").otherwise("sample_created"),
            "weekday": F.date_format("start_date", "EEEE"),
            "month": F.date_format("start_date", "MMMM"),
        }
    )
    tested = text.contains("test", term)
    if genomics:
        rows = rows.where(~tested).withColumn("TAT", time.whole_days("sample_received_at", "sent_date"))
        rows = rows.where(F.col("TAT") < (1500 if high is None else high))
    else:
        rows = rows.where(tested).withColumn("TAT", time.hours("sample_received_at", "sent_date"))
        rows = rows.where((F.col("TAT") > low) & (F.col("TAT") < (200 if high is None else high)))
        goal = F.when(F.coalesce(F.col("expedited"), F.lit(False)), 24).otherwise(72)
        rows = rows.withColumns(
            {
                "72 Hours": F.lit(72),
                "positive": F.coalesce(F.col("result") == "Positive", F.lit(False)).cast("int"),
                "goal": goal,
                "goal_missed": (F.col("TAT") >= goal).cast("int"),
            }
        )
    return clean_tracking(rows) if clean else rows


def clean_tracking(rows: DataFrame) -> DataFrame:
    """Drop the "N/A" marker but keep missing numbers, then reduce the text to a number."""
    kept = rows.where(~F.col("tracking_number").eqNullSafe("N/A"))
    return kept.withColumn("tracking_number", text.tracking_number("tracking_number"))


AVERAGE = "Average Turnaround"


def with_average(rows: DataFrame, path: str | None = None) -> DataFrame:
    """The overall mean on every row, as the chart's horizontal line.

    The rows are written once, below ``path`` or the scratch folder, and their sum and count are observed by that write, so
    what they are made from is worked out once. TAT has two decimals, so whole hundredths are summed exactly.
    """
    seen = Observation("turnaround")
    hundredths = F.round(F.col("TAT") * 100).cast("bigint")
    counted = rows.observe(seen, F.sum(hundredths).alias("hundredths"), F.count("TAT").alias("n"))
    held = writers.kept(counted, path or scratch_dir(rows.sparkSession, "turnaround"))
    # Where there are no rows, Spark plans the counters away as well.
    found = {} if held.isEmpty() else seen.get
    mean = found["hundredths"] / found["n"] / 100.0 if found.get("n") else None
    return held.withColumn(AVERAGE, F.lit(mean).cast("double"))


def published(rows: DataFrame) -> DataFrame:
    return columns.keep_present(rows, TURNAROUND_COLUMNS)


def positives(rows: DataFrame) -> DataFrame:
    return rows.select(*POSITIVE_COLUMNS)


def segment_rules(
    clinic_is: Sequence[str] = (),
    distributor_is: Sequence[str] = (),
    distributor_has: Sequence[str] = (),
    clinic_has: Sequence[str] = (),
) -> dict[str, Column]:
    """Rules of the per-customer dashboards, plus ``all``."""
    rules = {"all": F.lit(True)}
    rules.update({f"clinic {v}": F.col("clinic") == v for v in clinic_is})
    rules.update({f"distributor {v}": F.col("distributor") == v for v in distributor_is})
    rules.update({f"distributors with {v}": text.contains("distributor", v) for v in distributor_has})
    rules.update({f"clinics with {v}": text.contains("clinic", v) for v in clinic_has})
    return rules


def unseen_tracking(rows: DataFrame, trackers: DataFrame) -> DataFrame:
    """Tracking numbers that have no tracker yet."""
    numbers = rows.select("tracking_number").where(F.col("tracking_number").isNotNull()).distinct()
    return matching.absent(numbers, trackers, {"tracking_number": "tracking_number"})


def with_trackers(rows: DataFrame, trackers: DataFrame, *, low: float = 6, high: float = 200) -> DataFrame:
    """Restart the clock at delivery where a tracker knows it.

    A missing or negative duration falls back to sent minus start. The mean covers the rows before the range filter.
    """
    return in_range(tracked(rows, trackers), low=low, high=high)


def in_range(rows: DataFrame, *, low: float = 6, high: float = 200) -> DataFrame:
    return rows.where((F.col("TAT") > low) & (F.col("TAT") < high))


def tracked(rows: DataFrame, trackers: DataFrame) -> DataFrame:
    """All rows of ``with_trackers``, before its range filter, written once: each row of ``rows`` with its tracker, if any."""
    known = trackers.where(F.col("easypost_id").isNotNull()).select(
        F.col("tracking_number").alias("known_number"), "delivery_datetime", "public_url", "picked_up_city", "picked_up_state"
    )
    # Numbers are positive. Rows without one meet no tracker, and a number below zero keeps them out of a single task.
    none = -1 - F.pmod(F.xxhash64("start_date", "sent_date"), F.lit(1 << 40))
    met = F.coalesce("tracking_number", none) == F.col("known_number")
    joined = rows.drop("72 Hours").join(known, met, "left").drop("known_number")
    late = F.col("delivery_datetime").isNull() | (F.col("sent_date") < F.col("delivery_datetime"))
    begin = F.when(late, F.col("start_date")).otherwise(F.col("delivery_datetime"))
    timed = joined.withColumns(
        {
            "timedelta": time.seconds_between(begin, "sent_date"),
            "TAT": time.hours(begin, "sent_date"),
            "start_date_type": F.when(F.col("delivery_datetime").isNotNull(), "delivery_date").otherwise(
                F.col("start_date_type")
            ),
        }
    )
    if "goal" in timed.columns:
        timed = timed.withColumn("goal_missed", (F.col("TAT") >= F.col("goal")).cast("int"))
    return with_average(timed)
