"""The journal of scheduled runs: their windows, which steps are done, and the run that a failure left open.

Entries are only ever appended, one small file each, so a run that dies half way leaves what it has noted. A step is
noted after its output is written; a step that died in between is done again, so every step must be repeatable.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.functions import time
from labtide.sources import readers

SCHEMA = "run bigint, step string, window_start timestamp_ntz, window_end timestamp_ntz, noted_at timestamp"
BEGIN, FINISHED = "begin", "finished"


@dataclass
class Run:
    """One window and the steps that are done for it."""

    journal: Journal
    number: int
    start: dt.datetime
    end: dt.datetime
    done: set[str] = field(default_factory=set)

    def step(self, name: str, action: Callable[[], object]) -> None:
        """Do ``action`` and note it, unless the journal says that it is done."""
        if name not in self.done:
            action()
            self.journal.note(self, name)
            self.done.add(name)

    def finish(self) -> None:
        self.step(FINISHED, lambda: None)


class Journal:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def entries(self) -> DataFrame:
        return readers.empty_or(self.spark, f"{self.path}/entries", SCHEMA)

    def note(self, run: Run, step: str) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(run.number).cast("bigint").alias("run"),
            F.lit(step).alias("step"),
            time.ntz(run.start).alias("window_start"),
            time.ntz(run.end).alias("window_end"),
            F.current_timestamp().alias("noted_at"),
        )
        row.write.mode("append").parquet(f"{self.path}/entries")

    def runs(self) -> DataFrame:
        """One row per run: window, steps done, and whether it is finished. A run has a handful of steps."""
        return self.entries().groupBy("run").agg(
            F.min("window_start").alias("window_start"),
            F.max("window_end").alias("window_end"),
            F.sort_array(F.collect_set("step")).alias("steps"),
            F.max(F.col("step") == FINISHED).alias("is_finished"),
        )

    def unfinished(self) -> Run | None:
        """The run that began and did not finish; there is one at most."""
        row = self.runs().where(~F.col("is_finished")).orderBy("run").first()
        return None if row is None else Run(self, row.run, row.window_start, row.window_end, {*row.steps})

    def last_finished(self) -> Run | None:
        row = self.runs().where("is_finished").orderBy(F.desc("run")).first()
        return None if row is None else Run(self, row.run, row.window_start, row.window_end, {*row.steps})

    def begin(self, start: dt.datetime, end: dt.datetime) -> Run:
        """A new run over a window. A run that is still open has to be finished first."""
        if self.unfinished() is not None:
            raise ValueError("an earlier run is not finished")
        last = self.entries().agg(F.max("run")).first()[0] or 0
        run = Run(self, last + 1, start, end)
        run.step(BEGIN, lambda: None)
        return run
