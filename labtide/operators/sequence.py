"""Neighbouring rows within a key: next user, time in stage, next and previous event.

A plain ``lead`` sorts each key in one task, which fails when one report holds a third of the log. The rows of the longest
key are therefore counted first. Where it is longer than a window may be, the log is dealt into ranges that follow key,
time and tie, whatever their types, by Spark's sampled bounds. A task's share is cut by row into ranges of as many rows as a
window may hold, so the number of tasks follows the rows alone; each range is one window, and the rows at the edges of
ranges take their neighbours from the next range that the same key reaches. The edges are two rows for each range.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labtide.session import SHUFFLE_CONF, scratch_dir
from labtide.sources import writers

_RANGE, _SPREAD, _SIDE, _ROW = "__range", "__spread", "__side", "__row"
_NEAR, _EDGE, _FAR = "__near_", "__edge_", "__far_"
SPREAD = 1 << 16
HOT_ROWS = 1_000_000
# A row's number in its partition, as ``monotonically_increasing_id`` has it in its lower bits.
PLACE = (1 << 33) - 1


def longest(df: DataFrame, key: str) -> tuple[int, int]:
    """(rows of the longest key, all rows); rows without a key count as rows only. One scan, combined before its shuffle."""
    sizes = df.groupBy(F.col(key).alias("__key")).agg(F.count(F.lit(1)).alias("__n"))
    row = sizes.agg(
        F.max(F.when(F.col("__key").isNotNull(), F.col("__n"))).alias("longest"), F.sum("__n").alias("rows")
    ).first()
    return row.longest or 0, row.rows or 0


def in_ranges(df: DataFrame, order: Sequence[str], tasks: int, most: int = HOT_ROWS) -> DataFrame:
    """The rows with the number of their range, written out by ``tasks`` tasks; ranges follow ``order``.

    A range holds at most ``most`` rows; a task writes as many ranges as its rows need.
    """
    dealt = df.repartitionByRange(tasks, *[F.col(c) for c in order]).sortWithinPartitions(*order)
    place = F.col(_RANGE).bitwiseAND(F.lit(PLACE))
    cut = dealt.withColumn(_RANGE, F.monotonically_increasing_id()).withColumn(_RANGE, F.col(_RANGE) - place % F.lit(most))
    return writers.kept(cut, scratch_dir(df.sparkSession, "ranges"))


def neighbour(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    columns: Sequence[str],
    *,
    prefix: str = "next_",
    previous: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``columns`` of the next (or previous) row of the same key, ordered by ``(ts, tie)``, nulls first.

    Rows at the end of a key get nulls, as do rows without a key: they have no neighbours. No window holds more than
    ``hot_rows`` rows of a longer key; to know that, the rows are counted when this is called. ``hot_rows=None`` skips the count
    for keys known to be short.
    """
    return _with_neighbours(df, key, ts, tie, columns, {prefix: F.lag if previous else F.lead}, hot_rows)


def neighbours(
    df: DataFrame,
    key: str,
    ts: str,
    tie: str,
    columns: Sequence[str],
    *,
    after: str = "next_",
    before: str = "last_",
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Add ``columns`` of the next and of the previous row of the same key, from one exchange; else like ``neighbour``."""
    return _with_neighbours(df, key, ts, tie, columns, {after: F.lead, before: F.lag}, hot_rows)


Steps = Mapping[str, Callable]


def _with_neighbours(
    df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], steps: Steps, hot_rows: int | None
) -> DataFrame:
    if hot_rows is not None:
        most, rows = longest(df, key)
        if most > hot_rows:
            wanted = int(df.sparkSession.conf.get(SHUFFLE_CONF))
            tasks = max(wanted, -(-rows // max(hot_rows, HOT_ROWS)))
            return _across_ranges(df, key, ts, tie, columns, steps, tasks, max(hot_rows, 1))
    return _within_keys(df, key, ts, tie, columns, steps)


def _within_keys(df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], steps: Steps) -> DataFrame:
    # Rows without a key need no neighbour; they are dealt over many windows, so that no task gets them all.
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(ts, tie), F.lit(SPREAD)))
    w = Window.partitionBy(key, _SPREAD).orderBy(ts, tie)
    near = {_NEAR + p: F.when(F.col(key).isNotNull(), step(F.struct(*columns)).over(w)) for p, step in steps.items()}
    found = df.withColumn(_SPREAD, spread).withColumns(near)
    return found.select(*_own(df), *[F.col(_NEAR + p)[c].alias(f"{p}{c}") for p in steps for c in columns])


def _across_ranges(
    df: DataFrame, key: str, ts: str, tie: str, columns: Sequence[str], steps: Steps, tasks: int, most: int
) -> DataFrame:
    order = list(dict.fromkeys([key, ts, tie, *columns]))
    rows = in_ranges(df, order, tasks, most)
    whole = F.struct(F.col(key).alias("key"), F.struct(*columns).alias("row"))
    w = Window.partitionBy(_RANGE).orderBy(*order)
    near = rows.withColumns({_NEAR + p: step(whole).over(w) for p, step in steps.items()})
    near = near.withColumns({_EDGE + p: F.col(_NEAR + p).isNull() for p in steps})

    # The first and the last row of every range, side by side with those of the ranges that the same key reaches.
    place = F.struct(*order)
    ends = rows.groupBy(_RANGE).agg(F.min_by(whole, place).alias("first"), F.max_by(whole, place).alias("last"))
    sides = F.array(*[F.struct(F.lit(i).alias(_SIDE), F.col(c).alias(_ROW)) for i, c in enumerate(("first", "last"))])
    edges = ends.select(_RANGE, F.inline(sides)).where(F.col(_ROW)["key"].isNotNull())
    along = Window.partitionBy(F.col(_ROW)["key"]).orderBy(_RANGE, _SIDE)
    met = edges.withColumns({_FAR + p: step(F.col(_ROW)["row"]).over(along) for p, step in steps.items()})
    # A last row looks ahead, a first row looks back; the other ways lead into the same range.
    picked = [
        F.first(F.when(F.col(_SIDE) == (1 if step is F.lead else 0), F.col(_FAR + p)), ignorenulls=True).alias(_FAR + p)
        for p, step in steps.items()
    ]
    far = met.groupBy(F.col(_RANGE).alias("__of")).agg(*picked)

    def value(p: str, c: str):
        same = F.when(F.col(_NEAR + p)["key"] == F.col(key), F.col(_NEAR + p)["row"][c])
        return F.when(F.col(_EDGE + p) & F.col(key).isNotNull(), F.col(_FAR + p)[c]).otherwise(same).alias(f"{p}{c}")

    joined = near.join(far, F.col(_RANGE) == F.col("__of"), "left")
    return joined.select(*_own(df), *[value(p, c) for p in steps for c in columns])


def _own(df: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in df.columns]
