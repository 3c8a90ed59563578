"""Comparing the members of groups of any size in blocks that fit a task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.llm.staging import staged

BLOCK = 512
BLOCK_WEIGHT = 1 << 19
TASKS = 64


def met(hosts: DataFrame, visitors: DataFrame, block: int = BLOCK, heavy: int = BLOCK_WEIGHT) -> DataFrame:
    """Rows of ``hosts`` and ``visitors`` (meeting, rep and the same other columns), dealt out to be compared.

    Both sides of a meeting are cut into blocks of about ``block`` rows, or a weight of ``heavy`` if rows have a column
    ``weight``; each pair of a host and a visitor block becomes a (meeting, place, seat), so that no task holds a whole large
    meeting, and a row is repeated once per block of the other side. ``task`` puts small meetings together, about four
    blocks of rows or weight, and gives large ones a group for each pair of blocks.
    """
    weight = F.col("weight") if "weight" in hosts.columns else F.lit(0)

    def counted(side: DataFrame, name: str) -> DataFrame:
        blocks = F.greatest(F.ceil(F.count("*") / block), F.ceil(F.sum(weight) / heavy))
        own = (F.count("*").alias(f"{name}_rows"), F.sum(weight).alias(f"{name}_weight"))
        return side.groupBy("meeting").agg(blocks.alias(f"{name}_blocks"), *own)

    shape = staged(counted(hosts, "host").join(counted(visitors, "guest"), "meeting"), "meeting-sizes")
    alone_rows, alone_weight = (
        shape.where("host_blocks * guest_blocks = 1")
        .agg(F.sum(F.col("host_rows") + F.col("guest_rows")), F.sum(F.col("host_weight") + F.col("guest_weight")))
        .first()
    )
    shape = shape.select("meeting", "host_blocks", "guest_blocks")
    zero = F.lit(0).cast("bigint")

    def dealt(side: DataFrame, visiting: bool) -> DataFrame:
        own, other = ("guest_blocks", "host_blocks") if visiting else ("host_blocks", "guest_blocks")
        names = ("seat", "place") if visiting else ("place", "seat")
        return side.join(shape, "meeting").select(
            *[c for c in side.columns if c != "weight"],
            (F.col("host_blocks") * F.col("guest_blocks")).alias("pairs"),
            F.lit(visiting).alias("visiting"),
            F.pmod(F.xxhash64("rep"), F.col(own)).alias(names[0]),
            F.explode(F.sequence(zero, F.col(other) - 1)).alias(names[1]),
        )

    rows = dealt(hosts, False).unionByName(dealt(visitors, True))
    alone = F.xxhash64("meeting", "place", "seat")
    slots = max(TASKS, 4 * int(hosts.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    slots = max(slots, -(-(alone_rows or 0) // (4 * block)), -(-(alone_weight or 0) // (4 * heavy)))
    return rows.withColumn("task", F.when(F.col("pairs") == 1, F.pmod(F.xxhash64("meeting"), F.lit(slots))).otherwise(alone))


def meetings_of(table: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of the hosts and of the visitors of each (meeting, place, seat) in a task's rows."""
    keys = [table.column(c).to_numpy() for c in ("seat", "place", "meeting")]
    order = np.lexsort(keys)
    change = np.zeros(len(order), dtype=bool)
    for key in keys:
        change[1:] |= key[order][1:] != key[order][:-1]
    visiting = table.column("visiting").to_numpy()
    for rows in np.split(order, np.flatnonzero(change)) if len(order) else []:
        guest = visiting[rows]
        if guest.any() and not guest.all():
            yield rows[~guest], rows[guest]


def lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and n + 1 offsets of a list column."""
    column = column.combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    ends = column.offsets.to_numpy()
    return column.values.to_numpy(zero_copy_only=False), ends
