"""Near-duplicate vectors by Euclidean p-stable hashing, with exact cosines in the buckets."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.llm.blocks import BLOCK, lists, meetings_of, met
from labtide.llm.components import components
from labtide.llm.staging import staged

COSINE = 0.9
TABLES = 48
PROJECTIONS = 14
WIDTH = 2.0


@lru_cache(maxsize=4)
def projections(size: int, tables: int, count: int, width: float, seed: int = 11) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Gaussian directions, offsets within a step, and odd multipliers that fold the steps of a table into one key."""
    draw = np.random.default_rng([seed, size])
    return (
        draw.standard_normal((size, tables * count)),
        draw.random(tables * count) * width,
        draw.integers(0, 1 << 62, (tables, count), dtype=np.int64) * 2 + 1,
    )


def bucket_keys(unit: np.ndarray, tables: int, count: int, width: float) -> np.ndarray:
    """One key for each unit vector and table: the quantised projections of that table, folded."""
    directions, offsets, factors = projections(unit.shape[1], tables, count, width)
    steps = np.floor((unit @ directions + offsets) / width).astype(np.int64).reshape(len(unit), tables, count)
    keys = (steps * factors[None]).sum(axis=2)
    return (keys ^ (keys >> 29)) * np.int64(0x1F123BB5159A55E5) + np.arange(tables, dtype=np.int64)


def unit_rows(values: np.ndarray) -> np.ndarray:
    """Rows of length one. The greatest component is taken out first, so that no square overflows or vanishes."""
    scaled = values / np.abs(values).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _seats(reps: DataFrame, tables: int, count: int, width: float) -> DataFrame:
    """rep and bucket key for every table."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            values, ends = lists(pa.chunked_array([part.column(1)]))
            ids, sizes = part.column(0).to_numpy(), np.diff(ends)
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                taken = values[ends[rows][:, None] + np.arange(size)].astype(np.float64)
                keys = bucket_keys(unit_rows(taken), tables, count, width)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(ids[rows], tables)), pa.array(keys.reshape(-1))], names=["rep", "key"]
                )

    return reps.select("rep", "vector").mapInArrow(batches, "rep bigint, key bigint")


def _links(table: pa.Table, cosine: float, tables: int, count: int, width: float) -> pa.Table:
    """For each visitor the number of linked vectors, and links that hold together what is linked in the meeting.

    A pair that shares several buckets counts in the bucket of the first table only.
    """
    values, ends = lists(table.column("vector"))
    reps, weights = table.column("rep").to_numpy(), table.column("copies").to_numpy()
    keys = table.column("meeting").to_numpy()
    out: tuple[list, ...] = ([], [], [])
    unit: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    sizes = np.diff(ends)
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        ids, first, back = np.unique(reps[rows], return_index=True, return_inverse=True)
        vectors = unit_rows(values[ends[rows[first]][:, None] + np.arange(size)].astype(np.float64))
        own = bucket_keys(vectors, tables, count, width)
        for i, row in zip(back, rows):
            unit[row] = (vectors[i], own[i])
    for hosts, guests in meetings_of(table):
        left, right = np.array([unit[g][0] for g in guests]), np.array([unit[h][0] for h in hosts])
        near = left @ right.T >= cosine
        near &= reps[guests][:, None] != reps[hosts][None, :]
        i, j = np.nonzero(near)
        if not len(i):
            continue
        own, other = np.array([unit[g][1] for g in guests]), np.array([unit[h][1] for h in hosts])
        counted = np.zeros(len(i), dtype=bool)
        for lo in range(0, len(i), 1 << 16):
            part = slice(lo, lo + (1 << 16))
            same = own[i[part]] == other[j[part]]
            counted[part] = own[i[part], same.argmax(axis=1)] == keys[guests[0]]
        sums = np.bincount(i, weights=np.where(counted, weights[hosts][j], 0), minlength=len(guests)).astype(np.int64)
        low = np.minimum(reps[guests], np.where(near, reps[hosts][None, :], np.iinfo(np.int64).max).min(axis=1))
        tied = np.where(near, low[:, None], np.iinfo(np.int64).max).min(axis=0)
        while True:
            down = np.minimum(low, np.where(near, tied[None, :], np.iinfo(np.int64).max).min(axis=1))
            if (down == low).all():
                break
            low = down
            tied = np.where(near, low[:, None], np.iinfo(np.int64).max).min(axis=0)
        linked = near.any(axis=1)
        out[0].extend(reps[guests][linked].tolist())
        out[1].extend(sums[linked].tolist())
        out[2].extend(low[linked].tolist())
    return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("rep", "links", "low"), out)})


def near_duplicate_vectors(
    vectors: DataFrame,
    cosine: float = COSINE,
    tables: int = TABLES,
    count: int = PROJECTIONS,
    width: float = WIDTH,
    block: int = BLOCK,
) -> DataFrame:
    """vec_id, n_links, component_id and kept for every row of ``vectors`` (vec_id, embedding).

    Unit vectors that share the quantised projections of a table are compared by exact cosine in double precision; pairs
    of ``cosine`` or more are linked. With the default tables a pair at exactly 0.9 is found with a probability of 0.96,
    one at 0.95 with 0.9995.

    Equal vectors are one class, which is hashed once; all its members count as links. Null vectors, zero vectors and
    those with null or non-finite components link with nothing, nor do vectors of different sizes. A repeated row is a
    vector of its own. Rows without a vec_id are not linked: their component is null and they are kept.
    """
    fine = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(
        "vector", lambda x: x != 0
    )
    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"),
        F.transform(F.col("embedding").cast("array<double>"), lambda x: x + F.lit(0.0)).alias("vector"),
    )
    rows = rows.withColumn("vector", F.when(F.col("vec_id").isNotNull() & fine, F.col("vector")))
    rows = rows.withColumn("print", F.when(F.col("vector").isNotNull(), F.sha2(F.to_json("vector"), 256)))
    classes = staged(
        rows.where("vector is not null")
        .groupBy("print")
        .agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("vector").alias("vector")),
        "classes",
    )
    seats = _seats(classes, tables, count, width)
    crowded = seats.groupBy("key").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low <> high")
    meetings = staged(seats.join(crowded.select("key"), "key").select(F.col("key").alias("meeting"), "rep"), "meetings")
    known = classes.select("rep", "copies", "vector")
    found = staged(
        met(meetings, meetings, block)
        .join(known, "rep")
        .groupBy("task")
        .applyInArrow(lambda t: _links(t, cosine, tables, count, width), "rep bigint, links bigint, low bigint"),
        "links",
    )
    degrees = found.groupBy("rep").agg(F.sum("links").alias("links"))
    homes = components(found, "rep", "low").withColumnRenamed("node", "rep")
    return (
        rows.select("vec_id", "print")
        .join(classes.select("print", "rep", "copies"), "print", "left")
        .select("vec_id", "copies", F.coalesce("rep", "vec_id").alias("rep"))
        .join(degrees, "rep", "left")
        .join(homes, "rep", "left")
        .select(
            "vec_id",
            (F.coalesce(F.col("copies") - 1, F.lit(0)) + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.when(F.col("vec_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
