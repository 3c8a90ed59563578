"""Near-duplicate texts by min-max hashing: candidates from bands of signatures, links confirmed on whole shingle sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.llm import words
from labtide.llm.blocks import BLOCK, lists, meetings_of, met
from labtide.llm.components import components
from labtide.llm.staging import staged

WIDTH = 5
PERCENT = 80
ROWS = 6
BANDS = 40
COLUMNS = 1 << 14

SIGNATURE = "doc_id bigint, n_shingles bigint, set_id binary, bands array<bigint>"


def permutations(count: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """Factors and offsets of ``count`` hash functions on 32 bits."""
    draw = np.random.default_rng(seed)
    factors = draw.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    return factors, draw.integers(0, 1 << 32, count, dtype=np.uint32)


def min_max(shingles: np.ndarray, factors: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Smallest values under each permutation, then the greatest: two values for one evaluation per shingle."""
    low = np.full(len(factors), 0xFFFFFFFF, dtype=np.uint32)
    high = np.zeros(len(factors), dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), COLUMNS):
        values = factors[:, None] * short[None, at : at + COLUMNS]
        values += offsets[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each signature and band; ``rows`` values in a row make a band."""
    parts = signatures.reshape(len(signatures), bands, rows).astype(np.uint64)
    keys = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for j in range(rows):
        keys = words.mix(keys ^ (parts[:, :, j] + np.uint64(j << 32)))
    return keys.view(np.int64)


def signatures(docs: DataFrame, width: int, bands: int, rows: int, separating: np.ndarray = words.WHITE_SPACE) -> DataFrame:
    """Set size, set identity (128 bits) and band keys of each document; no shuffle."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        factors, offsets = permutations(bands * rows // 2)
        for part in (s for p in parts for s in words.slices(p)):
            sizes, names, signs = [], [], []
            for shingles in words.shingle_lists(part.column(1), width, separating):
                kept = words.distinct(shingles)
                sizes.append(len(kept))
                if len(kept):
                    names.append(hashlib.blake2b(kept.tobytes(), digest_size=16).digest())
                    signs.append(min_max(kept, factors, offsets))
                else:
                    names.append(None)
            filled = np.array(sizes, dtype=np.int64) > 0
            keys = band_keys(np.array(signs), bands, rows).reshape(-1) if signs else np.zeros(0, np.int64)
            ends = np.concatenate([[0], np.cumsum(filled * bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), lists],
                names=["doc_id", "n_shingles", "set_id", "bands"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(batches, SIGNATURE)


def shingle_sets(docs: DataFrame, width: int, separating: np.ndarray = words.WHITE_SPACE) -> DataFrame:
    """Document and its sorted distinct shingle hashes."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for p in parts for s in words.slices(p)):
            sets = [words.distinct(s).view(np.int64) for s in words.shingle_lists(part.column(1), width, separating)]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
            values = np.concatenate(sets) if sets else np.zeros(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(values, pa.int64()))
            yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["rep", "shingles"])

    return docs.select(F.col("doc_id").alias("rep"), "text").mapInArrow(batches, "rep bigint, shingles array<bigint>")


def _alike(shared: Column, left: Column, right: Column, percent: int) -> Column:
    return 100 * shared >= percent * (left + right - shared)


def pivot_links(meetings: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Confirmed links between the members of each bucket and its smallest member: one pair per member and pivot."""
    pairs = meetings.where("rep <> pivot").select("pivot", "rep").distinct()
    left = sets.select("rep", F.col("shingles").alias("own"))
    right = sets.select(F.col("rep").alias("pivot"), F.col("shingles").alias("other"))
    small, great = F.least(F.size("own"), F.size("other")), F.greatest(F.size("own"), F.size("other"))
    shared = F.size(F.array_intersect("own", "other"))
    return (
        pairs.join(left, "rep")
        .join(right, "pivot")
        .where(100 * small >= percent * great)
        .where(_alike(shared, F.size("own"), F.size("other"), percent))
        .select(F.col("pivot").alias("a"), F.col("rep").alias("b"))
    )


def _task_links(table: pa.Table, percent: int) -> pa.Table:
    """Links of visitors with hosts of another component: one for each visitor, component and meeting."""
    values, ends = lists(table.column("shingles"))
    reps, homes = table.column("rep").to_numpy(), table.column("home").to_numpy()
    found_a, found_b = [], []
    for hosts, guests in meetings_of(table):
        sizes = ends[hosts + 1] - ends[hosts]
        inside = np.concatenate([values[ends[h] : ends[h + 1]] for h in hosts])
        known, codes = np.unique(inside, return_inverse=True)
        marked = np.zeros(len(known) + 1, dtype=bool)
        starts = np.cumsum(sizes) - sizes
        for guest in guests:
            own = values[ends[guest] : ends[guest + 1]]
            at = np.searchsorted(known, own)
            at[at == len(known)] = 0
            at = at[known[at] == own]
            marked[at] = True
            shared = np.add.reduceat(marked[codes], starts, dtype=np.int64)
            marked[at] = False
            hits = np.flatnonzero((homes[hosts] != homes[guest]) & (100 * shared >= percent * (sizes + len(own) - shared)))
            _, first = np.unique(homes[hosts][hits], return_index=True)
            found_a += [reps[guest]] * len(first)
            found_b += reps[hosts[hits[first]]].tolist()
    return pa.table({"a": pa.array(found_a, pa.int64()), "b": pa.array(found_b, pa.int64())})


def _compared(hosts: DataFrame, visitors: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """Links between the hosts and visitors of each meeting; a pair of texts leaves a task only if it is linked."""
    rows = met(hosts, visitors, block).join(sets, "rep")
    return rows.groupBy("task").applyInArrow(lambda table: _task_links(table, percent), "a bigint, b bigint")


def crossing_links(
    meetings: DataFrame, homes: DataFrame, sets: DataFrame, weights: DataFrame, percent: int, block: int
) -> DataFrame:
    """Links that the pivots missed: between members of a bucket that are still in different components.

    In a bucket, the members outside its most frequent component are guests. Each guest is compared with that whole
    component (once, however many buckets they share), and with the other guests of the bucket. Buckets of one component
    are done already and drop out. ``weights`` has the number of shingles of each ``rep``, by which blocks are cut.
    """

    def weighed(side: DataFrame) -> DataFrame:
        return side.join(weights, "rep", "left").withColumn("weight", F.coalesce("weight", F.lit(0)))

    rows = meetings.where("rep <> pivot").select("key", "rep")
    rows = rows.join(homes, "rep", "left").withColumn("home", F.coalesce("component", "rep")).drop("component")
    tally = rows.groupBy("key", "home").agg(F.count("*").alias("n"))
    mixed = tally.groupBy("key").agg(
        F.max_by("home", F.struct("n", "home")).alias("main"), F.count("*").alias("homes")
    )
    guests = staged(
        rows.join(mixed.where("homes > 1").select("key", "main"), "key").where("home <> main"), "guests"
    )
    calls = guests.select(F.col("main").alias("meeting"), "rep", "home").distinct()
    hosts = (
        homes.select("rep", F.col("component").alias("home"))
        .unionAll(homes.select(F.col("component").alias("rep"), F.col("component").alias("home")).distinct())
        .unionAll(
            calls.select(F.col("meeting").alias("rep"), F.col("meeting").alias("home"))
            .distinct()
            .join(homes.select(F.col("component").alias("rep")).distinct(), "rep", "left_anti")
        )
    )
    hosts = hosts.join(calls.select(F.col("meeting").alias("home")).distinct(), "home").select(
        F.col("home").alias("meeting"), "rep", "home"
    )
    several = guests.groupBy("key").agg(F.min("home").alias("low"), F.max("home").alias("high")).where("low <> high")
    among = guests.join(several.select("key"), "key").select(F.col("key").alias("meeting"), "rep", "home")
    hosts, calls, among = weighed(hosts), weighed(calls), weighed(among)
    return _compared(hosts, calls, sets, percent, block).unionAll(_compared(among, among, sets, percent, block))


def near_duplicates(
    docs: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    bands: int = BANDS,
    rows: int = ROWS,
    block: int = BLOCK,
    separating: np.ndarray = words.WHITE_SPACE,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row of ``docs`` (doc_id, text; other columns are ignored).

    Texts are linked if their sets of ``width``-word shingles (A-Z lower-cased) have a Jaccard similarity of ``percent``
    or more; sets are compared by 64-bit hashes. A pair at the threshold shares no band with a probability of
    ``(1 - (percent / 100) ** rows) ** bands``, 5 in a million by default.

    Documents of equal sets are one class; only its smallest doc_id is hashed into bands. A text with fewer words is one
    shingle; null, empty and blank texts have no shingle and link with nothing. Rows of one doc_id are one document: if
    their texts differ, all their links count. A null doc_id is never linked: its component is null and it is kept.
    """
    signs = staged(signatures(docs, width, bands, rows, separating), "signatures")
    # Written out, so that the join below has exchanges of its own and adaptive execution can split a set of many copies.
    heads = staged(
        signs.where("doc_id is not null and set_id is not null")
        .groupBy("set_id")
        .agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"), F.first("n_shingles").alias("n_shingles")),
        "heads",
    )
    lean = signs.select("doc_id", "n_shingles", "set_id")
    named = staged(lean.join(heads.select("set_id", "rep"), "set_id", "left").select("doc_id", "n_shingles", "set_id", "rep"), "classes")

    seats = heads.select("rep", F.explode("bands").alias("key"))
    buckets = seats.groupBy("key").agg(F.min("rep").alias("pivot"), F.max("rep").alias("last")).where("pivot <> last")
    meetings = staged(seats.join(buckets.select("key", "pivot"), "key"), "meetings")

    wanted = meetings.select(F.col("rep").alias("doc_id")).distinct()
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sets = staged(shingle_sets(texts.join(wanted, "doc_id", "left_semi"), width, separating).distinct(), "sets")
    found = staged(pivot_links(meetings, sets, percent), "pivot-links")

    several = named.where("rep is not null").groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("z"))
    doubled = named.join(several.where("a <> z").select("doc_id"), "doc_id").select("doc_id", "rep")
    twins = doubled.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    found = found.unionAll(twins)

    homes = components(found, "a", "b").withColumnRenamed("node", "rep")
    weights = heads.groupBy("rep").agg(F.sum("n_shingles").alias("weight"))
    crossing = staged(crossing_links(meetings, homes, sets, weights, percent, block), "crossing-links")
    if not crossing.isEmpty():
        homes = components(
            crossing.unionAll(homes.select(F.col("rep").alias("a"), F.col("component").alias("b"))), "a", "b"
        ).withColumnRenamed("node", "rep")

    start = F.coalesce("rep", "doc_id")
    return (
        named.select("doc_id", "n_shingles", start.alias("rep"))
        .join(homes, "rep", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "rep").alias("component_id"))
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each_group(docs: DataFrame, **options) -> DataFrame:
    """The documents without those that are near-duplicates of one with a smaller doc_id.

    All columns stay as they are. Rows of one doc_id stay or go together.
    """
    gone = near_duplicates(docs, **options).where(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)
