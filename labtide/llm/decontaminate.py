"""Benchmark items inside documents: MinHash containment by size class, confirmed on whole shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labtide.llm import words
from labtide.llm.staging import body, staged, without
from labtide.session import scratch_dir

WIDTH = 5
PERCENT = 80
SKETCH = 24
MISS = 1e-6
BLOCK_SHINGLES = 1 << 20

ITEM = "item_id bigint, width int, shingles array<bigint>"
FOUND = "doc_id bigint, body bigint, item_id bigint, n_shared bigint, n_item bigint"


def hits_needed(sketch: int, percent: int = PERCENT, miss: float = MISS) -> int:
    """Sketch values a document must hold: one that holds ``percent`` of the item has fewer with a chance below ``miss``."""
    share, total = percent / 100, 0.0
    for hits in range(sketch + 1):
        total += math.comb(sketch, hits) * share**hits * (1 - share) ** (sketch - hits)
        if total > miss:
            return max(hits, 1)
    return 1


def size_class(n: int) -> int:
    """The class of a set of ``n`` shingles: the greatest power of two that is not above it."""
    return 1 << (n.bit_length() - 1)


def signature_length(of_class: int, sketch: int) -> int:
    """Hashes that stand for a set of this class: all of a small one; a quarter of ``sketch`` more for each doubling beyond it.

    Larger items meet longer texts and more shared passages, and so need more evidence before whole sets are compared.
    """
    if of_class <= sketch:
        return 2 * of_class - 1
    return sketch + round(sketch / 4 * math.log2(of_class / sketch))


def item_sets(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """Distinct shingle hashes of each item; one with fewer words has one shingle of all its words."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            hashes, first = words.word_hashes(part.column(1), words.NOT_ALPHANUMERIC)
            rows = []
            for item, lo, hi in zip(part.column(0).to_pylist(), first[:-1].tolist(), first[1:].tolist()):
                own = min(width, hi - lo)
                if own:
                    rows.append((item, own, words.distinct(words.fold(hashes[lo:hi], own)).view(np.int64)))
            columns = list(zip(*rows)) if rows else [(), (), ()]
            kinds = (pa.int64(), pa.int32(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=["item_id", "width", "shingles"]
            )

    return items.select(F.col("item_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(batches, ITEM)


class Sketches:
    """The items of one shingle width and one size class in a block: an index of their signatures.

    A signature has the smallest hashes of a set, ``signature_length`` of them at most. Since these are an even sample of the
    set, a document that contains ``percent`` of the item contains as large a share of the signature, give or take; the hits
    needed are set so low that one in a million such documents is missed. All hashes of a set together decide by
    themselves.
    """

    def __init__(self, items: list[tuple[int, np.ndarray]], percent: int, sketch: int):
        self.ids, self.sets, self.percent = [i for i, _ in items], [s for _, s in items], percent
        owners, values, needed = [], [], []
        for place, own in enumerate(self.sets):
            size = min(len(own), signature_length(size_class(len(own)), sketch))
            values.append(np.sort(words.mix(own))[:size])
            owners.append(np.full(size, place))
            needed.append(hits_needed(size, percent))
        values, owners = np.concatenate(values), np.concatenate(owners)
        order = np.argsort(values, kind="stable")
        self.values, self.first = np.unique(values[order], return_index=True)
        self.first = np.append(self.first, len(order))
        self.owners, self.needed = owners[order], np.array(needed)

    def among(self, runs: np.ndarray) -> np.ndarray:
        """For each shingle of many documents, the number of the sketch value it equals, or -1."""
        mixed = words.mix(runs)
        at = np.searchsorted(self.values, mixed)
        at[at == len(self.values)] = 0
        return np.where(self.values[at] == mixed, at, -1)

    def inside(self, own: np.ndarray, hits: np.ndarray) -> list[tuple[int, int, int]]:
        """item_id, shared and own number of shingles of the items that a document holds."""
        lists = [self.owners[self.first[h] : self.first[h + 1]] for h in np.unique(hits)]
        votes = np.bincount(np.concatenate(lists), minlength=len(self.ids))
        found = []
        for place in np.flatnonzero(votes >= self.needed):
            item = self.sets[place]
            at = np.searchsorted(own, item)
            at[at == len(own)] = 0
            shared = int((own[at] == item).sum())
            if 100 * shared >= self.percent * len(item):
                found.append((self.ids[place], shared, len(item)))
        return found


def _sketched(items: DataFrame, percent: int, sketch: int) -> dict[tuple[int, int], Sketches]:
    """An index of signatures for each shingle width and size class of a block of items."""
    parts: dict[tuple[int, int], list] = {}
    for row in items.collect():
        key = (row["width"], size_class(len(row["shingles"])))
        parts.setdefault(key, []).append((row["item_id"], np.array(row["shingles"], np.int64).view(np.uint64)))
    return {key: Sketches(own, percent, sketch) for key, own in sorted(parts.items())}


def _search(docs: DataFrame, groups: dict[tuple[int, int], Sketches]) -> DataFrame:
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (s for p in parts for s in words.slices(p)):
            hashes, first = words.word_hashes(part.column(1), words.NOT_ALPHANUMERIC)
            ids, bodies = part.column(0).to_pylist(), part.column(2).to_pylist()
            rows, runs, folded = [], None, 0
            for (width, _), sketches in groups.items():
                if width != folded:
                    runs, folded = words.fold(hashes, width), width
                hit = sketches.among(runs)
                places = np.flatnonzero(hit >= 0)
                owner = np.searchsorted(first, places, "right") - 1
                inside = places + width <= first[owner + 1]
                places, owner = places[inside], owner[inside]
                for doc in np.unique(owner):
                    own = words.distinct(runs[first[doc] : first[doc + 1] - width + 1])
                    for found in sketches.inside(own, hit[places[owner == doc]]):
                        rows.append((ids[doc], bodies[doc], *found))
            columns = list(zip(*rows)) if rows else [()] * 5
            names = ["doc_id", "body", "item_id", "n_shared", "n_item"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"), body().alias("body"))
    return rows.mapInArrow(batches, FOUND)


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    width: int = WIDTH,
    percent: int = PERCENT,
    sketch: int = SKETCH,
    block_shingles: int = BLOCK_SHINGLES,
) -> DataFrame:
    """doc_id, body, item_id, n_shared and n_item of every document of ``docs`` that holds an item of ``benchmark``.

    Items are searched by size class, each with an index, a signature length and a number of hits of its own. Documents are
    not sketched but looked through whole: in a signature of a long document a short item would have no part.

    A document holds an item if it has ``percent`` of the item's distinct ``width``-word shingles or more. Words are runs
    of letters and digits with A-Z lower-cased, so punctuation and line ends do not matter. The documents are read once
    for each block of items and never shuffled; a block of about ``block_shingles`` shingles goes through the driver to
    the tasks, and what it finds is written before the next is collected. So the size of a block is bounded, larger
    benchmarks take more blocks, and the plan of the result does not grow with them.

    An item with fewer words is one shingle of all its words; items and documents without words match nothing. Rows
    without an id are compared as well. Repeated rows are reported once.
    """
    sets = staged(item_sets(benchmark, width).distinct(), "items")
    total = sets.agg(F.sum(F.size("shingles"))).first()[0] or 0
    blocks = max(1, -(-total // block_shingles))
    folder = scratch_dir(docs.sparkSession, "contaminated")
    for number in range(blocks):
        part = sets.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(blocks)) == number)
        _search(docs, _sketched(part, percent, sketch)).write.mode("append").parquet(folder)
    return docs.sparkSession.read.schema(FOUND).parquet(folder).distinct()


def decontaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that hold no item of the benchmark, in all their columns."""
    return without(docs, contaminated(docs, benchmark, **options).select("doc_id", "body").distinct())
