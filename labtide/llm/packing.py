"""Best-fit packing of tokenised documents: planned on counts of lengths, carried out by rank within length."""

from __future__ import annotations

import bisect
import json
import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from labtide.llm.staging import staged

SEQUENCE = 2048
END_ID = 0
KNOWN_PARTS = 150_000
KNOWN_WORDS = 100_000
RANKED = 1_000

PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint"


# The form of a tokenizer whose ids can be had word by word, and its words in texts below U+0250.
LETTER_RUNS = {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}
NORMAL_FORM = ["NFC", "Replace", "Lowercase"]
WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_²³¹¼½¾]+|[\d²³¹¼½¾]|(?:[^\s\w]|_)+")
OUTSIDE = re.compile("[\x1c-\x1f\u0130\u0250-\U0010ffff]")


def by_words(tokenizer) -> bool:
    """Whether the tokenizer lower-cases, drops white space and cuts words as ``WORD`` does."""
    form = json.loads(tokenizer.to_str())
    steps = [n["type"] for n in (form["normalizer"] or {}).get("normalizers", [])]
    cut = [p for p in (form["pre_tokenizer"] or {}).get("pretokenizers", []) if p["type"] == "Split"]
    return steps == NORMAL_FORM and [p["pattern"] for p in cut] == [LETTER_RUNS] and form["model"]["type"] == "BPE"


class Table(dict):
    """What ``make`` gives for each key, kept. The memory is bounded: when full, keys not met again are forgotten."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        self[key] = value
        return value


class WordIds:
    """Token ids of texts, as little-endian 32-bit bytes.

    Latin texts are cut at white space and then into words; both tables are asked first, so that only new words are
    tokenised. Other texts, and other kinds of tokenizers, go through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.by_words = by_words(self.tokenizer)
        self.model = self.tokenizer.model
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        self.letters = {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}
        self.words = Table(self._word, KNOWN_WORDS)
        self.parts = Table(lambda part: b"".join(map(self.words.__getitem__, WORD.findall(part))), KNOWN_PARTS)

    def _word(self, word: str) -> bytes:
        spelt = word if word.isalpha() and word.isascii() else "".join(map(self.letters.__getitem__, word.encode()))
        return b"".join([t.id.to_bytes(4, "little") for t in self.model.tokenize(spelt)])

    def forget(self) -> None:
        """Give back the memory of both tables."""
        for table in (self.words, self.parts):
            table.older = {}
            table.clear()

    def ids(self, text: str) -> bytes:
        if self.by_words and "<|" not in text and not OUTSIDE.search(text):
            return b"".join(map(self.parts.__getitem__, text.lower().split()))
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()


@lru_cache(maxsize=1)
def word_ids(path: str) -> WordIds:
    """The loaded tokenizer of this Python worker, which serves one task after another; tables last for a task."""
    return WordIds(path)


def token_pieces(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """Pieces of at most ``size`` ids of each document: its text's ids, then ``end_id``.

    Only longer documents are cut. ``with_ids`` adds the ids themselves. A null text is empty and has one id.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, end = word_ids(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        for part in parts:
            rows: tuple[list, ...] = ([], [], [], [], [])
            chunks = []
            for doc, text in zip(part.column(0).to_pylist(), part.column(1)):
                ids = known.ids(text.as_py() or "") + end
                for piece, at in enumerate(range(0, len(ids), 4 * size)):
                    chunk = ids[at : at + 4 * size]
                    for column, value in zip(rows, (doc, piece, at // 4, len(chunk) // 4, zlib.crc32(chunk))):
                        column.append(value)
                    if with_ids:
                        chunks.append(np.frombuffer(chunk, dtype="<u4").astype(np.int32))
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            arrays = [pa.array(c, k) for c, k in zip(rows, kinds)]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays, names = [*arrays, pa.array(chunks, pa.list_(pa.int32()))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)
        known.forget()

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    return rows.mapInArrow(batches, PIECES + (", ids array<int>" if with_ids else ""))


class Plan:
    """Slots for every length, from counts alone.

    ``first_rank``, ``first_sequence`` and ``offset`` describe runs of slots, sorted by (length, rank): the piece of a
    length with rank r, in the run that begins at rank f, goes to sequence ``first_sequence + r - f`` at ``offset``.
    """

    def __init__(self, runs: list[tuple[int, int, int, int]]):
        table = np.array(sorted(runs), dtype=np.int64).reshape(-1, 4)
        self.length, self.first_rank, self.first_sequence, self.offset = table.T.copy()

    def slots(self, lengths: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces, given as lengths and ranks (from 0) within length."""
        sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
        for length in np.unique(lengths):
            own = np.flatnonzero(lengths == length)
            lo, hi = np.searchsorted(self.length, [length, length + 1])
            run = lo + np.searchsorted(self.first_rank[lo:hi], ranks[own], "right") - 1
            sequences[own] = self.first_sequence[run] + ranks[own] - self.first_rank[run]
            offsets[own] = self.offset[run]
        return sequences, offsets


def best_fit(counts: dict[int, int], size: int = SEQUENCE) -> Plan:
    """Best-fit decreasing over a histogram of lengths.

    Sequences with the same room are held as runs of numbers, so the work follows the number of lengths (at most
    ``size``), not of pieces: a length fills whole runs, splits at most one and opens at most one.
    """
    rooms: list[int] = []
    open_runs: dict[int, list[tuple[int, int]]] = {}
    runs, sequences = [], 0

    def give(room: int, first: int, n: int) -> None:
        if room:
            if room not in open_runs:
                bisect.insort(rooms, room)
                open_runs[room] = []
            open_runs[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        at = bisect.bisect_left(rooms, length)
        while left:
            if at < len(rooms):
                room = rooms[at]
                first, n = open_runs[room].pop()
                if not open_runs[room]:
                    del open_runs[room]
                    rooms.pop(at)
            else:
                room, first, n = size, sequences, -(-left // (size // length))
                sequences += n
            used = min(n, left)
            runs.append((length, rank, first, size - room))
            if used < n:
                give(room, first + used, n - used)
            give(room - length, first, used)
            left, rank = left - used, rank + used
            at = bisect.bisect_left(rooms, length)
    return Plan(runs)


def pack(pieces: DataFrame, size: int = SEQUENCE) -> DataFrame:
    """``pieces`` with sequence_id and offset.

    The histogram of lengths has at most ``size`` rows; it is planned on the driver. Ranks within a length are counted in
    slices, whose number follows the length's own count, so that one very common length does not meet in a task; most
    lengths are one slice. Slices start after the rows of the slices before them. The plan goes to the tasks: it has at most about ``4 * size`` runs of
    sequences, whatever the number of pieces. Ties are broken by all columns, so a task that runs again gives the same
    ranks. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    columns = pieces.columns
    keys = [c for c in columns if c != "ids"]
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slices = F.array(*[F.lit(max(1, -(-counts.get(length, 0) // RANKED))) for length in range(size + 1)])
    slices = F.get(slices, F.col("length").cast("int"))
    rows = pieces.withColumn("slice", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), slices))
    sizes = staged(rows.groupBy("length", "slice").agg(F.count("*").alias("n")), "lengths")
    plan = spark.sparkContext.broadcast(best_fit(counts, size))
    before = Window.partitionBy("length").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("length", "slice").orderBy(*keys)
    ranked = rows.join(starts, ["length", "slice"]).withColumn("rank", F.col("base") + F.row_number().over(inside) - 1)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            lengths, ranks = part.column("length").to_numpy(), part.column("rank").to_numpy()
            sequences, offsets = plan.value.slots(lengths, ranks)
            arrays = [*map(part.column, columns), pa.array(sequences), pa.array(offsets)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*columns, "sequence_id", "offset"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pieces.schema)
    return ranked.select(*columns, "rank").mapInArrow(batches, f"{kinds}, sequence_id bigint, offset bigint")


def packed_documents(docs: DataFrame, tokenizer: str, size: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Where every piece of every document goes: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Pieces are written out once, so that texts are tokenised once. Rows with the same or a null doc_id are documents of
    their own.
    """
    return pack(staged(token_pieces(docs, tokenizer, size, end_id), "pieces"), size)


def sequences(packed: DataFrame) -> DataFrame:
    """sequence_id and its ids, from packed pieces with ids. A sequence has at most the size that was packed for."""
    parts = packed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
