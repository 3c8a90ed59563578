"""Lines that many documents share: exact reference counts, sharded cuckoo filters before them, and undo by deletion."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.llm.cuckoo import CuckooFilter
from labtide.llm.staging import body, staged, unused

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 250_000
GROUP_ROWS = 20_000
STRIPPED = b" \t\n\x0b\x0c\r"

REFERENCES = "h1 bigint, h2 bigint, doc_id bigint, body bigint, places array<int>"
FILTERS = "shard int, live bigint, slots binary"


def line_key(line: bytes) -> bytes:
    """A line without white space at its ends, A-Z lower-cased."""
    return line.strip(STRIPPED).lower()


def code_points(text: bytes) -> int:
    return len(text) if text.isascii() else len(text.decode())


def references(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """A row for each document and each of its distinct line keys: the key's 128-bit hash and the places of its lines."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows: tuple[list, ...] = ([], [], [], [], [])
            ids, bodies = part.column(0).to_pylist(), part.column(2).to_pylist()
            for doc, text, body in zip(ids, part.column(1).cast(pa.large_binary()), bodies):
                held = defaultdict(list)
                for place, line in enumerate((text.as_py() or b"").split(b"\n")):
                    key = line_key(line)
                    if len(key) >= min_chars and code_points(key) >= min_chars:
                        held[key].append(place)
                for key, places in held.items():
                    number = xxhash.xxh3_128_intdigest(key)
                    for column, value in zip(rows, (number >> 64, number & (1 << 64) - 1, doc, body, places)):
                        column.append(value)
            halves = [pa.array(np.array(half, dtype=np.uint64).view(np.int64)) for half in rows[:2]]
            arrays = [*halves, pa.array(rows[2], pa.int64()), pa.array(rows[3], pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(rows[4], pa.list_(pa.int32()))], names=["h1", "h2", "doc_id", "body", "places"]
            )

    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint"), F.col("text").cast("string"), body().alias("body")
    )
    return rows.mapInArrow(batches, REFERENCES)


def _counted(rows: DataFrame) -> DataFrame:
    """Exact reference counts: documents that hold a key, and the largest of them."""
    held = rows.select("h1", "h2", "doc_id").distinct()
    return held.groupBy("h1", "h2").agg(F.count("*").alias("refs"), F.max("doc_id").alias("keeper"))


def _updated(changes: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter after its changes; without slots if it must be built anew."""
    shard = int((changes if len(changes) else filters)["shard"].iloc[0])
    if not len(filters):
        return pd.DataFrame({"shard": [shard], "live": [0], "slots": [None]})
    row = filters.iloc[0]
    held = CuckooFilter.from_bytes(row["slots"], int(row["live"]))
    held.remove(changes.loc[~changes["repeated"], "h1"].to_numpy())
    fits = held.add(changes.loc[changes["repeated"], "h1"].to_numpy())
    return pd.DataFrame({"shard": [shard], "live": [held.live], "slots": [held.to_bytes() if fits else None]})


def _built(keys: pd.DataFrame) -> pd.DataFrame:
    """A shard's filter from all its keys."""
    values, room = np.unique(keys["h1"].to_numpy()), len(keys)
    while True:
        held = CuckooFilter.for_keys(room)
        if held.add(values):
            return pd.DataFrame({"shard": [keys["shard"].iloc[0]], "live": [held.live], "slots": [held.to_bytes()]})
        room = 2 * room


def _passed(rows: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    """References whose key may be a repeated one."""
    if not len(rows) or not len(filters):
        return rows.iloc[:0].drop(columns=["shard", "salt"])
    held = CuckooFilter.from_bytes(filters["slots"].iloc[0], int(filters["live"].iloc[0]))
    return rows[held.contains(rows["h1"].to_numpy())].drop(columns=["shard", "salt"])


class LineIndex:
    """Lines of the documents inserted so far, with those that at least ``min_docs`` documents hold.

    Three tables, written to the shared scratch folder: references (one row per document and line key), exact reference
    counts per key, and one cuckoo filter per shard over the repeated keys, which spares most references the exact
    look-up. Inserting and deleting documents recounts only the keys they touch and adds to or removes from the filters
    the keys that became or ceased to be repeated, so a deletion undoes an insertion. A shard without room is built anew
    from the exact counts.

    Counts are of distinct doc_ids. Rows of one doc_id are one document, each row with its own text; repeated rows count
    once. Rows without a doc_id are not indexed and keep all lines.
    """

    def __init__(
        self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS
    ):
        self.spark, self.min_chars, self.min_docs, self.shard_keys = spark, min_chars, min_docs, shard_keys
        self.references = spark.createDataFrame([], REFERENCES)
        self.counts = spark.createDataFrame([], "h1 bigint, h2 bigint, refs bigint, keeper bigint")
        self.filters = spark.createDataFrame([], FILTERS)
        self.shards, self.empty = 1, True

    def insert(self, docs: DataFrame) -> None:
        """Add documents (doc_id, text; other columns are ignored)."""
        new = references(docs, self.min_chars)
        if self.empty:
            self.references = staged(new, "references")
            self._recount(None)
        else:
            new = staged(new.join(self.references, ["doc_id", "body", "h1", "h2"], "left_anti").select(new.columns), "new")
            self.references = self.references.unionByName(new)
            self._recount(new)
        self.empty = False

    def delete(self, doc_ids: DataFrame) -> None:
        """Take documents out again, by their doc_id."""
        gone = doc_ids.select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
        old = staged(self.references.join(gone, "doc_id", "left_semi").select(self.references.columns), "gone")
        self.references = staged(
            self.references.join(gone, "doc_id", "left_anti").select(self.references.columns), "references"
        )
        self._recount(old)

    def _recount(self, touched: DataFrame | None) -> None:
        before = self.counts
        if touched is None:
            self.counts = staged(_counted(self.references), "counts")
        else:
            keys = touched.select("h1", "h2").distinct()
            fresh = _counted(self.references.join(keys, ["h1", "h2"], "left_semi"))
            self.counts = staged(before.join(keys, ["h1", "h2"], "left_anti").unionByName(fresh), "counts")
        total = self.repeated().count()
        shards = max(1, -(-total // self.shard_keys))
        if touched is None or shards > 2 * self.shards:
            self.shards = shards
            self.filters = self._all_filters(self.repeated())
            return
        was = before.where(F.col("refs") >= self.min_docs).select("h1", "h2")
        now = self.repeated().select("h1", "h2")
        changes = now.join(was, ["h1", "h2"], "left_anti").withColumn("repeated", F.lit(True))
        changes = changes.unionAll(was.join(now, ["h1", "h2"], "left_anti").withColumn("repeated", F.lit(False)))
        changes = changes.withColumn("shard", self._shard()).groupBy("shard")
        updated = staged(changes.cogroup(self.filters.groupBy("shard")).applyInPandas(_updated, FILTERS), "filters")
        full = updated.where("slots is null").select("shard")
        anew = self._all_filters(self.repeated(), full)
        self.filters = staged(updated.where("slots is not null").unionByName(anew), "filters")

    def _shard(self):
        return F.pmod("h1", F.lit(self.shards)).cast("int")

    def _all_filters(self, keys: DataFrame, only: DataFrame | None = None) -> DataFrame:
        keys = keys.select("h1", self._shard().alias("shard"))
        if only is not None:
            keys = keys.join(only, "shard", "left_semi")
        return staged(keys.groupBy("shard").applyInPandas(_built, FILTERS), "filters")

    def repeated(self) -> DataFrame:
        """Repeated keys (h1, h2), how many documents hold them, and the document that keeps its lines."""
        return self.counts.where(F.col("refs") >= self.min_docs)

    def drops(self) -> DataFrame:
        """doc_id, body (hash of the row's text) and the places of the lines that go.

        References meet the filter of their shard in groups by shard and document, so that the references to one very
        common line are spread out. What passes is joined with the exact counts.
        """
        salts = max(1, -(-self.references.count() // (GROUP_ROWS * self.shards)))
        rows = self.references.withColumn("shard", self._shard())
        rows = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int"))
        every = self.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        passed = rows.groupBy("shard", "salt").cogroup(every.groupBy("shard", "salt")).applyInPandas(_passed, REFERENCES)
        gone = passed.join(self.repeated(), ["h1", "h2"]).where("doc_id < keeper")
        places = gone.select("doc_id", "body", F.explode("places").alias("place")).distinct()
        return places.groupBy("doc_id", "body").agg(F.collect_list("place").alias("places"))

    def _marked(self, docs: DataFrame) -> tuple[DataFrame, str, str]:
        """``docs`` with the doc_id as a number and the places of the lines that go, and the names of these two columns."""
        number, key, gone = (unused(n, docs.columns) for n in ("marked_id", "marked_body", "marked_places"))
        rows = docs.withColumns({number: F.col("doc_id").cast("bigint"), key: body()})
        return rows.join(self.drops().toDF(number, key, gone), [number, key], "left"), number, gone

    def clean(self, docs: DataFrame) -> DataFrame:
        """Indexed documents without their repeated lines, in all their columns; n_chars, if there is one, is set anew.

        A null text stays null, and a text of which all lines went is empty.
        """
        columns = docs.columns
        marked, _, gone = self._marked(docs)

        def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                texts = part.column("text").cast(pa.large_binary()).to_pylist()
                kept = []
                for text, places in zip(texts, part.column(gone)):
                    places = places.as_py()
                    kept.append(text if text is None or not places else _without(text, places)[0])
                kept = pa.array(kept, pa.large_binary()).cast(pa.large_string()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(
                    [kept if c == "text" else part.column(c) for c in columns], names=columns
                )

        out = marked.select(*columns, gone).mapInArrow(batches, docs.schema)
        return out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType)) if "n_chars" in columns else out

    def digests(self, docs: DataFrame) -> DataFrame:
        """doc_id, n_lines, n_dropped and the SHA-256 of what is left, for every row; a null text is one empty line."""
        marked, number, gone = self._marked(docs)

        def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part in parts:
                rows = []
                texts = part.column(1).cast(pa.large_binary())
                for doc, text, places in zip(part.column(0).to_pylist(), texts, part.column(2)):
                    places = places.as_py() or []
                    kept, lines = _without(text.as_py() or b"", places)
                    rows.append((doc, lines, len(places), hashlib.sha256(kept).hexdigest()))
                columns = zip(*rows) if rows else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, DIGESTS.types)], schema=DIGESTS)

        return marked.select(F.col(number).alias("doc_id"), F.col("text").cast("string"), gone).mapInArrow(
            batches, "doc_id bigint, n_lines bigint, n_dropped bigint, kept_sha256 string"
        )


DIGESTS = pa.schema(
    [("doc_id", pa.int64()), ("n_lines", pa.int64()), ("n_dropped", pa.int64()), ("kept_sha256", pa.string())]
)


def _without(text: bytes, places: list[int]) -> tuple[bytes, int]:
    """The text without the lines at ``places``, and how many lines it had."""
    if not places:
        return text, text.count(b"\n") + 1
    gone, lines = set(places), text.split(b"\n")
    return b"\n".join(line for place, line in enumerate(lines) if place not in gone), len(lines)


def without_repeated_lines(docs: DataFrame, **options) -> DataFrame:
    """The documents without the lines that many of them share, except in the largest doc_id that holds them."""
    index = LineIndex(docs.sparkSession, **options)
    index.insert(docs)
    return index.clean(docs)
