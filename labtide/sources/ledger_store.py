"""The ledger of reported ids in hash buckets, each with Bloom filters, so that a batch reads the buckets it may be in.

``log/bucket=B/batch=N`` holds the marks that a batch added and ``filters/bucket=B/batch=N`` a filter of their ids. Compaction
writes all marks up to a batch as one version beside the log and moves a pointer last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.operators import matching
from labtide.session import scratch_dir
from labtide.sources import readers, writers
from labtide.sources.versions import Pointer

BUCKETS = 256
PROBES = 7
BITS_PER_ID = 10
WORD = 64
KEY, BUCKET, BATCH = "report_id", "bucket", "batch"
FILTERS = "bits array<bigint>, bucket int, batch bigint"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _place(key: Column, probe: int, bits: Column) -> Column:
    """The bit that a key sets for a probe, in a filter of so many bits."""
    return F.pmod(F.xxhash64(key, F.lit(probe)), bits.cast("bigint"))


def might_hold(filter_bits: Column, key: Column) -> Column:
    """Whether a filter may hold a key: false is certain, true is not."""
    size = F.size(filter_bits) * WORD
    tests = []
    for probe in range(PROBES):
        at = _place(key, probe, size)
        word = F.get(filter_bits, F.call_function("div", at, F.lit(WORD)).cast("int"))
        tests.append(F.getbit(word, F.pmod(at, F.lit(WORD)).cast("int")) == 1)
    return reduce(lambda a, b: a & b, tests)


def filters_of(ids: DataFrame) -> DataFrame:
    """One filter per bucket and batch over ``ids`` (report_id, bucket, batch): its bits as words of 64.

    The words follow the ids of the fullest bucket, at ``BITS_PER_ID`` bits each: about one id in a hundred that it does not
    hold passes. All words of a filter are rows until they are put in order, so a bucket is never gathered by id.
    """
    most = ids.groupBy(BUCKET, BATCH).count().agg(F.max("count")).first()[0] or 0
    words = max(1, -(-most * BITS_PER_ID // WORD))
    probes = F.explode(F.array(*[_place(F.col(KEY), p, F.lit(words * WORD)) for p in range(PROBES)]))
    bits = ids.select(BUCKET, BATCH, probes.alias("at")).select(
        BUCKET, BATCH, F.expr(f"at div {WORD}").cast("int").alias("word"), F.expr(f"shiftleft(1L, cast(at % {WORD} AS int))").alias("bit")
    )
    every = ids.select(BUCKET, BATCH).distinct().select(
        BUCKET, BATCH, F.explode(F.sequence(F.lit(0), F.lit(words - 1))).alias("word"), F.lit(0).cast("bigint").alias("bit")
    )
    by_word = bits.unionByName(every).groupBy(BUCKET, BATCH, "word").agg(F.bit_or("bit").alias("bit"))
    packed = F.transform(F.array_sort(F.collect_list(F.struct("word", "bit"))), lambda w: w["bit"])
    return by_word.groupBy(BUCKET, BATCH).agg(packed.alias("bits"))


class LedgerStore:
    """A ledger with one row per report id. ``schema`` is that of its rows; the number of buckets is fixed for its life."""

    def __init__(self, spark: SparkSession, path: str, schema: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.schema = f"{schema}, {BUCKET} int, {BATCH} bigint"
        self.pointer = Pointer(spark, self.path)
        #: Buckets whose marks the last ``add`` has read, and those its rows fall into.
        self.read_buckets: list[int] = []
        self.own_buckets: list[int] = []

    def _log(self, batch_after: int) -> DataFrame:
        return readers.empty_or(self.spark, f"{self.path}/log", self.schema).where(F.col(BATCH) > batch_after)

    def _marks(self) -> DataFrame:
        version, upto = self.pointer.current()
        if not version:
            return self._log(-1)
        whole = readers.empty_or(self.spark, f"{self.path}/whole/v={version}", self.schema)
        return whole.unionByName(self._log(upto))

    def rows(self) -> DataFrame:
        """All marks."""
        return self._marks().drop(BUCKET, BATCH)

    def _filters(self) -> DataFrame:
        version, upto = self.pointer.current()
        log = readers.empty_or(self.spark, f"{self.path}/filters", FILTERS).where(F.col(BATCH) > upto)
        if not version:
            return log
        return log.unionByName(readers.empty_or(self.spark, f"{self.path}/whole_filters/v={version}", FILTERS))

    def _fresh(self, rows: DataFrame, batch: int) -> DataFrame:
        own = rows.where(F.col(KEY).isNotNull()).dropDuplicates([KEY]).withColumn(BUCKET, bucket_of(F.col(KEY), self.buckets))
        own = writers.kept(own, scratch_dir(self.spark, "ledger-batch"))
        self.own_buckets, self.read_buckets = self._distinct(own), []
        if not self.own_buckets:
            return own
        here = F.col(BUCKET).isin(self.own_buckets)
        filters = self._filters().where(here & (F.col(BATCH) != batch)).select(F.col(BUCKET).alias("of_bucket"), "bits")
        passing = (F.col(BUCKET) == F.col("of_bucket")) & might_hold(F.col("bits"), F.col(KEY))
        maybe = writers.kept(own.join(filters, passing, "left_semi").select(KEY, BUCKET), scratch_dir(self.spark, "ledger-maybe"))
        self.read_buckets = self._distinct(maybe)
        if not self.read_buckets:
            return own
        known = self._marks().where(F.col(BUCKET).isin(self.read_buckets) & (F.col(BATCH) != batch)).select(KEY)
        return matching.absent(own, known, {KEY: KEY})

    def fresh(self, rows: DataFrame, batch: int = -2) -> DataFrame:
        """One row for each id of ``rows`` that the ledger does not hold, apart from what ``batch`` has added.

        Filters are read for the buckets that the ids fall into; marks only for buckets where a filter lets an id through.
        What comes to the driver is two lists of buckets.
        """
        return self._fresh(rows, batch).drop(BUCKET)

    def add(self, rows: DataFrame, batch: int) -> DataFrame:
        """Add the rows whose ids the ledger does not hold, and return them. Rows without an id are left out.

        A batch compares against the others only and owns its partitions, so a batch that comes again writes the same rows in
        the same places. Of rows with the same id any one is taken. Reads are those of ``fresh``.
        """
        added = self._fresh(rows, batch).withColumn(BATCH, F.lit(batch).cast("bigint"))
        added = writers.kept(added, scratch_dir(self.spark, "ledger-added"))
        self._write(filters_of(added.select(KEY, BUCKET, BATCH)), "filters")
        self._write(added, "log")
        return added.drop(BUCKET, BATCH)

    def _distinct(self, rows: DataFrame) -> list[int]:
        return sorted(r[BUCKET] for r in rows.select(BUCKET).distinct().collect())

    def _write(self, rows: DataFrame, part: str) -> None:
        """Replace the partitions of the rows' buckets and batches, and no others."""
        writer = rows.repartition(BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(BUCKET, BATCH).parquet(f"{self.path}/{part}")

    def compact(self, upto: int) -> int:
        """Put all marks of batches up to ``upto`` together, with one filter a bucket; gives the new version.

        No batch up to ``upto`` may come again. Files of the log that a version covers are not read any more.
        """
        version, before = self.pointer.current()
        if upto <= before:
            return version
        whole = self._marks().where(F.col(BATCH) <= upto).withColumn(BATCH, F.lit(-1).cast("bigint"))
        target = f"{self.path}/whole/v={version + 1}"
        whole.repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
        kept = readers.empty_or(self.spark, target, self.schema)
        filters_of(kept.select(KEY, BUCKET, BATCH)).repartition(BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(
            f"{self.path}/whole_filters/v={version + 1}"
        )
        self.pointer.move(version + 1, upto)
        return version + 1
