"""Tables that are replaced or updated as a whole: versions beside each other, and a pointer that is moved last."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.operators import dedup
from labtide.sources import readers

POINTER = "version bigint, upto bigint, moved_at timestamp"


class Pointer:
    """The current version of a table, and up to which batch it covers what is logged beside it.

    Moving it appends one small file, so readers see the old or the new version, never half of one; the largest counts.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, f"{path.rstrip('/')}/pointer"

    def current(self) -> tuple[int, int]:
        """(version, upto); (0, -1) before the first."""
        rows = readers.empty_or(self.spark, self.path, POINTER)
        row = rows.orderBy(F.desc("version")).first()
        return (0, -1) if row is None else (row.version, row.upto)

    def move(self, version: int, upto: int = -1) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(version).cast("bigint").alias("version"), F.lit(upto).cast("bigint").alias("upto"), F.current_timestamp().alias("moved_at")
        )
        row.write.mode("append").parquet(self.path)


class VersionedTable:
    """A table with one row per ``key``. Readers of a version keep it while later ones are written.

    Of rows with the same key that wins which comes last by ``newest`` (columns in falling weight, nulls lose), then by the hash
    of the whole row: which one does not depend on the order in which they came. Rows without a key are left out.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, newest: Sequence[str]):
        self.spark, self.path, self.key, self.newest = spark, path.rstrip("/"), key, [*newest]
        self.pointer = Pointer(spark, self.path)

    def version(self) -> int:
        return self.pointer.current()[0]

    def read(self, version: int | None = None) -> DataFrame:
        """The current version, or an older one that is still there."""
        number = self.version() if version is None else version
        if not number:
            raise ValueError(f"{self.path} has no version yet")
        return self.spark.read.parquet(f"{self.path}/v={number}")

    def replace(self, rows: DataFrame) -> int:
        """Make ``rows`` the next version. One that was written but not pointed at is overwritten."""
        number = self.version() + 1
        rows.write.mode("overwrite").parquet(f"{self.path}/v={number}")
        self.pointer.move(number)
        return number

    def upsert(self, rows: DataFrame) -> int:
        """The next version: the winning row of every key among the current version and ``rows``."""
        both = rows
        if self.version():
            both = self.read().unionByName(rows, allowMissingColumns=True)
        order = [F.col(c).desc_nulls_last() for c in self.newest] + [F.xxhash64(*both.columns).desc()]
        return self.replace(dedup.top_per_key(both.where(F.col(self.key).isNotNull()), [self.key], order))
