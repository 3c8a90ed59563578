"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MEGABYTE = 1 << 20
UNKNOWN = 1 << 60

# Names of the zone without offset.
UTC_NAMES = "UTC Etc/UTC UCT Etc/UCT Universal Etc/Universal Zulu Etc/Zulu GMT Etc/GMT Greenwich Z +00:00".split()
CHECKPOINT_CONF = "spark.checkpoint.dir"
SHUFFLE_CONF = "spark.sql.shuffle.partitions"


def build_session(app: str = "labtide", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume; ``conf`` (dots as ``__``) overrides any of them.

    ``sized`` sets the number of shuffle partitions from the data a run reads; AQE then merges the small ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def require_utc(spark: SparkSession) -> SparkSession:
    """Refuse a session time zone with an offset: timestamps are UTC wall times, and clock changes would bend durations."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in UTC_NAMES:
        raise ValueError(f"spark.sql.session.timeZone must be UTC, not {zone}")
    return spark


def scan_bytes(*frames: DataFrame) -> int:
    """Bytes of the files and relations that the frames read, from plan statistics; nothing is run."""
    total = 0
    for frame in frames:
        leaves = frame._jdf.queryExecution().optimizedPlan().collectLeaves()
        sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
        total += sum(size for size in sizes if size < UNKNOWN)
    return total


def size_for(spark: SparkSession, *frames: DataFrame, target: int = 200 * MEGABYTE) -> int:
    """Shuffle partitions for a run over ``frames``: about ``target`` bytes each, at least one per core.

    AQE merges what turns out small, so the number may be generous; too few partitions would spill. Relations whose size
    Spark does not know do not count.
    """
    return max(spark.sparkContext.defaultParallelism, -(-scan_bytes(*frames) // target))


@contextmanager
def sized(spark: SparkSession, *frames: DataFrame) -> Iterator[SparkSession]:
    """The session with ``size_for(frames)`` shuffle partitions; afterwards it has its own number again."""
    before = spark.conf.get(SHUFFLE_CONF)
    spark.conf.set(SHUFFLE_CONF, str(size_for(spark, *frames)))
    try:
        yield spark
    finally:
        spark.conf.set(SHUFFLE_CONF, before)


def scratch_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors do not share one.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="labtide-")
    spark.conf.set(CHECKPOINT_CONF, root)
    return root


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared scratch root."""
    return os.path.join(scratch_root(spark), f"{label}-{uuid.uuid4().hex}")
