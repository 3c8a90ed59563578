"""Writers: dashboards, region files in their dialects, ledger, delivery log and watermark."""

from __future__ import annotations

import csv
import datetime as dt
import io
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labtide.config.settings import DIALECTS, Dialect, FileNames
from labtide.functions import time
from labtide.operators import matching
from labtide.session import scratch_dir
from labtide.sources import readers


def publish(
    df: DataFrame,
    path: str,
    *,
    fmt: str = "parquet",
    header: bool = True,
    by: str | None = None,
    sort: Sequence[str] = (),
) -> None:
    """Replace a dashboard's data. ``by`` writes one folder per segment; ``sort`` orders the rows of each file."""
    rows = df.hint("rebalance", by) if by else df
    if sort:
        rows = rows.sortWithinPartitions(*([by] if by else []), *sort)
    writer = rows.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", header)
    (writer.partitionBy(by) if by else writer).save(path)


def kept(df: DataFrame, path: str) -> DataFrame:
    """The frame, written once and read back, for use by more than one step."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def replace_table(df: DataFrame, base: str, version: str) -> str:
    """Write a new version of a table beside the old one, so that a plan may read the old one meanwhile."""
    path = f"{base.rstrip('/')}/{version}"
    df.write.mode("overwrite").parquet(path)
    return path


def replace_bucketed(df: DataFrame, name: str, path: str, key: str, buckets: int) -> None:
    """Write a catalog table bucketed and sorted by ``key``.

    Tables that meet on one key every day (reports, samples, kits) then join and group without an exchange. A bucket
    is one task, so this is for keys with few rows each; AQE cannot split a hot key in a bucketed join.
    """
    df.write.mode("overwrite").option("path", path).bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def stage(df: DataFrame, path: str, *, region: str = "file_state") -> DataFrame:
    """Write rows once, one partition per region, and read them back: later steps prune to the regions they need."""
    df.hint("rebalance", region).write.mode("overwrite").partitionBy(region).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


ROWS_PER_FILE = 1_000_000
FILE = "file"
LINE_KEY, LINE, HEADER = "__key", "value", "__header"


def header_line(names: Sequence[str], dialect: Dialect) -> str:
    """The first line of a file, quoted as its rows are."""
    line = io.StringIO()
    csv.writer(line, delimiter=dialect.sep, lineterminator="").writerow(names)
    return line.getvalue()


def _line_columns(df: DataFrame, dialect: Dialect, region: str, key: str) -> tuple[Column, Column]:
    """(a row as a line, the header of its file or null). ``region`` and ``key`` are not part of it; values keep their blanks."""
    shown = [c for c in df.columns if c not in (region, key)]
    options = {
        "sep": dialect.sep,
        "timestampNTZFormat": "MM/dd/yyyy HH:mm",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    }
    header = F.lit(header_line(shown, dialect)) if dialect.header else F.lit(None).cast("string")
    return F.to_csv(F.struct(*[F.col(f"`{c}`") for c in shown]), options), header


def lines(df: DataFrame, *, region: str = "file_state", key: str = "report_id") -> DataFrame:
    """Each row as one line of its region's file, in that region's dialect: region, key, line, header of the file.

    All regions come from one scan: a row takes the separator of its region. Rows that lack a value their region asks for
    are left out.
    """
    here, rows = F.col(region), df
    groups: dict[Dialect, list[str]] = {}
    for code, dialect in DIALECTS.items():
        groups.setdefault(dialect, []).append(code)
    value, header = F, F
    for dialect, codes in groups.items():
        for name in dialect.required:
            if name in df.columns:
                rows = rows.where(~here.isin(*codes) | F.col(f"`{name}`").isNotNull())
        text, first = _line_columns(df, dialect, region, key)
        value, header = value.when(here.isin(*codes), text), header.when(here.isin(*codes), first)
    text, first = _line_columns(df, Dialect(), region, key)
    return rows.select(
        region, F.col(key).cast("string").alias(LINE_KEY), value.otherwise(text).alias(LINE), header.otherwise(first).alias(HEADER)
    )


def region_files(
    rows: DataFrame, path: str, *, region: str = "file_state", rows_per_file: int = ROWS_PER_FILE, staged: bool = False
) -> dict[str, int]:
    """Write ``lines`` of all regions in one job; gives the number of files of each region.

    A region's folder holds one file, or several for a region of many rows, dealt by row: each is a whole file with a header of
    its own. So a region that holds most of the rows is written by many tasks. Rows of a file are ordered, so that
    a repeated run writes the same files. What comes back to the driver is a count for each region. No rows, no files.
    The lines are written once first, since the number of files follows their counts, and what they are made from is not to be
    worked out twice; lines over rows that are ``staged`` in files are not, as only their regions are read to count them.
    """
    spark = rows.sparkSession
    rows = rows if staged else kept(rows, scratch_dir(spark, "region-lines"))
    counted = rows.groupBy(region).agg(F.count(F.lit(1)).alias("n"), F.max(HEADER).alias(HEADER)).collect()
    files = {r[region]: -(-r["n"] // rows_per_file) for r in counted}
    if not files:
        spark.createDataFrame([], f"{LINE} string, {region} string, {FILE} int").write.mode("overwrite").partitionBy(region, FILE).text(path)
        return files
    many = F
    for code, n in files.items():
        if n > 1:
            many = many.when(F.col(region) == code, F.lit(n))
    number = F.lit(0) if many is F else F.pmod(F.xxhash64(LINE_KEY, LINE), many.otherwise(F.lit(1)).cast("bigint")).cast("int")
    dealt = rows.select(region, number.alias(FILE), F.lit(1).alias("place"), LINE_KEY, LINE)
    heads = [(r[region], files[r[region]], r[HEADER]) for r in counted if r[HEADER] is not None]
    if heads:
        firsts = spark.createDataFrame(heads, f"{region} string, files int, {LINE} string")
        numbers = F.explode(F.sequence(F.lit(0), F.col("files") - 1)).alias(FILE)
        firsts = firsts.select(region, numbers, LINE).select(region, FILE, F.lit(0).alias("place"), F.lit(None).cast("string").alias(LINE_KEY), LINE)
        dealt = dealt.unionByName(firsts)
    ordered = dealt.repartition(region, FILE).sortWithinPartitions(region, FILE, "place", LINE_KEY, LINE)
    ordered.select(LINE, region, FILE).write.mode("overwrite").partitionBy(region, FILE).text(path)
    return files


def out_name(region: Column, names: FileNames, day: dt.date) -> Column:
    """File name for the recipient of a region."""
    usual = F.concat(region, F.lit(f"_{day:%Y_%m_%d}.csv"))
    chain = None
    for code, pattern in names.by_region.items():
        text = F.lit(pattern.format(day=f"{day:%Y%m%d}", region=code))
        chain = (F if chain is None else chain).when(region == code, text)
    return usual if chain is None else chain.otherwise(usual)


def delivery_manifest(counts: DataFrame, names: FileNames, day: dt.date, region: str = "file_state") -> DataFrame:
    """What goes out: region, day, file name and rows."""
    return counts.where(F.col("n") > 0).select(
        F.col(region).alias("state"), F.lit(day).alias("day"), out_name(F.col(region), names, day).alias("file"), "n"
    )


DELIVERY_KEY = {"state": "state", "day": "day", "file": "file"}


def undelivered(manifest: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Manifest rows that the delivery log does not hold."""
    return matching.absent(manifest, deliveries, DELIVERY_KEY)


def append_new(spark: SparkSession, rows: DataFrame, path: str, key: str) -> None:
    """Append rows whose key the table does not hold yet; running it again appends nothing."""
    known = readers.empty_or(spark, path, rows.schema)
    fresh = matching.absent(rows.dropDuplicates([key]), known, {key: key})
    fresh.write.mode("append").parquet(path)


def log_deliveries(spark: SparkSession, manifest: DataFrame, path: str) -> None:
    known = readers.empty_or(spark, path, manifest.schema)
    undelivered(manifest, known).write.mode("append").parquet(path)


def write_watermark(spark: SparkSession, path: str, value, *, test_run: bool = False) -> None:
    """Record the end of a successful export; a test run leaves the watermark alone.

    Appending keeps the old value readable if the job dies half way; readers take the largest.
    """
    if not test_run:
        spark.range(1).select(time.ntz(value).alias("last_export")).write.mode("append").parquet(path)


def write_tables(frames: Iterable[tuple[str, DataFrame]], base: str) -> None:
    for name, frame in frames:
        frame.write.mode("overwrite").parquet(f"{base.rstrip('/')}/{name}")
