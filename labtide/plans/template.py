"""Template-driven column mapping: a region's output columns picked from the export by catalogue number.

The template is configuration (at most a few hundred rows) and becomes a select list, so the data is never transposed.
"""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from importlib.resources import files

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labtide.config.settings import SPLIT_PHONE_REGIONS
from labtide.functions import text, time
from labtide.operators import columns


@dataclass(frozen=True)
class Template:
    """One region's output: ordered (column, catalogue number) pairs, phone layout and date format."""

    region: str
    fields: tuple[tuple[str, int | None], ...]
    phone_layout: str
    date_format: str


def read_catalogue(spark: SparkSession, path: str) -> dict[int, str]:
    """Catalogue number to export column."""
    rows = spark.read.csv(path, header=True, comment="#", schema="name string, colid int").collect()
    return {r.colid: r.name for r in rows}


def read_templates(spark: SparkSession, path: str) -> DataFrame:
    """Templates of a folder as one table; the region is the first part of the file name."""
    schema = "column_name string, colid int, phoneform string, dateform string"
    rows = spark.read.csv(path, header=True, comment="#", schema=schema, pathGlobFilter="*_template.csv")
    return rows.select(
        F.upper(F.regexp_extract("_metadata.file_name", r"^([^_.]+)", 1)).alias("region"),
        F.monotonically_increasing_id().alias("position"),
        "*",
    )


def load_templates(spark: SparkSession, path: str) -> dict[str, Template]:
    """Templates of a folder by region."""
    return templates_of(read_templates(spark, path))


def templates_of(table: DataFrame) -> dict[str, Template]:
    """Templates of a stored template table. Formats are taken from the first row that has them."""
    grouped: dict[str, list] = {}
    for row in table.orderBy("region", "position").collect():
        grouped.setdefault(row.region, []).append(row)
    return {region: _template(region, [r.asDict() for r in rows]) for region, rows in grouped.items()}


def _template(region: str, rows: list[dict]) -> Template:
    return Template(
        region,
        tuple((r["column_name"], None if r["colid"] in (None, "") else int(r["colid"])) for r in rows),
        next(r["phoneform"] for r in rows if r["phoneform"]),
        spark_date_format(next(r["dateform"] for r in rows if r["dateform"])),
    )


def _packaged_rows(name: str) -> list[dict]:
    with (files("labtide.config") / "templates" / name).open(encoding="utf-8") as lines:
        return list(csv.DictReader(line for line in lines if not line.startswith("#")))


def packaged_catalogue() -> dict[int, str]:
    """The catalogue that comes with the package. It is read by the driver, so executors need not see the package."""
    return {int(r["colid"]): r["name"] for r in _packaged_rows("catalogue.csv")}


def packaged_template(region: str) -> Template:
    """A region's template that comes with the package, read by the driver."""
    return _template(region, _packaged_rows(f"{region.lower()}_template.csv"))


# Date codes used in template files and their Spark letters.
DATE_CODES = {"%Y": "yyyy", "%m": "MM", "%d": "dd", "%H": "HH", "%M": "mm", "%S": "ss"}


def spark_date_format(fmt: str) -> str:
    for code, letters in DATE_CODES.items():
        fmt = fmt.replace(code, letters)
    return fmt


def template_select(
    export: DataFrame, template: Template, catalogue: Mapping[int, str], *, strict: bool = False, keep: tuple[str, ...] = ()
) -> DataFrame:
    """The template's columns in its order.

    A number without a catalogue entry, or an entry the export lacks, gives an empty column; ``strict`` leaves out the
    former. One export column may feed several outputs. Single blanks become null.
    """
    picked: list[Column] = [F.col(f"`{k}`") for k in keep]
    for name, colid in template.fields:
        source = catalogue.get(colid)
        if source is None and strict:
            continue
        if source is None or source not in export.columns:
            picked.append(F.lit(None).cast("string").alias(name))
        elif isinstance(export.schema[source].dataType, T.StringType):
            picked.append(text.blank_to_null(F.col(f"`{source}`")).alias(name))
        else:
            picked.append(F.col(f"`{source}`").alias(name))
    return export.select(*picked)


def date_columns(df: DataFrame, region: str | None = None) -> list[str]:
    """Columns whose name marks a date; for WV the letters "dt" alone do not."""
    return columns.search(df, ["date", "dob"] if region == "WV" else ["date", "dt", "dob"])


def format_dates(df: DataFrame, fmt: Column | str, names: list[str]) -> DataFrame:
    """Dates of any readable form in the wanted format; a name with "time" in it also shows hours and minutes."""
    changed = {}
    for name in names:
        source = F.col(f"`{name}`")
        if isinstance(df.schema[name].dataType, T.StringType):
            source = time.parse_text(source)
        else:
            source = source.cast("timestamp_ntz")
        changed[name] = _shown(source, fmt, "time" in name.lower())
    return df.withColumns(changed) if changed else df


def _shown(ts: Column, fmt: Column | str, with_time: bool) -> Column:
    suffix = " HH:mm" if with_time else ""
    if isinstance(fmt, str):
        return F.date_format(ts, fmt + suffix)
    return F.call_function("date_format", ts, F.concat(fmt, F.lit(suffix)))


def reformat(df: DataFrame, template: Template, *, default_phone: str, as_of) -> DataFrame:
    """Phones, area codes, race and ethnicity, dates and region extras, in that order."""
    region = template.region
    phones = columns.search(df, "phone")
    df = df.withColumns({p: text.phone_format(F.col(f"`{p}`"), template.phone_layout, default_phone) for p in phones})
    if region in SPLIT_PHONE_REGIONS:
        areas = columns.search(df, "area_code")
        df = columns.copy_group(df, areas, phones)
        df = df.withColumns({a: text.area_code(F.col(f"`{a}`")) for a in areas})
        df = df.withColumns({p: text.without_area_code(F.col(f"`{p}`")) for p in phones})
    race, ethnicity = columns.search(df, "race"), columns.search(df, "ethnicity")
    if race and ethnicity:
        df = df.withColumn(race[0], text.race_code(F.col(f"`{race[0]}`")))
        df = df.withColumn(ethnicity[0], text.ethnicity_code(F.col(f"`{race[0]}`"), region))
    df = format_dates(df, template.date_format, date_columns(df, region))
    extras = REGION_EXTRAS.get(region)
    return df.withColumns(extras(time.ntz(as_of))) if extras else df


# Columns that single regions add or overwrite.
REGION_EXTRAS: dict[str, Callable[[Column], dict[str, Column]]] = {
    "MO": lambda now: {"Specimen_Source": F.lit("OT")},
    "OK": lambda now: {
        "File_created_date": F.date_format(now, "MM/dd/yyyy"),
        "flatfile_version_no": F.date_format(now, "'V'yyyy-MM-dd'_Results'"),
        "Patient_ID_type": F.lit("Patient Internal"),
    },
}


def transform(
    export: DataFrame, template: Template, catalogue: Mapping[int, str], *, default_phone: str, as_of, strict: bool = False,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """A region's finished columns from its finished export rows."""
    rows = template_select(export, template, catalogue, strict=strict, keep=keep)
    return reformat(rows, template, default_phone=default_phone, as_of=as_of)
