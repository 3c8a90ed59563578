"""Cleansing of all-text region files: row gates, dates, phones and zips, for every region in one job."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labtide.config.settings import COMPACT_DATE_REGIONS, DIALECTS, PLAIN_PHONE_REGIONS, Dialect
from labtide.functions import text
from labtide.operators import columns, quality
from labtide.operators.rules import Rule, filled_values
from labtide.plans import template

BAD_PHONE = "bad_phone"


def gate(df: DataFrame, *, region: str = "state", min_values: int = 7) -> DataFrame:
    """Rows with accession values and at least ``min_values`` values, once each. The region tag does not count."""
    rows = quality.require(df, "accession")
    # dropna(thresh=...) counts the region tag too, and it is never null
    return quality.at_least(rows, min_values + 1).dropDuplicates()


def fix_dates(df: DataFrame, region: str = "state") -> DataFrame:
    here = F.col(region)
    fmt = F.when(here.isin(*COMPACT_DATE_REGIONS), "yyyyMMdd").otherwise("MM/dd/yyyy")
    names = [c for c in template.date_columns(df) if c != region]
    plain = template.date_columns(df, "WV")
    untouched = {f"__{c}": F.col(f"`{c}`") for c in names if c not in plain}
    fixed = template.format_dates(df.withColumns(untouched) if untouched else df, fmt, names)
    restored = {
        c: F.when(here == "WV", F.col(f"`__{c}`")).otherwise(F.col(f"`{c}`")) for c in names if c not in plain
    }
    return fixed.withColumns(restored).drop(*untouched) if restored else fixed


def _repaired_phones(df: DataFrame, region: str, pad: bool) -> dict[str, Column]:
    """For each phone column, one structure of its repaired value and whether that failed. KS is not looked at."""
    here = F.col(region)
    separator = F.when(here.isin(*PLAIN_PHONE_REGIONS), F.lit("")).otherwise(F.lit("-"))
    out = {}
    for name in columns.search(df.drop(BAD_PHONE), "phone"):
        out[name] = F.when(here != "KS", text.repaired_phone(F.col(f"`{name}`"), separator, pad=pad))
    return out


def fix_phones(df: DataFrame, region: str = "state", *, pad: bool = False) -> DataFrame:
    """Repaired phones and a ``bad_phone`` flag for rows to look at. KS files are left alone."""
    found = _repaired_phones(df, region, pad)
    if not found:
        return df.withColumn(BAD_PHONE, F.lit(False))
    both = df.withColumns({f"__{name}": c for name, c in found.items()})
    broken = {name: F.coalesce(F.col(f"`__{name}`")["broken"], F.lit(False)) for name in found}
    bad = F.lit(False)
    for flag in broken.values():
        bad = bad | flag
    kept = {n: F.when(F.col(f"`__{n}`").isNull() | broken[n], F.col(f"`{n}`")).otherwise(F.col(f"`__{n}`")["value"]) for n in found}
    return both.withColumns({**kept, BAD_PHONE: bad}).drop(*[f"__{name}" for name in found])


def bad_phone(df: DataFrame, region: str = "state", *, pad: bool = False) -> Column:
    """Whether a row has a phone that cannot be repaired. Those of KS are not looked at."""
    bad = F.lit(False)
    for found in _repaired_phones(df, region, pad).values():
        bad = bad | F.coalesce(found["broken"], F.lit(False))
    return bad


def export_rules(df: DataFrame, region: str, accession: str, *, min_values: int = 7) -> list[Rule]:
    """Why a row of the export is held back: no accession number, a phone nobody can call, or hardly any values."""
    return [
        Rule("no_accession", F.col(f"`{accession}`").isNull()),
        Rule("bad_phone", bad_phone(df, region)),
        Rule("few_values", filled_values(df, [region]) < min_values),
    ]


def fix_zips(df: DataFrame, region: str = "state") -> DataFrame:
    zips = columns.search(df, "zip")
    return df.withColumns({z: text.zip_repair(F.col(f"`{z}`"), region) for z in zips}) if zips else df


def flagged(df: DataFrame, region: str = "state", *, pad: bool = False) -> DataFrame:
    """Cleansed rows with the ``bad_phone`` flag, in one pass. Write this once when both parts are needed.

    Eight-digit phones are flagged, or completed with a 0 with ``pad``.
    """
    return repaired(gate(df, region=region), region, pad=pad)


def repaired(df: DataFrame, region: str = "state", *, pad: bool = False) -> DataFrame:
    """Dates, phones and zips in the region's form, with the ``bad_phone`` flag; rows stay as they are, without a shuffle."""
    return fix_zips(fix_phones(fix_dates(df, region), region, pad=pad), region)


def cleanse(df: DataFrame, region: str = "state") -> tuple[DataFrame, DataFrame]:
    """(clean rows, rows with a phone that cannot be repaired)."""
    good, bad = quality.split_bad(flagged(df, region), F.col(BAD_PHONE))
    return good.drop(BAD_PHONE), bad.drop(BAD_PHONE)


def dialect_of(region: str) -> Dialect:
    return DIALECTS.get(region, Dialect())
