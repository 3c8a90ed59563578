"""Text expressions: names, phones, zips, categories and code maps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from labtide.functions.time import col


def full_name(first: Column | str, last: Column | str) -> Column:
    """First and last name joined by one space; a missing part counts as empty, so the result is never null."""
    return F.concat(F.coalesce(col(first), F.lit("")), F.lit(" "), F.coalesce(col(last), F.lit("")))


def before(c: Column | str, mark: str) -> Column:
    """The text before the first ``mark``."""
    return F.split_part(col(c), F.lit(mark), F.lit(1))


def digits(c: Column | str) -> Column:
    return F.regexp_replace(col(c), "[^0-9]", "")


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(" "))


def contains(c: Column | str, term: str) -> Column:
    """Case-sensitive substring test; null counts as no match."""
    return F.coalesce(F.contains(col(c), F.lit(term)), F.lit(False))


def last_match(c: Column | str, terms: Sequence[tuple[str, str]]) -> Column:
    """Label of the last listed term that the text contains; null when none does."""
    chain = None
    for term, label in reversed(terms):
        test = F.contains(col(c), F.lit(term))
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return chain


def map_values(c: Column | str, mapping: Mapping[str, str], default: Column | None = None) -> Column:
    """Replace known values; unknown ones keep their text unless ``default`` is given."""
    chain = None
    for key, value in mapping.items():
        test = col(c) == F.lit(key)
        chain = F.when(test, F.lit(value)) if chain is None else chain.when(test, F.lit(value))
    return chain.otherwise(col(c) if default is None else default)


def first_containing(arr: Column | str, term: str) -> Column:
    """First array element that contains ``term``; null when there is none."""
    return F.try_element_at(F.filter(col(arr), lambda x: F.contains(x, F.lit(term))), F.lit(1))


def phone_digits(c: Column | str) -> Column:
    """Digits of a phone without the leading country code 1."""
    return F.regexp_replace(digits(c), "^1(\\d{10})$", "$1")


# Phone layouts by name.
PHONE_LAYOUTS = {"dashes": "$1-$2-$3", "nodashes": "$1$2$3", "national": "($1) $2-$3"}


def phone_format(c: Column | str, layout: str, default: str | None = None) -> Column:
    """A ten-digit phone in one of the named layouts; a missing phone takes ``default``."""
    source = col(c) if default is None else F.coalesce(col(c), F.lit(default))
    return F.regexp_replace(phone_digits(source), "^(\\d{3})(\\d{3})(\\d{4})$", PHONE_LAYOUTS[layout])


def phone_repair(c: Column | str, separator: Column | str = "-", *, pad: bool = False) -> tuple[Column, Column]:
    """(repaired phone, needs-attention flag).

    Eleven digits lose a leading 1, else are cut to ten characters; eight digits are flagged, or get a 0 appended
    with ``pad``; fewer than eight or more than eleven digits, or text that does not group as 3-3-4, cannot be
    repaired and is flagged.
    """
    found = repaired_phone(c, separator, pad=pad)
    return found["value"], found["broken"]


def repaired_phone(c: Column | str, separator: Column | str = "-", *, pad: bool = False) -> Column:
    """Both results of ``phone_repair`` as one structure (value, broken).

    Each step is worked out once a phone: the next one takes it as the variable of a ``transform``.
    """
    split = F.struct(before(c, "/").alias("text"), digits(before(c, "/")).alias("digits"))
    mark = F.lit(separator) if isinstance(separator, str) else separator

    def grouped(phone: Column) -> Column:
        text, n = phone["text"], F.length(phone["digits"])
        fixed = (
            F.when((n == 11) & F.startswith(phone["digits"], F.lit("1")), F.substr(text, F.lit(2)))
            .when(n == 11, F.substring(text, 1, 10))
            .when(n == 8, F.concat(text, F.lit("0")) if pad else F.lit(None).cast("string"))
            .when((n < 8) | (n > 11), F.lit(None).cast("string"))
            .otherwise(text)
        )
        return F.regexp_extract_all(fixed, F.lit("(\\d{4}$|\\d{3})"), F.lit(1))

    def joined(groups: Column) -> Column:
        whole = F.size(groups) >= 3
        parts = [F.try_element_at(groups, F.lit(i)) for i in (1, 2, 3)]
        value = F.when(whole, F.concat(parts[0], mark, parts[1], mark, parts[2]))
        return F.struct(value.alias("value"), (col(c).isNotNull() & ~F.coalesce(whole, F.lit(False))).alias("broken"))

    return F.transform(F.transform(F.array(split), grouped), joined)[0]


def area_code(phone: Column | str) -> Column:
    return F.substring(col(phone), 1, 3)


def without_area_code(phone: Column | str) -> Column:
    return F.substr(col(phone), F.lit(4))


def zip_repair(c: Column | str, region: Column | str | None = None) -> Column:
    """Put back the leading zero of a four-digit zip; shorter text, or the region code itself, becomes null."""
    zip_ = col(c)
    unusable = F.length(zip_) < 4
    if region is not None:
        unusable = unusable | (zip_ == col(region))
    return F.when(unusable, F.lit(None).cast("string")).when(
        F.length(zip_) == 4, F.concat(F.lit("0"), zip_)
    ).otherwise(zip_)


def tracking_number(c: Column | str) -> Column:
    """Digits as BIGINT; values up to 1000, and text without usable digits, become null."""
    number = digits(c).try_cast("bigint")
    return F.when(number > 1000, number)


# Race names to one-letter codes.
RACE_CODES = {
    "European": "W",
    "Latin American": "W",
    "East Asian": "A",
    "African": "B",
    "Other": "O",
    "Unknown": "U",
    "Unspecified": "U",
    " ": "U",
}


def race_code(c: Column | str) -> Column:
    """One-letter race code; missing or longer unknown text is ``U``."""
    code = F.coalesce(map_values(c, RACE_CODES), F.lit("U"))
    return F.when(F.length(code) > 1, F.lit("U")).otherwise(code)


def ethnicity_code(race: Column, region: str | None = None) -> Column:
    """``U`` where the race code is ``U``, otherwise the region's code for not Hispanic."""
    return F.when(race == "U", F.lit("U")).otherwise(F.lit("N" if region == "MO" else "NH"))
