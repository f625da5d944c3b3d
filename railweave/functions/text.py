"""Names, station codes and train numbers (STR-01 to STR-09)."""

from __future__ import annotations

import functools
import sys
import unicodedata

from pyspark.sql import Column, functions as F

#: Words that station names are compared without.
STOP_WORDS = ["gare", "de", "du", "des", "la", "le", "l", "saint", "st", "estacion"]


@functools.cache
def _folding() -> tuple[str, str]:
    """For translate(): letters that decompose to one of a-z, A-Z, 0-9, their bases, and then all marks to delete."""
    letters, bases, marks = [], [], []
    for c in map(chr, range(0x80, sys.maxunicode + 1)):
        if unicodedata.category(c) == "Mn":
            marks.append(c)
            continue
        base = "".join(x for x in unicodedata.normalize("NFD", c) if unicodedata.category(x) != "Mn")
        if base != c and len(base) == 1 and base.isascii():
            letters.append(c)
            bases.append(base)
    return "".join(letters + marks), "".join(bases)


def normalized_name(c: Column) -> Column:
    """STR-01: no accents, lower case, letters and digits of ASCII only, without stop words; null gives ''."""
    plain = F.regexp_replace(F.lower(F.translate(c, *_folding())), "[^a-z0-9]", " ")
    words = F.filter(F.split(plain, " +"), lambda w: (w != "") & ~w.isin(STOP_WORDS))
    return F.coalesce(F.array_join(words, " "), F.lit(""))


def _first(c: Column, pattern: str) -> Column:
    """The pattern's first group, with Unicode's digits and word borders, else null."""
    return F.nullif(F.regexp_extract(c, f"(?U){pattern}", 1), F.lit(""))


def uic_code(c: Column) -> Column:
    """STR-02: the first 7 or 8 digits in a row, else five digits that stand alone after '71', else ''."""
    return F.coalesce(_first(c, r"(\d{7,8})"), F.concat(F.lit("71"), _first(c, r"\b(\d{5})\b")), F.lit(""))


def stop_uic(stop_code: Column, stop_id: Column) -> Column:
    """STR-03: from the code, else from the id."""
    return F.coalesce(F.nullif(uic_code(stop_code), F.lit("")), uic_code(stop_id))


def first_train_number(trip_id: Column) -> Column:
    """STR-04: the first three to five digits, else the id as it is; null gives ''."""
    return F.coalesce(_first(trip_id, r"(\d{3,5})"), trip_id, F.lit(""))


def _no_leading_zeros(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^0+(?=\d)", "")


def short_or_train_number(short_name: Column, trip_id: Column) -> Column:
    """STR-05: the short name (a number without leading zeros), else the first four or five digits of the id, else ''."""
    name = F.regexp_replace(short_name, r"^\s+|\s+$", "")
    number = F.when(name.rlike(r"(?U)^\d+$"), _no_leading_zeros(name)).otherwise(name)
    return F.coalesce(F.nullif(number, F.lit("")), _no_leading_zeros(_first(trip_id, r"(\d{4,5})")), F.lit(""))


def first_digits(c: Column) -> Column:
    """STR-06: the first run of digits, else null."""
    return _first(c, r"(\d+)")


def country_code(c: Column) -> Column:
    """STR-07: trimmed, upper case, two letters at most; null gives ''."""
    return F.coalesce(F.substring(F.upper(F.trim(c)), 1, 2), F.lit(""))


def code_variants(uic7: Column, uic8: Column) -> Column:
    """STR-08: the keys under which a station is known, in the order in which they are written."""
    seven, eight = F.nullif(F.trim(uic7), F.lit("")), F.nullif(F.trim(uic8), F.lit(""))
    keys = F.array(
        seven, F.when(F.length(seven) == 7, F.concat(F.lit("8"), seven)),
        eight, F.when((F.length(eight) == 8) & eight.startswith("8"), F.substring(eight, 2, 7)),
    )
    return F.filter(keys, lambda k: k.isNotNull())


def prefixed(operator: Column | str, c: Column) -> Column:
    """PRJ-01: '<operator>_<id>'; null stays null."""
    return F.concat(F.lit(operator) if isinstance(operator, str) else operator, F.lit("_"), c)


def clean_header(name: str) -> str:
    """SRC-10: a column name without blanks around it, byte-order mark and no-break spaces."""
    return name.strip().lstrip("﻿").replace("\xa0", "").strip()
