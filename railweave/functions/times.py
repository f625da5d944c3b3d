"""Dates, times of day and casts (DAT-01 to DAT-04, NUM-01 to NUM-03)."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, functions as F


def minutes_of_day(c: Column) -> Column:
    """DAT-03: 60 * hours + minutes of 'HH:MM[:SS]', hours of 24 and more included; null or no ':' gives 0, words raise."""
    parts = F.split(c, ":")
    return F.when(F.contains(c, F.lit(":")), parts[0].cast("int") * 60 + parts[1].cast("int")).otherwise(0)


def iso_date(c: Column, strict: bool = False) -> Column:
    """DAT-01 and DAT-02: YYYYMMDD to YYYY-MM-DD; what is no date gives null, or raises if strict."""
    day = F.to_date(c, "yyyyMMdd") if strict else F.try_to_date(c, "yyyyMMdd")
    return F.date_format(day, "yyyy-MM-dd")


def window_end(start: Column, days: int = 60) -> Column:
    return F.date_format(F.date_add(start.cast("date"), days), "yyyy-MM-dd")


def in_window(date: Column, start: str | datetime.date | None = None, days: int = 60) -> Column:
    """FLT-01: start <= date <= start + days, for ISO dates; the start is today unless given."""
    first = F.current_date() if start is None else F.lit(str(start)).cast("date")
    return date.between(F.date_format(first, "yyyy-MM-dd"), window_end(first, days))


def strict_double(c: Column) -> Column:
    """NUM-01: null stays null, words raise."""
    return c.cast("double")


def lenient_double(c: Column) -> Column:
    """NUM-02: words give null."""
    return c.try_cast("double")


def strict_int(c: Column) -> Column:
    """NUM-03, STR-09: blanks around a number don't matter, words raise."""
    return F.trim(c).cast("int")
