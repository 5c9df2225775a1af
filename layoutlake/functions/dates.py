"""Dates and numbers in clipping headers, as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Italian month abbreviations in order.
MONTHS = ("GEN", "FEB", "MAR", "APR", "MAG", "GIU", "LUG", "AGO", "SET", "OTT", "NOV", "DIC")


def _date(day: Column, month: Column, year: Column) -> Column:
    return F.try_to_date(F.concat_ws("-", F.lpad(year, 4, "0"), F.lpad(month, 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")


def extract_date(c: Column) -> Column:
    """The first valid ``dd-MMM-yyyy``, else the first valid ``d/m/yy`` or ``d/m/yyyy``."""
    months = F.array(*map(F.lit, MONTHS))

    def named(m: Column) -> Column:
        p = F.split(m, "-")
        return _date(p[0], F.nullif(F.array_position(months, F.upper(p[1])), F.lit(0)).cast("string"), p[2])

    def slashed(m: Column) -> Column:
        p = F.split(m, "/")
        year = p[2].cast("int")
        return _date(p[0], p[1], F.when(year < 100, year + 2000).otherwise(year).cast("string"))

    first = lambda pattern, f: F.try_element_at(F.filter(F.transform(F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), f), lambda d: d.isNotNull()), F.lit(1))
    return F.coalesce(first(r"\b\d{1,2}-[A-Za-z]{3}-\d{4}\b", named), first(r"\b\d{1,2}/\d{1,2}/\d{2,4}\b", slashed))


def _number(c: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit("")).try_cast("int")


# The patterns below are fixed values: how clippings print sheets, pages and surfaces.
def sheet(c: Column) -> tuple[Column, Column]:
    pattern = r"(?i)\bfoglio\s+(\d+)(?:\s*/\s*(\d+))?"
    return _number(c, pattern), _number(c, pattern, 2)


def original_page(c: Column) -> Column:
    return _number(c, r"(?i)\bda\s+pag\.?\s+(\d+)")


def surface_percent(c: Column) -> Column:
    return F.replace(F.regexp_extract(c, r"(?i)\bSuperficie\s+([\d.,]+)\s*%", 1), F.lit(","), F.lit(".")).try_cast("double")


def strict_date(c: Column) -> tuple[Column, Column]:
    """Status (valid, invalid, none) and date of the first ``dd-MMM-yyyy``; a day that doesn't exist is invalid."""
    first = F.regexp_extract(c, r"\b(\d{1,2}-[A-Za-z]{3}-\d{4})\b", 1)
    day, name, year = (F.try_element_at(F.split(first, "-"), F.lit(k)) for k in (1, 2, 3))
    month = F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), F.upper(name)), F.lit(0))
    found = F.when(month.isNotNull(), _date(day, month.cast("string"), year))
    return F.when((first == "") | month.isNull(), "none").when(found.isNull(), "invalid").otherwise("valid"), found
