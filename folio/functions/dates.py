"""Fiscal year ends: read from cells and lines of text, compared, and brought to the year that was audited. A year end is a struct (month, year)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: How months are written, the days that a spreadsheet counts dates in, and the years that are believed.
MONTHS = ["jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?", "sep(?:t|tember)?", "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?"]
SERIALS, SERIAL_EPOCH = (32874, 55153), "1899-12-30"
FIRST_YEAR, YEARS_AHEAD = 1990, 3
MONTH = "(" + "|".join(MONTHS) + ")"
NAMED = rf"(?i)\b{MONTH}[\s.,-]+([0-9]{{1,2}})(?:st|nd|rd|th)?[\s.,-]+([0-9]{{4}}|[0-9]{{2}})\b"
DAY_FIRST = rf"(?i)\b([0-9]{{1,2}})(?:st|nd|rd|th)?[\s.,-]+{MONTH}[\s.,-]+([0-9]{{4}}|[0-9]{{2}})\b"
NUMERIC = r"\b([0-9]{1,2})[./-]([0-9]{1,2})[./-]([0-9]{4}|[0-9]{2})\b"
ISO = r"\b([0-9]{4})-([0-9]{1,2})-([0-9]{1,2})\b"


def _month(name: Column) -> Column:
    low = F.lower(name)
    return reduce(lambda c, k: c.when(low.startswith(MONTHS[k][:3]), k + 1), range(1, 12), F.when(low.startswith(MONTHS[0][:3]), 1))


def _year(text: Column) -> Column:
    """Two digits are 2000 to 2049 and 1950 to 1999."""
    n = text.try_cast("int")
    return F.when(F.length(text) == 2, F.when(n < 50, 2000 + n).otherwise(1900 + n)).otherwise(n)


def _end(month: Column, day: Column, year: Column, first_year: int = FIRST_YEAR, last_year: Column | None = None) -> Column:
    last = F.year(F.current_date()) + YEARS_AHEAD if last_year is None else last_year
    good = month.between(1, 12) & day.between(1, 31) & year.between(F.lit(first_year), last)
    return F.when(good, F.struct(month.cast("int").alias("month"), year.cast("int").alias("year")))


def _parts(text: Column, pattern: str, of) -> Column:
    at = lambda k: F.regexp_extract(text, pattern, k)
    return F.when(text.rlike(pattern), of(at(1), at(2), at(3)))


def year_end(cell: Column, last_year: Column | None = None) -> Column:
    """The year end of a cell as text: a date in ISO, American or long form within other words, or a spreadsheet's day number. Null where
    none is found, or month, day or year aren't believable."""
    text = F.trim(F.regexp_replace(F.regexp_replace(cell, "[–—]", "-"), r"[\s ]+", " "))
    end = lambda m, d, y: _end(m.try_cast("int"), d.try_cast("int"), _year(y), last_year=last_year)
    forms = [
        _parts(text, ISO, lambda y, m, d: end(m, d, y)),
        _parts(text, NUMERIC, lambda m, d, y: end(m, d, y)),
        _parts(text, NAMED, lambda m, d, y: end(_month(m).cast("string"), d, y)),
        _parts(text, DAY_FIRST, lambda d, m, y: end(_month(m).cast("string"), d, y)),
    ]
    serial = F.when(text.rlike(r"^[0-9]{5}(\.[0-9]+)?$"), F.floor(text.try_cast("double")).cast("int"))
    day = F.date_add(F.lit(SERIAL_EPOCH).cast("date"), serial)
    of_serial = F.when(serial.between(*SERIALS), _end(F.month(day), F.dayofmonth(day), F.year(day), last_year=last_year))
    return F.coalesce(of_serial, *forms)


def line_dates(line: Column) -> Column:
    """All dates of a line as structs (year, month, raw), the latest first. A line without two digits beside each other has none and isn't searched."""
    found = F.concat(*[F.regexp_extract_all(line, F.lit(p), F.lit(0)) for p in (NAMED, DAY_FIRST, NUMERIC)])
    found = F.when(line.rlike("[0-9]{2}"), found).when(line.isNotNull(), F.array().cast("array<string>"))
    dated = F.transform(F.array_distinct(found), lambda raw: F.struct(year_end(raw).alias("end"), raw.alias("raw")))
    good = F.filter(dated, lambda d: d["end"].isNotNull())
    return F.reverse(F.array_sort(F.transform(good, lambda d: F.struct(d["end"]["year"].alias("year"), d["end"]["month"].alias("month"), d["raw"].alias("raw")))))


def compare(wanted: Column, found: Column) -> Column:
    """EXACT, MONTH, YEAR or NONE; a missing side is NONE."""
    month, year = wanted["month"] == found["month"], wanted["year"] == found["year"]
    return F.when(wanted.isNull() | found.isNull(), "NONE").when(month & year, "EXACT").when(month, "MONTH").when(year, "YEAR").otherwise("NONE")


def reconcile(end: Column, audited: Column, fiscal: Column) -> Column:
    """A struct (month, year, note): the year end with the year of the filing that was found. fiscal is the year that was asked for, the end's own where missing."""
    wanted = F.coalesce(fiscal.try_cast("int"), end["year"])
    note = F.when(end.isNull(), "UNPARSEABLE").when(audited.isNull(), "AS IS").when(audited > wanted, "ADVANCED").when(audited < wanted, "RETRACTED").when(end["year"] != audited, "CORRECTED").otherwise("OK")
    year = F.when(note.isin("ADVANCED", "RETRACTED", "CORRECTED"), audited).otherwise(end["year"])
    return F.struct(end["month"].alias("month"), year.cast("int").alias("year"), note.alias("note"))


def month_day(end: Column, day: Column) -> Column:
    """mm/dd of a year end, the day (31 where missing) at most the month's last."""
    last = F.dayofmonth(F.last_day(F.make_date(end["year"], end["month"], F.lit(1))))
    return F.when(end.isNotNull(), F.concat(F.lpad(end["month"].cast("string"), 2, "0"), F.lit("/"), F.lpad(F.least(F.coalesce(day, F.lit(31)), last).cast("string"), 2, "0")))
