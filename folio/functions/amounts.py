"""Amounts written as text, as decimal(38,4) columns. Three readings are kept apart because statements rely on each."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
#: What stands for an empty cell.
DASHES = ["-", "–", "—"]


def _number(text: Column) -> Column:
    return F.when(text.rlike(NUMBER), text.try_cast("decimal(38,4)"))


def _bracketed(text: Column) -> Column:
    """(x) as -x."""
    return F.when(text.rlike(r"^\(.*\)$"), F.concat(F.lit("-"), F.regexp_extract(text, r"^\((.*)\)$", 1))).otherwise(text)


def val_amount(c: Column) -> Column:
    """Commas go, (x) is -x; blank, '-', 'null' and whatever is no number are 0."""
    return F.coalesce(_number(_bracketed(F.replace(F.trim(c), F.lit(","), F.lit("")))), F.lit(0).cast("decimal(38,4)"))


def parse_amount(c: Column) -> Column:
    """As val_amount, but $ and spaces go too, and brackets and a leading minus both just mean negative."""
    text = F.regexp_replace(F.trim(c), r"[$,\s]", "")
    negative = text.rlike(r"^\(.*\)$") | F.regexp_replace(text, r"^\(", "").startswith("-")
    size = _number(F.regexp_replace(text, r"^\(?-?|\)$", ""))
    return F.coalesce(F.when(negative, -size).otherwise(size), F.lit(0)).cast("decimal(38,4)")


def to_dec(c: Column) -> Column:
    """Commas and $ go, (x) is -x; blanks, dashes and whatever is no number are null."""
    return _number(_bracketed(F.regexp_replace(F.trim(c), "[,$]", "")))


def is_empty(c: Column) -> Column:
    """Null, blank, a dash, or only #."""
    text = F.trim(c)
    return c.isNull() | text.isin(["", *DASHES]) | text.rlike("^#+$")


def yes_no(c: Column) -> Column:
    """1, 0 or null."""
    text = F.lower(F.trim(c))
    return F.when(text.isin("yes", "y", "true", "1"), 1).when(text.isin("no", "n", "false", "0"), 0).cast("long")


def format_amount(c: Column) -> Column:
    """Thousands parted by commas; two decimals only where there is a fraction."""
    return F.when(c == F.floor(c), F.format_number(c, 0)).otherwise(F.format_number(c, 2))
