"""Tables from outside: CSV with chosen columns, sheets with headers of many names, databases; and CSV out."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_csv(spark: SparkSession, path: str, wanted: list[str], upper: list[str] = ()) -> DataFrame:
    """The wanted columns as trimmed text; those in upper in upper case. Spark's reader parses only the columns selected."""
    rows = spark.read.csv(path, header=True)
    return rows.select(*[(F.upper(F.trim(c)) if c in upper else F.trim(c)).alias(c) for c in wanted])


def read_jdbc(spark: SparkSession, url: str, table: str, split: str, low: int, high: int, parts: int, **options: str) -> DataFrame:
    """A database table read in ranges of a number column, one connection for each."""
    return spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=split, lowerBound=low, upperBound=high, numPartitions=parts, **options).load()


def in_values(c: Column, values: list) -> Column:
    """Membership; nothing is in an empty list."""
    return c.isin(*values) if values else F.lit(False)


def _plain(name: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", name.lower()).strip()


def find_column(columns: list[str], aliases: list[str]) -> str | None:
    """The column whose plain name equals an alias, else the first that holds one or is held by one; aliases in order."""
    plain = {c: _plain(c) for c in columns}
    equal = (c for a in aliases for c in columns if plain[c] == _plain(a))
    within = (c for a in aliases for c in columns if plain[c] and (_plain(a) in plain[c] or plain[c] in _plain(a)))
    return next(equal, None) or next(within, None)


def by_alias(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns under their own names, found by aliases; null text where none is found."""
    found = {name: find_column(df.columns, own) for name, own in aliases.items()}
    return df.select(*[(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(n) for n, c in found.items()])


def pipe_text(df: DataFrame) -> DataFrame:
    """Each row as one line (line), cells joined by ' | ', missing cells blank; rows of blank cells go."""
    cells = [F.coalesce(F.trim(F.col(f"`{c}`").cast("string")), F.lit("")) for c in df.columns]
    return df.where(reduce(lambda a, b: a | b, [c != "" for c in cells])).select(F.concat_ws(" | ", *cells).alias("line"))


def stack(frames: list[DataFrame], first: list[str]) -> DataFrame:
    """All rows under all columns, the first ones in front; missing cells are null."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.select(*[c for c in first if c in rows.columns], *[c for c in rows.columns if c not in first])


def write_csv(df: DataFrame, path: str, fields: list[str]) -> None:
    """CSV parts with a header: the fields in this order, missing ones and nulls blank."""
    cells = [(F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in fields]
    df.select(*cells).write.mode("overwrite").csv(path, header=True, emptyValue="")
