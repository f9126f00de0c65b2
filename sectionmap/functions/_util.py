from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def group(s: Column, pattern: str, idx: int) -> Column:
    """First match group, NULL (not '') when the pattern does not match."""
    return F.nullif(F.regexp_extract(s, pattern, idx), F.lit(""))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with the columns, computed once a row.  The optimizer copies a projected
    expression into every filter on it (a join's keys are filtered for NULLs) and below; a
    generated row it leaves in its place."""
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))))


def pad(number, width: int = 3) -> Column:
    """A number as text of ``width`` digits or more: zeros in front, nothing cut."""
    text = col(number).cast("string")
    return F.lpad(text, F.greatest(F.length(text), F.lit(width)), F.lit("0"))
