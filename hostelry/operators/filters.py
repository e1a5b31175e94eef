"""Row filters (catalogue C01, C13-C16, C31, C32)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed_once(*cols: Column) -> Column:
    """The (aliased) columns, for a ``select``, out of a generator of one row. A filter on a plain
    projection's column is pushed below it with the column's whole expression written out at each
    reference, and the projection computes it again; a filter on generated columns stays above."""
    return F.inline(F.array(F.struct(*cols)))


def require_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows where any of ``cols`` is NULL."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.filter(cond)


def drop_outside_range(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Keep rows with lo < col < hi; NULL is dropped."""
    return df.filter((F.col(col) > lo) & (F.col(col) < hi))


def valid_interval(df: DataFrame, start: str, end: str) -> DataFrame:
    """Both ends present and end strictly after start (C14).

    ``end > start`` is NULL when either side is NULL, so the comparison alone
    is the whole test."""
    return df.filter(F.col(end) > F.col(start))


def drop_sentinel(df: DataFrame, col: str, value: str) -> DataFrame:
    """Drop rows equal to a sentinel; NULL is dropped too, as in SQL."""
    return df.filter(F.col(col) != F.lit(value))


def drop_null(df: DataFrame, col: str) -> DataFrame:
    """Drop rows whose (parsed) value is NULL."""
    return df.filter(F.col(col).isNotNull())


def bounded(df: DataFrame, col: str, lo: float, hi: float) -> DataFrame:
    """Keep lo < col <= hi."""
    return df.filter((F.col(col) > lo) & (F.col(col) <= hi))


def flag_filter(df: DataFrame, flag: str, value: bool = True) -> DataFrame:
    """Rows where a boolean column is true (or false)."""
    return df.filter(F.col(flag) if value else ~F.col(flag))
