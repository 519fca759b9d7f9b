"""Ordering and top-k, with NULLs placed last ascending and first descending."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.functions.numeric import is_number


def sort_asc(df: DataFrame, *columns: str) -> DataFrame:
    """Global sort, for results. Rows that are equal in all columns end up in one task.

    For whole tables with frequent values see ``sinks.layout.by_range``.
    """
    return df.orderBy(*[F.asc_nulls_last(c) for c in columns])


def sort_desc(df: DataFrame, *columns: str) -> DataFrame:
    return df.orderBy(*[F.desc_nulls_first(c) for c in columns])


def top(df: DataFrame, measure: str, *ties: str, k: int = 1) -> DataFrame:
    """The ``k`` rows with the largest measure; equal ones in ascending order of ``ties``.

    A missing measure, NULL or NaN, is no largest value and is left out. Runs as one bounded heap per task.
    """
    return (
        df.where(is_number(F.col(measure), df.schema[measure].dataType))
        .orderBy(F.desc(measure), *[F.asc_nulls_last(c) for c in ties])
        .limit(k)
    )
