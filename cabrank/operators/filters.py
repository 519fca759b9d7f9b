"""Row filters.

Day and month filters are written as half-open ranges on the raw timestamp, so that they reach the
Parquet scan. A filter on the timestamp alone does not prune the directories of a day-partitioned
table, so the same range is also applied to the day column that the table has for that timestamp.
Both columns are marked as belonging together when they are stored. A column that has been computed
since carries no mark, and then the timestamp alone decides.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cabrank.functions.temporal import day_of

DAY_COLUMN = "pickup_date"

# Column metadata key: the timestamp column that a day column was taken from.
DAY_OF = "day_of"

# Column metadata key: the day column that was taken from a timestamp column as it is.
DAY_IN = "day_in"


def with_day_column(df: DataFrame, event_time: str, day_column: str = DAY_COLUMN) -> DataFrame:
    """Add the calendar day of the event time, or replace the one there is.

    The day and its time are marked for ``between_days``.
    """
    columns = []
    for name in df.columns:
        column = F.col("`" + name.replace("`", "``") + "`")
        if name.lower() == event_time.lower():
            columns.append(column.alias(name, metadata={DAY_IN: day_column.lower()}))
        elif name.lower() != day_column.lower():
            columns.append(column)
    marked = day_of(event_time).alias(day_column, metadata={DAY_OF: event_time.lower()})
    return df.select(*columns, marked)


def between_days(df: DataFrame, event_time: str, first: dt.date, last: dt.date) -> DataFrame:
    """Rows whose event time falls on ``first`` … ``last``, both days included."""
    time = F.col(event_time)
    kept = (time >= F.lit(first)) & (time < F.lit(last + dt.timedelta(days=1)))
    stored_in = {
        field.metadata.get(DAY_IN) for field in df.schema.fields if field.name.lower() == event_time.lower()
    }
    for field in df.schema.fields:
        if field.metadata.get(DAY_OF) == event_time.lower() and field.name.lower() in stored_in:
            kept = kept & F.col(field.name).between(F.lit(first), F.lit(last))
    return df.where(kept)


def on_day(df: DataFrame, event_time: str, day: dt.date) -> DataFrame:
    return between_days(df, event_time, day, day)


def in_month(df: DataFrame, event_time: str, year: int, month: int) -> DataFrame:
    first = dt.date(year, month, 1)
    following = (first + dt.timedelta(days=31)).replace(day=1)
    return between_days(df, event_time, first, following - dt.timedelta(days=1))


def equals(df: DataFrame, column: str, value: object) -> DataFrame:
    return df.where(F.col(column) == F.lit(value))


def any_of(column: str, values: Iterable[object]) -> Column:
    """Membership in a list; NULL is never a member."""
    return F.col(column).isin(*values)


def none_of(column: str, values: Iterable[object]) -> Column:
    """Not in a list. A NULL gives NULL, so a filter drops it, as SQL does."""
    return ~F.col(column).isin(*values)
