"""Dates and times. Trip times carry no zone, so all timestamps are ``timestamp_ntz``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# How times are written to CSV.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"


def parse_time(text: Column | str, fmt: str | None = None) -> Column:
    """String to timestamp. A malformed value fails the job, whether ANSI mode is on or not.

    Without a format, ISO times are read: with a blank or ``T`` between day and time, with or
    without fractions, or a day alone, which is its midnight. The CSV sources read times the same
    way.
    """
    value = F.col(text) if isinstance(text, str) else text
    parsed = value.try_cast("timestamp_ntz") if fmt is None else F.try_to_timestamp(value, F.lit(fmt))
    wrong = F.raise_error(F.concat(F.lit("malformed time: "), value))
    return F.when(value.isNotNull(), F.coalesce(parsed.cast("timestamp_ntz"), wrong.cast("timestamp_ntz")))


def day_of(time: Column | str) -> Column:
    """Calendar day of a timestamp."""
    return F.to_date(time)


def as_date(value: Column | str) -> Column:
    """``CAST(value AS DATE)``."""
    return (F.col(value) if isinstance(value, str) else value).cast("date")


def year_of(day: Column | str) -> Column:
    return F.year(day)


def month_of(day: Column | str) -> Column:
    return F.month(day)


def month_label(time: Column | str) -> Column:
    """``yyyy-MM`` of a timestamp, as used in monthly file names."""
    return F.date_format(time, "yyyy-MM")


def month_number(label: str) -> Column:
    """Months since year 0 of a ``yyyy-MM`` label."""
    return F.substring(label, 1, 4).cast("int") * 12 + F.substring(label, 6, 2).cast("int")
