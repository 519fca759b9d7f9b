"""Monthly source files: ``<root>/<dataset>_tripdata_<yyyy-MM>.csv``."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.sources.csv import read_csv, read_csv_typed
from cabrank.specs import DatasetSpec

MONTH_COLUMN = "month"


def month_range(first: dt.date, last: dt.date) -> list[str]:
    """``yyyy-MM`` labels of all months from ``first`` to ``last``, both included."""
    labels = []
    month = first.replace(day=1)
    while month <= last:
        labels.append(f"{month:%Y-%m}")
        month = (month + dt.timedelta(days=32)).replace(day=1)
    return labels


def monthly_paths(spec: DatasetSpec, root: str, first: dt.date, last: dt.date) -> list[str]:
    return paths_of(spec, root, month_range(first, last))


def paths_of(spec: DatasetSpec, root: str, months: Sequence[str]) -> list[str]:
    return [f"{root.rstrip('/')}/{spec.file_name(m)}" for m in months]


def month_of_path(path: Column | str) -> Column:
    """Month label in the name of a file, or of the ``.csv`` directory that it lies in."""
    return F.regexp_extract(path, r"(\d{4}-\d{2})\.csv(/[^/]*)?$", 1)


def month_of_file() -> Column:
    """Month label in the name of the file (or ``.csv`` directory) that a row came from."""
    return month_of_path(F.col("_metadata.file_path"))


def read_months(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    first: dt.date,
    last: dt.date,
    schema: T.StructType | None = None,
) -> DataFrame:
    """All months of a range as one scan, each row with the month of its file."""
    return scan_months(spark, spec, root, month_range(first, last), schema)


def scan_months(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    months: Sequence[str],
    schema: T.StructType | None = None,
) -> DataFrame:
    """Some ``yyyy-MM`` months as one scan, each row with the month of its file.

    A missing month is an error, and so are months whose headers differ in more than case: read
    the ranges in which they agree one by one.
    """
    paths = paths_of(spec, root, months)
    if schema is None:
        df = read_csv_typed(spark, paths, spec.types, spec.multi_line)
    else:
        df = read_csv(spark, paths, schema, spec.multi_line)
    return df.withColumn(MONTH_COLUMN, month_of_file())
