"""Aggregations. All of them combine on the map side, so a hot group shuffles one row per task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.functions.numeric import exact_amount, is_number, mean_to_cents
from cabrank.functions.temporal import day_of


def count_rows(df: DataFrame, name: str = "trips") -> DataFrame:
    return df.agg(F.count("*").alias(name))


def count_by(df: DataFrame, *keys: str, name: str = "trip_count") -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias(name))


def max_by_day(
    df: DataFrame, event_time: str, value: str, name: str, day_name: str = "trip_date"
) -> DataFrame:
    """The largest value of each day; NaN counts as missing, as NULL does."""
    numbers = F.when(is_number(F.col(value), df.schema[value].dataType), F.col(value))
    return df.groupBy(day_of(event_time).alias(day_name)).agg(F.max(numbers).alias(name))


def mean_by(df: DataFrame, *keys: str, amount: str, name: str) -> DataFrame:
    """Average money amount of each group, rounded to cents once; missing amounts do not count.

    Amounts are summed as decimals, so the average is exact whatever the order of the rows.
    """
    exact = exact_amount(amount)
    mean = F.when(F.col("_n") > 0, mean_to_cents("_total", F.greatest("_n", F.lit(1))))
    return (
        df.groupBy(*keys)
        .agg(F.sum(exact).alias("_total"), F.count(exact).alias("_n"))
        .select(*keys, mean.alias(name))
    )


def count_distinct_values(df: DataFrame, *columns: str, name: str) -> DataFrame:
    """Number of distinct values, NULL counted as one (``countDistinct`` would leave it out)."""
    return df.select(*columns).distinct().agg(F.count("*").alias(name))
