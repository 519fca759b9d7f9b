"""The k-th largest value of a column, without sorting it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BINS = 4096


def kth_largest(df: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest of a long column, by counting bins of ever smaller ranges."""
    low, high = df.agg(F.min(key), F.max(key)).head()
    if low is None or k <= 0:
        return None
    while low < high:
        width = max(1, -(-(high - low + 1) // BINS))
        inside = df.where(F.col(key).between(low, high))
        bins = inside.groupBy(F.floor((F.col(key) - low) / width).alias("bin")).count().collect()
        for number, count in sorted(map(tuple, bins), reverse=True):
            if k <= count:
                break
            k -= count
        low, high = low + number * width, min(high, low + (number + 1) * width - 1)
    return low
