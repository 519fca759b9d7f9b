"""How rows are spread over files ahead of a write."""

from __future__ import annotations

import threading
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_TIE = "_tie"

# AQE merges a shuffle of less than a megabyte per partition into few tasks, which would then
# open thousands of files one after another; larger shuffles are not affected. And Spark lists
# the written directories in one task each.
_MANY_DIRECTORIES = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
}


_lock = threading.Lock()
_writers = 0
_before: dict[str, str] = {}


@contextmanager
def many_directories(spark: SparkSession) -> Iterator[None]:
    """Settings for a write into many directories, which is bound by files rather than bytes.

    Writes may run side by side: the first one sets them, the last one puts them back.
    """
    global _writers
    with _lock:
        if not _writers:
            for key, value in _MANY_DIRECTORIES.items():
                _before[key] = spark.conf.get(key)
                spark.conf.set(key, value)
        _writers += 1
    try:
        yield
    finally:
        with _lock:
            _writers -= 1
            if not _writers:
                for key, value in _before.items():
                    spark.conf.set(key, value)


def by_group(df: DataFrame, *columns: str) -> DataFrame:
    """Bring the rows of each group into few files.

    A rebalance rather than a plain hash repartition: AQE splits a group that exceeds the advisory
    partition size over several tasks, so one day with a third of all rows is written in parallel,
    and it merges small groups. Without AQE the rows are range-partitioned (``by_range``), which
    splits such a group as well.
    """
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return by_range(df, *columns)
    return df.hint("rebalance", *[F.col(c) for c in columns])


def by_range(df: DataFrame, *columns: str, partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the columns, so that each file covers a narrow range of them.

    Read in the order of its partitions, the result is sorted as a whole, NULLs first.

    ``partitions`` defaults to the session's shuffle partitions, fewer where AQE finds them small.

    The row's position in its input partition is the last range key: rows that are equal in all
    columns still spread over several partitions. ``df`` has to be read from files or a table,
    whose partitions come out the same when a lost task is run again. Finding the range bounds
    takes a sampling pass over ``df`` first.
    """
    keys = [*columns, _TIE]
    tied = df.withColumn(_TIE, F.monotonically_increasing_id())
    if partitions is None:
        ranged = tied.repartitionByRange(*keys)
    else:
        ranged = tied.repartitionByRange(partitions, *keys)
    return ranged.sortWithinPartitions(*keys).drop(_TIE)
