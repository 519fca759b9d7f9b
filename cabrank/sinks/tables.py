"""Table publication. Tables are replaced whole, by versions (``sinks.versions``)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cabrank.operators.filters import DAY_COLUMN, with_day_column
from cabrank.quality import require_key, require_new_keys, require_row_count
from cabrank.session import fresh_dir
from cabrank.sinks import versions
from cabrank.sinks.layout import by_group, by_range, many_directories
from cabrank.sources.files import write_index


def replace_table(df: DataFrame, table: str, *partition_by: str, key: Iterable[str] = ()) -> DataFrame:
    """Create the table, or replace it whole.

    The new rows are written into a folder of their own, which the table is then pointed at. So a
    write that fails leaves the old table as it was, ``df`` may read from it, and no files are
    moved. A ``key`` is checked before, and kept by later appends.
    """
    spark = df.sparkSession
    key = list(key)
    with versions.new_version(spark, table) as version:
        df.write.option("path", version.path).partitionBy(*partition_by).saveAsTable(version.name)
        if key:
            require_key(spark.table(version.name), *key)
            versions.declare_key(spark, version.name, key)
        return versions.publish(spark, version, table)


def replace_dimension(df: DataFrame, table: str, *key: str) -> DataFrame:
    """Replace a dimension table; its key is checked now and by every append."""
    return replace_table(df, table, key=key)


def create_empty(df: DataFrame, table: str, key: Iterable[str] = ()) -> DataFrame:
    """Create or replace the table with the schema of ``df`` and no rows."""
    return replace_table(df.limit(0), table, key=key)


def append_table(df: DataFrame, table: str) -> DataFrame:
    """Append, matching columns by name; a table that is not there is created.

    If the table has a declared key, the batch is written to the shared folder first, and checked
    there: by itself, and against the keys in the table. A violation fails the append before
    anything is written to the table. Appends that run side by side do not see each other's keys.
    """
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        return replace_table(df, table)
    name = versions.stored(spark, table)
    key = versions.declared_key(spark, table)
    if key:
        path = fresh_dir(spark, "batch")
        df.write.parquet(path)
        df = spark.read.schema(df.schema).parquet(path)
        require_new_keys(df, spark.table(name), *key)
    df.write.mode("append").saveAsTable(name)
    spark.catalog.refreshTable(table)
    return spark.table(table)


def load_table(
    spark: SparkSession, batches: Iterable[DataFrame], table: str, key: Iterable[str] = ()
) -> int:
    """Replace the table with the concatenation of the batches; returns the checked row count.

    Each batch is one job over all executors. Loading everything as one batch is the fast way;
    several serve sources that become available one after another. The batches are collected in a
    version that nobody sees until all are in, the rows are as many as were counted while they
    were written, and the ``key``, if any, holds: a load that fails in between leaves the old table.
    """
    expected, key = 0, list(key)
    with versions.new_version(spark, table) as version:
        for number, batch in enumerate(batches):
            if number == 0:
                batch.limit(0).write.option("path", version.path).saveAsTable(version.name)
            written = Observation()
            counted = batch.observe(written, F.count(F.lit(1)).alias("rows"))
            counted.write.mode("append").saveAsTable(version.name)
            expected += written.get["rows"]
        if not spark.catalog.tableExists(version.name):
            raise ValueError(f"no batches for {table}")
        require_row_count(spark, version.name, expected)
        if key:
            require_key(spark.table(version.name), *key)
            versions.declare_key(spark, version.name, key)
        versions.publish(spark, version, table)
    return expected


def publish_by_day(
    df: DataFrame,
    table: str,
    event_time: str,
    drop: Iterable[str] = (),
    day_column: str = DAY_COLUMN,
) -> DataFrame:
    """Replace the table, partitioned by the calendar day of the event time.

    Columns in ``drop`` are left out before anything is read, so files may disagree about their
    types. Rows without an event time go to the NULL partition.
    """
    kept = with_day_column(df.drop(*drop), event_time, day_column)
    spark = df.sparkSession
    with many_directories(spark):
        return replace_table(by_group(kept, day_column), table, day_column)


def refresh_days(
    df: DataFrame,
    table: str,
    event_time: str,
    drop: Iterable[str] = (),
    day_column: str = DAY_COLUMN,
) -> DataFrame:
    """Replace the days that ``df`` has trips for; all other days of the published table stay.

    So a new or corrected month costs its own bytes, not those of the whole table. Columns are
    matched by name, and the table keeps its own.
    """
    kept = with_day_column(df.drop(*drop), event_time, day_column)
    spark = df.sparkSession
    with many_directories(spark):
        days = by_group(kept.select(*spark.table(table).columns), day_column)
        (
            days.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(day_column)
            .parquet(versions.location(spark, table))
        )
    spark.catalog.recoverPartitions(versions.stored(spark, table))
    spark.catalog.refreshTable(table)
    return spark.table(table)


def publish_clustered(
    df: DataFrame,
    table: str,
    event_time: str,
    cluster_by: str,
    day_column: str,
    partitions: int | None = None,
) -> DataFrame:
    """Day partitions with rows clustered by a column inside each day.

    For queries that filter by day and order by ``cluster_by``: the day prunes directories, the
    narrow column range of each file lets readers skip files and row groups. Clustering is by
    range, so a value with a third of the rows spans several files, where a bucket would not. The
    ranges of the files are indexed (``sources.files``), for scans that open only matching ones.
    """
    kept = with_day_column(df, event_time, day_column)
    spark = df.sparkSession
    with many_directories(spark), versions.new_version(spark, table) as version:
        laid_out = by_range(kept, day_column, cluster_by, event_time, partitions=partitions)
        rows = laid_out.write.option("path", version.path).partitionBy(day_column)
        rows.saveAsTable(version.name)
        write_index(spark, version.name, [cluster_by])
        return versions.publish(spark, version, table)
