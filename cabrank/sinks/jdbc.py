"""Publication to a relational database over JDBC.

The driver jar is the user's to provide (``spark.jars``). The rows are written to the shared folder
first and counted there, so nothing is computed twice. Each partition is one connection and one
transaction, so a lost executor repeats whole partitions; the row count is checked afterwards.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from cabrank.quality import RowCountMismatch
from cabrank.session import fresh_dir

ROWS_PER_BATCH = 100_000


def publish_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    properties: Mapping[str, str],
    mode: str = "overwrite",
    connections: int = 8,
) -> int:
    """Replace or append to a database table; returns the checked row count.

    ``connections`` bounds the load on the database: files are read by so many tasks at most,
    without a shuffle, while the stages before run at their own width.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, "jdbc")
    df.write.parquet(path)
    rows = spark.read.schema(df.schema).parquet(path)
    options = {
        **properties,
        "batchsize": str(ROWS_PER_BATCH),
        "numPartitions": str(connections),
    }
    before = 0 if mode == "overwrite" else spark.read.jdbc(url, table, properties=options).count()
    rows.write.jdbc(url, table, mode=mode, properties=options)
    added = spark.read.jdbc(url, table, properties=options).count() - before
    expected = rows.count()
    if added != expected:
        raise RowCountMismatch(f"{table} got {added} rows, expected {expected}")
    return added
