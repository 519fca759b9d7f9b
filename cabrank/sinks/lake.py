"""Files in the lake."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cabrank.functions.temporal import month_label
from cabrank.sinks.layout import by_group, many_directories
from cabrank.sources.csv import read_csv, read_csv_inferred, require_csv
from cabrank.sources.months import MONTH_COLUMN


def parquet_name(csv_path: str) -> str:
    """The same path with the extension swapped."""
    require_csv(csv_path)
    return csv_path.rstrip("/")[: -len(".csv")] + ".parquet"


def csv_to_parquet(
    spark: SparkSession,
    source: str,
    target: str | None = None,
    schema: T.StructType | None = None,
) -> str:
    """Convert one CSV input to Parquet; types are inferred where no schema is given."""
    target = target or parquet_name(source)
    df = read_csv_inferred(spark, source) if schema is None else read_csv(spark, source, schema)
    df.write.mode("overwrite").parquet(target)
    return target


def land_raw(df: DataFrame, lake: str, name: str, rows_per_file: int = 0) -> str:
    """Publish as ``<lake>/raw/<name>.parquet``, straight from the executors.

    ``rows_per_file`` bounds the size of the files; 0 leaves one file per input split.
    """
    path = f"{lake.rstrip('/')}/raw/{name}.parquet"
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).parquet(path)
    return path


def regroup_raw(spark: SparkSession, lake: str, dataset: str, event_time: str) -> str:
    """Collect ``raw/<dataset>_tripdata*.parquet`` under ``<dataset>/``, by month of event time.

    The months that are in raw replace those of the dataset; all other months stay, whoever wrote
    them. The raw files stay where they are, so the step can be run again. Raw files may have
    different columns: where one lacks a column, it is NULL.
    """
    lake = lake.rstrip("/")
    source = f"{lake}/raw/{dataset}_tripdata*.parquet"
    raw = spark.read.option("mergeSchema", True).parquet(source)
    monthly = raw.withColumn(MONTH_COLUMN, month_label(event_time))
    target = f"{lake}/{dataset}"
    with many_directories(spark):
        grouped = by_group(monthly, MONTH_COLUMN)
        (
            grouped.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH_COLUMN)
            .parquet(target)
        )
    return target
