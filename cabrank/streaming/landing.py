"""The monthly load as a stream: every new file in the landing folder is processed once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cabrank.sinks.layout import by_group, many_directories
from cabrank.sources.csv import DIALECT
from cabrank.sources.months import MONTH_COLUMN, month_of_file, month_of_path

# What the file source tells about files; the content is never asked for.
FILES = "path string, modificationTime timestamp, length long, content binary"


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    target: str,
    checkpoint: str,
    files_per_batch: int = 10_000,
) -> str:
    """Land the months of the CSV files that arrived since the last run, then stop.

    ``checkpoint`` records which files are done. The stream is one of file names, so new files are
    opened only once, to be landed. A batch tells which months have new files; these
    are read whole from the source and replace ``target/month=…``, by the write that the backfill
    uses. So a run that dies and is resumed, a month whose files come in several batches, and a
    backfill of the same folder all leave each row once.
    """
    options = {**DIALECT, "enforceSchema": False}
    arrived = (
        spark.readStream.format("binaryFile")
        .schema(FILES)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(source)
        .select(month_of_path("path").alias(MONTH_COLUMN))
    )

    def land(batch: DataFrame, _: int) -> None:
        months = [row[0] for row in batch.distinct().collect()]
        if not months:
            return
        own = batch.sparkSession
        whole = own.read.schema(schema).options(**options).csv(source)
        whole = whole.withColumn(MONTH_COLUMN, month_of_file()).where(
            month_of_file().isin(*months)
        )
        with many_directories(own):
            (
                by_group(whole, MONTH_COLUMN)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(MONTH_COLUMN)
                .parquet(target)
            )

    (
        arrived.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return target
