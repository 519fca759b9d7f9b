"""Month loads that know which months are done.

The ledger ``<lake>/_ledger/<dataset>`` has a row for each load of a month: how many source files
there were, their bytes and the latest time (in microseconds), the rows in the lake afterwards, and the run. A run
compares the source folder with the last row of each month and loads only months that are new or
changed. The rows are added after the load, so a run that dies loads its months again, which
replaces them.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.plans.pipelines import land_months
from cabrank.sources.months import MONTH_COLUMN, month_of_path, month_range
from cabrank.specs import DatasetSpec

LEDGER = (
    "dataset string, month string, files long, length long, modified long, rows long, "
    "run string, loaded timestamp"
)
ANY_MONTH = "[0-9][0-9][0-9][0-9]-[0-9][0-9]"
_STATE = ("files", "length", "modified")


def ledger_path(lake: str, spec: DatasetSpec) -> str:
    return f"{lake.rstrip('/')}/_ledger/{spec.name}"


def read_ledger(spark: SparkSession, spec: DatasetSpec, lake: str) -> DataFrame:
    """All loads of a dataset; none if there has not been a run."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger_path(lake, spec))
    if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], LEDGER)
    return spark.read.schema(LEDGER).parquet(ledger_path(lake, spec))


def last_loads(ledger: DataFrame) -> DataFrame:
    """The last load of each month."""
    own = [c for c in ledger.columns if c != MONTH_COLUMN]
    last = F.max_by(F.struct(*own), F.struct("loaded", "run")).alias("last")
    return ledger.groupBy(MONTH_COLUMN).agg(last).select(MONTH_COLUMN, "last.*")


def source_state(spark: SparkSession, spec: DatasetSpec, root: str) -> DataFrame:
    """month, files, length and modified of all months in the source folder.

    Files are looked at by name, length and time; none is opened. A month may be one file or a
    directory of files.
    """
    files = spark.read.format("binaryFile").load(f"{root.rstrip('/')}/{spec.file_name(ANY_MONTH)}")
    return (
        files.select(month_of_path("path").alias(MONTH_COLUMN), "length", "modificationTime")
        .groupBy(MONTH_COLUMN)
        .agg(
            F.count("*").alias("files"),
            F.sum("length").alias("length"),
            F.unix_micros(F.max("modificationTime")).alias("modified"),
        )
    )


def months_to_load(
    spark: SparkSession, spec: DatasetSpec, root: str, lake: str, first: dt.date, last: dt.date
) -> DataFrame:
    """The state of the months in the range that are new or differ from their last load.

    A month of the range without a source file is an error.
    """
    months = month_range(first, last)
    state = source_state(spark, spec, root).where(F.col(MONTH_COLUMN).isin(months))
    wanted = spark.createDataFrame([(m,) for m in months], f"{MONTH_COLUMN} string")
    known = last_loads(read_ledger(spark, spec, lake)).select(
        MONTH_COLUMN, *[F.col(c).alias(f"known_{c}") for c in _STATE]
    )
    same = F.lit(True)
    for c in _STATE:
        same = same & F.col(c).eqNullSafe(F.col(f"known_{c}"))
    compared = wanted.join(state, MONTH_COLUMN, "left").join(known, MONTH_COLUMN, "left")
    return compared.where(~same | F.col("files").isNull()).select(MONTH_COLUMN, *_STATE)


def catch_up(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    lake: str,
    first: dt.date,
    last: dt.date,
    schema: T.StructType | None = None,
) -> list[str]:
    """Load the months of the range that are new or changed; returns them.

    If there are none, no source file is opened. The number of months, not of files, comes to the
    driver.
    """
    todo = months_to_load(spark, spec, root, lake, first, last).collect()
    missing = sorted(row[MONTH_COLUMN] for row in todo if row["files"] is None)
    if missing:
        raise FileNotFoundError(f"no source for {spec.name} in {', '.join(missing)}")
    months = sorted(row[MONTH_COLUMN] for row in todo)
    if not months:
        return []
    target = land_months(spark, spec, root, lake, months, schema)
    landed = spark.read.parquet(target).where(F.col(MONTH_COLUMN).isin(months))
    counts = dict(landed.groupBy(MONTH_COLUMN).count().collect())
    run = uuid.uuid4().hex[:12]
    rows = [
        (spec.name, r[MONTH_COLUMN], *[r[c] for c in _STATE], counts.get(r[MONTH_COLUMN], 0), run)
        for r in todo
    ]
    entries = spark.createDataFrame(rows, LEDGER.rpartition(", ")[0])
    timed = entries.coalesce(1).withColumn("loaded", F.current_timestamp())
    timed.write.mode("append").parquet(ledger_path(lake, spec))
    return months
