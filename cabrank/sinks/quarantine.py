"""CSV loads that set bad rows aside.

The rows are read once, with the types of the table; the parser marks a record that does not fit
them. Good and bad rows are written by the same job, into two folders of one version, and counted
while they are written. Only bad records are looked at again, to say what is wrong with them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.functions.temporal import TIME_FORMAT
from cabrank.quality import RowCountMismatch
from cabrank.sinks import versions
from cabrank.sources.csv import DIALECT, require_csv

RECORD, FILE, REASON, REJECTED = "_record", "_file", "_reason", "_rejected"


class TooManyRejected(ValueError):
    """More rows are bad than the load allows."""


def read_csv_checked(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType, multi_line: bool = False
) -> DataFrame:
    """The columns of ``schema``, and _record, _file and _reason, NULL in good rows.

    A record is bad if it has another number of values than the schema, or a value that is not of
    its column's type. The header of every file is compared as in other reads.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    require_csv(*paths)
    options = {**DIALECT, "mode": "PERMISSIVE", "enforceSchema": False, "multiLine": multi_line}
    marked = T.StructType([*schema.fields, T.StructField(RECORD, T.StringType())])
    rows = (
        spark.read.schema(marked).options(**options, columnNameOfCorruptRecord=RECORD).csv(paths)
    )
    bad = F.col(f"`{RECORD}`").isNotNull()
    return rows.withColumns(
        {
            FILE: F.when(bad, F.col("_metadata.file_path")),
            REASON: F.when(bad, reason(F.col(f"`{RECORD}`"), schema)),
        }
    )


def reason(record: Column, schema: T.StructType) -> Column:
    """What is wrong with a record: the first value not of its type, or the number of values."""
    names = [f"c{i}" for i in range(len(schema.fields))]
    plain = ", ".join(f"{name} string" for name in names)
    values = F.from_csv(record, F.lit(plain), {"quote": '"', "escape": '"', "mode": "PERMISSIVE"})
    said = F.lit("number of values")
    for name, field in reversed(list(zip(names, schema.fields, strict=True))):
        value = values[name]
        said = F.when(value.isNotNull() & _parsed(value, field.dataType).isNull(), F.concat(F.lit(f"{field.name}: "), value)).otherwise(said)
    return said


def _parsed(value: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampNTZType):
        # Written times have a format; the reader takes all ISO times.
        timed = F.try_to_timestamp(value, F.lit(TIME_FORMAT)).cast("timestamp_ntz")
        return F.coalesce(value.try_cast(kind), timed)
    return value.try_cast(kind)


def load_checked(
    spark: SparkSession,
    paths: str | Sequence[str],
    table: str,
    schema: T.StructType,
    most_rejected: int = 0,
    multi_line: bool = False,
) -> tuple[int, int]:
    """Replace ``table`` by the good rows and ``<table>_rejected`` by the bad ones.

    Returns both numbers; together they are the rows of the source. The rejected table has the raw
    record, its file and the reason. If more than ``most_rejected`` rows are bad, the load fails
    and leaves both tables as they were. The two are pointed at their new rows one after the
    other, the rejected ones first.
    """
    rejects = f"{table}_rejected"
    rows = read_csv_checked(spark, paths, schema, multi_line)
    bad = F.col(f"`{RECORD}`").isNotNull()
    with versions.new_version(spark, table) as good, versions.new_version(spark, rejects) as rest:
        seen = Observation()
        counted = rows.withColumn(REJECTED, bad).observe(
            seen, F.count(F.lit(1)).alias("rows"), F.count_if(bad).alias("bad")
        )
        counted.write.partitionBy(REJECTED).parquet(good.path)
        total, wrong = seen.get["rows"], seen.get["bad"]
        folder = {flag: f"{good.path}/{REJECTED}={flag}" for flag in ("true", "false")}
        if wrong > most_rejected:
            found = spark.read.schema(f"{REASON} string").parquet(folder["true"])
            examples = ", ".join(row[0] for row in found.distinct().limit(3).collect())
            raise TooManyRejected(f"{wrong} of {total} rows are bad, for example {examples}")
        said = T.StructType([T.StructField(c, T.StringType()) for c in (RECORD, FILE, REASON)])
        if wrong:
            aside = spark.read.schema(said).parquet(folder["true"])
        else:
            aside = spark.createDataFrame([], said)
        aside.write.option("path", rest.path).saveAsTable(rest.name)
        if total == wrong:
            spark.createDataFrame([], schema).write.parquet(folder["false"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        spark.sql(f"CREATE TABLE {good.name} ({columns}) USING parquet LOCATION '{folder['false']}'")
        loaded = spark.table(good.name).count() + spark.table(rest.name).count()
        if loaded != total:
            raise RowCountMismatch(f"{table} and {rejects} hold {loaded} rows, expected {total}")
        versions.publish(spark, rest, rejects)
        versions.publish(spark, good, table)
    return total - wrong, wrong
