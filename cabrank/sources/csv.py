"""CSV sources.

Spark cuts large files into splits of ``spark.sql.files.maxPartitionBytes`` and streams each one,
so no read ever holds a whole file. Files are RFC 4180, a quote inside a quoted value being doubled,
except that a record is one line. ``multi_line`` admits quoted line breaks as well; a file then goes
to one task, as nothing but its start tells whether a line break is quoted. A record that does not
parse fails the job rather than turning into NULL, also where only rows are counted: every read
parses all columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.functions.temporal import TIME_FORMAT

DIALECT = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
    "columnPruning": False,
}


def require_csv(*paths: str) -> None:
    """Reject inputs that are not CSV."""
    others = [path for path in paths if not path.rstrip("/").endswith(".csv")]
    if others or not paths:
        raise ValueError(f"only .csv inputs are accepted, got {others or 'none'}")


def read_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    multi_line: bool = False,
) -> DataFrame:
    """Read with an explicit schema: one pass, and one schema for all files.

    ``enforceSchema=false`` compares every file's header with the schema, so a file with other or
    reordered columns fails instead of being read into the wrong ones.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    require_csv(*paths)
    options = {**DIALECT, "enforceSchema": False, "multiLine": multi_line}
    return spark.read.schema(schema).options(**options).csv(paths)


def header_schema(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, T.DataType],
    multi_line: bool = False,
) -> T.StructType:
    """Schema from the header line of the first path, with the types that are named.

    If there are other columns, one pass over all paths infers theirs, so that one schema holds for
    the whole load. With every column named, only the header is read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    require_csv(*paths)
    known = {name.lower(): dtype for name, dtype in types.items()}
    header = spark.read.options(**DIALECT, multiLine=multi_line).csv(paths[0]).columns
    if any(name.lower() not in known for name in header):
        inferred = read_csv_inferred(spark, paths, multi_line).schema
        known = {f.name.lower(): f.dataType for f in inferred.fields} | known
    return T.StructType([T.StructField(name, known[name.lower()]) for name in header])


def read_csv_typed(
    spark: SparkSession,
    paths: str | Sequence[str],
    types: Mapping[str, T.DataType],
    multi_line: bool = False,
) -> DataFrame:
    """Read with the named columns typed and the types of the rest inferred once for all paths."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    schema = header_schema(spark, paths, types, multi_line)
    return read_csv(spark, paths, schema, multi_line)


def read_csv_inferred(
    spark: SparkSession, paths: str | Sequence[str], multi_line: bool = False
) -> DataFrame:
    """Read with inferred types. Inference is a second pass: meant for dimension files.

    Inferred times come back without a zone, with the wall-clock time that is in the file.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    require_csv(*paths)
    df = spark.read.options(**DIALECT, inferSchema=True, multiLine=multi_line).csv(paths)
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(f"`{name}`").cast("timestamp_ntz") for name in zoned})


def write_csv(df: DataFrame, path: str, *partition_by: str) -> str:
    """Write in the same dialect, values unchanged. Partition directories need no ``.csv`` path."""
    if not partition_by:
        require_csv(path)
    (
        df.write.partitionBy(*partition_by)
        .options(
            header=True,
            quote='"',
            escape='"',
            ignoreLeadingWhiteSpace=False,
            ignoreTrailingWhiteSpace=False,
            timestampNTZFormat=TIME_FORMAT,
        )
        .csv(path)
    )
    return path
