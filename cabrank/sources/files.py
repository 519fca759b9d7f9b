"""Files of a table: their value ranges, and the bytes that a scan of them reads.

``write_index`` stores the range of some columns in every file of a table, in the hidden folder
``_index`` beside them. ``scan_indexed`` asks it while planning, so that a filter on a clustered
column opens only files that can hold its values. The folder is listed each time: files that the
index does not know, as they were added since, are always opened, and those that are gone do not
matter, so an old index costs time but no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cabrank.sinks import versions

INDEX = "_index"
# Beyond so many matching files the filter is not selective, and the table is scanned as it is.
MOST_FILES = 10_000

# The file systems of pyarrow, by the schemes that Hadoop has for them.
SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "hdfs": "hdfs"}


def _key(path: Column) -> Column:
    """A path without scheme and host, which are written in several ways."""
    return F.regexp_replace(path, r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "")


def _own_file() -> Column:
    """The file of a row, as ``_key`` has it; the metadata has it in URL encoding."""
    encoded = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    return _key(F.url_decode(encoded))


def listed(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length, and the partition columns) of the files below a folder, unopened."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder)
    return files.drop("content", "modificationTime")


def index_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """file, rows, and min_, max_ and nulls_ of each column, for each file of a Parquet scan."""
    measures = [F.count("*").alias("rows")]
    for c in columns:
        measures += [
            F.min(c).alias(f"min_{c}"),
            F.max(c).alias(f"max_{c}"),
            F.count_if(F.col(c).isNull()).alias(f"nulls_{c}"),
        ]
    return df.groupBy(_own_file().alias("file")).agg(*measures)


def write_index(spark: SparkSession, table: str, columns: Sequence[str]) -> str:
    """Index the files of a table (or version) by the ranges of some columns; returns the path."""
    path = f"{versions.location(spark, table)}/{INDEX}"
    rows = index_rows(spark.table(versions.stored(spark, table)), columns)
    rows.write.mode("overwrite").parquet(path)
    return path


def _in_range(column: str, values: Sequence) -> Column:
    """Whether any of the values lies in a file's range of the column."""
    low, high = F.col(f"min_{column}"), F.col(f"max_{column}")
    return F.exists(F.array(*map(F.lit, values)), lambda v: (v >= low) & (v <= high))


def matching_files(spark: SparkSession, table: str, wanted: Mapping[str, Sequence]) -> DataFrame:
    """(path): the files that may hold rows with one of the wanted values in each column."""
    folder = versions.location(spark, table)
    known = spark.read.parquet(f"{folder}/{INDEX}")
    possible = F.lit(True)
    for column, values in wanted.items():
        possible = possible & F.coalesce(_in_range(column, values), F.lit(False))
    files = listed(spark, folder).select("path", _key(F.col("path")).alias("file"))
    return files.join(known, "file", "left").where(F.col("rows").isNull() | possible).select("path")


def scan_indexed(spark: SparkSession, table: str, wanted: Mapping[str, Sequence]) -> DataFrame:
    """The rows with one of the wanted values in each column, from the files that may hold them."""
    whole = spark.table(versions.stored(spark, table))
    rows = matching_files(spark, table, wanted).limit(MOST_FILES + 1).collect()
    if 0 < len(rows) <= MOST_FILES:
        reader = spark.read.schema(whole.schema).option("basePath", versions.location(spark, table))
        # A partition column loses the mark of its time on the way.
        marked = [F.col(f"`{f.name}`").alias(f.name, metadata=f.metadata) for f in whole.schema.fields]
        whole = reader.parquet(*[row["path"] for row in rows]).select(*marked)
    for column, values in wanted.items():
        whole = whole.where(F.col(column).isin(list(values)) if values else F.lit(False))
    return whole if rows else whole.limit(0)


def column_bytes(files: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """path, rows and bytes (column chunks of some columns and footer) of each listed file.

    Footers are read by executors. The path's scheme has to be one that pyarrow has a file system
    for (local, s3, gs, hdfs).
    """
    names = None if columns is None else {c.lower() for c in columns}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            rows, sizes = [], []
            for path in paths:
                footer = _footer(path)
                rows.append(footer.num_rows)
                size = footer.serialized_size + 8
                for g in range(footer.num_row_groups):
                    group = footer.row_group(g)
                    for c in range(group.num_columns):
                        chunk = group.column(c)
                        if names is None or chunk.path_in_schema.split(".")[0].lower() in names:
                            size += chunk.total_compressed_size
                sizes.append(size)
            yield pa.RecordBatch.from_arrays(
                [pa.array(paths, pa.string()), pa.array(rows, pa.int64()), pa.array(sizes, pa.int64())],
                names=["path", "rows", "bytes"],
            )

    return files.select("path").mapInArrow(run, "path string, rows long, bytes long")


def arrow_store(uri: str) -> tuple[fs.FileSystem, str]:
    """pyarrow's file system for a folder or file that Spark names, and its path there."""
    scheme, colon, rest = uri.partition(":")
    if not colon or "/" in scheme:
        return fs.LocalFileSystem(), uri
    if scheme == "file":
        return fs.LocalFileSystem(), "/" + rest.lstrip("/")
    try:
        return fs.FileSystem.from_uri(f"{SCHEMES.get(scheme, scheme)}:{rest}")
    except pa.ArrowInvalid as error:
        raise ValueError(f"pyarrow has no file system for {scheme}: paths, such as {uri}") from error


def _footer(path: str) -> pq.FileMetaData:
    system, inner = arrow_store(path)
    with system.open_input_file(inner) as file:
        return pq.read_metadata(file)


def scan_bytes(
    spark: SparkSession, table: str, columns: Sequence[str], pruned: Column | None = None
) -> DataFrame:
    """files, rows and bytes that a scan of some columns reads, estimated without reading them.

    ``pruned`` is a filter on the partition columns: only files in matching directories count.
    Filters on other columns may let the scan skip row groups, which is not estimated.
    """
    files = listed(spark, versions.location(spark, table))
    if pruned is not None:
        files = files.where(pruned)
    measured = column_bytes(files, columns)
    return measured.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("rows"),
        F.coalesce(F.sum("bytes"), F.lit(0).cast("long")).alias("bytes"),
    )
