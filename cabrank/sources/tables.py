"""Lake files and catalog tables as sources."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_lake(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Parquet files, directories or globs; the schema comes from the files."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    return spark.read.parquet(*paths)


def _below(spark: SparkSession, location: str) -> DataFrame:
    """(folder): of every file below ``location``, relative to it; listed and read by executors.

    Files are named by their metadata alone. The folders above ``location`` do not count.
    """
    path = spark._jvm.org.apache.hadoop.fs.Path(location)
    root = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()
    files = spark.read.format("binaryFile").load(location).select("path")
    inside = F.substring("path", len(root) + 2, 1 << 20)
    return files.select(F.regexp_replace(inside, "/?[^/]*$", "").alias("folder"))


def partition_keys(spark: SparkSession, location: str) -> list[str]:
    """Names of the ``key=value`` folders below ``location``, lowered."""
    parts = _below(spark, location).distinct().select(F.explode(F.split("folder", "/")).alias("part"))
    keys = parts.where(F.col("part").contains("=")).select(
        F.lower(F.substring_index("part", "=", 1)).alias("key")
    )
    return sorted(row["key"] for row in keys.distinct().collect())


def _conflict(name: str, location: str, one: T.DataType, two: T.DataType) -> ValueError:
    kinds = f"{one.simpleString()} and {two.simpleString()}"
    return ValueError(f"column {name} under {location} is {kinds}")


def _types_differ(error: Exception) -> bool:
    """Whether a merge of schemas failed on types; it comes as a plain JVM error."""
    return "CANNOT_MERGE_SCHEMAS" in str(error)


def merged_schema(spark: SparkSession, location: str, drop: Sequence[str] = ()) -> T.StructType:
    """All columns of all Parquet files under ``location``, without the ones in ``drop``.

    Files may lack columns, and may disagree about the types of dropped ones from directory to
    directory. A kept column of two types is an error. Partition columns come last.

    Footers are read and merged by executors, in one pass. Only where types disagree, the list of
    directories is halved until the parts agree, and the parts' schemas are compared here.
    """
    gone = {name.lower() for name in drop}
    keys = partition_keys(spark, location)

    def merge(paths: list[str]) -> list[T.StructField]:
        return spark.read.option("mergeSchema", True).parquet(*paths).schema.fields

    def fields(folders: list[str]) -> list[T.StructField]:
        try:
            return merge(folders)
        except Exception as error:
            if len(folders) == 1 or not _types_differ(error):
                raise
        known: dict[str, T.StructField] = {}
        middle = len(folders) // 2
        for part in (folders[:middle], folders[middle:]):
            for field in fields(part):
                first = known.setdefault(field.name.lower(), field)
                if first.dataType != field.dataType and field.name.lower() not in gone:
                    raise _conflict(field.name, location, first.dataType, field.dataType)
        return list(known.values())

    try:
        found = merge([location])
    except Exception as error:
        if not _types_differ(error):
            raise
        below = sorted(row["folder"] for row in _below(spark, location).distinct().collect())
        found = fields([f"{location.rstrip('/')}/{folder}".rstrip("/") for folder in below])
        names = {f.name.lower() for f in found}
        plain = spark.read.parquet(location).schema.fields
        found += [f for f in plain if f.name.lower() in keys and f.name.lower() not in names]
    columns = [f for f in found if f.name.lower() not in keys and f.name.lower() not in gone]
    partitions = [f for f in found if f.name.lower() in keys]
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in columns + partitions])


def external_table(
    spark: SparkSession, table: str, location: str, drop: Sequence[str] = ()
) -> DataFrame:
    """Publish the Parquet files under ``location`` as a table, without copying them.

    The table has the merged columns of all files but those in ``drop``; where a file lacks one,
    it is NULL. ``key=value`` directories below ``location`` become partition columns and are
    registered in the catalog, so filters on them list only the matching directories. An earlier
    external table of the name is replaced; one that owns its data is not touched.
    """
    schema = merged_schema(spark, location, drop)
    keys = partition_keys(spark, location)
    partitions = [f"`{f.name}`" for f in schema.fields if f.name.lower() in keys]
    if spark.catalog.tableExists(table):
        if spark.catalog.getTable(table).tableType != "EXTERNAL":
            raise ValueError(f"{table} is not an external table")
        spark.sql(f"DROP TABLE {table}")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = f"PARTITIONED BY ({', '.join(partitions)}) " if partitions else ""
    spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet {by}LOCATION '{location}'")
    if partitions:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def scan_table(spark: SparkSession, table: str) -> DataFrame:
    """A catalog table by ``table``, ``database.table`` or ``catalog.database.table``."""
    return spark.table(table)
