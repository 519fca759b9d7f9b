"""Session settings, and the shared folder that intermediate tables are written to."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import SparkSession

MIB = 1024 * 1024

# What one task should carry. AQE merges smaller shuffle partitions towards it. It divides larger
# ones only in rebalances and, where they are skewed, in joins; so the number has to be right for
# aggregations, sorts and evenly large joins from the start.
PARTITION_BYTES = 128 * MIB

# A shuffle has a block for each pair of a map and a reduce task, so both numbers are bounded.
# Tasks keep to PARTITION_BYTES up to 25 TB and then grow: 512 MB at 100 TB.
MAX_MAP_TASKS = 200_000
MAX_SHUFFLE_PARTITIONS = 200_000

_local_dirs: dict[str, tempfile.TemporaryDirectory] = {}

# Folders on ``file:`` that were tried, by application.
_tried: set[tuple[str, str]] = set()


def shuffle_partitions(input_bytes: int, minimum: int = 8) -> int:
    """Reduce partitions for an input of this size; AQE merges them where a shuffle is smaller."""
    wanted = math.ceil(input_bytes / PARTITION_BYTES)
    return max(minimum, min(MAX_SHUFFLE_PARTITIONS, wanted))


def split_bytes(input_bytes: int) -> int:
    """Size of the file splits for an input of this size."""
    return max(PARTITION_BYTES, math.ceil(input_bytes / MAX_MAP_TASKS))


def build_session(
    app: str = "cabrank",
    master: str | None = None,
    input_bytes: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """A session set up for trip jobs.

    ``input_bytes``, the size of the largest input, sizes splits and shuffles, for which Spark's
    defaults of 128 MB and 200 partitions are too small by far at 100 TB. ``conf`` overrides any
    setting.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(PARTITION_BYTES),
        # Day-partitioned tables have thousands of directories: list them in a few hundred tasks,
        # not in one each.
        "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    }
    if input_bytes is not None:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions(input_bytes))
        settings["spark.sql.files.maxPartitionBytes"] = str(split_bytes(input_bytes))
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    A local master without the setting gets a temporary folder of its own. A cluster without it is
    an error. A path on ``file:``, by its own scheme or by that of ``fs.defaultFS``, may be a mount
    that all nodes share or a disk of each node, which its name does not tell: a cluster tries it
    once per application, and one that executors cannot share is an error as well.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    cluster = not spark.conf.get("spark.master", "").startswith("local")
    if cluster and not shared:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors can reach")
    if cluster and (shared.startswith("file:") or _local_by_default(spark, shared)):
        _try_shared(spark, shared.rstrip("/"))
    if shared:
        return shared.rstrip("/")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.TemporaryDirectory(prefix="cabrank-")
    return _local_dirs[app].name


def _local_by_default(spark: SparkSession, path: str) -> bool:
    """Whether a path without a scheme lies on the file system of each node."""
    if ":" in path.partition("/")[0]:
        return False
    return spark._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///").startswith("file:")


def _try_shared(spark: SparkSession, shared: str) -> None:
    """Fail unless the driver and other tasks find what tasks have written to the folder.

    Two rows for each core of the cluster, each a file of its own, are written, listed by the
    driver, read by other tasks and deleted again. On local disks the driver misses the files of
    other nodes. Executors that join later are not asked.
    """
    try:
        tried = (spark.sparkContext.applicationId, shared)
        if tried in _tried:
            return
        files = 2 * spark.sparkContext.defaultParallelism
        path = f"{shared}/cabrank/probe-{uuid.uuid4().hex[:12]}"
        try:
            spark.range(0, files, 1, files).write.parquet(path)
            found = spark.read.schema("id long").parquet(path).count()
        finally:
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        if found != files:
            raise FileNotFoundError(f"{files - found} of {files} files written to {path} are not there")
    except Exception as error:
        raise RuntimeError(
            f"set spark.checkpoint.dir to a folder that all executors can reach, not {shared}"
        ) from error
    _tried.add(tried)


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path under the workspace that nothing has been written to yet."""
    return f"{workspace(spark)}/cabrank/{label}-{uuid.uuid4().hex[:12]}"


def fresh_database(spark: SparkSession, label: str = "scratch") -> str:
    """A new database whose managed tables live in the shared folder, not in a local warehouse."""
    name = f"{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{fresh_dir(spark, name)}'")
    return name
