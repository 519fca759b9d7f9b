"""Versions of a table behind one catalog pointer.

A published table is a view ``SELECT * FROM <database>__versions.<version>`` and nothing else. Every
version has a folder of its own and is written, counted and checked before the view is pointed at
it, which is one change of one catalog entry: readers find the old version or the new one, never
none, and a run that dies anywhere leaves the old one. Readers that have resolved the old version
go on reading it, as it stays until the publication after the next; then it is collected, and so is
what dead runs have left behind, once it is older than ``GRACE``.

A plain table that someone else made under the name is renamed away at its first replacement. That
once, the name is free for a moment.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Table properties: the declared key, and the mark of a version that another has taken the place of.
KEY = "cabrank.key"
REPLACED = "cabrank.replaced"

# A version that was never pointed at may belong to a run that is still writing it.
GRACE = dt.timedelta(days=1)

_STAMP = "%Y%m%d%H%M%S"


@dataclass(frozen=True)
class Version:
    """A table that is being written, by its catalog name, and its folder."""

    name: str
    path: str


def _split(spark: SparkSession, table: str) -> tuple[str, str]:
    *_, database, name = [spark.catalog.currentDatabase(), *table.split(".")]
    return database, name


def _store(database: str) -> str:
    return f"{database}__versions"


@contextmanager
def new_version(spark: SparkSession, table: str) -> Iterator[Version]:
    """A version to write; if that fails before the table points at it, nothing of it is left."""
    database, name = _split(spark, table)
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_store(database)} LOCATION '{folder}/__versions'")
    own = f"{name}__{dt.datetime.now(dt.timezone.utc):{_STAMP}}_{uuid.uuid4().hex[:8]}"
    version = Version(f"{_store(database)}.{own}", f"{folder}/__versions/{own}")
    try:
        yield version
    except BaseException:
        if current(spark, table) != version.name:
            discard(spark, version)
        raise


def discard(spark: SparkSession, version: Version) -> None:
    """Drop a version with its folder."""
    spark.sql(f"DROP TABLE IF EXISTS {version.name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(version.path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def current(spark: SparkSession, table: str) -> str | None:
    """The version that a published table points at; None for any other table."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'View Text'").head(1)
    target = rows[0]["data_type"].rpartition(" FROM ")[2] if rows else ""
    database, name = _split(spark, table)
    return target if target.startswith(f"{_store(database)}.{name}__") else None


def stored(spark: SparkSession, table: str) -> str:
    """The table that holds the rows: the current version, or the table itself."""
    return current(spark, table) or table


def location(spark: SparkSession, table: str) -> str:
    """The folder with the rows of a table."""
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {stored(spark, table)}")
    return described.where("col_name = 'Location'").head()["data_type"]


def declare_key(spark: SparkSession, name: str, key: Sequence[str]) -> None:
    """Store the key with a version, for the appends to come."""
    if key:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEY}' = '{json.dumps(list(key))}')")


def declared_key(spark: SparkSession, table: str) -> list[str]:
    rows = spark.sql(f"SHOW TBLPROPERTIES {stored(spark, table)}").where(f"key = '{KEY}'").head(1)
    return json.loads(rows[0]["value"]) if rows else []


def publish(spark: SparkSession, version: Version, table: str, grace: dt.timedelta = GRACE) -> DataFrame:
    """Point the table at a finished version, and return that version's rows."""
    database, name = _split(spark, table)
    before = current(spark, table)
    if before is not None:
        point(spark, table, version)
        spark.sql(f"ALTER TABLE {before} SET TBLPROPERTIES ('{REPLACED}' = 'true')")
    elif spark.catalog.tableExists(table):
        aside = f"{name}__old_{uuid.uuid4().hex[:12]}"
        spark.sql(f"ALTER TABLE {table} RENAME TO {database}.{aside}")
        try:
            spark.sql(f"CREATE VIEW {table} AS SELECT * FROM {version.name}")
        except BaseException:
            spark.sql(f"ALTER TABLE {database}.{aside} RENAME TO {database}.{name}")
            raise
        spark.sql(f"DROP TABLE {database}.{aside}")
    else:
        spark.sql(f"CREATE VIEW {table} AS SELECT * FROM {version.name}")
    collect(spark, table, {version.name, before}, grace)
    return spark.table(version.name)


def point(spark: SparkSession, table: str, version: Version) -> None:
    """The switch: the catalog entry of the view gets its new text and schema in one change."""
    spark.sql(f"ALTER VIEW {table} AS SELECT * FROM {version.name}")


def versions(spark: SparkSession, table: str) -> list[Version]:
    """All versions of a table, also the unfinished ones, the oldest first."""
    database, name = _split(spark, table)
    folder = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    found = spark.sql(f"SHOW TABLES IN {_store(database)} LIKE '{name}__*'").where("NOT isTemporary")
    own = sorted(row["tableName"] for row in found.collect())
    return [Version(f"{_store(database)}.{n}", f"{folder}/__versions/{n}") for n in own]


def collect(spark: SparkSession, table: str, keep: set[str | None], grace: dt.timedelta = GRACE) -> None:
    """Drop the versions that were replaced before, and what dead runs have left."""
    limit = dt.datetime.now(dt.timezone.utc) - grace
    _, name = _split(spark, table)
    for version in versions(spark, table):
        stamp = version.name.rpartition(".")[2][len(name) + 2 :].partition("_")[0]
        if version.name in keep or not stamp.isdigit():
            continue
        begun = dt.datetime.strptime(stamp, _STAMP).replace(tzinfo=dt.timezone.utc)
        marks = spark.sql(f"SHOW TBLPROPERTIES {version.name}").where(f"key = '{REPLACED}'")
        if begun <= limit or marks.head(1):
            discard(spark, version)
    _collect_folders(spark, table, limit)


def _collect_folders(spark: SparkSession, table: str, limit: dt.datetime) -> None:
    """Folders of versions that died before the catalog knew of them."""
    database, name = _split(spark, table)
    root = spark._jvm.org.apache.hadoop.fs.Path(
        f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/__versions"
    )
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    known = {v.path.rpartition("/")[2] for v in versions(spark, table)}
    for status in system.listStatus(root) if system.exists(root) else []:
        own = status.getPath().getName()
        stamp = own[len(name) + 2 :].partition("_")[0]
        if not own.startswith(f"{name}__") or own in known or not stamp.isdigit() or len(stamp) != 14:
            continue
        if dt.datetime.strptime(stamp, _STAMP).replace(tzinfo=dt.timezone.utc) <= limit:
            system.delete(status.getPath(), True)
