"""Load pipelines: CSV into tables, months into the lake, the lake into day-partitioned tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.functions.temporal import day_of, month_number
from cabrank.operators.aggregates import count_by
from cabrank.operators.filters import DAY_COLUMN
from cabrank.sinks.layout import by_group, many_directories
from cabrank.session import fresh_dir
from cabrank.sinks.ordinal import load_csv_with_index
from cabrank.quality import require_row_count
from cabrank.sinks.tables import load_table, publish_by_day, refresh_days, replace_dimension
from cabrank.sources.csv import header_schema, read_csv_typed
from cabrank.sources.months import MONTH_COLUMN, month_range, scan_months
from cabrank.sources.tables import external_table
from cabrank.specs import REGISTRY, ZONES, DatasetSpec


def load_zones(spark: SparkSession, source: str, table: str = "zone_data") -> DataFrame:
    """Replace the zone dimension by a CSV file, whose ``LocationID`` must be a key."""
    return replace_dimension(read_csv_typed(spark, source, ZONES.types), table, "LocationID")


def load_trips(
    spark: SparkSession,
    source: str,
    table: str = "yellow_taxi_data",
    spec: DatasetSpec = REGISTRY["yellow"],
    row_numbers: bool = True,
) -> int:
    """Replace a trip table by a CSV file; returns the checked row count.

    ``row_numbers`` adds the position of each row in the source as column ``index``, at the cost
    of landing the rows once before.
    """
    if row_numbers:
        schema = header_schema(spark, source, spec.types)
        trips = load_csv_with_index(spark, source, schema, fresh_dir(spark, table))
    else:
        trips = read_csv_typed(spark, source, spec.types)
    return load_table(spark, [trips], table)


def backfill(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    lake: str,
    first: dt.date,
    last: dt.date,
    schema: T.StructType | None = None,
) -> str:
    """Load the monthly CSV files of a range into ``<lake>/<dataset>/month=…``; returns the path.

    Every month of the range is loaded, whatever has been before; ``ledger.catch_up`` loads only
    what is new or changed.
    """
    return land_months(spark, spec, root, lake, month_range(first, last), schema)


def land_months(
    spark: SparkSession,
    spec: DatasetSpec,
    root: str,
    lake: str,
    months: Sequence[str],
    schema: T.StructType | None = None,
) -> str:
    """Load the files of some ``yyyy-MM`` months into the lake; returns the dataset's path there.

    All of them are one job. It replaces these months and leaves all others alone, so any can be
    run again. The months that come through the write are observed: one whose file has become
    empty writes no partition and has its old one emptied.
    """
    target = f"{lake.rstrip('/')}/{spec.name}"
    first = int(months[0][:4]) * 12 + int(months[0][5:])
    trips = scan_months(spark, spec, root, months, schema)
    seen = Observation()
    position = month_number(MONTH_COLUMN) - F.lit(first)
    written = F.bitmap_construct_agg(position).alias("months")
    with many_directories(spark):
        (
            by_group(trips, MONTH_COLUMN)
            .observe(seen, written)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(MONTH_COLUMN)
            .parquet(target)
        )
    bitmap = int.from_bytes(seen.get["months"], "little")
    for month in months:
        if not bitmap >> int(month[:4]) * 12 + int(month[5:]) - first & 1:
            empty = trips.drop(MONTH_COLUMN).limit(0)
            empty.write.mode("overwrite").parquet(f"{target}/{MONTH_COLUMN}={month}")
    return target


def lake_sources(
    spark: SparkSession,
    lake: str,
    database: str,
    registry: Mapping[str, DatasetSpec] = REGISTRY,
) -> dict[str, DataFrame]:
    """External tables ``<database>.<dataset>_tripdata_external_table`` over ``<lake>/<dataset>``.

    The month that only the directories know is left out.
    """
    return {
        name: external_table(
            spark,
            f"{database}.{name}_tripdata_external_table",
            f"{lake.rstrip('/')}/{name}",
            spec.drop_columns,
        ).drop(MONTH_COLUMN)
        for name, spec in registry.items()
    }


def publish_registry(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    database: str,
    registry: Mapping[str, DatasetSpec] = REGISTRY,
) -> DataFrame:
    """Publish ``<database>.<dataset>_tripdata`` by day for each registered dataset.

    ``sources`` holds the raw trips of each dataset, usually an external table. The datasets are
    published side by side, and their trips counted while they are written. Returns the trips
    per dataset and day, for which one column of the sources is read.
    """

    def publish(name: str) -> None:
        spec, written = registry[name], Observation()
        trips = sources[name].observe(written, F.count(F.lit(1)).alias("rows"))
        table = f"{database}.{name}_tripdata"
        publish_by_day(trips, table, spec.event_time, spec.drop_columns)
        require_row_count(spark, table, written.get["rows"])

    with ThreadPoolExecutor(max_workers=max(1, len(registry))) as pool:
        list(pool.map(publish, registry))
    return reduce(DataFrame.unionByName, [_daily(sources[n], n, s) for n, s in registry.items()])


def refresh_registry(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    database: str,
    registry: Mapping[str, DatasetSpec] = REGISTRY,
) -> DataFrame:
    """Replace the days of ``sources``, some months of each dataset, in the published tables."""
    for name, source in sources.items():
        spec = registry[name]
        refresh_days(source, f"{database}.{name}_tripdata", spec.event_time, spec.drop_columns)
    counts = [_daily(source, name, registry[name]) for name, source in sources.items()]
    return reduce(DataFrame.unionByName, counts)


def _daily(source: DataFrame, name: str, spec: DatasetSpec) -> DataFrame:
    days = source.select(day_of(spec.event_time).alias(DAY_COLUMN))
    daily = count_by(days, DAY_COLUMN, name="trips")
    return daily.select(F.lit(name).alias("dataset"), DAY_COLUMN, "trips")
