"""Every operator and question as a query over the test tables.

Queries on files and tables first write what they read back, into the shared folder. Each call
takes new paths and table names, so queries may run side by side and over again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cabrank.functions import numeric, temporal
from cabrank.operators import aggregates, filters, joins, projection, ranking
from cabrank.plans import ledger, pipelines, trips
from cabrank.plans.standin import UNKNOWN, table, trips_ev, zone_trips, zones
from cabrank.quality import KeyViolation, key_violations, known_keys, loaded_counts, require_key
from cabrank.session import fresh_database, fresh_dir
from cabrank.sinks import lake, layout, ordinal, quarantine, tables
from cabrank.sources import csv, files, months
from cabrank.sources import tables as source_tables
from cabrank.sources.tables import external_table, read_lake
from cabrank.specs import REGISTRY, DatasetSpec
from cabrank.streaming.landing import land_new_files

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

DAY = dt.date(2024, 1, 15)
FIRST, LAST = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
BASES = ("click", "view", "error")
PICKUP_ZONE = "NATION_15"
YEAR = (dt.date(1997, 1, 1), dt.date(1997, 12, 31))

# Monthly CSV directories as one partitioned write produces them: tripdata=<yyyy-MM>.csv.
ORDER_MONTHS = DatasetSpec(
    name="orders", event_time="o_orderdate", file_template="tripdata={month}.csv"
)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _staged_csv(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, T.StructType]:
    df = table(spark, sf_dir, name)
    return csv.write_csv(df, f"{fresh_dir(spark, 'source')}/{name}.csv"), df.schema


def _monthly_csv(spark: SparkSession, sf_dir: str) -> tuple[str, T.StructType, dt.date, dt.date]:
    """Orders as one CSV directory per month, with the first and last day in them."""
    orders = table(spark, sf_dir, "orders")
    label = F.concat(temporal.month_label("o_orderdate"), F.lit(".csv"))
    with layout.many_directories(spark):
        root = csv.write_csv(
            layout.by_group(orders.withColumn("tripdata", label), "tripdata"),
            fresh_dir(spark, "months"),
            "tripdata",
        )
    day = temporal.day_of("o_orderdate")
    first, last = orders.agg(F.min(day), F.max(day)).head()
    return root, orders.schema, first, last


def _first_half(df: DataFrame, time: str, split: dt.date) -> tuple[DataFrame, DataFrame]:
    early = F.coalesce(F.col(time) < F.lit(split), F.lit(False))
    return df.where(early), df.where(~early)


# Sources


@query
def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, _ = _staged_csv(spark, sf_dir, "supplier")
    df = csv.read_csv_inferred(spark, path)
    return df.withColumn("s_suppkey", F.col("s_suppkey").cast("bigint"))


@query
def scan_csv_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _staged_csv(spark, sf_dir, "lineitem")
    landed = lake.land_raw(
        csv.read_csv(spark, path, schema), fresh_dir(spark, "lake"), "lineitem", 5_000_000
    )
    return (
        read_lake(spark, landed)
        .groupBy("l_returnflag", "l_linestatus", "l_linenumber")
        .agg(
            F.count("*").alias("line_count"),
            F.sum(numeric.to_cents("l_extendedprice")).alias("price_cents"),
            F.sum(numeric.to_cents("l_quantity")).alias("quantity_cents"),
            F.sum(numeric.to_cents("l_discount")).alias("discount_cents"),
            F.sum(numeric.to_cents("l_tax")).alias("tax_cents"),
            *[F.sum(c).alias(f"{c}_sum") for c in ("l_orderkey", "l_partkey", "l_suppkey")],
            *[F.max(c).alias(f"{c}_max") for c in ("l_orderkey", "l_partkey", "l_suppkey")],
            F.min("l_shipdate").alias("first_ship"),
            F.max("l_shipdate").alias("last_ship"),
            F.max("l_tax").alias("max_tax"),
        )
    )


@query
def scan_csv_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _staged_csv(spark, sf_dir, "events")
    return csv.read_csv_typed(spark, path, {f.name: f.dataType for f in schema.fields})


@query
def external_table_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.part_external_table"
    return external_table(spark, name, f"{sf_dir}/part.parquet")


@query
def external_table_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with two headers: the earlier ones lack a column that the later ones have."""
    prefix = fresh_dir(spark, "yellow")
    early, late = _first_half(table(spark, sf_dir, "events"), "ts", DAY)
    early.drop("props").write.parquet(prefix)
    late.write.mode("append").parquet(prefix)
    name = f"{fresh_database(spark)}.yellow_tripdata_external_table"
    return external_table(spark, name, prefix)


@query
def scan_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.customers"
    tables.replace_table(table(spark, sf_dir, "customer"), name)
    return source_tables.scan_table(spark, f"spark_catalog.{name}")


@query
def monthly_source_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, schema, first, last = _monthly_csv(spark, sf_dir)
    loaded = months.read_months(spark, ORDER_MONTHS, root, first, last, schema)
    return aggregates.count_by(loaded, "month", name="trips")


# Sinks and publication


@query
def sink_table_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.zone_data"
    suppliers = table(spark, sf_dir, "supplier")
    tables.replace_table(suppliers.withColumn("s_name", F.lit("outdated")), name)
    return tables.replace_dimension(suppliers, name, "s_suppkey")


@query
def sink_create_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.orders"
    return tables.create_empty(table(spark, sf_dir, "orders"), name)


@query
def sink_table_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.yellow_taxi_data"
    tables.load_table(spark, _first_half(table(spark, sf_dir, "events"), "ts", DAY), name)
    return spark.table(name)


@query
def row_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return ordinal.write_ordered(orders, fresh_dir(spark, "ordered"), "o_orderdate", "o_orderkey")


@query
def row_ordinal_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    ordered = layout.by_range(orders, "o_orderdate", "o_orderkey")
    source = csv.write_csv(ordered, f"{fresh_dir(spark, 'source')}/orders.csv")
    return ordinal.load_csv_with_index(spark, source, orders.schema, fresh_dir(spark, "indexed"))


@query
def convert_csv_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, schema = _staged_csv(spark, sf_dir, "events")
    return read_lake(spark, lake.csv_to_parquet(spark, path, schema=schema))


@query
def land_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return read_lake(spark, lake.land_raw(customers, fresh_dir(spark, "lake"), "customer"))


@query
def relayout_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regrouped twice from a raw folder that holds other months each time."""
    root = fresh_dir(spark, "lake")
    halves = _first_half(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(1998, 1, 1))
    for half in halves:
        lake.land_raw(half, root, "green_tripdata_latest")
        target = lake.regroup_raw(spark, root, "green", "o_orderdate")
    return read_lake(spark, target)


@query
def ctas_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fresh_database(spark)}.yellow_tripdata"
    return tables.publish_by_day(table(spark, sf_dir, "events"), name, "ts")


@query
def ctas_partitioned_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two raw files that disagree about the type of the column that is left out."""
    root = fresh_dir(spark, "lake")
    early, late = _first_half(table(spark, sf_dir, "events"), "ts", DAY)
    lake.land_raw(early.withColumn("ehail_fee", F.lit(0.5)), root, "green_tripdata_early")
    lake.land_raw(late.withColumn("ehail_fee", F.lit("none")), root, "green_tripdata_late")
    raw = read_lake(spark, f"{root}/raw/green_tripdata*.parquet")
    name = f"{fresh_database(spark)}.green_tripdata"
    return tables.publish_by_day(raw, name, "ts", REGISTRY["green"].drop_columns)


@query
def registry_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three datasets, each with its own time column: landed, made external, published by day."""
    root, database = fresh_dir(spark, "lake"), fresh_database(spark)
    stand_ins = {
        "yellow": ("events", "ts"),
        "green": ("orders", "o_orderdate"),
        "fhv": ("events", "ts"),
    }
    for name, (source, time) in stand_ins.items():
        raw = table(spark, sf_dir, source).withColumnRenamed(time, REGISTRY[name].event_time)
        raw.withColumn("ehail_fee", F.lit(0.0)).write.parquet(f"{root}/{name}")
    sources = pipelines.lake_sources(spark, root, database)
    return pipelines.publish_registry(spark, sources, database)


@query
def monthly_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months, then the later half of them a second time."""
    root, schema, first, last = _monthly_csv(spark, sf_dir)
    target_lake = fresh_dir(spark, "lake")
    middle = first + (last - first) // 2
    for start in (first, middle):
        target = pipelines.backfill(spark, ORDER_MONTHS, root, target_lake, start, last, schema)
    return read_lake(spark, target)


@query
def monthly_landing_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same months landed by the file stream, which a second run leaves as they are."""
    root, schema, _, _ = _monthly_csv(spark, sf_dir)
    target, checkpoint = fresh_dir(spark, "landed"), fresh_dir(spark, "progress")
    for _ in range(2):
        land_new_files(spark, f"{root}/tripdata=*.csv", schema, target, checkpoint)
    return read_lake(spark, target)


@query
def load_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fresh_database(spark)
    orders = table(spark, sf_dir, "orders")
    tables.load_table(spark, [orders], f"{database}.orders")
    counts = loaded_counts(spark, f"{database}.orders", orders)
    return counts.withColumn("table_name", F.lit("orders"))


@query
def key_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_key(zones(spark, sf_dir), "LocationID")
    return key_violations(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query
def clustered_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips_by_dropoff = table(spark, sf_dir, "events").withColumnsRenamed(
        {"ts": "dropoff_datetime", "event_type": "dispatching_base_num"}
    )
    name = f"{fresh_database(spark)}.fhv_clustered"
    clustered = tables.publish_clustered(
        trips_by_dropoff, name, "dropoff_datetime", "dispatching_base_num", "dropoff_date"
    )
    wanted = filters.between_days(clustered, "dropoff_datetime", FIRST, LAST)
    # Ordered by base over all partitions, without leaving a frequent base to one task.
    return layout.by_range(wanted, "dispatching_base_num")


@query
def load_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which some have no time and some no number: good and bad rows, by what is wrong."""
    events = table(spark, sf_dir, "events")
    texts = events.withColumns(
        {
            "ts": F.when(F.col("event_id") % 97 == 0, "yesterday").otherwise(
                F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
            ),
            "value": F.when(F.col("event_id") % 89 == 0, "much").otherwise(F.col("value").cast("string")),
        }
    )
    source = csv.write_csv(texts, f"{fresh_dir(spark, 'source')}/events.csv")
    name = f"{fresh_database(spark)}.events"
    quarantine.load_checked(spark, source, name, events.schema, most_rejected=events.count())
    good = spark.table(name).select(F.lit("good").alias("verdict"), "event_id")
    number = F.substring_index("_record", ",", 1).cast("bigint").alias("event_id")
    bad = spark.table(f"{name}_rejected").select(F.col("_reason").alias("verdict"), number)
    counted = good.union(bad).groupBy("verdict")
    return counted.agg(F.count("*").alias("loaded"), F.sum("event_id").alias("ids"))


@query
def load_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The earlier months, then all, then again after two months got another file each."""
    root, schema, first, last = _monthly_csv(spark, sf_dir)
    target, middle = fresh_dir(spark, "lake"), first + (last - first) // 2
    for end in (middle, last, last):
        ledger.catch_up(spark, ORDER_MONTHS, root, target, first, end, schema)
    for month in ("1996-02", "2000-11"):
        path = f"{root}/{ORDER_MONTHS.file_name(month)}"
        again = csv.read_csv(spark, path, schema)
        again.coalesce(1).write.options(header=True, timestampNTZFormat=temporal.TIME_FORMAT).mode("append").csv(path)
    ledger.catch_up(spark, ORDER_MONTHS, root, target, first, last, schema)
    loads = ledger.read_ledger(spark, ORDER_MONTHS, target)
    times = loads.groupBy("month").agg(F.count("*").alias("loads"))
    landed = read_lake(spark, f"{target}/orders").groupBy("month").agg(F.count("*").alias("landed"))
    return ledger.last_loads(loads).select("month", "rows").join(times, "month").join(landed, "month")


@query
def append_key_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with a declared key; of a later batch the known ones, for which its append fails."""
    name = f"{fresh_database(spark)}.orders"
    early, late = _first_half(table(spark, sf_dir, "orders"), "o_orderdate", dt.date(1998, 1, 1))
    tables.load_table(spark, [early], name, key=["o_orderkey"])
    batch = late.union(early.where("o_orderkey % 7 = 0"))
    known = fresh_dir(spark, "known")
    known_keys(batch, spark.table(name), "o_orderkey").write.parquet(known)
    try:
        tables.append_table(batch, name)
    except KeyViolation:
        tables.append_table(late, name)
    return read_lake(spark, known).join(spark.table(name), "o_orderkey")


@query
def clustered_base_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two bases from the files that may have them."""
    events = table(spark, sf_dir, "events")
    name = f"{fresh_database(spark)}.fhv_clustered"
    tables.publish_clustered(events, name, "ts", "event_type", "event_day")
    return files.scan_indexed(spark, name, {"event_type": ["click", "error"]})


@query
def trips_for_bases_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows in the days of the question, from footers, and whether its columns are the smaller part."""
    name = f"{fresh_database(spark)}.trips"
    tables.publish_by_day(trips_ev(spark, sf_dir), name, "pickup_datetime")
    days = F.col("pickup_date").between(F.lit(FIRST), F.lit(LAST))
    asked = files.scan_bytes(spark, name, ["pickup_datetime", "dispatching_base_num"], days)
    whole = files.scan_bytes(spark, name, spark.table(name).columns).select(F.col("bytes").alias("all_bytes"))
    return asked.crossJoin(whole).select("rows", (F.col("bytes") < F.col("all_bytes")).alias("part"))


# Projections


@query
def project_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project_star(table(spark, sf_dir, "events"))


@query
def project_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project_except(table(spark, sf_dir, "events"), "props")


@query
def project_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projection.project_alias(
        trips_ev(spark, sf_dir),
        trip_id=F.col("trip_id"),
        trip_date=temporal.day_of("pickup_datetime"),
        tip=F.col("tip_amount"),
    )


@query
def distinct_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_range = filters.between_days(trips_ev(spark, sf_dir), "pickup_datetime", FIRST, LAST)
    return projection.distinct_values(in_range, "dispatching_base_num")


# Filters


@query
def filter_date_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.on_day(trips_ev(spark, sf_dir), "pickup_datetime", DAY)


@query
def filter_year_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.in_month(table(spark, sf_dir, "orders"), "o_orderdate", 1997, 3)


@query
def filter_date_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.between_days(trips_ev(spark, sf_dir), "pickup_datetime", FIRST, LAST)


@query
def filter_string_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = joins.join_dimension(
        zone_trips(spark, sf_dir), zones(spark, sf_dir), joins.PICKUP_KEY, pickup_zone="Zone"
    )
    return filters.equals(named, "pickup_zone", PICKUP_ZONE)


@query
def filter_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips_ev(spark, sf_dir).where(filters.any_of("raw_base", BASES))


@query
def filter_not_in_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = joins.without_unknown_zones(zone_trips(spark, sf_dir), UNKNOWN)
    return aggregates.count_by(placed, joins.PICKUP_KEY, joins.DROPOFF_KEY)


@query
def filter_conjunction(spark: SparkSession, sf_dir: str) -> DataFrame:
    in_range = filters.between_days(trips_ev(spark, sf_dir), "pickup_datetime", FIRST, LAST)
    return in_range.where(filters.any_of("raw_base", BASES))


# Joins


@query
def join_dim_inner(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers of nation 7 count as having no zone, and drop out."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.nullif("c_nationkey", F.lit(7)).alias(joins.PICKUP_KEY)
    )
    return joins.join_dimension(
        customers, zones(spark, sf_dir), joins.PICKUP_KEY, pickup_zone="Zone"
    )


@query
def join_dim_role_playing(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = joins.join_both_roles(zone_trips(spark, sf_dir), zones(spark, sf_dir))
    return aggregates.count_by(named, "pickup_zone", "dropoff_zone")


# Aggregations


@query
def count_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_rows(table(spark, sf_dir, "lineitem"))


@query
def count_by_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_by(zone_trips(spark, sf_dir), joins.DROPOFF_KEY)


@query
def max_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.max_by_day(
        trips_ev(spark, sf_dir), "pickup_datetime", "tip_amount", "max_tip_amount"
    )


@query
def avg_by_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.mean_by(
        zone_trips(spark, sf_dir),
        joins.PICKUP_KEY,
        joins.DROPOFF_KEY,
        amount="total_amount",
        name="average_fare",
    )


@query
def distinct_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aggregates.count_distinct_values(
        trips_ev(spark, sf_dir), "dispatching_base_num", name="bases"
    )


# Sorts and limits


def _daily_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = temporal.day_of("pickup_datetime")
    return aggregates.count_by(trips_ev(spark, sf_dir).withColumn("trip_date", day), "trip_date")


@query
def sort_asc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sort_asc(_daily_counts(spark, sf_dir), "trip_date")


@query
def sort_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.sort_desc(_daily_counts(spark, sf_dir), "trip_count", "trip_date")


@query
def top_1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top(_daily_counts(spark, sf_dir), "trip_count", "trip_date")


# Scalar functions


@query
def fn_to_timestamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("pickup_datetime").cast("string")
    return trips_ev(spark, sf_dir).select(
        "trip_id", temporal.parse_time(text).alias("pickup_datetime")
    )


@query
def fn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = temporal.day_of("pickup_datetime")
    return trips_ev(spark, sf_dir).select("trip_id", day.alias("trip_date"))


@query
def fn_date_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = temporal.as_date("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", temporal.year_of(day).alias("year"), temporal.month_of(day).alias("month")
    )


@query
def fn_cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = temporal.as_date("pickup_datetime")
    return trips_ev(spark, sf_dir).select("trip_id", day.alias("trip_date"))


@query
def fn_round_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    net = F.col("l_extendedprice").cast("decimal(12,2)") * (
        1 - F.col("l_discount").cast("decimal(4,2)")
    )
    rounded = lines.select("l_shipdate", numeric.round_numeric(net).alias("net"))
    return rounded.groupBy("l_shipdate").agg(
        F.sum(numeric.to_cents("net")).alias("net_cents"), F.max("net").alias("max_net")
    )


# Named questions


@query
def trips_on_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_on_day(trips_ev(spark, sf_dir), DAY)


@query
def daily_max_tip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.daily_max_tip(trips_ev(spark, sf_dir), 2024, 1)


@query
def top_tip_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.top_tip_day(trips_ev(spark, sf_dir), 2024, 1)


@query
def top_destination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.top_destination(
        zone_trips(spark, sf_dir), zones(spark, sf_dir), PICKUP_ZONE, *YEAR
    )


@query
def priciest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.priciest_pair(zone_trips(spark, sf_dir), zones(spark, sf_dir), UNKNOWN)


@query
def trips_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_in_range(trips_ev(spark, sf_dir), FIRST, LAST)


@query
def trips_in_range_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same count on the day-partitioned table, where it lists only the days asked for."""
    name = f"{fresh_database(spark)}.fhv_tripdata"
    published = tables.publish_by_day(trips_ev(spark, sf_dir), name, "pickup_datetime")
    return trips.trips_in_range(published, FIRST, LAST)


@query
def distinct_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.distinct_bases(trips_ev(spark, sf_dir), FIRST, LAST)


@query
def trips_for_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trips.trips_for_bases(trips_ev(spark, sf_dir), FIRST, LAST, BASES, base="raw_base")

