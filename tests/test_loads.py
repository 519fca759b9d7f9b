"""Loading, publication, layouts and row numbers on small hand-made inputs."""

import datetime as dt
import pathlib

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from cabrank.operators.filters import between_days, on_day
from cabrank.plans import pipelines, trips
from cabrank.quality import KeyViolation, RowCountMismatch
from cabrank.session import (
    build_session,
    fresh_database,
    shuffle_partitions,
    split_bytes,
    workspace,
)
from cabrank.sinks import jdbc, lake, layout, ordinal, tables, versions
from cabrank.sources import csv, months
from cabrank.sources.tables import external_table, read_lake, scan_table
from cabrank.specs import REGISTRY, DatasetSpec
from cabrank.streaming.landing import land_new_files
from test_plans import setting

TIME = T.TimestampNTZType()
SPEC = DatasetSpec("cab", "pickup", {"pickup": TIME, "fare": T.DoubleType(), "id": T.LongType()})
SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("pickup", TIME),
        T.StructField("fare", T.DoubleType()),
    ]
)


def put(path, *lines):
    path = pathlib.Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    return str(path)


def month_file(root, month, *ids):
    data = [f"{i},{month}-03 10:00:00,1.5" for i in ids]
    return put(f"{root}/cab_tripdata_{month}.csv", "id,pickup,fare", *data)


def ids(df):
    return sorted(row["id"] for row in df.select("id").collect())


# CSV


def test_only_csv_is_accepted(spark, tmp_path):
    for read in (csv.read_csv_inferred, lambda s, p: csv.read_csv(s, p, SCHEMA)):
        with pytest.raises(ValueError, match="only .csv"):
            read(spark, str(tmp_path / "trips.txt"))
    with pytest.raises(ValueError, match="only .csv"):
        lake.csv_to_parquet(spark, str(tmp_path / "trips.tsv"))
    with pytest.raises(ValueError, match="none"):
        csv.require_csv()


def test_quotes_commas_and_missing_values(spark, tmp_path):
    path = put(
        tmp_path / "zones.csv",
        '"LocationID","Zone","Note"',
        '1,"Park, ""North"""," spaced "',
        "2,,x",
    )
    rows = [tuple(r) for r in csv.read_csv_inferred(spark, path).collect()]
    assert rows == [(1, 'Park, "North"', " spaced "), (2, None, "x")]
    copy = csv.write_csv(csv.read_csv_inferred(spark, path), str(tmp_path / "copy.csv"))
    assert [tuple(r) for r in csv.read_csv_inferred(spark, copy).collect()] == rows


def test_inferred_times_have_no_zone(spark, tmp_path):
    path = put(tmp_path / "t.csv", "a,t", "1,2021-01-01 00:30:10")
    df = csv.read_csv_inferred(spark, path)
    assert df.schema["t"].dataType == TIME
    with setting(spark, "spark.sql.session.timeZone", "America/New_York"):
        assert csv.read_csv_inferred(spark, path).head()["t"] == dt.datetime(2021, 1, 1, 0, 30, 10)


def test_typed_columns_resolve_without_case_and_others_are_inferred(spark, tmp_path):
    path = put(tmp_path / "t.csv", "Pickup,ID,extra", "2021-01-01 00:30:10,7,007")
    other = put(tmp_path / "u.csv", "Pickup,ID,extra", "2021-01-01T00:30:10,8,1.5", "2021-01-02,9,")
    df = csv.read_csv_typed(spark, [path, other], SPEC.types)
    assert df.schema["Pickup"].dataType == TIME
    assert {tuple(row) for row in df.collect()} == {
        (dt.datetime(2021, 1, 1, 0, 30, 10), 7, 7.0),
        (dt.datetime(2021, 1, 1, 0, 30, 10), 8, 1.5),
        (dt.datetime(2021, 1, 2), 9, None),
    }


def test_numbers_of_the_published_columns_load_as_numbers(spark, tmp_path):
    header = "VendorID,tpep_pickup_datetime,fare_amount,store_and_fwd_flag"
    path = put(tmp_path / "t.csv", header, "1,2021-01-01 00:30:10,9.5,N", ",2021-01-01,100,")
    name = f"{fresh_database(spark)}.trips"
    assert pipelines.load_trips(spark, path, name) == 2
    assert spark.table(name).selectExpr("max(fare_amount)", "max(VendorID)").head() == (100.0, 1)


def test_quoted_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "one\ntwo"), (2, 'say "x"')], "id long, note string")
    path = csv.write_csv(df, f"{tmp_path}/t.csv")
    read = csv.read_csv(spark, path, df.schema, multi_line=True)
    assert sorted(map(tuple, read.collect())) == [(1, "one\ntwo"), (2, 'say "x"')]
    assert read.count() == 2
    assert csv.read_csv_typed(spark, path, {}, multi_line=True).count() == 2
    for action in ("collect", "count"):
        with pytest.raises(Exception, match="MALFORMED"):
            getattr(csv.read_csv(spark, path, df.schema), action)()


def test_malformed_value_fails(spark, tmp_path):
    path = put(tmp_path / "t.csv", "id,pickup,fare", "1,not a time,2.0")
    with pytest.raises(Exception, match="MALFORMED"):
        csv.read_csv(spark, path, SCHEMA).collect()


def test_reordered_header_fails(spark, tmp_path):
    one = put(tmp_path / "a.csv", "id,pickup,fare", "1,2021-01-01 00:00:00,2.0")
    two = put(tmp_path / "b.csv", "id,fare,pickup", "1,2.0,2021-01-01 00:00:00")
    with pytest.raises(Exception, match="CSV header does not conform"):
        csv.read_csv_typed(spark, [one, two], SPEC.types).collect()


# Months


def test_month_range_and_paths():
    labels = months.month_range(dt.date(2019, 11, 30), dt.date(2020, 2, 1))
    assert labels == ["2019-11", "2019-12", "2020-01", "2020-02"]
    paths = months.monthly_paths(
        REGISTRY["yellow"], "s3a://b/", dt.date(2021, 1, 1), dt.date(2021, 1, 9)
    )
    assert paths == ["s3a://b/yellow_tripdata_2021-01.csv"]


def test_missing_month_fails(spark, tmp_path):
    month_file(tmp_path, "2021-01", 1)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        months.read_months(spark, SPEC, str(tmp_path), dt.date(2021, 1, 1), dt.date(2021, 2, 1))


def test_backfill_replaces_only_its_months(spark, tmp_path):
    root, target = tmp_path / "csv", str(tmp_path / "lake")
    span = (dt.date(2021, 1, 1), dt.date(2021, 3, 31))
    for month, values in (("2021-01", (1, 2)), ("2021-02", (3,)), ("2021-03", (4, 5))):
        month_file(root, month, *values)

    def run(first, last):
        return spark.read.parquet(
            pipelines.backfill(spark, SPEC, str(root), target, first, last)
        )

    assert ids(run(*span)) == [1, 2, 3, 4, 5]
    assert ids(run(*span)) == [1, 2, 3, 4, 5]
    month_file(root, "2021-01", 99)  # outside the next range
    month_file(root, "2021-02")  # now empty
    month_file(root, "2021-03", 6)
    again = run(dt.date(2021, 2, 1), dt.date(2021, 3, 31))
    assert ids(again) == [1, 2, 6]
    assert dict(again.groupBy("month").count().collect()) == {"2021-01": 2, "2021-03": 1}
    month_file(root, "2021-03")
    assert ids(run(dt.date(2021, 2, 1), dt.date(2021, 3, 31))) == [1, 2]


def test_stream_lands_each_file_once(spark, tmp_path):
    root, target, progress = (str(tmp_path / n) for n in ("csv", "landed", "progress"))
    month_file(root, "2021-01", 1, 2)

    def run():
        land_new_files(spark, f"{root}/*.csv", SCHEMA, target, progress)
        return ids(spark.read.parquet(target))

    assert run() == [1, 2]
    assert run() == [1, 2]
    month_file(root, "2021-02", 3)
    assert run() == [1, 2, 3]


# Tables


def test_load_trips_and_zones(spark, tmp_path):
    database = fresh_database(spark)
    header = "tpep_pickup_datetime,tpep_dropoff_datetime,PULocationID,DOLocationID,total_amount,x"
    data = [f"2021-01-0{i} 00:00:00,2021-01-0{i} 00:10:00,{i},1,{i}.5,t{i}" for i in (3, 1, 2)]
    source = put(tmp_path / "trips.csv", header, *data)
    assert pipelines.load_trips(spark, source, f"{database}.indexed") == 3
    rows = spark.table(f"{database}.indexed").orderBy("index").select("index", "x").collect()
    assert [tuple(r) for r in rows] == [(0, "t3"), (1, "t1"), (2, "t2")]
    assert pipelines.load_trips(spark, source, f"{database}.plain", row_numbers=False) == 3
    assert pipelines.load_trips(spark, source, f"{database}.plain", row_numbers=False) == 3
    good = put(tmp_path / "zones.csv", "LocationID,Zone", "1,Park", "2,Harbour")
    bad = put(tmp_path / "twice.csv", "LocationID,Zone", "1,Park", "1,Harbour")
    assert pipelines.load_zones(spark, good, f"{database}.zone_data").count() == 2
    with pytest.raises(KeyViolation):
        pipelines.load_zones(spark, bad, f"{database}.zone_data")
    assert spark.table(f"{database}.zone_data").count() == 2


def test_months_to_questions(spark, tmp_path):
    """All registered datasets from monthly files, with headers in different case, to answers."""
    root, target = tmp_path / "csv", str(tmp_path / "lake")
    headers = {
        "yellow": ["tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "tip_amount"],
        "green": ["lpep_pickup_datetime", "ehail_fee", "total_amount"],
        "fhv": ["Pickup_datetime", "dropoff_datetime", "dispatching_base_num"],
    }
    values = {"yellow": "2,3.5", "green": "1.5", "fhv": "B1"}
    for name, header in headers.items():
        for month, renamed in (("2021-01", str), ("2021-02", str.lower)):
            day = f"{month}-05 23:30:00"
            later = "x" if name == "green" else f"{month}-06 00:10:00"
            lines = [f"{day},{later},{values[name]}"] * 2
            if name == "fhv":
                lines.append(f"{day},{later},")
            put(root / f"{name}_tripdata_{month}.csv", renamed(",".join(header)), *lines)
    span = (dt.date(2021, 1, 1), dt.date(2021, 2, 28))
    for spec in REGISTRY.values():
        pipelines.backfill(spark, spec, str(root), target, *span)
    database = fresh_database(spark)
    sources = pipelines.lake_sources(spark, target, database)
    counts = pipelines.publish_registry(spark, sources, database).collect()
    assert {tuple(r) for r in counts} == {
        (name, dt.date(2021, month, 5), 3 if name == "fhv" else 2)
        for name in headers
        for month in (1, 2)
    }
    assert "ehail_fee" not in spark.table(f"{database}.green_tripdata").columns
    fhv = spark.table(f"{database}.fhv_tripdata")
    january = (dt.date(2021, 1, 1), dt.date(2021, 1, 5))
    assert trips.distinct_bases(fhv, *january).head()[0] == 2
    assert trips.trips_for_bases(fhv, *january, ["B1", "B2"]).head()[0] == 2
    best = trips.top_tip_day(
        spark.table(f"{database}.yellow_tripdata"), 2021, 2, "tpep_pickup_datetime"
    )
    assert tuple(best.head()) == (dt.date(2021, 2, 5), 3.5)


def test_day_column_serves_only_its_own_time(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2021, 1, 1, 23, 50), dt.datetime(2021, 1, 2, 0, 10))],
        "id int, pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz",
    )
    published = tables.publish_by_day(df, f"{fresh_database(spark)}.t", "pickup_datetime")
    one, two = dt.date(2021, 1, 1), dt.date(2021, 1, 2)
    assert ids(on_day(published, "dropoff_datetime", two)) == [1]
    assert ids(on_day(published, "Pickup_Datetime", one)) == [1]
    assert ids(on_day(published, "pickup_datetime", two)) == []


def test_a_changed_time_is_filtered_by_itself(spark):
    times = [dt.datetime(2021, 1, 1, 23, 50), dt.datetime(2021, 1, 2, 12)]
    df = spark.createDataFrame(list(enumerate(times)), "id int, t timestamp_ntz")
    name = f"{fresh_database(spark)}.t"
    published = tables.publish_by_day(df, name, "t")
    later = published.withColumn("t", F.col("t") + F.expr("interval 1 hour"))
    assert ids(on_day(later, "t", dt.date(2021, 1, 2))) == [0, 1]
    again = tables.publish_by_day(later, name, "t")
    assert again.columns.count("pickup_date") == 1
    assert ids(on_day(again, "t", dt.date(2021, 1, 2))) == [0, 1]


def test_a_failed_publish_leaves_the_old_table(spark):
    name = f"{fresh_database(spark)}.t"
    df = spark.createDataFrame([(1, dt.datetime(2021, 1, 1))], "id int, t timestamp_ntz")
    tables.publish_by_day(df, name, "t")
    broken = df.withColumn("id", F.raise_error(F.lit("boom")).cast("int"))
    for publish in (
        lambda: tables.publish_by_day(broken, name, "t"),
        lambda: tables.replace_table(broken, name),
        lambda: tables.publish_clustered(broken, name, "t", "id", "day"),
    ):
        with pytest.raises(Exception, match="boom"):
            publish()
        assert ids(spark.table(name)) == [1]
        assert ids(on_day(spark.table(name), "t", dt.date(2021, 1, 1))) == [1]
    database = name.partition(".")[0]
    assert [t.name for t in spark.catalog.listTables(database) if not t.isTemporary] == ["t"]
    assert len(versions.versions(spark, name)) == 1


def test_refresh_replaces_only_its_days(spark):
    rows = [(1, dt.datetime(2021, 1, 1)), (2, dt.datetime(2021, 1, 2)), (3, dt.datetime(2021, 2, 1))]
    df = spark.createDataFrame(rows, "id int, t timestamp_ntz")
    name = f"{fresh_database(spark)}.t"
    tables.publish_by_day(df, name, "t")
    new = [(dt.datetime(2021, 1, 2, 5), 20), (dt.datetime(2021, 1, 2, 6), 21), (dt.datetime(2021, 3, 1), 4)]
    after = tables.refresh_days(spark.createDataFrame(new, "t timestamp_ntz, id int"), name, "t")
    assert ids(after) == [1, 3, 4, 20, 21]
    assert ids(on_day(after, "t", dt.date(2021, 1, 2))) == [20, 21]


def test_months_with_other_columns_make_one_table(spark, tmp_path):
    root, target = f"{tmp_path}/csv", f"{tmp_path}/lake"
    spec = DatasetSpec("cab", "pickup", {**SPEC.types, "sr_flag": T.IntegerType()})
    put(f"{root}/cab_tripdata_2021-01.csv", "id,pickup", "1,2021-01-03 10:00:00")
    put(f"{root}/cab_tripdata_2021-02.csv", "id,pickup,SR_Flag", "2,2021-02-03 10:00:00,5")
    for month in (1, 2):
        day = dt.date(2021, month, 1)
        pipelines.backfill(spark, spec, root, target, day, day)
    database = fresh_database(spark)
    source = pipelines.lake_sources(spark, target, database, {"cab": spec})["cab"]
    assert {(r["id"], r["SR_Flag"]) for r in source.collect()} == {(1, None), (2, 5)}
    table = pipelines.publish_registry(spark, {"cab": source}, database, {"cab": spec})
    assert table.count() == 2
    spark.range(3).selectExpr("cast(id as string) id").write.parquet(f"{target}/cab/month=2021-03")
    with pytest.raises(ValueError, match="column id"):
        pipelines.lake_sources(spark, target, database, {"cab": spec})
    assert external_table(spark, f"{database}.part", f"{target}/cab", drop=["ID"]).count() == 5


def test_stream_backfill_and_regrouping_share_a_folder(spark, tmp_path):
    root, target = f"{tmp_path}/csv", f"{tmp_path}/lake"
    month_file(root, "2021-01", 1, 2)
    month_file(root, "2021-02", 3)
    jan, feb = dt.date(2021, 1, 1), dt.date(2021, 2, 1)

    def stream():
        land_new_files(spark, root, SCHEMA, f"{target}/cab", f"{tmp_path}/progress", 1)
        return ids(read_lake(spark, f"{target}/cab"))

    assert stream() == [1, 2, 3]
    month_file(root, "2021-03", 4, 5)
    pipelines.backfill(spark, SPEC, root, target, jan, feb)
    assert ids(read_lake(spark, f"{target}/cab")) == [1, 2, 3]
    assert stream() == [1, 2, 3, 4, 5]
    raw = spark.createDataFrame([(6, dt.datetime(2021, 4, 1), 1.0)], SCHEMA)
    lake.land_raw(raw, target, "cab_tripdata_2021-04")
    lake.regroup_raw(spark, target, "cab", "pickup")
    assert ids(read_lake(spark, f"{target}/cab")) == [1, 2, 3, 4, 5, 6]


def test_write_settings_survive_writes_side_by_side(spark):
    key = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    before = spark.conf.get(key)
    one, two = layout.many_directories(spark), layout.many_directories(spark)
    one.__enter__()
    two.__enter__()
    one.__exit__(None, None, None)
    assert spark.conf.get(key) == "16k"
    two.__exit__(None, None, None)
    assert spark.conf.get(key) == before


def test_files_of_one_task_are_in_order_of_their_numbers(spark):
    names = [f"file:/d/part-00000-u-c{n:03d}.snappy.parquet" for n in (0, 101, 999, 1000, 1001)]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id int, f string")
    assert [r["id"] for r in df.orderBy(*ordinal._file_order("f")).collect()] == [0, 1, 2, 3, 4]


def test_batches_concatenate(spark):
    name = f"{fresh_database(spark)}.t"
    batches = [spark.range(5), spark.range(5, 9), spark.range(0)]
    assert tables.load_table(spark, batches, name) == 9
    assert ids(spark.table(name)) == list(range(9))
    empty = tables.create_empty(spark.range(5), name)
    assert (empty.count(), empty.columns) == (0, ["id"])


def test_missing_event_time_goes_to_the_null_day(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2021, 1, 1, 23, 59)), (2, None)], "id int, t timestamp_ntz"
    )
    published = tables.publish_by_day(df, f"{fresh_database(spark)}.t", "t")
    assert {tuple(r) for r in published.select("id", "pickup_date").collect()} == {
        (1, dt.date(2021, 1, 1)),
        (2, None),
    }
    day = dt.date(2021, 1, 1)
    assert ids(between_days(published, "t", day, day)) == [1]


def test_external_table_over_month_directories(spark, tmp_path):
    root, target = tmp_path / "csv", str(tmp_path / "lake")
    month_file(root, "2021-01", 1)
    month_file(root, "2021-02", 2)
    pipelines.backfill(spark, SPEC, str(root), target, dt.date(2021, 1, 1), dt.date(2021, 2, 1))
    database = fresh_database(spark)
    registry = {"cab": SPEC}
    sources = pipelines.lake_sources(spark, target, database, registry)
    assert ids(sources["cab"]) == [1, 2]
    assert ids(scan_table(spark, f"spark_catalog.{database}.cab_tripdata_external_table")) == [1, 2]
    counts = pipelines.publish_registry(spark, sources, database, registry).collect()
    assert {tuple(r) for r in counts} == {
        ("cab", dt.date(2021, 1, 3), 1),
        ("cab", dt.date(2021, 2, 3), 1),
    }
    again = external_table(spark, f"{database}.again", f"{target}/cab")
    assert again.where("month = '2021-02'").count() == 1
    owned = f"{database}.cab_tripdata"
    with pytest.raises(ValueError, match="not an external table"):
        external_table(spark, owned, f"{target}/cab")
    assert spark.table(owned).count() == 2


def test_glob_with_conflicting_types(spark, tmp_path):
    root = str(tmp_path)
    one, two = spark.range(2).toDF("id"), spark.range(2, 4).toDF("id")
    lake.land_raw(one.withColumn("ehail_fee", F.lit(1.0)), root, "green_tripdata_2021-01")
    lake.land_raw(two.withColumn("ehail_fee", F.lit("x")), root, "green_tripdata_2021-02")
    raw = read_lake(spark, f"{root}/raw/green_tripdata*.parquet")
    assert ids(raw.drop("ehail_fee")) == [0, 1, 2, 3]


# Layouts


@pytest.mark.parametrize("adaptive, observed", [("true", 0), ("true", 1), ("false", 0)])
def test_hot_day_is_written_by_several_tasks(spark, tmp_path, adaptive, observed):
    hot = F.when(F.col("id") % 3 > 0, 1).otherwise(F.col("id") % 50)
    source = str(tmp_path / "source")
    spark.range(200_000).withColumn("noise", F.rand(1)).withColumn("day", hot).repartition(
        16
    ).write.parquet(source)
    df = spark.read.parquet(source)
    target = str(tmp_path / "target")
    with (
        setting(spark, "spark.sql.adaptive.enabled", adaptive),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "128k"),
        setting(spark, "spark.sql.files.maxPartitionBytes", "256k"),
    ):
        laid_out = layout.by_group(df, "day")
        if observed:
            laid_out = laid_out.observe(Observation(), F.count(F.lit(1)).alias("n"))
        laid_out.write.partitionBy("day").parquet(target)
    written = spark.read.parquet(target)
    sizes = (
        written.where("day = 1").groupBy(F.col("_metadata.file_path")).count().toPandas()["count"]
    )
    assert len(sizes) > 3 and sizes.max() < 0.5 * sizes.sum()
    assert ids(written) == list(range(200_000))


def test_write_settings_are_put_back(spark):
    def current():
        return {key: spark.conf.get(key) for key in layout._MANY_DIRECTORIES}

    before = current()
    with pytest.raises(ZeroDivisionError), layout.many_directories(spark):
        assert current() == layout._MANY_DIRECTORIES
        raise ZeroDivisionError
    assert current() == before


def test_clustering_splits_a_hot_value_and_narrows_files(spark, tmp_path):
    source = str(tmp_path / "source")
    base = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.format_string("b%02d", F.col("id") % 40))
    spark.range(20_000).select(
        "id",
        F.expr("timestamp_ntz '2021-01-01 00:00:00'").alias("dropoff_datetime"),
        base.alias("base"),
    ).repartition(8).write.parquet(source)
    clustered = tables.publish_clustered(
        spark.read.parquet(source),
        f"{fresh_database(spark)}.t",
        "dropoff_datetime",
        "base",
        "dropoff_date",
        partitions=12,
    )
    files = clustered.groupBy(F.col("_metadata.file_path")).agg(
        F.count("*").alias("n"),
        F.countDistinct("base").alias("bases"),
        F.count_if(F.col("base") == "hot").alias("hot"),
    )
    summary = files.collect()
    assert sum(row["hot"] > 0 for row in summary) >= 3
    assert max(row["n"] for row in summary) < 20_000 / 4
    assert max(row["bases"] for row in summary) < 20
    in_file = Window.partitionBy("_metadata.file_path").orderBy("_metadata.row_index")
    steps = clustered.select("base", F.lag("base").over(in_file).alias("before"))
    assert steps.where("base < before").count() == 0
    assert ids(clustered) == list(range(20_000))


# Row numbers


def test_row_index_follows_the_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id").write.option(
        "maxRecordsPerFile", 33
    ).parquet(path)
    indexed = ordinal.with_row_index(spark.read.parquet(path))
    assert indexed.where("id <> index").count() == 0
    assert indexed.count() == 1000


def test_order_with_one_hot_value(spark, tmp_path):
    source = str(tmp_path / "source")
    value = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 11)
    spark.range(9000).select(value.alias("v"), F.lit("same").alias("w")).repartition(
        6
    ).write.parquet(source)
    df = spark.read.parquet(source)
    ordered = ordinal.write_ordered(df, str(tmp_path / "ordered"), "v", partitions=10)
    rows = ordered.orderBy("index").collect()
    assert [r["index"] for r in rows] == list(range(9000))
    assert [r["v"] for r in rows] == sorted(r["v"] for r in df.collect())
    parts = spark.read.parquet(str(tmp_path / "ordered"))
    largest = parts.groupBy(F.col("_metadata.file_path")).count().agg(F.max("count")).head()[0]
    assert largest < 9000 / 4


def test_csv_index_over_many_splits(spark, tmp_path):
    source = tmp_path / "trips.csv"
    put(source / "a.csv", "id,pickup,fare", *(f"{i},2021-01-01 00:00:00,1" for i in range(5000)))
    put(
        source / "b.csv",
        "id,pickup,fare",
        *(f"{i},2021-01-01 00:00:00,1" for i in range(5000, 5400)),
    )
    with (
        setting(spark, "spark.sql.files.maxPartitionBytes", "9k"),
        setting(spark, "spark.sql.files.openCostInBytes", "1k"),
    ):
        df = ordinal.load_csv_with_index(spark, str(source), SCHEMA, str(tmp_path / "out"))
        assert df.where("id <> index").count() == 0
        assert df.count() == 5400
    staged = spark.read.parquet(str(tmp_path / "out"))
    assert staged.select("_source", "_split").distinct().count() > 10


def test_offsets_beyond_the_broadcast_bound_join_by_shuffle(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "rows")
    spark.range(500).repartitionByRange(5, "id").sortWithinPartitions("id").write.parquet(path)
    monkeypatch.setattr(ordinal, "BROADCAST_BYTES", 0)
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        indexed = ordinal.with_row_index(spark.read.parquet(path))
        assert indexed.where("id <> index").count() == 0


# JDBC: no database here, so the calls are recorded instead


def test_jdbc_options_and_count_check(spark, monkeypatch):
    stored = {}

    def write(self, url, table, mode=None, properties=None):
        stored.update(url=url, table=table, mode=mode, properties=properties)

    def read(self, url, table, properties=None):
        return spark.range(stored.get("rows", 4))

    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", write)
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameReader.jdbc", read)
    properties = {"user": "u", "driver": "d"}
    assert jdbc.publish_jdbc(spark.range(4), "jdbc:x", "t", properties) == 4
    assert stored["mode"] == "overwrite"
    assert stored["properties"] == {**properties, "batchsize": "100000", "numPartitions": "8"}
    stored["rows"] = 5
    with pytest.raises(RowCountMismatch):
        jdbc.publish_jdbc(spark.range(4), "jdbc:x", "t", properties)


# Session


def test_workspace_is_the_configured_shared_folder(spark):
    assert workspace(spark) == spark.conf.get("spark.checkpoint.dir")
    assert build_session() is not None


def test_cluster_without_shared_folder_is_an_error():
    class Conf:
        def get(self, key, default=None):
            return {"spark.master": "yarn"}.get(key, default)

    class Session:
        conf = Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(Session())
    Conf.get = lambda self, key, default=None: {"spark.master": "yarn", "spark.checkpoint.dir": "file:///tmp/x"}[key]
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        workspace(Session())


@pytest.mark.parametrize("default, fails", [("file:///", True), ("hdfs://name", False)])
def test_cluster_folder_without_a_scheme_follows_the_default_store(default, fails):
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: {"spark.master": "yarn", "spark.checkpoint.dir": "/shared"}[key])

        class _jsc:
            @staticmethod
            def hadoopConfiguration():
                return {"fs.defaultFS": default}

    if fails:
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            workspace(Session())
    else:
        assert workspace(Session()) == "/shared"


def test_splits_and_partitions_grow_with_the_input():
    assert shuffle_partitions(1) == 8
    assert shuffle_partitions(1024**4) == 8192
    assert split_bytes(1024**4) == 128 * 1024**2
    assert shuffle_partitions(100 * 1024**4) == 200_000
    assert 500 * 1024**2 < split_bytes(100 * 1024**4) < 600 * 1024**2


def test_folders_above_an_external_table_are_no_partitions(spark, tmp_path):
    location = f"{tmp_path}/run=9/day=3/data"
    df = spark.createDataFrame([(1, 9, "x"), (2, 8, "y")], "id int, run int, key string")
    df.write.partitionBy("key").parquet(location)
    found = external_table(spark, f"{fresh_database(spark)}.t", location)
    assert sorted(map(tuple, found.collect())) == [(1, 9, "x"), (2, 8, "y")]
    assert ids(found.where("run = 8")) == [2] and ids(found.where("key = 'x'")) == [1]
    # A single file below such a folder.
    plain = f"{tmp_path}/run=9/plain"
    df.drop("key").coalesce(1).write.parquet(plain)
    file = next(pathlib.Path(plain).glob("*.parquet"))
    for place in (plain, f"{plain}/", str(file)):
        assert ids(external_table(spark, f"{fresh_database(spark)}.t", place)) == [1, 2]


def test_conflicts_are_narrowed_down_to_their_folders(spark, tmp_path):
    root = f"{tmp_path}/lake"
    for n in range(9):
        kind = "string" if n in (2, 7) else "double"
        spark.range(n, n + 1).selectExpr("id", f"cast(id as {kind}) fee", f"{n} as c{n % 2}").write.parquet(f"{root}/month={n}")
    database = fresh_database(spark)
    found = external_table(spark, f"{database}.t", root, drop=["FEE"])
    assert set(found.columns) == {"id", "c0", "c1", "month"} and found.columns[-1] == "month"
    assert ids(found) == list(range(9)) and ids(found.where("month = 7")) == [7]
    with pytest.raises(ValueError, match="column fee"):
        external_table(spark, f"{database}.t", root)
