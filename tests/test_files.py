"""File ranges asked while planning, and bytes estimated from footers."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from cabrank.operators.filters import between_days
from cabrank.plans import trips
from cabrank.session import fresh_database
from cabrank.sinks import tables, versions
from cabrank.sources import files
from test_plans import setting


@pytest.fixture(scope="module")
def clustered(spark):
    base = F.when(F.col("id") % 3 == 0, "B50").otherwise(F.format_string("B%02d", F.col("id") % 97))
    df = spark.range(60_000).select(
        "id",
        (F.expr("timestamp_ntz '2021-01-01 00:00:00'") + F.expr("make_interval(0, 0, 0, 0, 0, 0, id * 4)")).alias("dropoff_datetime"),
        F.when(F.col("id") % 1000 != 7, base).alias("dispatching_base_num"),
    )
    name = f"{fresh_database(spark)}.fhv"
    tables.publish_clustered(df.repartition(4), name, "dropoff_datetime", "dispatching_base_num", "dropoff_date", partitions=24)
    return name, df


def test_a_base_filter_opens_only_matching_files(spark, clustered):
    name, df = clustered
    plain = spark.table(name).where("dispatching_base_num IN ('B07', 'B91')")
    found = files.scan_indexed(spark, name, {"dispatching_base_num": ["B07", "B91"]})
    assert sorted(map(tuple, found.select("id").collect())) == sorted(map(tuple, plain.select("id").collect()))
    before, after = len(plain.inputFiles()), len(found.inputFiles())
    assert before >= 20 and 0 < after <= before / 3
    # Days prune on top of it, and the result has the columns and marks of the table.
    day = dt.date(2021, 1, 2)
    assert found.columns == spark.table(name).columns
    on_day = between_days(found, "dropoff_datetime", day, day)
    assert on_day.count() == df.where("dispatching_base_num IN ('B07', 'B91') AND date(dropoff_datetime) = '2021-01-02'").count()
    plan = on_day._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*dropoff_date", plan)


def test_values_that_no_file_has(spark, clustered):
    name, _ = clustered
    for values in (["A"], ["Z"], []):
        assert files.scan_indexed(spark, name, {"dispatching_base_num": values}).count() == 0
    assert files.matching_files(spark, name, {"dispatching_base_num": ["Z"]}).count() == 0


def test_too_many_matching_files_fall_back_to_the_table(spark, clustered, monkeypatch):
    name, df = clustered
    monkeypatch.setattr(files, "MOST_FILES", 1)
    got = files.scan_indexed(spark, name, {"dispatching_base_num": ["B50"]})
    assert got.count() == df.where("dispatching_base_num = 'B50'").count()


def test_files_added_since_are_opened(spark, clustered):
    _, df = clustered
    name = f"{fresh_database(spark)}.fhv"
    tables.publish_clustered(df.where("id < 20000").repartition(2), name, "dropoff_datetime", "dispatching_base_num", "dropoff_date", partitions=6)
    wanted = {"dispatching_base_num": ["B07"]}
    one = files.scan_indexed(spark, name, wanted).count()
    extra = spark.createDataFrame([(1, dt.datetime(2021, 1, 1, 1), "B07")], "id long, dropoff_datetime timestamp_ntz, dispatching_base_num string")
    tables.refresh_days(extra, name, "dropoff_datetime", day_column="dropoff_date")
    assert files.scan_indexed(spark, name, wanted).count() == spark.table(name).where("dispatching_base_num = 'B07'").count() != one


def test_names_that_urls_encode(spark, tmp_path):
    folder = f"{tmp_path}/a b+c%d"
    spark.range(10).selectExpr("id", "concat('k ', id % 2, ':+%') AS k").write.partitionBy("k").parquet(folder)
    df = spark.read.parquet(folder)
    keys = {row["file"] for row in files.index_rows(df, ["id"]).collect()}
    there = files.listed(spark, folder).select(files._key(F.col("path")).alias("file"))
    assert keys == {row["file"] for row in there.collect()} and len(keys) >= 2


def read_bytes(spark):
    storage = spark._jvm.org.apache.hadoop.fs.FileSystem.getGlobalStorageStatistics().get("file")
    return storage.getLong("bytesRead")


def test_estimated_bytes_are_those_that_a_question_reads(spark, tmp_path):
    rows = spark.range(0, 3_000_000, 1, 8).select(
        (F.expr("timestamp_ntz '2021-01-01 00:00:00'") + F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 259200 + id / 4000000)")).alias("pickup_datetime"),
        F.concat(F.lit("B"), F.xxhash64("id") % 1000).alias("dispatching_base_num"),
        F.xxhash64("id").alias("noise"),
    )
    name = f"{fresh_database(spark)}.fhv"
    published = tables.publish_by_day(rows, name, "pickup_datetime")
    first, last = dt.date(2021, 1, 2), dt.date(2021, 1, 3)
    pruned = F.col("pickup_date").between(F.lit(first), F.lit(last))
    estimate = files.scan_bytes(spark, name, ["pickup_datetime", "dispatching_base_num"], pruned).head()
    question = trips.trips_for_bases(published, first, last, ["B1", "B77"])
    # Vectored reads do not show in the statistics of the local file system.
    with setting(spark, "parquet.hadoop.vectored.io.enabled", "false"):
        before = read_bytes(spark)
        question.collect()
        actual = read_bytes(spark) - before
    assert estimate["rows"] == published.where(pruned).count()
    assert abs(estimate["bytes"] - actual) <= 0.05 * actual
    whole = files.scan_bytes(spark, name, published.columns).head()
    assert whole["bytes"] > 2 * estimate["bytes"] and whole["rows"] == 3_000_000
    none = files.scan_bytes(spark, name, ["noise"], F.col("pickup_date") == F.lit(dt.date(2000, 1, 1))).head()
    assert tuple(none) == (0, 0, 0)


def test_stores_by_their_schemes():
    assert files.arrow_store("file:///tmp/a b%20c")[1] == "/tmp/a b%20c"
    assert files.arrow_store("/tmp/x=1:2/y")[1] == "/tmp/x=1:2/y"
    system, path = files.arrow_store("s3a://bucket/key?region=us-east-1")
    assert type(system).__name__ == "S3FileSystem" and path == "bucket/key"
    with pytest.raises(ValueError, match="unknown"):
        files.arrow_store("unknown://store/in")
