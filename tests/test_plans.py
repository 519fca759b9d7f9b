"""The physical plans that the queries rely on."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from cabrank.operators import filters, joins
from cabrank.plans import trips
from cabrank.plans.catalogue import FIRST, LAST, PICKUP_ZONE, UNKNOWN, YEAR
from cabrank.plans.standin import table, trips_ev, zone_trips, zones
from cabrank.session import fresh_database
from cabrank.sinks.tables import publish_by_day
from conftest import TESTDATA

SF_DIR = f"{TESTDATA}/sf0.01"


def plan(df, mode="formatted") -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


@contextlib.contextmanager
def setting(spark, key, value):
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def test_clustered_table_is_read_in_order(spark):
    rows = contract.queries()["clustered_layout"](spark, SF_DIR).collect()
    bases = [row["dispatching_base_num"] for row in rows]
    assert bases == sorted(bases) and len(set(bases)) == 5


def test_day_filter_reaches_the_scan(spark):
    text = plan(filters.on_day(table(spark, SF_DIR, "events"), "ts", dt.date(2024, 1, 15)))
    assert "GreaterThanOrEqual(ts,2024-01-15T00:00)" in text
    assert "LessThan(ts,2024-01-16T00:00)" in text


def test_count_reads_two_columns(spark):
    df = trips.trips_for_bases(trips_ev(spark, SF_DIR), FIRST, LAST, ["click"], base="raw_base")
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan(df)


def test_day_filter_prunes_directories(spark):
    name = f"{fresh_database(spark)}.trips"
    published = publish_by_day(trips_ev(spark, SF_DIR), name, "pickup_datetime")
    df = filters.between_days(published, "pickup_datetime", FIRST, LAST)
    text = plan(df)
    assert "PartitionFilters: [isnotnull(pickup_date" in text
    assert df.count() == filters.between_days(
        trips_ev(spark, SF_DIR), "pickup_datetime", FIRST, LAST
    ).count()


def test_unknown_zones_and_names_filter_before_the_large_joins(spark):
    text = plan(trips.priciest_pair(zone_trips(spark, SF_DIR), zones(spark, SF_DIR), UNKNOWN))
    assert text.count("Not(In(s_nationkey, [23,24]))") == 1
    assert text.count("Not(In(c_nationkey, [23,24]))") == 1
    assert "TakeOrderedAndProject" in text
    assert "SortAggregate" not in text


def test_small_dimension_is_broadcast_and_a_large_one_is_not(spark):
    def question():
        return trips.top_destination(
            zone_trips(spark, SF_DIR), zones(spark, SF_DIR), PICKUP_ZONE, *YEAR
        )

    assert "LeftSemi BuildRight" in plan(question())
    expected = question().collect()
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        assert "BroadcastHashJoin LeftSemi" not in plan(question())
        assert question().collect() == expected


def test_hot_zone_is_split_where_the_dimension_is_too_large_to_broadcast(spark):
    lines = table(spark, SF_DIR, "lineitem")
    hot = F.when(F.col("l_orderkey") % 3 == 0, 1).otherwise(F.col("l_suppkey") % 25).cast("int")
    # A hot partition is split between map tasks, so there have to be several.
    facts = lines.repartition(16).select("*", hot.alias("PULocationID"))
    with (
        setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.autoBroadcastJoinThreshold", "-1"),
        setting(spark, "spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64k"),
        setting(spark, "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2"),
    ):
        by_zone = zones(spark, SF_DIR)
        for joined in (
            joins.join_dimension(facts, by_zone, "PULocationID", pickup_zone="Zone"),
            joins.with_known(facts, by_zone, "PULocationID"),
        ):
            counted = joined.groupBy("l_linenumber").count()
            assert sum(row["count"] for row in counted.collect()) == lines.count()
            assert "AQEShuffleRead coalesced and skewed" in plan(counted, "simple")


QUESTIONS = [
    "trips_on_day",
    "daily_max_tip",
    "top_tip_day",
    "top_destination",
    "priciest_pair",
    "trips_in_range",
    "distinct_bases",
    "trips_for_bases",
    "avg_by_pair",
    "count_by_group",
    "join_dim_role_playing",
    "filter_not_in_list",
    "key_check",
]


@pytest.mark.parametrize("name", QUESTIONS)
def test_no_cross_joins_or_python(spark, name):
    text = plan(contract.queries()[name](spark, SF_DIR))
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Window"):
        assert node not in text
