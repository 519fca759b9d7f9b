"""The questions as SQL text on Spark, and properties of the day and month filters."""

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import __spark_entry__ as contract
from cabrank.operators import filters
from cabrank.plans import trips
from cabrank.plans.standin import trips_ev
from cabrank.session import fresh_database
from cabrank.sinks.tables import publish_by_day
from cabrank.sources.months import month_range
from compare import TABLES, canonical
from conftest import TESTDATA
from test_plans import setting

SF_DIR = f"{TESTDATA}/sf0.001"

# Portable SQL; the others use DuckDB's integer division or its date formats.
PORTABLE = sorted(
    name
    for name, sql in contract.oracle_sql().items()
    if not any(word in sql for word in ("//", "strftime", "strptime"))
)


@pytest.fixture(scope="module")
def views(spark):
    for name in TABLES:
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").createOrReplaceTempView(name)
    yield
    for name in TABLES:
        spark.catalog.dropTempView(name)


@pytest.mark.parametrize("name", [n for n in PORTABLE if n in trips.__dict__ or "_by_" in n])
def test_sql_text_gives_the_same_answer(spark, views, name):
    with setting(spark, "spark.sql.ansi.doubleQuotedIdentifiers", "true"):
        by_sql = spark.sql(contract.oracle_sql()[name])
        rows = [tuple(row) for row in by_sql.collect()]
    df = contract.queries()[name](spark, SF_DIR)
    assert canonical(df.columns, df.collect()) == canonical(by_sql.columns, rows)


def test_sql_on_a_published_table(spark):
    name = f"spark_catalog.{fresh_database(spark)}.fhv_tripdata"
    publish_by_day(trips_ev(spark, SF_DIR), name, "pickup_datetime")
    total = spark.sql(
        f"""SELECT COUNT(*) FROM {name}
            WHERE DATE(pickup_datetime) BETWEEN '2024-01-05' AND '2024-01-20'
              AND raw_base IN ("click", "view", "error")"""
    )
    assert total.head()[0] == contract.queries()["trips_for_bases"](spark, SF_DIR).head()[0]
    by_alias = spark.sql(
        f"""SELECT DATE(pickup_datetime) AS trip_date, MAX(tip_amount) AS max_tip_amount
            FROM {name}
            WHERE DATE_PART('year', CAST(pickup_datetime AS DATE)) = '2024'
              AND DATE_PART('month', CAST(pickup_datetime AS DATE)) = '01'
            GROUP BY trip_date ORDER BY trip_date ASC"""
    )
    assert by_alias.collect() == contract.queries()["daily_max_tip"](spark, SF_DIR).collect()


@given(st.dates(dt.date(1990, 1, 1), dt.date(2060, 1, 1)), st.integers(0, 4000))
def test_month_range_holds_each_month_once(first, days):
    last = first + dt.timedelta(days=days)
    expected = {f"{first + dt.timedelta(days=i):%Y-%m}" for i in range(days + 1)}
    assert month_range(first, last) == sorted(expected)


TIMES = [
    dt.datetime(2020, month, day, hour, 59, 59)
    for month in (1, 2, 3, 12)
    for day in (1, 15, 28, 29)
    for hour in (0, 23)
]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.sampled_from(TIMES), st.integers(0, 90))
def test_day_ranges_against_python(spark, start, days):
    df = spark.createDataFrame([(t,) for t in TIMES], "t timestamp_ntz")
    first, last = start.date(), start.date() + dt.timedelta(days=days)
    kept = [row[0] for row in filters.between_days(df, "t", first, last).collect()]
    assert kept == [t for t in TIMES if first <= t.date() <= last]
    month = [row[0] for row in filters.in_month(df, "t", first.year, first.month).collect()]
    assert month == [t for t in TIMES if (t.year, t.month) == (first.year, first.month)]
