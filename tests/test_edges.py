"""Cases that the test tables do not contain: NULLs, ties, boundaries, halves of a cent."""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

import pytest
from pyspark.sql import functions as F

from cabrank.functions.numeric import exact_amount, mean_to_cents, round_numeric, to_cents
from cabrank.functions.temporal import parse_time
from cabrank.operators import aggregates, filters, joins, projection, ranking
from cabrank.plans import trips
from cabrank.quality import (
    KeyViolation,
    RowCountMismatch,
    key_violations,
    require_key,
    require_row_count,
)
from test_plans import setting

TRIP = (
    "pickup_datetime timestamp_ntz, PULocationID int, DOLocationID int, "
    "total_amount double, dispatching_base_num string"
)


def at(text):
    return dt.datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def zones(spark):
    # Two ids share a name.
    return spark.createDataFrame(
        [(1, "Park"), (2, "Harbour"), (3, "Harbour"), (264, "NV")], "LocationID int, Zone string"
    )


def rows(df):
    return [tuple(row) for row in df.collect()]


def test_distinct_counts_null(spark):
    df = spark.createDataFrame([("A",), (None,), ("A",), (None,), ("B",)], "b string")
    assert rows(aggregates.count_distinct_values(df, "b", name="n")) == [(3,)]
    assert set(rows(projection.distinct_values(df, "b"))) == {("A",), ("B",), (None,)}


def test_null_order(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert rows(ranking.sort_asc(df, "x")) == [(1,), (2,), (None,)]
    assert rows(ranking.sort_desc(df, "x")) == [(None,), (2,), (1,)]


def test_top_leaves_out_null_and_breaks_ties(spark):
    df = spark.createDataFrame([(3, 7), (1, 7), (2, None), (4, 5)], "id int, x int")
    assert rows(ranking.top(df, "x", "id")) == [(1, 7)]
    assert rows(ranking.top(df, "x", "id", k=2)) == [(1, 7), (3, 7)]


def test_day_and_range_boundaries(spark):
    times = [
        "2021-01-14 23:59:59.999999",
        "2021-01-15 00:00:00",
        "2021-01-15 23:59:59.999999",
        "2021-01-16 00:00:00",
    ]
    df = spark.createDataFrame([(at(t),) for t in times] + [(None,)], "t timestamp_ntz")
    day = dt.date(2021, 1, 15)
    assert rows(filters.on_day(df, "t", day)) == [(at(times[1]),), (at(times[2]),)]
    both = filters.between_days(df, "t", dt.date(2021, 1, 14), day)
    assert rows(both) == [(at(t),) for t in times[:3]]


@pytest.mark.parametrize("year, month", [(2020, 2), (2021, 12), (2021, 1)])
def test_month_boundaries(spark, year, month):
    first = dt.datetime(year, month, 1)
    following = (first + dt.timedelta(days=32)).replace(day=1)
    inside = [(first,), (following - dt.timedelta(microseconds=1),)]
    outside = [(first - dt.timedelta(microseconds=1),), (following,)]
    df = spark.createDataFrame(inside + outside, "t timestamp_ntz")
    assert rows(filters.in_month(df, "t", year, month)) == inside


def test_membership_with_null(spark):
    df = spark.createDataFrame([(1,), (264,), (None,)], "x int")
    assert rows(df.where(filters.none_of("x", (264, 265)))) == [(1,)]
    assert rows(df.where(filters.any_of("x", (264, 265)))) == [(264,)]


def test_inner_join_drops_null_and_unknown_keys(spark, zones):
    facts = spark.createDataFrame([(1, 1), (2, None), (3, 99)], "id int, PULocationID int")
    joined = joins.join_dimension(facts, zones, "PULocationID", pickup_zone="Zone")
    assert rows(joined) == [(1, 1, "Park")]
    assert rows(joins.with_known(facts, zones, "PULocationID").select("id")) == [(1,)]


def test_zones_that_share_a_name_are_counted_apart(spark, zones):
    start = at("2021-01-14 10:00:00")
    data = [(start, 1, 2, 1.0, None)] * 3 + [(start, 1, 3, 1.0, None)] * 2
    data += [(start, 1, 1, 1.0, None)] * 2 + [(start, 1, None, 1.0, None)] * 9
    data += [(start, 1, 77, 1.0, None)] * 9 + [(at("2021-01-15 00:00:00"), 1, 1, 1.0, None)] * 9
    df = spark.createDataFrame(data, TRIP)
    day = dt.date(2021, 1, 14)
    assert rows(trips.top_destination(df, zones, "Park", day, day)) == [("Harbour", 3)]
    ranked = trips.top_destination(df, zones, "Park", day, day, k=9)
    assert rows(ranked) == [("Harbour", 3), ("Park", 2), ("Harbour", 2)]


def test_priciest_pair_leaves_out_unknown_zones(spark, zones):
    start = at("2021-01-14 10:00:00")
    data = [(start, 1, 264, 900.0, None), (start, 264, 1, 900.0, None)]
    data += [(start, 1, 99, 900.0, None), (start, None, 1, 900.0, None)]
    data += [(start, 1, 2, 10.0, None), (start, 1, 2, 10.01, None), (start, 2, 1, 10.0, None)]
    data += [(start, 3, 3, None, None)]
    df = spark.createDataFrame(data, TRIP)
    assert rows(trips.priciest_pair(df, zones)) == [("Park", "Harbour", 10.01)]
    assert len(rows(trips.priciest_pair(df, zones, k=9))) == 2


def test_rounding_is_half_away_from_zero(spark):
    df = spark.createDataFrame([(10.125,), (-10.125,), (2.675,), (1.005,), (None,)], "x double")
    expected = [(10.13,), (-10.13,), (2.68,), (1.01,), (None,)]
    assert rows(df.select(round_numeric("x"))) == expected


def test_mean_to_cents_against_decimals(spark):
    totals = [Decimal(t) / 1000 for t in range(-60, 61)]
    totals += [Decimal("0.014999"), Decimal("0.015"), Decimal("-0.015"), Decimal(10) ** 12 - Decimal("0.000001")]
    cases = [(total, n) for total in totals for n in (1, 2, 3, 4, 7, 8, 200)]
    cases += [(Decimal("49.999999"), 10_000), (Decimal(50), 10_000)]
    df = spark.createDataFrame(cases, "t decimal(28,6), n bigint")
    for total, n, mean in rows(df.select("t", "n", mean_to_cents("t", "n"))):
        exact = (total / n).quantize(Decimal("0.01"), ROUND_HALF_UP)
        assert mean == float(exact)


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("amount", [1e17, -1e17, float("inf"), float("-inf")])
def test_amounts_that_do_not_fit_fail(spark, ansi, amount):
    df = spark.createDataFrame([(amount,), (-5.0,)], "x double")
    with setting(spark, "spark.sql.ansi.enabled", ansi):
        with pytest.raises(Exception, match="amount out of range"):
            aggregates.mean_by(df, amount="x", name="m").collect()


def test_amounts_keep_their_digits_until_the_end(spark):
    df = spark.createDataFrame([(1, 0.005), (1, 0.004), (2, -0.005), (3, 0.005), (4, 10.125)], "k int, x double")
    assert dict(rows(aggregates.mean_by(df, "k", amount="x", name="m"))) == {1: 0.0, 2: -0.01, 3: 0.01, 4: 10.13}
    cents = rows(df.select(to_cents("x"), exact_amount("x")))
    assert cents[2] == (-1, Decimal("-0.005")) and cents[1] == (0, Decimal("0.004"))
    whole = spark.createDataFrame([(1,), (2,)], "x bigint")
    assert rows(aggregates.mean_by(whole, amount="x", name="m")) == [(1.5,)]


def test_mean_by_group(spark):
    data = [(1, 0.1), (1, 0.2), (1, 0.3), (2, None), (3, 1.0), (3, 1.01), (3, None), (3, float("nan"))]
    df = spark.createDataFrame(data, "k int, x double")
    means = dict(rows(aggregates.mean_by(df, "k", amount="x", name="m")))
    assert means == {1: 0.2, 2: None, 3: 1.01}


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_times(spark, ansi):
    texts = ["2021-01-01 00:30:10", "2021-01-01T00:30:10", "2021-01-01", "2021-01-01T00:30:10.25", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = spark.createDataFrame([("yesterday",)], "t string")
    with setting(spark, "spark.sql.ansi.enabled", ansi):
        assert rows(df.select(parse_time("t"))) == [(t and at(t),) for t in texts]
        for fmt in (None, "yyyy-MM-dd"):
            with pytest.raises(Exception, match="yesterday"):
                wrong.select(parse_time("t", fmt)).collect()
    plain = spark.createDataFrame([(texts[0],)], "t string")
    assert rows(plain.select(parse_time("t", "yyyy-MM-dd HH:mm:ss"))) == [(at(texts[0]),)]


def test_key_violations(spark, zones):
    require_key(zones, "LocationID")
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3)], "a int, b int")
    assert set(rows(key_violations(df, "a", "b"))) == {(1, 1, 2), (None, 3, 1)}
    with pytest.raises(KeyViolation):
        require_key(df, "a", "b")


def test_row_count_mismatch(spark):
    spark.range(3).createOrReplaceTempView("three")
    assert require_row_count(spark, "three", 3) == 3
    with pytest.raises(RowCountMismatch):
        require_row_count(spark, "three", 4)
    spark.catalog.dropTempView("three")


def test_bases_and_ranges(spark):
    data = [
        (at("2019-01-01 00:00:00"), 1, 1, 1.0, "B1"),
        (at("2020-01-01 23:59:59"), 1, 1, 1.0, "B2"),
        (at("2020-01-02 00:00:00"), 1, 1, 1.0, "B3"),
        (at("2019-06-01 00:00:00"), 1, 1, 1.0, None),
        (None, 1, 1, 1.0, "B1"),
    ]
    df = spark.createDataFrame(data, TRIP)
    year = (dt.date(2019, 1, 1), dt.date(2020, 1, 1))
    assert rows(trips.trips_in_range(df, *year)) == [(3,)]
    assert rows(trips.distinct_bases(df, *year)) == [(3,)]
    assert rows(trips.trips_for_bases(df, *year, ["B1", "B3"])) == [(1,)]


def test_daily_max_of_a_month(spark):
    data = [("2021-01-02", 1.5), ("2021-01-01", 2.0), ("2021-01-01", 3.0), ("2021-01-03", None)]
    data += [("2021-02-01", 9.0)]
    df = spark.createDataFrame(
        [(at(d), x) for d, x in data], "pickup_datetime timestamp_ntz, tip_amount double"
    )
    days = [dt.date(2021, 1, d) for d in (1, 2, 3)]
    assert rows(trips.daily_max_tip(df, 2021, 1)) == list(zip(days, [3.0, 1.5, None], strict=True))
    assert rows(trips.top_tip_day(df, 2021, 1)) == [(days[0], 3.0)]


def test_nan_is_no_maximum(spark):
    nan = float("nan")
    data = [("2021-01-01", nan), ("2021-01-01", 3.0), ("2021-01-02", nan), ("2021-01-02", None)]
    df = spark.createDataFrame([(at(d), x) for d, x in data], "pickup_datetime timestamp_ntz, tip_amount double")
    days = [dt.date(2021, 1, d) for d in (1, 2)]
    assert rows(trips.daily_max_tip(df, 2021, 1)) == [(days[0], 3.0), (days[1], None)]
    assert rows(trips.top_tip_day(df, 2021, 1)) == [(days[0], 3.0)]
    assert rows(ranking.top(spark.createDataFrame([(1, nan), (2, 1.0)], "id int, x double"), "x")) == [(2, 1.0)]


def test_projections(spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert projection.project_star(df).columns == ["a", "b"]
    assert projection.project_except(df, "B").columns == ["a"]
    assert rows(projection.project_alias(df, twice=F.col("a") * 2)) == [(2,)]
