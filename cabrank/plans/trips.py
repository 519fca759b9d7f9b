"""The trip questions.

Zone questions aggregate on integer ids and join the zones to the groups: the shuffle carries only
ids, zones that share a name stay separate, and trips with a missing or unknown id drop out as
they would in a join ahead of the aggregation, because the group key is the join key.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.operators.aggregates import (
    count_by,
    count_distinct_values,
    count_rows,
    max_by_day,
    mean_by,
)
from cabrank.operators.filters import any_of, between_days, in_month, on_day
from cabrank.operators.joins import (
    DROPOFF_KEY,
    PICKUP_KEY,
    join_both_roles,
    join_dimension,
    with_known,
    without_unknown_zones,
)
from cabrank.operators.ranking import sort_asc, top
from cabrank.specs import UNKNOWN_ZONES

PICKUP_TIME = "pickup_datetime"
BASE = "dispatching_base_num"


def trips_on_day(trips: DataFrame, day: dt.date, event_time: str = PICKUP_TIME) -> DataFrame:
    """How many trips started on one day?"""
    return count_rows(on_day(trips, event_time, day))


def _max_tips(trips: DataFrame, year: int, month: int, event_time: str) -> DataFrame:
    return max_by_day(
        in_month(trips, event_time, year, month), event_time, "tip_amount", "max_tip_amount"
    )


def daily_max_tip(
    trips: DataFrame, year: int, month: int, event_time: str = PICKUP_TIME
) -> DataFrame:
    """The largest tip of each day of a month, by day."""
    return sort_asc(_max_tips(trips, year, month, event_time), "trip_date")


def top_tip_day(
    trips: DataFrame, year: int, month: int, event_time: str = PICKUP_TIME
) -> DataFrame:
    """The day of the month with the largest tip, the earliest one if several."""
    return top(_max_tips(trips, year, month, event_time), "max_tip_amount", "trip_date")


def top_destination(
    trips: DataFrame,
    zones: DataFrame,
    pickup_zone: str,
    first: dt.date,
    last: dt.date,
    k: int = 1,
    event_time: str = PICKUP_TIME,
) -> DataFrame:
    """The most frequent dropoff zone of trips that started in a zone within a range of days."""
    started = between_days(trips, event_time, first, last)
    started = with_known(started, zones.where(F.col("Zone") == pickup_zone), PICKUP_KEY)
    counts = count_by(started, DROPOFF_KEY)
    named = join_dimension(counts, zones, DROPOFF_KEY, dropoff_zone="Zone")
    return top(named, "trip_count", DROPOFF_KEY, k=k).select("dropoff_zone", "trip_count")


def priciest_pair(
    trips: DataFrame,
    zones: DataFrame,
    unknown: tuple[int, ...] = UNKNOWN_ZONES,
    k: int = 1,
) -> DataFrame:
    """The pickup and dropoff zones with the highest average fare, unknown zones left out."""
    placed = without_unknown_zones(trips, unknown)
    fares = mean_by(placed, PICKUP_KEY, DROPOFF_KEY, amount="total_amount", name="average_fare")
    named = join_both_roles(fares, zones)
    return top(named, "average_fare", PICKUP_KEY, DROPOFF_KEY, k=k).select(
        "pickup_zone", "dropoff_zone", "average_fare"
    )


def trips_in_range(
    trips: DataFrame, first: dt.date, last: dt.date, event_time: str = PICKUP_TIME
) -> DataFrame:
    """How many trips started from one day to another, both included?"""
    return count_rows(between_days(trips, event_time, first, last))


def distinct_bases(
    trips: DataFrame, first: dt.date, last: dt.date, event_time: str = PICKUP_TIME
) -> DataFrame:
    """How many dispatching bases, a missing one included, had trips in a range of days?"""
    return count_distinct_values(between_days(trips, event_time, first, last), BASE, name="bases")


def trips_for_bases(
    trips: DataFrame,
    first: dt.date,
    last: dt.date,
    bases: Iterable[str],
    event_time: str = PICKUP_TIME,
    base: str = BASE,
) -> DataFrame:
    """How many trips in a range of days were dispatched by certain bases?"""
    return count_rows(between_days(trips, event_time, first, last).where(any_of(base, bases)))
