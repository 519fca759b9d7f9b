"""Joins of trips to the zone dimension.

No join carries a broadcast hint. Catalyst broadcasts the dimension when its size is below
``spark.sql.autoBroadcastJoinThreshold`` and sort-merges otherwise; AQE checks again with the
sizes it has measured, and splits hot keys of a sort-merge join. The dimension key must be unique
(``quality.require_key``), as it is for a declared primary key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cabrank.operators.filters import none_of
from cabrank.specs import UNKNOWN_ZONES

ZONE_KEY = "LocationID"
PICKUP_KEY = "PULocationID"
DROPOFF_KEY = "DOLocationID"


def join_dimension(
    facts: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str = ZONE_KEY,
    **attributes: str,
) -> DataFrame:
    """Inner join that adds ``new_name=dimension_column`` attributes to each fact.

    Facts with a NULL or unknown key drop out.
    """
    role = dimension.select(
        F.col(dimension_key).alias("_dimension_key"),
        *[F.col(source).alias(name) for name, source in attributes.items()],
    )
    return facts.join(role, facts[fact_key] == role["_dimension_key"]).drop("_dimension_key")


def join_both_roles(
    trips: DataFrame,
    zones: DataFrame,
    pickup_name: str = "pickup_zone",
    dropoff_name: str = "dropoff_zone",
) -> DataFrame:
    """The zone dimension joined twice, once as the pickup and once as the dropoff zone."""
    with_pickup = join_dimension(trips, zones, PICKUP_KEY, **{pickup_name: "Zone"})
    return join_dimension(with_pickup, zones, DROPOFF_KEY, **{dropoff_name: "Zone"})


def with_known(facts: DataFrame, dimension: DataFrame, fact_key: str) -> DataFrame:
    """Facts whose key is in the dimension: the filtering half of the inner join."""
    keys = dimension.select(F.col(ZONE_KEY).alias(fact_key))
    return facts.join(keys, fact_key, "left_semi")


def without_unknown_zones(
    trips: DataFrame, unknown: tuple[int, ...] = UNKNOWN_ZONES
) -> DataFrame:
    return trips.where(none_of(PICKUP_KEY, unknown) & none_of(DROPOFF_KEY, unknown))
