"""The datasets: their monthly file names, typed columns and event-time columns."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import types as T

_TIME, _ID, _FARE, _TEXT = T.TimestampNTZType(), T.IntegerType(), T.DoubleType(), T.StringType()


@dataclass(frozen=True)
class DatasetSpec:
    """What a parameterised job has to know about one dataset.

    ``types`` lists the published columns with their types; the types of others are inferred. Names
    resolve without regard to case, as the sources do not agree on it. ``multi_line`` admits line
    breaks inside quoted values, at the price that a file is no longer read in splits.
    """

    name: str
    event_time: str | None = None
    types: Mapping[str, T.DataType] = field(default_factory=dict)
    drop_columns: tuple[str, ...] = ()
    file_template: str = "{dataset}_tripdata_{month}.csv"
    multi_line: bool = False

    def file_name(self, month: str) -> str:
        return self.file_template.format(dataset=self.name, month=month)


# Dataset, column and file names of the published trip records.
REGISTRY: dict[str, DatasetSpec] = {
    "yellow": DatasetSpec(
        name="yellow",
        event_time="tpep_pickup_datetime",
        types={
            "VendorID": _ID,
            "tpep_pickup_datetime": _TIME,
            "tpep_dropoff_datetime": _TIME,
            "passenger_count": _FARE,
            "trip_distance": _FARE,
            "RatecodeID": _FARE,
            "store_and_fwd_flag": _TEXT,
            "PULocationID": _ID,
            "DOLocationID": _ID,
            "payment_type": _ID,
            "fare_amount": _FARE,
            "extra": _FARE,
            "mta_tax": _FARE,
            "tip_amount": _FARE,
            "tolls_amount": _FARE,
            "improvement_surcharge": _FARE,
            "total_amount": _FARE,
            "congestion_surcharge": _FARE,
            "airport_fee": _FARE,
        },
    ),
    "green": DatasetSpec(
        name="green",
        event_time="lpep_pickup_datetime",
        types={
            "VendorID": _ID,
            "lpep_pickup_datetime": _TIME,
            "lpep_dropoff_datetime": _TIME,
            "store_and_fwd_flag": _TEXT,
            "RatecodeID": _FARE,
            "PULocationID": _ID,
            "DOLocationID": _ID,
            "passenger_count": _FARE,
            "trip_distance": _FARE,
            "fare_amount": _FARE,
            "extra": _FARE,
            "mta_tax": _FARE,
            "tip_amount": _FARE,
            "tolls_amount": _FARE,
            "ehail_fee": _TEXT,  # left out at publication, as files disagree about its type
            "improvement_surcharge": _FARE,
            "total_amount": _FARE,
            "payment_type": _FARE,
            "trip_type": _FARE,
            "congestion_surcharge": _FARE,
        },
        drop_columns=("ehail_fee",),
    ),
    "fhv": DatasetSpec(
        name="fhv",
        event_time="pickup_datetime",
        types={
            "dispatching_base_num": _TEXT,
            "pickup_datetime": _TIME,
            "dropoff_datetime": _TIME,
            "PULocationID": _ID,
            "DOLocationID": _ID,
            "SR_Flag": _ID,
            "Affiliated_base_number": _TEXT,
        },
    ),
}

ZONES = DatasetSpec(
    name="zone_data",
    types={"LocationID": _ID, "Borough": _TEXT, "Zone": _TEXT, "service_zone": _TEXT},
    file_template="zone_data.csv",
)

# Zone ids that stand for an unknown place.
UNKNOWN_ZONES = (264, 265)
