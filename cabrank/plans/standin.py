"""Trip-shaped views over the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Zone ids that take the part of the unknown ones in these tables.
UNKNOWN = (23, 24)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def trips_ev(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as trips. Type ``error`` plays the missing base; ``raw_base`` keeps it."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("trip_id"),
        F.col("ts").alias("pickup_datetime"),
        F.col("value").alias("tip_amount"),
        F.nullif(F.col("event_type"), F.lit("error")).alias("dispatching_base_num"),
        F.col("event_type").alias("raw_base"),
    )


def zone_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as trips from the supplier's to the customer's nation.

    Suppliers join first: a filter on the pickup zone then thins the lines before their shuffle
    to the orders, which have met their customers by then. None of the sides has a bounded size,
    so the strategy of each join is left to the optimizer. The right sides have unique keys: AQE
    can split a hot key of the left side over tasks at the price of one repeated row.
    """
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    lines = table(spark, sf_dir, "lineitem")
    placed_orders = orders.join(customers, orders.o_custkey == customers.c_custkey)
    return (
        lines.join(suppliers, lines.l_suppkey == suppliers.s_suppkey)
        .join(placed_orders, lines.l_orderkey == placed_orders.o_orderkey)
        .select(
            F.col("o_orderdate").alias("pickup_datetime"),
            F.col("l_shipdate").alias("dropoff_datetime"),
            F.col("s_nationkey").alias("PULocationID"),
            F.col("c_nationkey").alias("DOLocationID"),
            F.col("l_extendedprice").alias("total_amount"),
        )
    )


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("LocationID"), F.col("n_name").alias("Zone")
    )
