"""Load checks: row counts and keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class KeyViolation(ValueError):
    """The declared key has NULLs or duplicates."""


class RowCountMismatch(ValueError):
    """A table holds another number of rows than was loaded into it."""


def key_violations(df: DataFrame, *key: str) -> DataFrame:
    """Key values that are NULL in any part or occur more than once, with their row counts."""
    missing = F.lit(False)
    for column in key:
        missing = missing | F.col(column).isNull()
    counted = df.groupBy(*key).agg(F.count("*").alias("row_count"))
    return counted.where((F.col("row_count") > 1) | missing)


def require_key(df: DataFrame, *key: str) -> DataFrame:
    """Return ``df`` if ``key`` is unique and not null, fail otherwise."""
    example = key_violations(df, *key).head(1)
    if example:
        raise KeyViolation(f"{', '.join(key)} is not a key: {example[0].asDict()}")
    return df


# Bits of the key filter for each key of a batch, and the largest filter (8 MB of rows).
FILTER_BITS = 8
FILTER_MOST = 1 << 25


def known_keys(batch: DataFrame, stored: DataFrame, *key: str) -> DataFrame:
    """The keys of ``batch`` that ``stored`` has already.

    Of the stored rows only those take part in the join that pass a Bloom filter of the batch's
    keys: a table of 64-bit blocks, bounded by ``FILTER_MOST`` bits, that is broadcast. The range
    of the first key column goes to the scan before. With a batch too large for the filter more
    rows get through, and the join is as exact.
    """
    types = {f.name.lower(): f.dataType for f in stored.schema.fields}
    own = batch.select(*[F.col(k).cast(types[k.lower()]).alias(k) for k in key]).distinct()
    count, low, high = own.agg(F.count("*"), F.min(key[0]), F.max(key[0])).head()
    bits = 1 << min(max(16, (FILTER_BITS * count).bit_length()), FILTER_MOST.bit_length() - 1)
    place = F.pmod(F.xxhash64(*key), F.lit(bits))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("place") % 64)
    of_place = F.shiftright("place", 6).alias("block")
    blocks = (
        own.select(place.cast("int").alias("place"))
        .select(of_place, bit.alias("bit"))
        .groupBy("block")
        .agg(F.bit_or("bit").alias("bits"))
    )
    inside = stored.where(F.col(key[0]).between(F.lit(low), F.lit(high)))
    placed = inside.select(*key, place.cast("int").alias("place"))
    passed = (
        placed.select(*key, of_place, bit.alias("bit"))
        .join(F.broadcast(blocks), "block")
        .where(F.col("bits").bitwiseAND(F.col("bit")) != 0)
    )
    return own.join(passed.select(*key), list(key), "left_semi")


def require_new_keys(batch: DataFrame, stored: DataFrame, *key: str) -> DataFrame:
    """Return ``batch`` if ``key`` holds in it and none of its keys is stored, fail otherwise."""
    require_key(batch, *key)
    example = known_keys(batch, stored, *key).head(1)
    if example:
        raise KeyViolation(f"{', '.join(key)} is there already: {example[0].asDict()}")
    return batch


def loaded_counts(spark: SparkSession, table: str, source: DataFrame) -> DataFrame:
    """One row: table name, rows in the source and rows in the table, counted in one job."""
    here, there = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    return (
        source.select(here.alias("s"), there.alias("t"))
        .unionAll(spark.table(table).select(there.alias("s"), here.alias("t")))
        .agg(
            F.coalesce(F.sum("s"), there).alias("source_rows"),
            F.coalesce(F.sum("t"), there).alias("loaded_rows"),
        )
        .select(F.lit(table).alias("table_name"), "source_rows", "loaded_rows")
    )


def require_row_count(spark: SparkSession, table: str, expected: int) -> int:
    """Rows in the table, which must be as many as expected."""
    loaded = spark.table(table).count()
    if loaded != expected:
        raise RowCountMismatch(f"{table} holds {loaded} rows, expected {expected}")
    return loaded
