"""Projections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame


def project_star(df: DataFrame) -> DataFrame:
    return df.select("*")


def project_except(df: DataFrame, *columns: str) -> DataFrame:
    """All columns but the named ones. Dropped columns are never read from columnar files."""
    return df.drop(*columns)


def project_alias(df: DataFrame, **named: Column) -> DataFrame:
    """Computed columns under the given names."""
    return df.select(*[column.alias(name) for name, column in named.items()])


def distinct_values(df: DataFrame, *columns: str) -> DataFrame:
    """Distinct rows of the columns, NULL included. Deduplicated before and after the shuffle."""
    return df.select(*columns).distinct()
