"""Rounding and exact money averages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# What an amount is summed as: exact to a millionth, up to 10 ** 12.
AMOUNT = "decimal(18,6)"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_numeric(value: Column | str, scale: int = 2) -> Column:
    """Round half away from zero on a decimal, as ``ROUND(x::numeric, scale)`` does."""
    return F.round(_column(value).cast("decimal(38,10)"), scale).cast("double")


def is_number(value: Column, kind: T.DataType) -> Column:
    """False for NaN and NULL. ``kind`` is the type, as only floating ones have NaN."""
    present = value.isNotNull()
    return present & ~F.isnan(value) if isinstance(kind, (T.DoubleType, T.FloatType)) else present


def exact_amount(amount: Column | str) -> Column:
    """A money amount as a decimal, whose sums do not depend on the order of the rows.

    NaN gives NULL, as a missing value does. An amount that does not fit, Infinity included, fails
    the job, whether ANSI mode is on or not.
    """
    value = _column(amount)
    fits = value.try_cast(AMOUNT)
    wrong = F.raise_error(F.concat(F.lit("amount out of range: "), value.cast("string")))
    missing = value.isNull() | F.isnan(value.cast("double"))
    return F.when(~missing, F.coalesce(fits, wrong.cast(AMOUNT)))


def to_cents(amount: Column | str) -> Column:
    """An amount rounded to whole cents, halves away from zero, in a bigint."""
    return F.round(exact_amount(amount) * 100, 0).cast("bigint")


def mean_to_cents(total: Column | str, n: Column | str) -> Column:
    """``total / n``, rounded once to whole cents, halves away from zero.

    ``total`` is a sum of ``exact_amount``: doubled and divided as whole numbers of millionths, so
    no digit of the quotient is lost before it is rounded.
    """
    total, n = _column(total), _column(n).cast("decimal(15,0)")
    size = F.abs(total).cast("decimal(28,6)")
    cents = F.call_function("div", size * F.lit(200) + n, n * F.lit(2))
    return (F.signum(total) * cents / 100).cast("double")
