"""Scalar expressions shared by rules, metrics and reports."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def same_text(column: Column, value: str) -> Column:
    """Equality ignoring case; a null is not equal."""
    return F.coalesce(F.upper(column) == value.upper(), F.lit(False))


def is_blank(column: Column) -> Column:
    """Null, empty or only white space."""
    first = F.substring(column, 1, 1)
    # a printable first character settles it without a pattern match
    printable = (first > " ") & (first <= "~")
    return column.isNull() | ~(printable | column.rlike(r"\S"))


def fixed2(number: Column) -> Column:
    """A decimal as text with two places, half up."""
    return F.round(number, 2).cast("decimal(30,2)").cast("string")


def or_default(column: Column, default: str) -> Column:
    """Null or empty text becomes ``default``."""
    return F.coalesce(F.nullif(column.cast("string"), F.lit("")), F.lit(default))


def log_amount(amount: Column) -> Column:
    """Base-10 logarithm of the amount, amounts below one counting as one."""
    return F.log10(F.greatest(F.coalesce(amount.cast("double"), F.lit(0.0)), F.lit(1.0)))


def risk_score(
    amount: Column, black_device: Column, black_card: Column, label: Column, status: Column
) -> Column:
    """Heuristic score from 18 to 100 of one transaction, as a decimal with two places.

    A decimal keeps sums and means of scores independent of row order.
    """
    flag = lambda cond, points: F.when(cond, F.lit(points)).otherwise(F.lit(0.0))
    raw = (
        F.least(F.lit(99.0), F.lit(18.0) + log_amount(amount) * 10.0)
        + flag(F.coalesce(black_device, F.lit(False)), 18.0)
        + flag(F.coalesce(black_card, F.lit(False)), 10.0)
        + flag(~same_text(or_default(label, "NORMAL"), "NORMAL"), 12.0)
        + flag(same_text(status, "FAILED"), 7.0)
    )
    return F.round(F.least(raw, F.lit(100.0)), 2).cast("decimal(5,2)")


def event_risk_score() -> Column:
    """``risk_score`` over the columns of an event."""
    return risk_score(
        F.col("amount"), F.col("is_black_device"), F.col("is_black_card"),
        F.col("risk_label"), F.col("transaction_status"),
    )
