"""Event-time expressions.  Instants are kept in microseconds, minutes as integers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# An ISO-8601 instant in UTC.  Without this guard the timestamp parser would
# also take bare dates and blanks between date and time.
ISO_INSTANT = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?Z$"


def parse_instant(text: Column) -> Column:
    """Timestamp of an ISO instant, null when the text is not one."""
    return F.when(text.rlike(ISO_INSTANT), F.try_to_timestamp(text))


def iso_text(instant: Column) -> Column:
    """ISO-8601 with microseconds, or without a fraction on whole seconds."""
    whole = F.unix_micros(instant) % 1_000_000 == 0
    return F.when(whole, F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(
        F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    )


def minute_of(instant: Column) -> Column:
    """Minutes since the epoch, rounding down."""
    return F.floor(F.unix_seconds(instant) / 60)


def minute_start(minute: Column) -> Column:
    return F.timestamp_seconds(minute * 60)


def millis(instant: Column) -> Column:
    return F.unix_millis(instant)
