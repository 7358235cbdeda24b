from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import values as V


def moment(as_of: str | None) -> Column:
    """The reference instant of a run. Without one, the start of the query."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def day(as_of: str | None) -> Column:
    return F.current_date() if as_of is None else F.lit(as_of).cast("date")


def event_timestamp(raw: Column) -> Column:
    """Event time from ISO 8601 text (any fraction, any or no offset), epoch ms or epoch s.

    The pattern decides the form and a cast does the parsing, so no format
    string is tried and failed per row. Text of another form is null.
    """
    number = raw.try_cast("bigint")
    return (
        F.when(raw.rlike(V.ISO_TIMESTAMP), raw.try_cast("timestamp"))
        .when(raw.rlike(V.EPOCH_MILLIS), F.timestamp_millis(number))
        .when(raw.rlike(V.EPOCH_SECONDS), F.timestamp_seconds(number))
    )


def iso_timestamp(raw: Column) -> Column:
    """Event time from ISO 8601 text only."""
    return F.when(raw.rlike(V.ISO_TIMESTAMP), raw.try_cast("timestamp"))


def date_key(c: Column) -> Column:
    """20240115 for 2024-01-15."""
    return F.year(c) * 10000 + F.month(c) * 100 + F.dayofmonth(c)


def days_since(c: Column, as_of: str | None) -> Column:
    return F.datediff(day(as_of), c)
