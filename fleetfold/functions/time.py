"""Time expressions. All durations go through epoch microseconds, so zone-less and zoned columns mix."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def instant(as_of: Column | str | None) -> Column:
    """The clock of an operator: a column, an ISO string, or now."""
    if as_of is None:
        return F.current_timestamp()
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, str) else as_of


def fixed_instant(as_of: Column | str | None) -> Column:
    """As ``instant``, but now is taken once, on the driver: a load that runs several jobs needs one clock."""
    return F.lit(dt.datetime.now(dt.timezone.utc)).cast("timestamp") if as_of is None else instant(as_of)


def micros(ts: Column | str) -> Column:
    return F.unix_micros(col(ts).cast("timestamp"))


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """``end - start`` in seconds with fractions."""
    return (micros(end) - micros(start)) / F.lit(1_000_000.0)


def whole_seconds_between(start: Column | str, end: Column | str) -> Column:
    """Difference of the two times after each is cut to its second."""
    return F.unix_seconds(col(end).cast("timestamp")) - F.unix_seconds(col(start).cast("timestamp"))


def parse(ts: Column | str) -> Column:
    """ISO-8601 text to a timestamp; text that is no time becomes null instead of an error."""
    return F.try_to_timestamp(col(ts))
