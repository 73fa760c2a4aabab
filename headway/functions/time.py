"""Clock arithmetic on time-zone-free timestamps (TIMESTAMP_NTZ).

The data has local wall-clock times without a zone, so no result here depends on
the session time zone.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_timestamp(text: Column) -> Column:
    """Text to timestamp; unreadable text gives null."""
    return text.try_cast("timestamp_ntz")


def start_of_day(ts: Column) -> Column:
    return ts.cast("date").cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """``end - start`` in seconds with microsecond precision, as a double."""
    return (end - start).cast("interval second").cast("decimal(20,6)").cast("double")


def at_time_of(day: Column, clock: Column) -> Column:
    """The date of ``day`` with the time of day of ``clock``; null if either is null."""
    return day.cast("date").cast("timestamp_ntz") + (clock - start_of_day(clock))


def floor_hour(ts: Column) -> Column:
    return start_of_day(ts) + F.make_dt_interval(F.lit(0), F.hour(ts))


def monday_first(day: Column) -> Column:
    """Day of the week with Monday = 0."""
    return F.weekday(day)


def weekend_flag(weekday: Column) -> Column:
    """1 for Saturday and Sunday, 0 otherwise and for null."""
    return F.coalesce(weekday >= 5, F.lit(False)).cast("int")


def hour_timestamp(year: Column, month: Column, day: Column, hour: Column) -> Column:
    return F.make_timestamp_ntz(year, month, day, hour, F.lit(0), F.lit(0))
