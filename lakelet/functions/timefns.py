"""Time functions, all JVM-side (no Python workers, stay inside whole-stage codegen).

Convention: a TIMESTAMP_NTZ value is a UTC wall-clock time.  Spark's own
``unix_timestamp`` and ``window`` already read NTZ that way, independent of the
session zone.  TIMESTAMP (instant) columns are accepted too; helpers that need a
wall clock first turn them into UTC wall-clock NTZ with :func:`as_utc_ntz`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values that must equal the reference's results.
NEW_YORK = "America/New_York"   # weekend flag is computed in New York time
MONTH_FORMAT = "yyyy-MM"        # partition label of a feature row, "YYYY-MM"


def _epoch_ntz() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def _dtype(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def as_utc_ntz(df: DataFrame, name: str) -> Column:
    """The column as a UTC wall-clock TIMESTAMP_NTZ, whatever its timestamp type."""
    dt = _dtype(df, name)
    if isinstance(dt, T.TimestampNTZType):
        return F.col(name)
    if isinstance(dt, T.TimestampType):
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), F.col(name).cast("timestamp_ntz"))
    raise TypeError(f"{name} is {dt.simpleString()}, not a timestamp")


def epoch_seconds(c: Column | str) -> Column:
    """DT1: whole epoch seconds of a TIMESTAMP or (UTC) TIMESTAMP_NTZ column."""
    return F.unix_timestamp(c if isinstance(c, Column) else F.col(c))


def ntz_epoch_micros(c: Column) -> Column:
    """Epoch microseconds of a UTC wall-clock TIMESTAMP_NTZ, independent of the session zone.

    ``unix_timestamp`` reads NTZ as UTC (whole seconds); the microseconds of the
    second come from ``extract(SECOND ...)``, which is zone-free on NTZ.
    """
    frac = (F.extract(F.lit("SECOND"), c) * F.lit(1_000_000)).cast("long") % F.lit(1_000_000)
    return F.unix_timestamp(c).cast("long") * F.lit(1_000_000) + frac


def epoch_micros(df: DataFrame, name: str) -> Column:
    """Exact epoch microseconds (integer arithmetic, no float rounding)."""
    dt = _dtype(df, name)
    if isinstance(dt, T.TimestampNTZType):
        return ntz_epoch_micros(F.col(name))
    return F.unix_micros(F.col(name))


def epoch_to_timestamp(c: Column | str, strict: bool = False) -> Column:
    """DT2/DT3: epoch seconds (long, double or text) to a TIMESTAMP, whole seconds.

    Text that is not a number gives NULL (``try_cast``) unless ``strict``.
    The fraction of a double is dropped, as a "yyyy-MM-dd HH:mm:ss" round trip would.
    """
    col = c if isinstance(c, Column) else F.col(c)
    secs = col.cast("bigint") if strict else col.try_cast("double").try_cast("bigint")
    return F.timestamp_seconds(secs)


def ntz_from_epoch_seconds(c: Column) -> Column:
    """Epoch seconds to a UTC wall-clock TIMESTAMP_NTZ (session-zone independent)."""
    return F.timestamp_add("SECOND", c, _epoch_ntz())


def date_of(c: Column | str) -> Column:
    """DT4: calendar date of a timestamp (in the session zone for TIMESTAMP, as-is for NTZ)."""
    return F.to_date(c)


def parse_timestamp(c: Column | str, fmt: str | None = None, strict: bool = False) -> Column:
    """DT9: string or timestamp to timestamp; unparsable text gives NULL unless ``strict``."""
    col = c if isinstance(c, Column) else F.col(c)
    if strict:
        return F.to_timestamp(col, fmt) if fmt else F.to_timestamp(col)
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


def month_label(c: Column | str) -> Column:
    """DT6: "YYYY-MM" label of a timestamp (its calendar date in the session zone; for NTZ
    the wall-clock date, zone-free)."""
    return F.date_format(F.to_date(c), MONTH_FORMAT)


def month_label_of_epoch(seconds: Column) -> Column:
    """DT6 for epoch seconds: the UTC calendar month, with no time-zone conversion at all."""
    return F.date_format(F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int")), MONTH_FORMAT)


def is_weekend_in(ntz_utc: Column, tz: str = NEW_YORK) -> Column:
    """DT7: 1 when the UTC wall-clock time falls on Saturday or Sunday in ``tz``, else 0.

    ``dayofweek`` numbers Sunday 1 .. Saturday 7.  Daylight-saving changes are
    handled by ``convert_timezone``.
    """
    local = F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz_utc)
    return F.dayofweek(local).isin(1, 7).cast("int")


def ceil_to_minutes_epoch(df: DataFrame, name: str, minutes: int) -> Column:
    """DT8: ceil a timestamp to the next ``minutes`` mark, as INT epoch seconds.

    A value exactly on a mark stays.  Marks are anchored at the epoch, like
    ``window``; ``minutes`` must divide 60 so that this equals "the next mark
    within the hour" in every zone with whole-hour offsets.
    """
    if minutes <= 0 or 60 % minutes:
        raise ValueError("minutes must divide 60")
    step = minutes * 60 * 1_000_000
    us = epoch_micros(df, name)
    # integer arithmetic: us + pmod(-us, step) is the next multiple of step (or us itself);
    # it is a whole number of seconds, so the division below is exact.
    return ((us + F.pmod(-us, F.lit(step))) / F.lit(1_000_000)).cast("long").cast("int")


def utc_date(c: Column | str) -> Column:
    """The UTC calendar date of an instant, whatever the session zone."""
    seconds = F.unix_seconds(c if isinstance(c, Column) else F.col(c))
    return F.date_from_unix_date(F.floor(seconds / F.lit(86400)).cast("int"))
