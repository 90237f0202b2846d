"""The notebook's three Python functions as Arrow-native user functions (UD1, UD2).

The library computes these natively (``timefns``: month label, weekend flag, ceil-to-minutes).  These are
for user code that wants Python: they take and return Arrow arrays, so no row is converted, and arguments
may be literals.  Inputs are UTC wall-clock timestamps; a null gives null.
"""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import IntegerType, StringType

NEW_YORK = "America/New_York"  # fixed value, as in timefns


@arrow_udf(IntegerType())
def weekend_flag(ts: pa.Array) -> pa.Array:
    local = pc.assume_timezone(ts.cast(pa.timestamp("us")), "UTC").cast(pa.timestamp("us", NEW_YORK))
    return pc.greater_equal(pc.day_of_week(local), 5).cast(pa.int32())  # Monday is 0


@arrow_udf(StringType())
def month_text(ts: pa.Array) -> pa.Array:
    return pc.strftime(ts.cast(pa.timestamp("us")), "%Y-%m")


@arrow_udf(IntegerType())
def ceil_epoch(ts: pa.Array, minutes: pa.Array) -> pa.Array:
    step = pc.multiply(minutes.cast(pa.int64()), 60_000_000)
    us = ts.cast(pa.timestamp("us")).cast(pa.int64())
    whole = pc.divide(us, step)  # towards zero
    up = pc.if_else(pc.greater(us, pc.multiply(whole, step)), pc.add(whole, 1), whole)
    return pc.divide(pc.multiply(up, step), 1_000_000).cast(pa.int32())
