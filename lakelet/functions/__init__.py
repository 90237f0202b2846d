from lakelet.functions.timefns import (
    as_utc_ntz,
    ceil_to_minutes_epoch,
    date_of,
    epoch_micros,
    epoch_seconds,
    epoch_to_timestamp,
    is_weekend_in,
    month_label,
    ntz_from_epoch_seconds,
    parse_timestamp,
)

__all__ = [
    "as_utc_ntz",
    "ceil_to_minutes_epoch",
    "date_of",
    "epoch_micros",
    "epoch_seconds",
    "epoch_to_timestamp",
    "is_weekend_in",
    "month_label",
    "ntz_from_epoch_seconds",
    "parse_timestamp",
]
