from clickvault.functions.columns import (
    coalesced_rate,
    days_late,
    guarded_rate,
    lower_trim,
    surrogate_key,
    title_trim,
    to_timestamp_ntz,
    upper_trim,
)

__all__ = [
    "coalesced_rate",
    "days_late",
    "guarded_rate",
    "lower_trim",
    "surrogate_key",
    "title_trim",
    "to_timestamp_ntz",
    "upper_trim",
]
