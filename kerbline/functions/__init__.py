from kerbline.functions.fares import expected_fare, tariff_table
from kerbline.functions.timeparts import (
    clock,
    is_peak,
    is_weekend,
    minute_of,
    parsed_time,
    trailing_window,
)

__all__ = [
    "clock",
    "expected_fare",
    "is_peak",
    "is_weekend",
    "minute_of",
    "parsed_time",
    "tariff_table",
    "trailing_window",
]
