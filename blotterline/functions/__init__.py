"""Column expressions. All are built-in Spark expressions; none is a UDF."""

from blotterline.functions.calendar import (
    day_name_of,
    day_number,
    event_time,
    hour_of_day,
    weekend_flag,
    weekend_text,
)
from blotterline.functions.text import flag, is_blank, or_unknown, percent_bucket, to_number

__all__ = [
    "day_name_of",
    "day_number",
    "event_time",
    "flag",
    "hour_of_day",
    "is_blank",
    "or_unknown",
    "percent_bucket",
    "to_number",
    "weekend_flag",
    "weekend_text",
]
