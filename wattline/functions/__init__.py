"""Column functions: everything here returns a Spark ``Column`` built from JVM-side functions only."""

from wattline.functions.geo import chord2, haversine_metres, latlon_text, unit_vector
from wattline.functions.numeric import half_up, milli, safe_double
from wattline.functions.temporal import (
    add_minutes,
    clock_text_to_seconds,
    floor_minute,
    parse_reading_time,
    quarter_label,
    second_of_day,
    time_text,
)
from wattline.functions.text import canonical_id, row_hash

__all__ = [
    "add_minutes",
    "canonical_id",
    "chord2",
    "clock_text_to_seconds",
    "floor_minute",
    "half_up",
    "haversine_metres",
    "latlon_text",
    "milli",
    "parse_reading_time",
    "quarter_label",
    "row_hash",
    "safe_double",
    "second_of_day",
    "time_text",
    "unit_vector",
]
