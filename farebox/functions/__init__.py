"""Column functions: time arithmetic and exact money sums."""

from farebox.functions.money import average, from_units, to_units, total
from farebox.functions.time import (
    boundary_minutes,
    calendar_day,
    calendar_parts,
    elapsed_minutes,
    elapsed_seconds,
    half_open,
    minute_number,
    month_start,
    on_day,
    second_number,
)

__all__ = [
    "average",
    "boundary_minutes",
    "calendar_day",
    "calendar_parts",
    "elapsed_minutes",
    "elapsed_seconds",
    "from_units",
    "half_open",
    "minute_number",
    "month_start",
    "on_day",
    "second_number",
    "to_units",
    "total",
]
