"""Column expressions."""

from playledger.functions.clock import (
    epoch_ms,
    event_time,
    format_played_at,
    moment,
    monday_of,
    parse_played_at,
    parse_release_date,
    played_ms,
    utc_now,
    week_bounds,
    week_of,
)
from playledger.functions.payload import first_field
from playledger.functions.text import escape_markup, strip_fences

__all__ = [
    "epoch_ms",
    "escape_markup",
    "event_time",
    "first_field",
    "format_played_at",
    "moment",
    "monday_of",
    "parse_played_at",
    "parse_release_date",
    "played_ms",
    "strip_fences",
    "utc_now",
    "week_bounds",
    "week_of",
]
