"""Column-level helpers: event time, window arithmetic, hashing and report text."""

from eventide.functions.time import (
    to_event_time, micros, millis, interval_micros, interval_millis, floor_to, window_end_ms, window_start_ms,
    next_utc_midnight,
)
from eventide.functions.hashing import poly_hash
from eventide.functions.text import format_ranking

__all__ = [
    "to_event_time", "micros", "millis", "interval_micros", "interval_millis", "floor_to", "window_end_ms",
    "window_start_ms", "next_utc_midnight", "poly_hash", "format_ranking",
]
