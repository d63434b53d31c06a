"""Column-level functions: spreads, time helpers, sentinels, JSON payloads."""

from .spread import relative_spread
from .timeutil import anchor_date, local_hour
from .sentinel import far_date_sentinel, apply_far_date_sentinel
from .jsonq import parse_quote_json, quote_events_to_json

__all__ = [
    "relative_spread", "anchor_date", "local_hour", "far_date_sentinel",
    "apply_far_date_sentinel", "parse_quote_json", "quote_events_to_json",
]
