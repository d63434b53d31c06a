"""Relative bid-ask spread."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def relative_spread(bid: Column | str = "bid", ask: Column | str = "ask") -> Column:
    """(ask - bid) / ((ask + bid) / 2); null when the mid price is zero.

    ``try_divide`` keeps ANSI mode on and returns null on a zero mid, as the
    original non-ANSI arithmetic did. A crossed quote (bid > ask) gives a
    negative spread and is kept.
    """
    bid = F.col(bid) if isinstance(bid, str) else bid
    ask = F.col(ask) if isinstance(ask, str) else ask
    return F.try_divide(ask - bid, (ask + bid) / F.lit(2))
