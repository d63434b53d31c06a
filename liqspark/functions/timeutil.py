"""Business-day anchor: local hour and the ``yyyyMMdd`` anchor date.

The daily batch reads the folder of the *anchor date*: the local (exchange)
date, or the day before while it is earlier than the cut-off hour. These are
column functions, so they work over any timestamp column, not just "now".
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the original job: exchange time zone, cut-off hour, format.
EXCHANGE_TZ = "Europe/Moscow"
CUTOFF_HOUR = 10
ANCHOR_FORMAT = "yyyyMMdd"


def _local_wall_clock(ts: Column, tz: str, source_tz: str) -> Column:
    # TIMESTAMP_NTZ wall clock in ``source_tz`` -> wall clock in ``tz``.
    return F.convert_timezone(F.lit(source_tz), F.lit(tz), ts.cast("timestamp_ntz"))


def local_hour(ts: Column | str, tz: str = EXCHANGE_TZ, source_tz: str = "UTC") -> Column:
    """Hour of day of ``ts`` in ``tz``.

    ``ts`` is a wall-clock timestamp in ``source_tz`` (a TIMESTAMP column is
    first rendered in the session time zone, so pass that as ``source_tz``).
    """
    ts = F.col(ts) if isinstance(ts, str) else ts
    return F.hour(_local_wall_clock(ts, tz, source_tz))


def anchor_date(ts: Column | str, tz: str = EXCHANGE_TZ, cutoff_hour: int = CUTOFF_HOUR,
                fmt: str = ANCHOR_FORMAT, source_tz: str = "UTC") -> Column:
    """Local date of ``ts`` in ``tz``, minus one day before ``cutoff_hour``, formatted."""
    ts = F.col(ts) if isinstance(ts, str) else ts
    local = _local_wall_clock(ts, tz, source_tz)
    day = F.to_date(local)
    day = F.when(F.hour(local) < F.lit(cutoff_hour), F.date_sub(day, 1)).otherwise(day)
    return F.date_format(day, fmt)
