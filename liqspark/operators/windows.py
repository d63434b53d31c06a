"""Event-time sliding windows over quotes, newest quote per key, enrichment.

The same aggregation serves batch and stream:
key (window, bond, tg, date) -> sum(volume_money), max(bid), max(ask),
max(update_ts), count(update_ts). Grouping on ``date`` splits a window that
crosses midnight; a null event time falls in no window.

Four ways to the same rows (``method``):

* ``frames`` (batch default): rows are reduced per ``gcd(window, slide)`` bucket, a window frame lists
  the at most window / bucket buckets that end in each bucket, and every output window is made once, from
  the last bucket with events that it covers. A quote is never copied into the windows it lies in: one
  row a (key, bucket) is shuffled, and a key holds at most a day's buckets.
* ``held`` (append streams' default): the state holds a row a (key, bucket); see ``streaming.held_windows``.
* ``plain`` (streams in update mode; the native state): one Expand of window / slide copies
  (30 for 30 min / 1 min), a map-side partial aggregate, one shuffle.
* ``buckets``: reduced per bucket, then the reduced rows are copied into their windows.

``frames`` and ``held`` first make *runs*: neighbouring windows of a key with the same quotes, as one row from
``_first`` to ``_last`` start (counted in buckets). ``spread_runs`` copies a run into its windows, behind
whatever is joined to it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import broadcast_if_small

# Fixed values of the original stream: watermark, window length, slide.
WATERMARK = "120 minutes"
WINDOW = "30 minutes"
SLIDE = "1 minute"
KEYS = ("bond", "tg", "date")

_UNITS_US = {
    "microsecond": 1, "millisecond": 1_000, "second": 1_000_000, "minute": 60_000_000,
    "hour": 3_600_000_000, "day": 86_400_000_000, "week": 604_800_000_000,
}


def duration_us(text: str) -> int:
    """'30 minutes' -> microseconds (the fixed-length units ``window`` accepts)."""
    total = 0
    parts = re.findall(r"(\d+)\s*([a-zA-Z]+)", text)
    if not parts:
        raise ValueError(f"not a duration: {text!r}")
    for num, unit in parts:
        unit = unit.lower().rstrip("s")
        if unit not in _UNITS_US:
            raise ValueError(f"unsupported unit in {text!r}")
        total += int(num) * _UNITS_US[unit]
    return total


def _final_aggs(vm: str, bid: str, ask: str, ts: str, cnt: Column) -> list[Column]:
    return [
        F.sum(vm).alias("volume_money"),
        F.max(bid).alias("bid"),
        F.max(ask).alias("ask"),
        F.max(ts).alias("update_ts"),
        cnt.alias("cnt"),
    ]


def _project(agg: DataFrame, keys: Sequence[str], keep_window: bool) -> DataFrame:
    cols = list(keys) + ["volume_money", "bid", "ask", "update_ts", "cnt"]
    if keep_window:
        return agg.select(F.col("window.start").alias("window_start"),
                          F.col("window.end").alias("window_end"), *cols)
    return agg.select(*cols)


METHODS = ("frames", "held", "plain", "buckets")


def sliding_window_agg(quotes: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                       keys: Sequence[str] = KEYS, ts_col: str = "update_ts",
                       method: str | None = None, keep_window: bool = True) -> DataFrame:
    """Windowed quote aggregate by ``method``: ``frames`` in batch and ``held`` on
    streams if none is named."""
    keys = list(keys)
    method = _method(quotes, method)
    if method == "plain":
        agg = quotes.groupBy(F.window(ts_col, window, slide).alias("window"), *keys).agg(
            *_final_aggs("volume_money", "bid", "ask", ts_col, F.count(ts_col)))
        return _project(agg, keys, keep_window)

    bucket_us, width, step = _in_buckets(window, slide)
    if method in ("frames", "held"):
        runs = window_runs(quotes, window, slide, keys, ts_col, method)
        return spread_runs(runs, bucket_us, width, step, quotes.schema[ts_col].dataType, keep_window)
    bucket = F.window(ts_col, f"{bucket_us} microseconds").start
    pre = quotes.where(F.col(ts_col).isNotNull()).groupBy(*keys, bucket.alias("_bucket")).agg(*_partial_aggs(ts_col))
    agg = pre.groupBy(F.window("_bucket", window, slide).alias("window"), *keys).agg(
        *_final_aggs("_vm", "_bid", "_ask", "_ts", F.sum("_cnt")))
    return _project(agg, keys, keep_window)


def _method(quotes: DataFrame, method: str | None) -> str:
    method = method or ("held" if quotes.isStreaming else "frames")
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    if method in ("frames", "held") and (method == "held") != quotes.isStreaming:
        raise ValueError("frames are for batch, held windows for streams")
    return method


def _in_buckets(window: str, slide: str) -> tuple[int, int, int]:
    """Length of a bucket in microseconds; window and slide in buckets."""
    bucket_us = math.gcd(duration_us(window), duration_us(slide))
    return bucket_us, duration_us(window) // bucket_us, duration_us(slide) // bucket_us


def window_runs(quotes: DataFrame, window: str = WINDOW, slide: str = SLIDE, keys: Sequence[str] = KEYS,
                ts_col: str = "update_ts", method: str | None = None) -> DataFrame:
    """The windows of ``sliding_window_agg`` as runs, by ``frames`` or ``held``."""
    keys, (bucket_us, width, step) = list(keys), _in_buckets(window, slide)
    timed = quotes.where(F.col(ts_col).isNotNull()).withColumn("_us", F.unix_micros(F.col(ts_col).cast("timestamp")))
    number = F.expr(f"(_us - pmod(_us, {bucket_us}L)) div {bucket_us}L").alias("_m")
    if _method(quotes, method) == "held":
        from ..streaming.held_windows import held_runs
        parts = timed.select(*keys, number, F.col("volume_money").cast("double").alias("_vm"), F.col("bid").cast("double").alias("_bid"),
                             F.col("ask").cast("double").alias("_ask"), F.col("_us").alias("_ts"), F.lit(1).cast("bigint").alias("_cnt"))
        return held_runs(parts, keys, bucket_us, width, step)
    return framed_runs(timed.groupBy(*keys, number).agg(*_partial_aggs(ts_col)), keys, width, step)


def chained_window_agg(quotes: DataFrame, window: str = WINDOW, slide: str = SLIDE, keys: Sequence[str] = KEYS,
                       ts_col: str = "update_ts") -> DataFrame:
    """The aggregate of a watermarked stream by two stateful operators: quotes into rows of one
    ``gcd(window, slide)`` bucket, then closed buckets into their windows. A window's state is opened by
    its first closed bucket, not by its first quote: the first operator holds a row a key and open bucket, the
    second the closed buckets of open windows. Same windows as ``sliding_window_agg``, in append mode."""
    from ..streaming.held_windows import held_runs
    keys, (bucket_us, width, step) = list(keys), _in_buckets(window, slide)
    pre = quotes.groupBy(F.window(ts_col, f"{bucket_us} microseconds").alias("_minute"), *keys).agg(*_partial_aggs(ts_col))
    number = F.expr(f"unix_micros(_minute.start) div {bucket_us}L").alias("_m")
    closed = pre.select(*keys, number, "_vm", "_bid", "_ask", F.unix_micros("_ts").alias("_ts"), "_cnt")
    runs = held_runs(closed, keys, bucket_us, width, step, in_time=True)
    return spread_runs(runs, bucket_us, width, step, quotes.schema[ts_col].dataType)


def _partial_aggs(ts_col: str) -> list[Column]:
    return [F.sum("volume_money").alias("_vm"), F.max("bid").alias("_bid"), F.max("ask").alias("_ask"),
            F.max(ts_col).alias("_ts"), F.count(ts_col).alias("_cnt")]


def framed_runs(parts: DataFrame, keys: list[str], width: int, step: int) -> DataFrame:
    """Runs of the buckets of a batch (keys, ``_m`` and the partial aggregates), each made from the last
    bucket with events that its windows cover.

    In buckets, a window of length w that starts at s covers s .. s + w - 1. Bucket m is the last one of
    the windows with s + w - 1 >= m that start at or before m and end before the key's next bucket; of
    these, the ones that start behind the bucket before the i-th held one hold the i-th and all later ones.
    """
    in_order = Window.partitionBy(*keys).orderBy("_m")
    part = F.struct("_m", "_vm", "_bid", "_ask", "_ts", "_cnt")
    framed = parts.select(*keys, F.col("_m"), F.lead("_m").over(in_order).alias("_next"),
                          F.collect_list(part).over(in_order.rangeBetween(1 - width, 0)).alias("_held"))
    framed = framed.withColumn("_from", F.col("_m") - (width - 1))
    framed = framed.withColumn("_to", F.least(F.col("_m"), F.coalesce(F.col("_next") - width, F.col("_m"))))
    before = lambda i: F.when(i == 0, F.col("_from")).otherwise(F.col("_held")[F.greatest(i - 1, F.lit(0))]["_m"] + 1)
    starts = F.transform("_held", lambda p, i: F.struct(before(i).alias("_first"), F.least(F.col("_to"), p["_m"]).alias("_last"), i.alias("_i")))
    # Starts are multiples of the step: a run without one holds no window.
    kept = F.filter(starts, lambda r: F.ceil(r["_first"] / F.lit(step)) <= F.floor(r["_last"] / F.lit(step)))
    runs = framed.select(*keys, "_held", F.explode(kept).alias("_run"))
    runs = runs.select(*keys, "_run._first", "_run._last", F.slice("_held", F.col("_run._i") + 1, F.size("_held")).alias("_in"))
    of = lambda c: F.transform("_in", lambda p: p[c])
    known = F.filter(of("_vm"), lambda v: v.isNotNull())
    total = F.when(F.size(known) > 0, F.aggregate(known, F.lit(0).cast("double"), lambda s, v: s + v))
    count = F.aggregate(of("_cnt"), F.lit(0).cast("bigint"), lambda s, v: s + v)
    return runs.select(*keys, "_first", "_last", total.alias("volume_money"), F.array_max(of("_bid")).alias("bid"), F.array_max(of("_ask")).alias("ask"),
                       F.array_max(of("_ts")).alias("update_ts"), count.alias("cnt"))


def spread_runs(runs: DataFrame, bucket_us: int, width: int, step: int, kind, keep_window: bool = True) -> DataFrame:
    """Every window of the runs; times of type ``kind``."""
    up, down = F.ceil(F.col("_first") / F.lit(step)).cast("bigint"), F.floor(F.col("_last") / F.lit(step)).cast("bigint")
    rest = [c for c in runs.columns if c not in ("_first", "_last")]
    windows = runs.select(*rest, F.explode(F.when(up <= down, F.sequence(up, down))).alias("_start"))
    start, end = (F.timestamp_micros((F.col("_start") * step + more) * bucket_us).cast(kind) for more in (0, width))
    frame = [start.alias("window_start"), end.alias("window_end")] if keep_window else []
    return windows.select(*frame, *rest)


def latest_quote(quotes: DataFrame, keys: Sequence[str] = ("bond", "tg"),
                 ts_col: str = "update_ts") -> DataFrame:
    """Newest row per key: latest ``ts_col`` (nulls last), ties by the remaining
    columns descending.

    An aggregate (``max`` of a struct led by the event time), not a window:
    partial aggregation keeps a hot key from landing whole in one task.
    """
    keys = list(keys)
    rest = [c for c in quotes.columns if c not in keys and c != ts_col]
    newest = F.max(F.struct(F.col(ts_col), *[F.col(c) for c in rest])).alias("_newest")
    out = quotes.groupBy(*keys).agg(newest)
    return out.select(*keys, *[F.col(f"_newest.{c}").alias(c) for c in rest],
                      F.col(f"_newest.{ts_col}").alias(ts_col))


ENRICHED_COLUMNS = ["bond", "isin", "tg", "date", "volume_money", "bid", "ask", "update_ts",
                    "baspread_rel_median", "baspread_rel_rank", "cnt"]


def enrich_with_metrics(windowed: DataFrame, metrics: DataFrame,
                        broadcast_max_bytes: int | None = None) -> DataFrame:
    """Left join of windowed quotes with the bond metrics on bond = id.

    Unmatched quotes keep null isin / median / rank. The metrics side is
    broadcast only when its measured size fits the limit; otherwise the join
    shuffles. Works on a stream (static side read once at start) and in batch.
    """
    side = metrics.select(
        F.col("id").alias("_liq_id"), "isin",
        F.col("bid_ask_spread_relative_median").alias("baspread_rel_median"),
        F.col("bid_ask_spread_relative_rank").alias("baspread_rel_rank"))
    side, _ = broadcast_if_small(side, broadcast_max_bytes)
    joined = windowed.join(side, windowed["bond"] == side["_liq_id"], "left")
    extra = [c for c in ("window_start", "window_end", "_first", "_last") if c in windowed.columns]
    return joined.select(*extra, *ENRICHED_COLUMNS)


def enriched_windows(quotes: DataFrame, metrics: DataFrame, window: str = WINDOW, slide: str = SLIDE,
                     keep_window: bool = True, broadcast_max_bytes: int | None = None) -> DataFrame:
    """``enrich_with_metrics`` of ``sliding_window_agg``, joined run by run: a join that shuffles moves
    the runs, not their windows."""
    runs = enrich_with_metrics(window_runs(quotes, window, slide), metrics, broadcast_max_bytes)
    return spread_runs(runs, *_in_buckets(window, slide), quotes.schema["update_ts"].dataType, keep_window)
