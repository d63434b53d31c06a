"""Sliding windows of a watermarked stream whose state holds buckets, not windows.

The native windowed aggregate keeps window / slide state rows a quote (30 for 30 min / 1 min), and every
one is shuffled, stored and evicted. Here the state holds one entry a key and ``gcd(window, slide)`` bucket,
and a window is made when the watermark passes its end. Neighbouring windows with the same quotes leave the
operator as one *run* (first to last start), which ``operators.windows.spread_runs`` copies into its windows
after the joins. Append mode only. As with the native operator a quote behind the watermark misses the
windows that are closed and counts in those that are open; the windows it misses are counted
(``LATE``, read by ``runner.dropped_by_watermark``).

Keys are spread over ``groups`` state entries by their hash; like the state partitions it is fixed for a
checkpoint. A task handles one entry at a time and takes its quotes in batches, so what must fit in memory are
the open buckets of an entry's keys. A day of 36 million quotes makes 35,000 of them an entry.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import ByteType, DateType, IntegerType, LongType, ShortType, StringType

# Tasks get the processor by value: executors need numpy and pandas, not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

STATE = "buckets"
LATE = "windows_behind_watermark"
GROUPS = 1024
VALUES = ("vm", "bid", "ask")
FIELDS = ("nulls", "m", *VALUES, "ts", "cnt")
FIELD_TYPES = {"nulls": "bigint", "m": "bigint", "vm": "double", "bid": "double", "ask": "double", "ts": "bigint", "cnt": "bigint"}


def _key_type(kind) -> str:
    if isinstance(kind, DateType):
        return "date"
    if isinstance(kind, StringType):
        return "string"
    if isinstance(kind, (LongType, IntegerType, ShortType, ByteType)):
        return kind.simpleString()
    raise ValueError(f"keys of held windows are whole numbers, dates or text, not {kind.simpleString()}")


def _carried(kind: str) -> str:
    return "string" if kind == "string" else "bigint"


class HeldWindows(StatefulProcessor):
    """Buckets of the keys of one state entry; see the module. Times are counted in buckets."""

    def __init__(self, keys: list[tuple[str, str]], bucket_us: int, width: int, step: int, in_time: bool = False):
        self.keys, self.bucket_us, self.width, self.step, self.in_time = keys, bucket_us, width, step, in_time
        self.key_columns = [f"{name}__{kind}" for name, kind in keys]
        self.columns = [*self.key_columns, *FIELDS]

    def init(self, handle) -> None:
        self.handle = handle
        held = [f"`{c}` array<{_carried(kind)}>" for c, (_, kind) in zip(self.key_columns, self.keys)]
        held += [f"{c} array<{FIELD_TYPES[c]}>" for c in FIELDS]
        self.held = handle.getValueState(STATE, ", ".join([*held, "closed bigint", "timer bigint", "frame array<bigint>"]))

    def handleInputRows(self, key, rows, timerValues):
        closed = self._closed(timerValues)
        new = self._compact(None)
        for chunk in rows:
            new = self._compact(pd.concat([new, chunk[self.columns]], ignore_index=True))
        held, before, timer = self._load(None if self.in_time else closed)
        if self.in_time:
            held, new = self._compact(pd.concat([held, new], ignore_index=True)), self._compact(None)
        yield from self._emit(held, before, closed)
        missed = self._runs(new, None, closed)
        late = int((missed["last"] // self.step + (-missed["first"]) // self.step + 1).clip(lower=0).sum())
        if late:
            nothing = {c: [0 if t == "bigint" else ""] for c, t in ((c, _carried(k)) for c, (_, k) in zip(self.key_columns, self.keys))}
            yield pd.DataFrame({**nothing, "nulls": [0], "first": [0], "last": [-1], **{c: [0.0] for c in VALUES}, "ts": [0], "cnt": [0], "late": [late]})
        self._store(self._compact(pd.concat([held, new], ignore_index=True)), closed, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        closed = self._closed(timerValues)
        held, before, timer = self._load(closed)
        yield from self._emit(held, before, closed)
        self._store(held, closed, None if timer == expiredTimerInfo.getExpiryTimeInMs() else timer)

    def close(self) -> None:
        pass

    def _closed(self, timer_values) -> int:
        """The last start whose window has ended."""
        return (timer_values.getCurrentWatermarkInMs() * 1000 - self.width * self.bucket_us) // self.bucket_us

    def _load(self, closed: int | None):
        value = self.held.get() if self.held.exists() else None
        if value is None:
            return self._compact(None), closed, None
        n = len(self.columns)
        return pd.DataFrame(dict(zip(self.columns, value[:n]))), value[n], value[n + 1]

    def _store(self, held: pd.DataFrame, closed: int, timer: int | None) -> None:
        held = held[held["m"] > closed]
        if timer is not None:
            self.handle.deleteTimer(timer)
        if held.empty:
            self.held.clear()
            return
        start = max(int(held["m"].min()) - self.width + 1, closed + 1)
        end = (-(-start // self.step) * self.step + self.width) * self.bucket_us
        due = -(-end // 1000)
        self.handle.registerTimer(due)
        self.held.update((*(held[c].tolist() for c in self.columns), closed, due, [self.bucket_us, self.width, self.step]))

    def _emit(self, held: pd.DataFrame, before: int | None, closed: int):
        runs = self._runs(held, before, closed)
        if len(runs):
            yield runs.assign(late=0)

    def _compact(self, rows: pd.DataFrame | None) -> pd.DataFrame:
        """One row a key and bucket, by key and bucket."""
        if rows is None or rows.empty:
            kinds = {c: "object" if k == "string" else "int64" for c, (_, k) in zip(self.key_columns, self.keys)}
            kinds |= {c: "float64" if c in VALUES else "int64" for c in FIELDS}
            return pd.DataFrame({c: pd.Series(dtype=t) for c, t in kinds.items()})
        key, m = self._numbered(rows), rows["m"].to_numpy()
        order = np.lexsort((m, key))
        key, m = key[order], m[order]
        at = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (m[1:] != m[:-1])])
        one = rows.iloc[order[at]].reset_index(drop=True)
        if len(at) == len(rows):
            return one
        return one.assign(**self._folded(rows.iloc[order], at))

    def _numbered(self, rows: pd.DataFrame) -> np.ndarray:
        return rows.groupby([*(rows[c] for c in self.key_columns), rows["nulls"].to_numpy() >> len(VALUES)], sort=True).ngroup().to_numpy()

    def _folded(self, rows: pd.DataFrame, at: np.ndarray) -> dict:
        """The aggregates of the rows from each place of ``at`` to the next."""
        nulls, out = rows["nulls"].to_numpy(), {}
        flags = (nulls[at] >> len(VALUES)) << len(VALUES)
        for bit, name in enumerate(VALUES):
            known, value = (nulls >> bit) & 1 == 0, rows[name].to_numpy()
            with np.errstate(invalid="ignore"):
                folded = np.add.reduceat(np.where(known, value, 0.0), at) if name == "vm" else np.maximum.reduceat(np.where(known, value, -np.inf), at)
            empty = ~np.logical_or.reduceat(known, at)
            out[name] = np.where(empty, 0.0, folded)
            flags = flags | (empty.astype("int64") << bit)
        return {**out, "nulls": flags, "ts": np.maximum.reduceat(rows["ts"].to_numpy(), at), "cnt": np.add.reduceat(rows["cnt"].to_numpy(), at)}

    def _runs(self, held: pd.DataFrame, after: int | None, upto: int) -> pd.DataFrame:
        """Starts with the same buckets in their window, as runs from ``first`` to ``last``, with the
        aggregates; of the starts beyond ``after`` up to ``upto``. A window starts to hold a bucket at the
        bucket's number - width + 1 and ends to hold it behind its number."""
        m = held["m"].to_numpy()
        held, m = (held[m - self.width < upto], m[m - self.width < upto]) if len(m) else (held, m)
        names = [*self.key_columns, "nulls", "first", "last", *VALUES, "ts", "cnt"]
        if not len(m):
            return self._no_runs(names)
        key, low = self._numbered(held), m.min() - self.width
        span = m.max() - low + self.width + 2
        place = key * span + (m - low)
        cuts = np.unique(np.r_[place - self.width + 1, place + 1])
        begin, last = cuts[:-1], cuts[1:] - 1
        lo, hi = np.searchsorted(place, begin), np.searchsorted(place, begin + self.width - 1, side="right")
        some = hi > lo
        begin, last, lo, hi = begin[some], last[some], lo[some], hi[some]
        shift = low - key[lo] * span
        first, last = begin + shift, np.minimum(last + shift, upto)
        if after is not None:
            first = np.maximum(first, after + 1)
        some = first <= last
        first, last, lo, size = first[some], last[some], lo[some], (hi - lo)[some]
        if not len(lo):
            return self._no_runs(names)
        at = np.cumsum(size) - size
        inside = held.iloc[np.repeat(lo - at, size) + np.arange(size.sum())]
        return held.iloc[lo].reset_index(drop=True).assign(first=first, last=last, **self._folded(inside, at))[names]

    def _no_runs(self, names: list[str]) -> pd.DataFrame:
        none = self._compact(None)
        return none.assign(first=none["m"], last=none["m"])[names]


def held_runs(buckets: DataFrame, keys: list[str], bucket_us: int, width: int, step: int, groups: int = GROUPS,
              in_time: bool = False) -> DataFrame:
    """Runs (keys, ``_first``, ``_last``, aggregates) of a stream of quotes or partial aggregates ``_m``, ``_vm``,
    ``_bid``, ``_ask``, ``_ts`` (microseconds), ``_cnt``, below a watermark. ``in_time``: they come from an operator that emits a
    bucket once, when the watermark passes its end, so they are never late, though windows may end in the same batch."""
    kinds = [(k, _key_type(buckets.schema[k].dataType)) for k in keys]
    carried = {"date": lambda c: F.unix_date(c).cast("bigint"), "string": lambda c: c}
    columns, nulls = [], F.lit(0).cast("bigint")
    flagged = ["_vm", "_bid", "_ask", *keys]
    for bit, c in enumerate(flagged):
        nulls = nulls + F.when(F.col(c).isNull(), F.lit(1 << bit)).otherwise(F.lit(0))
    for name, kind in kinds:
        value = carried.get(kind, lambda c: c.cast("bigint"))(F.col(name))
        columns.append(F.coalesce(value, F.lit("" if kind == "string" else 0)).alias(f"{name}__{kind}"))
    values = [F.coalesce(F.col(f"_{c}"), F.lit(0.0)).alias(c) for c in VALUES]
    plain = buckets.select(F.pmod(F.xxhash64(*keys), F.lit(groups).cast("bigint")).alias("part"), *columns, nulls.alias("nulls"),
                           F.col("_m").alias("m"), *values, F.col("_ts").alias("ts"), F.col("_cnt").alias("cnt"))
    out = ", ".join([*(f"`{n}__{k}` {_carried(k)}" for n, k in kinds), "nulls bigint", "first bigint", "last bigint",
                     *(f"{c} double" for c in VALUES), "ts bigint", "cnt bigint", "late bigint"])
    runs = plain.groupBy("part").transformWithStateInPandas(HeldWindows(kinds, bucket_us, width, step, in_time), out, "Append", "EventTime")
    runs = runs.observe(LATE, F.sum("late").alias("late")).where("late = 0")
    return runs.select(*_named(kinds), F.col("first").alias("_first"), F.col("last").alias("_last"), *_aggregates())


def _named(kinds: list[tuple[str, str]]) -> list:
    """The keys as they came."""
    out = []
    for k, (name, kind) in enumerate(kinds):
        value = F.col(f"{name}__{kind}")
        value = F.date_from_unix_date(value.cast("int")) if kind == "date" else value.cast(kind)
        out.append(F.when(F.col("nulls").bitwiseAND(F.lit(1 << (len(VALUES) + k))) == 0, value).alias(name))
    return out


def _known(bit: int):
    # Values are filled where null, so what pandas hands back as null was NaN.
    return F.when(F.col("nulls").bitwiseAND(F.lit(1 << bit)) == 0, F.coalesce(F.col(VALUES[bit]), F.lit(float("nan"))))


def _aggregates() -> list:
    return [_known(0).alias("volume_money"), _known(1).alias("bid"), _known(2).alias("ask"),
            F.timestamp_micros("ts").alias("update_ts"), F.col("cnt").cast("bigint").alias("cnt")]


def is_held(spark: SparkSession, checkpoint_dir: str, operator: int) -> bool:
    found = spark.read.format("state-metadata").load(checkpoint_dir).where(F.col("operatorId") == operator).select("operatorName").distinct()
    return any(r[0].startswith("transformWithState") for r in found.collect())


def held_state(spark: SparkSession, checkpoint_dir: str, operator: int) -> DataFrame:
    """The open windows with a quote, as the native operator's state would hold them: key (window and
    keys) and value (sum, max, max, max, count) structs."""
    from ..operators.windows import framed_runs, spread_runs
    rows = spark.read.format("statestore").option("operatorId", str(operator)).option("stateVarName", STATE).load(checkpoint_dir)
    fields = [f.name for f in rows.schema["value"].dataType.fields if f.name not in ("closed", "timer", "frame")]
    kinds = [tuple(f.rsplit("__", 1)) for f in fields[:-len(FIELDS)]]
    frames = [tuple(r[0]) for r in rows.select("value.frame").distinct().collect()] or [(1, 1, 1)]
    (bucket_us, width, step), = frames
    # The generator keeps the arrays of an entry from being copied into every column.
    entries = rows.select(F.col("value.closed").alias("_closed"), F.inline(F.arrays_zip(*[F.col("value").getField(f).alias(f) for f in fields])))
    parts = entries.select("_closed", *_named(kinds), F.col("m").alias("_m"), *[_known(b).alias(f"_{c}") for b, c in enumerate(VALUES)],
                           F.timestamp_micros("ts").alias("_ts"), F.col("cnt").alias("_cnt"))
    names = [n for n, _ in kinds]
    runs = framed_runs(parts, [*names, "_closed"], width, step)
    still = runs.withColumn("_first", F.greatest("_first", F.col("_closed") + 1)).where("_first <= _last")
    wide = spread_runs(still, bucket_us, width, step, "timestamp")
    value = [F.col("volume_money").alias("sum_0"), F.col("bid").alias("max_1"), F.col("ask").alias("max_2"), F.col("update_ts").alias("max_3"),
             F.col("cnt").alias("count_4")]
    window = F.struct(F.col("window_start").alias("start"), F.col("window_end").alias("end"))
    return wide.select(F.struct(window.alias("window"), *names).alias("key"), F.struct(*value).alias("value"))
