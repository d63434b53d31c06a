"""Running totals that no single task has to hold: per key and slot, then carried over."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def join_same(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner", on=None) -> DataFrame:
    """Equi-join on ``keys`` that matches nulls too, and ``on`` if given; the keys are the left's."""
    other = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    equal = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    joined = left.join(other, equal if on is None else equal & on, how)
    return joined.drop(*[f"_right_{k}" for k in keys])


def running_total(df: DataFrame, keys: list[str], slot: str, order: list, value: str, out: str) -> DataFrame:
    """Adds ``out``, the sum of ``value`` over the rows of the same ``keys`` up to and with
    this one, by ``slot`` and then ``order``. ``slot`` rises with the order and splits a key
    that holds many rows; only one row a slot is looked at beyond it. Keys and slots must not
    be null, so that the rows stay where the window has put them. ``df`` is read twice."""
    sums = df.groupBy(*keys, slot).agg(F.sum(value).alias("_sum"))
    earlier = Window.partitionBy(*keys).orderBy(slot).rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select(*keys, slot, F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy(*keys, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumn(out, F.sum(value).over(inside))
    joined = local.join(before, [*keys, slot])
    return joined.select(*df.columns, (F.col(out) + F.col("_before")).alias(out))
