"""Broadcast only behind a measured size bound."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, BooleanType, ByteType, DateType, DecimalType,
                               FloatType, IntegerType, MapType, ShortType, StringType, StructType)

ROW_HEADER = 16


def _width(value: Column, kind) -> Column:
    """Bytes of a value: fixed by its type, or measured for strings and nested values."""
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 8
    if isinstance(kind, (ArrayType, MapType, StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(value.alias("v")))), F.lit(0)) + 8
    if isinstance(kind, (BooleanType, ByteType)):
        return F.lit(1)
    if isinstance(kind, ShortType):
        return F.lit(2)
    if isinstance(kind, (IntegerType, FloatType, DateType)):
        return F.lit(4)
    if isinstance(kind, DecimalType):
        return F.lit(8 if kind.precision <= 18 else 16)
    return F.lit(8)


def measured_bytes(df: DataFrame) -> int:
    """Size of all rows of ``df``, with every string's own length."""
    width = F.lit(ROW_HEADER)
    for field in df.schema.fields:
        width = width + _width(F.col(f"`{field.name}`"), field.dataType)
    return df.agg(F.coalesce(F.sum(width), F.lit(0))).first()[0]


def broadcast_limit(df: DataFrame) -> int:
    raw = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = raw.strip().lower()
    for suffix, mult in (("gb", 1 << 30), ("g", 1 << 30), ("mb", 1 << 20), ("m", 1 << 20),
                         ("kb", 1 << 10), ("k", 1 << 10), ("b", 1)):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * mult)
    return int(raw)


def broadcast_if_small(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``(broadcast(df), True)`` when the measured size fits ``max_bytes``
    (default: the session's auto-broadcast threshold), else ``(df.hint("merge"),
    False)``: a sort-merge join that neither the planner nor AQE turns into a
    broadcast on an estimate. Measuring runs ``df`` once; call it on a table or
    a cheap plan."""
    limit = broadcast_limit(df) if max_bytes is None else max_bytes
    if limit is not None and limit >= 0 and measured_bytes(df) <= limit:
        return F.broadcast(df), True
    return df.hint("merge"), False
