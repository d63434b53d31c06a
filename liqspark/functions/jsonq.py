"""Quote events as JSON payloads (the topic's ``value``) and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import QUOTE_EVENT, QUOTE_EVENT_FIELDS


def quote_events_to_json(df: DataFrame, value_col: str = "value") -> DataFrame:
    """One JSON object per event, all fields as strings, no key (the producer's payload).

    ``to_json`` skips null fields, like a producer that omits absent values.
    """
    fields = [F.col(f).cast("string").alias(f) for f in QUOTE_EVENT_FIELDS]
    return df.select(F.to_json(F.struct(*fields)).alias(value_col))


def parse_quote_json(df: DataFrame, value_col: str = "value", keep_raw: bool = False) -> DataFrame:
    """Topic value -> typed quote rows.

    Binary/str value -> ``from_json`` with the all-string event schema (a non-JSON
    value gives an all-null row) -> ``try_cast`` of each field (a bad value gives
    null) -> rows without ``bond`` or ``tg`` are dropped.
    """
    value: Column = F.col(value_col).cast("string")
    # The struct goes through a generator (``inline`` of a one-element array):
    # a filter on generated columns is not pushed below the generator, so the
    # payload is parsed once. With a plain projection Catalyst copies the parse
    # into the pushed-down null filter and every payload is parsed twice
    # (measured: 2.2x slower on 1M payloads).
    parsed = F.inline(F.array(F.from_json(value, QUOTE_EVENT)))
    flat = df.select(parsed, *([value.alias("raw_value")] if keep_raw else []))
    typed = flat.select(
        F.col("bond").try_cast("bigint").alias("bond"),
        F.col("tg").try_cast("bigint").alias("tg"),
        F.col("volume_money").try_cast("double").alias("volume_money"),
        F.col("bid").try_cast("double").alias("bid"),
        F.col("ask").try_cast("double").alias("ask"),
        F.col("overturn").try_cast("double").alias("overturn"),
        F.col("date").try_cast("date").alias("date"),
        F.col("update_ts").try_cast("timestamp").alias("update_ts"),
        *(["raw_value"] if keep_raw else []),
    )
    return typed.where(F.col("bond").isNotNull() & F.col("tg").isNotNull())
