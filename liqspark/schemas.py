"""Table schemas and strict-schema enforcement.

Raw inputs are read with all-string schemas and typed with ``try_cast``, so a
bad value becomes null instead of poisoning an inferred column type. The
``non-null`` contract of a typed table is then enforced in one of three modes:

* ``"drop"``: rows that break it are filtered out;
* ``"assert"``: the job fails on the first such row (``assert_true``);
* ``"quarantine"``: rows are kept and tagged; ``split_quarantine`` gives the
  good and the rejected rows.

No RDD round trip, so predicates and column pruning still reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, DoubleType, LongType, StringType, StructField,
                               StructType, TimestampNTZType, TimestampType)


def _all_strings(names: list[str]) -> StructType:
    return StructType([StructField(n, StringType(), True) for n in names])


# Raw CSV layouts (header row; extra columns in a file are ignored by name).
RAW_EXCHANGE = _all_strings(["bond", "tg", "date", "bid", "ask"])
RAW_OTC = _all_strings(["bond", "org", "date", "quote_type", "price"])
RAW_BONDS = _all_strings(["id", "isin_code", "date_of_end_placing", "maturity_date", "usd_volume"])

# Typed tables. Quote dates are wall-clock values without a zone: TIMESTAMP_NTZ.
EXCHANGE = StructType([
    StructField("bond", LongType(), False),
    StructField("tg", LongType(), False),
    StructField("date", TimestampNTZType(), False),
    StructField("bid", DoubleType(), False),
    StructField("ask", DoubleType(), False),
])
OTC_KEYS = StructType([
    StructField("bond", LongType(), False),
    StructField("org", LongType(), False),
    StructField("date", TimestampNTZType(), False),
])
OTC_PAIRED = StructType([
    StructField("bond", LongType(), False),
    StructField("org", LongType(), False),
    StructField("date", TimestampNTZType(), False),
    StructField("bid", DoubleType(), False),
    StructField("ask", DoubleType(), False),
])
BONDS = StructType([
    StructField("id", LongType(), False),
    StructField("isin", StringType(), False),
    StructField("date_of_end_placing", TimestampNTZType(), True),
    StructField("maturity_date", TimestampNTZType(), True),
    StructField("usd_volume", DoubleType(), True),
])
METRICS = StructType([
    StructField("id", LongType(), True),
    StructField("isin", StringType(), True),
    StructField("date_of_end_placing", TimestampNTZType(), True),
    StructField("maturity_date", TimestampNTZType(), True),
    StructField("usd_volume", DoubleType(), True),
    StructField("bid_ask_spread_relative_median", DoubleType(), True),
    StructField("bid_ask_spread_relative_rank", DoubleType(), True),
])

# Quote event as it travels on the topic: every field a string.
QUOTE_EVENT_FIELDS = ["id", "bond", "bid", "ask", "tg", "date", "update_ts",
                      "volume", "volume_money", "overturn"]
QUOTE_EVENT = _all_strings(QUOTE_EVENT_FIELDS)

# Quote event after typing (update_ts is the event-time column of the stream).
TYPED_QUOTE = StructType([
    StructField("bond", LongType(), True),
    StructField("tg", LongType(), True),
    StructField("volume_money", DoubleType(), True),
    StructField("bid", DoubleType(), True),
    StructField("ask", DoubleType(), True),
    StructField("overturn", DoubleType(), True),
    StructField("date", DateType(), True),
    StructField("update_ts", TimestampType(), True),
])

REJECT_COL = "_rejected_fields"

MODES = ("drop", "assert", "quarantine")


def typed_select(df: DataFrame, schema: StructType, renames: dict[str, str] | None = None) -> DataFrame:
    """Project ``df`` onto ``schema`` with ``try_cast`` (bad values become null).

    ``renames`` maps target name -> source column name.
    """
    renames = renames or {}
    cols = []
    for field in schema.fields:
        src = df[renames.get(field.name, field.name)]
        cols.append(src.try_cast(field.dataType).alias(field.name))
    return df.select(*cols)


def _violations(schema: StructType) -> Column:
    """array<string> of the non-nullable fields that are null in a row."""
    checks = [F.when(F.col(f.name).isNull(), F.lit(f.name)) for f in schema.fields if not f.nullable]
    if not checks:
        return F.array().cast("array<string>")
    return F.filter(F.array(*checks), lambda x: x.isNotNull())


def _observed(df: DataFrame, schema: StructType, observation: Observation) -> DataFrame:
    required = [f.name for f in schema.fields if not f.nullable]
    broken = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"bad_{c}") for c in required]
    bad_rows = F.count(F.when(F.size(_violations(schema)) > 0, 1))
    return df.observe(observation, F.count(F.lit(1)).alias("rows"), bad_rows.alias("rejected"), *broken)


def rejects(observation: Observation) -> dict[str, int]:
    """What an observation given to ``enforce_schema`` has counted: ``rows`` and ``rejected`` rows, and
    ``bad_<field>`` for every non-nullable field (a row that breaks two counts in both). Waits for the
    first action over the frame. Rows of map tasks run again after a lost executor count again: a
    figure to watch a feed by; the rows themselves are those of ``quarantine``."""
    return dict(observation.get)


def enforce_schema(df: DataFrame, schema: StructType, mode: str = "drop", observation: Observation | None = None) -> DataFrame:
    """Enforce the non-null contract of ``schema`` on an already typed ``df``. An ``observation`` counts
    the rejects on the way, in whatever job reads the rows: no scan of its own (see ``rejects``)."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    if observation is not None:
        df = _observed(df, schema, observation)
    required = [F.col(f.name).isNotNull() for f in schema.fields if not f.nullable]
    if not required:
        return df.withColumn(REJECT_COL, _violations(schema)) if mode == "quarantine" else df
    ok = required[0]
    for cond in required[1:]:
        ok = ok & cond
    if mode == "drop":
        return df.where(ok)
    if mode == "assert":
        msg = "strict schema violated: a non-nullable field is null (bad value or failed cast)"
        # assert_true yields null when the check passes; the filter keeps it in the
        # plan. No second `where(ok)`: null checks inferred from it would be pushed
        # below the assert and remove the bad rows before it could fire.
        return df.where(F.assert_true(ok, msg).isNull())
    return df.withColumn(REJECT_COL, _violations(schema))


def split_quarantine(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the tag column, rejected rows with it).

    Both come from the same plan; write ``tagged`` once (e.g. partitioned by
    ``size(_rejected_fields) > 0``) when both sides are needed at scale.
    """
    bad = F.size(F.col(REJECT_COL)) > 0
    return tagged.where(~bad).drop(REJECT_COL), tagged.where(bad)
