"""The intraday quote stream.

topic value (JSON) -> typed quotes (bond / tg required) -> watermark on
``update_ts`` -> sliding window aggregate keyed by (window, bond, tg, date)
-> left join with the batch metrics (broadcast when measured small) -> the
enriched columns. Append mode: a window is written once, when its end passes
the watermark; rows arriving behind the watermark are dropped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.jsonq import parse_quote_json
from ..operators.windows import KEYS, SLIDE, WATERMARK, WINDOW, chained_window_agg, enrich_with_metrics, enriched_windows, sliding_window_agg


def kafka_source(spark: SparkSession, servers: str, topic: str,
                 starting_offsets: str = "earliest") -> DataFrame:
    """Kafka topic as a stream of (key, value, timestamp). Needs the Kafka
    connector on the classpath (not present in the test container)."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting_offsets)
            .load()
            .selectExpr("CAST(key AS STRING) AS key", "CAST(value AS STRING) AS value",
                        "timestamp"))


def file_source(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                glob: str | None = None, max_files_per_trigger: int | None = None) -> DataFrame:
    """Files landing in ``path`` as a stream (same contract as the topic once
    mapped to a ``value`` column)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def windowed_quotes(values: DataFrame, watermark: str = WATERMARK, window: str = WINDOW,
                    slide: str = SLIDE, keep_window: bool = True, update_mode: bool = False) -> DataFrame:
    """Topic values -> watermarked sliding-window aggregate, for append mode or, by the native
    operator, ``update_mode``."""
    typed = parse_quote_json(values).withWatermark("update_ts", watermark)
    return sliding_window_agg(typed, window, slide, KEYS, "update_ts",
                              method="plain" if update_mode else None, keep_window=keep_window)


def chained_quotes(values: DataFrame, watermark: str = WATERMARK, window: str = WINDOW, slide: str = SLIDE) -> DataFrame:
    """The windows of ``windowed_quotes`` by two stateful operators in one append query."""
    typed = parse_quote_json(values).withWatermark("update_ts", watermark)
    return chained_window_agg(typed, window, slide, KEYS, "update_ts")


def enriched_quotes(values: DataFrame, metrics: DataFrame, watermark: str = WATERMARK,
                    window: str = WINDOW, slide: str = SLIDE, keep_window: bool = False,
                    broadcast_max_bytes: int | None = None, update_mode: bool = False) -> DataFrame:
    """The full intraday enrichment; ``keep_window=False`` drops the window as
    the original output did (so one key can appear once per window)."""
    if update_mode:
        win = windowed_quotes(values, watermark, window, slide, keep_window=keep_window, update_mode=True)
        return enrich_with_metrics(win, metrics, broadcast_max_bytes)
    typed = parse_quote_json(values).withWatermark("update_ts", watermark)
    return enriched_windows(typed, metrics, window, slide, keep_window, broadcast_max_bytes)


def to_wall_clock(df: DataFrame, cols=("window_start", "window_end", "update_ts")) -> DataFrame:
    """TIMESTAMP -> TIMESTAMP_NTZ (session zone UTC) for zone-free outputs."""
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols if c in df.columns})
