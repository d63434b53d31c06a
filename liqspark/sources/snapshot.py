"""Landed REST snapshots -> one quote event per item.

A snapshot is one JSON document ``{"count": n, "items": [{...}, ...], ...}``.
Items are parsed as maps so a *missing* key (filled with its default) stays
distinct from a key holding JSON null (kept null). A non-object item is
skipped; a snapshot whose ``items`` is not a list, or without ``count``,
yields nothing. Pages are bounded by the service's page limit, so ``explode``
never builds an unbounded row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, MapType, StringType, StructField, StructType

from ..schemas import QUOTE_EVENT_FIELDS

ENVELOPE = StructType([
    StructField("count", LongType(), True),
    StructField("items", ArrayType(StringType()), True),
])
ITEM = MapType(StringType(), StringType())

# Fixed values of the original producer: event field <- service field, default
# when the key is missing.
FIELD_MAP = {
    "id": ("id", "0"),
    "bond": ("emission_id", "0"),
    "bid": ("buying_quote", "0"),
    "ask": ("selling_quote", "0"),
    "tg": ("trading_ground_id", "0"),
    "date": ("date", "1970-01-01"),
    "update_ts": ("update_time", "1970-01-01T00:00:00"),
    "volume": ("volume", "0"),
    "volume_money": ("volume_money", "0"),
    "overturn": ("overturn", "0"),
}


def read_snapshots(spark: SparkSession, path: str, fmt: str = "lines") -> DataFrame:
    """Snapshot documents -> ``value`` column: ``lines`` holds one document per
    line, ``documents`` one per file (a response as it came, whatever its line
    breaks)."""
    if fmt not in ("lines", "documents"):
        raise ValueError(f"snapshot format must be lines or documents, got {fmt!r}")
    return spark.read.text(path, wholetext=fmt == "documents")


def snapshot_stream(spark: SparkSession, path: str, fmt: str = "documents", max_files_per_trigger: int | None = None) -> DataFrame:
    """Snapshots landing in ``path`` as a stream of ``value``; formats as in ``read_snapshots``."""
    if fmt not in ("lines", "documents"):
        raise ValueError(f"snapshot format must be lines or documents, got {fmt!r}")
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.text(path, wholetext=fmt == "documents")


def published_once(events: DataFrame, delay: str = "120 minutes") -> DataFrame:
    """A stream of quote events without the copies that later polls repeat: one event per
    (id, update_ts), so an update of a quote stays. ``delay`` is how long a quote is repeated by later polls;
    the state forgets it after that, and events older than the watermark are dropped (they have been
    seen, or came too late). Adds ``event_time``, the watermark's column; an event without a
    readable ``update_ts`` has no time to be told apart by and is dropped."""
    timed = events.withColumn("event_time", F.col("update_ts").try_cast("timestamp")).where("event_time is not null")
    return timed.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["id", "update_ts"])


def snapshot_rejects(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """The documents that ``snapshot_explode`` takes nothing from though they are
    not empty snapshots: no JSON object, no ``count``, or ``items`` not a list."""
    env = F.from_json(F.col(value_col), ENVELOPE)
    return docs.where(env.isNull() | env["count"].isNull() | env["items"].isNull())


def snapshot_explode(docs: DataFrame, value_col: str = "value") -> DataFrame:
    """Snapshot documents -> quote events (all fields strings, producer names)."""
    # Parses happen inside generators, so the null filters after them are not
    # pushed below (and copied into) the parse: each document and item is parsed once.
    env = docs.select(F.inline(F.array(F.from_json(F.col(value_col), ENVELOPE))))
    env = env.where(F.col("count").isNotNull())
    texts = env.select(F.explode("items").alias("item_text"))
    items = texts.select(F.inline(F.array(F.struct(F.from_json("item_text", ITEM).alias("item")))))
    items = items.where(F.col("item").isNotNull())
    m = F.col("item")
    cols = []
    for out in QUOTE_EVENT_FIELDS:
        src, default = FIELD_MAP[out]
        cols.append(F.when(F.map_contains_key(m, F.lit(src)), m[src])
                    .otherwise(F.lit(default)).alias(out))
    return items.select(*cols)
