"""Metric sinks and their readers.

Files: ``overwrite`` replaces the directory (no shell ``rm``). One output file
is an option, not the default: it funnels every row through one task.
JDBC: overwrite with ``truncate`` keeps the table definition; far dates can be
replaced by the sentinel for targets whose TIMESTAMP ends in 2038; reads are
split into parallel range queries on a numeric column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.sentinel import apply_far_date_sentinel
from ..schemas import METRICS

# DDL column types for the metrics table (nullable, unlike the original DDL:
# usd_volume and the median can be null).
METRICS_JDBC_TYPES = ("id BIGINT, isin VARCHAR(64), date_of_end_placing TIMESTAMP, "
                      "maturity_date TIMESTAMP, usd_volume DOUBLE, "
                      "bid_ask_spread_relative_median DOUBLE, bid_ask_spread_relative_rank DOUBLE")


def _maybe_single(df: DataFrame, single_file: bool) -> DataFrame:
    # repartition(1), not coalesce(1): the upstream stages keep their parallelism.
    return df.repartition(1) if single_file else df


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
                  partition_by: list[str] | None = None) -> str:
    w = _maybe_single(df, single_file).write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False,
              header: bool = True) -> str:
    _maybe_single(df, single_file).write.mode(mode).option("header", header).csv(path)
    return path


ANCHOR = "anchor_date"


def write_metrics_day(df: DataFrame, path: str, anchor: str) -> str:
    """The metrics of one day as the partition ``anchor_date=<yyyyMMdd>`` of the table at ``path``. A day
    that is written again replaces its own partition and no other; a day without rows changes
    nothing."""
    if not (len(anchor) == 8 and anchor.isdecimal()):
        raise ValueError(f"an anchor is yyyyMMdd, got {anchor!r}")
    (df.withColumn(ANCHOR, F.lit(anchor)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(ANCHOR).parquet(path))
    return path


def read_metrics_days(spark: SparkSession, path: str) -> DataFrame:
    """All days of the table; the anchor stays text (inferred it would be a number)."""
    return spark.read.schema(StructType([*METRICS.fields, StructField(ANCHOR, StringType())])).parquet(path)


def read_newest_metrics(spark: SparkSession, path: str, upto: str | None = None) -> DataFrame:
    """The newest day of the table, or the newest at or before ``upto``. The day is a scalar subquery
    over the partition column alone, so the scan is pruned to one partition when it starts."""
    days = read_metrics_days(spark, path)
    wanted = days if upto is None else days.where(F.col(ANCHOR) <= upto)
    return spark.sql(f"SELECT * FROM {{days}} WHERE {ANCHOR} = (SELECT max({ANCHOR}) FROM {{wanted}})", days=days, wanted=wanted)


def read_metrics_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_metrics_csv(spark: SparkSession, path: str) -> DataFrame:
    """Metrics CSV directory with the declared schema (no type drift from inference)."""
    return spark.read.schema(METRICS).option("header", True).csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, properties: dict, mode: str = "overwrite",
               column_types: str | None = METRICS_JDBC_TYPES, far_date_sentinel: bool = True,
               num_partitions: int | None = None, batch_size: int = 10_000) -> None:
    """Replace (or append to) a JDBC table. ``num_partitions`` caps concurrent
    connections; the writer batches inserts per task."""
    out = apply_far_date_sentinel(df) if far_date_sentinel else df
    w = out.write.mode(mode).option("batchsize", str(batch_size))
    if mode == "overwrite":
        w = w.option("truncate", "true")
    if column_types:
        w = w.option("createTableColumnTypes", column_types)
    if num_partitions:
        w = w.option("numPartitions", str(num_partitions))
    w.jdbc(url, table, properties=properties)


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str, lower: int, upper: int, num_partitions: int) -> DataFrame:
    """Read a JDBC table as ``num_partitions`` range queries on a numeric column.
    The bounds are required: without them the whole table goes through one task."""
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                           upperBound=upper, numPartitions=num_partitions, properties=properties)


def console(stream: DataFrame, checkpoint_dir: str, num_rows: int = 20, truncate: bool = False):
    """Debug sink for a stream (append mode)."""
    return (stream.writeStream.format("console").outputMode("append")
            .option("checkpointLocation", checkpoint_dir)
            .option("numRows", str(num_rows)).option("truncate", str(truncate).lower())
            .start())


def write_kafka(events: DataFrame, servers: str, topic: str) -> None:
    """Publish quote events as JSON values without a key (batch). Needs the
    Kafka connector on the classpath (absent in the test container)."""
    from ..functions.jsonq import quote_events_to_json
    (quote_events_to_json(events).write.format("kafka")
     .option("kafka.bootstrap.servers", servers).option("topic", topic).save())


def stream_to_kafka(events: DataFrame, servers: str, topic: str, checkpoint_dir: str):
    """Streaming twin of ``write_kafka`` (append, checkpointed)."""
    from ..functions.jsonq import quote_events_to_json
    return (quote_events_to_json(events).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint_dir).outputMode("append").start())
