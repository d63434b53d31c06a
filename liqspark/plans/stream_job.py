"""Intraday stream job: quote topic -> windows -> enrichment -> sink.

    python -m liqspark.plans.stream_job --metrics DIR --output DIR \
        (--kafka-servers HOST:PORT --topic T | --landing-dir DIR) \
        [--metrics-format parquet|csv] [--format parquet|delta] [--upsert-table DIR] [--trigger "1 minute"]

The static side (the batch metrics) is read once when the query starts and
broadcast only if its measured size fits the broadcast threshold. The
checkpoint lives under the output folder, so a new output (a new day) never
resumes another output's offsets and state. The upsert table takes windows as
they change (update mode), so it holds the newest quote without waiting for the
watermark; the file sink takes closed windows (append mode).
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..schemas import METRICS
from ..sinks.upsert import upsert_writer
from ..streaming import quotes, runner


def read_metrics(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Metrics copy in the declared schema: ``parquet`` or header ``csv``. A copy
    that can't be read fails the job."""
    if fmt not in ("parquet", "csv"):
        raise ValueError(f"metrics format must be parquet or csv, got {fmt!r}")
    reader = spark.read.schema(METRICS)
    return reader.parquet(path) if fmt == "parquet" else reader.option("header", True).csv(path)


def start(spark: SparkSession, values: DataFrame, metrics_path: str, output: str,
          fmt: str = "parquet", trigger: str | None = "1 minute", upsert_table: str | None = None,
          available_now: bool = False, state_partitions: int | None = None,
          metrics_format: str = "parquet") -> StreamingQuery:
    metrics = read_metrics(spark, metrics_path, metrics_format)
    stream = quotes.enriched_quotes(values, metrics, keep_window=False, update_mode=bool(upsert_table))
    if upsert_table:
        return runner.start(stream, None, f"{upsert_table.rstrip('/')}/_checkpoint",
                            processing_time=trigger, available_now=available_now,
                            foreach_batch=upsert_writer(upsert_table), output_mode="update",
                            state_partitions=state_partitions)
    return runner.start(stream, output, f"{output.rstrip('/')}/_checkpoint", fmt=fmt,
                        processing_time=trigger, available_now=available_now,
                        state_partitions=state_partitions)


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    ap.add_argument("--metrics", required=True)
    ap.add_argument("--metrics-format", default="parquet", choices=["parquet", "csv"])
    ap.add_argument("--output", required=True)
    ap.add_argument("--kafka-servers")
    ap.add_argument("--topic")
    ap.add_argument("--landing-dir", help="folder of JSON-lines quote events (one event per line)")
    ap.add_argument("--format", default="parquet")
    ap.add_argument("--trigger", default="1 minute")
    ap.add_argument("--available-now", action="store_true")
    ap.add_argument("--upsert-table")
    ap.add_argument("--state-partitions", type=int,
                    help="state partitions of a new checkpoint (fixed afterwards)")
    args = ap.parse_args(argv)

    from ..session import build_session
    spark = build_session(app_name="liqspark-stream")
    if args.kafka_servers:
        values = quotes.kafka_source(spark, args.kafka_servers, args.topic)
    else:
        values = spark.readStream.format("text").load(args.landing_dir)
    q = start(spark, values, args.metrics, args.output, args.format, args.trigger,
              args.upsert_table, args.available_now, args.state_partitions, args.metrics_format)
    spark.streams.awaitAnyTermination()
    if q.exception():
        raise RuntimeError(str(q.exception()))


if __name__ == "__main__":
    main()
