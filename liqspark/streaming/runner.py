"""Start, bound and stop streaming queries.

Production runs use a processing-time trigger and ``awaitAnyTermination``;
tests and the registered queries use ``availableNow`` (process what is there,
then stop) and always stop the query.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from pyspark.sql.streaming import StreamingQuery

from .held_windows import LATE, held_state, is_held


@contextmanager
def _shuffle_partitions(spark, n: int | None):
    # A stream fixes its state partition count at its first run, from this
    # setting; the query clones the session conf when it starts, so setting it
    # around start() only affects this query.
    if not n:
        yield
        return
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def start(stream: DataFrame, out_dir: str | None, checkpoint_dir: str, fmt: str = "parquet",
          output_mode: str = "append", processing_time: str | None = None,
          available_now: bool = False, options: dict | None = None,
          query_name: str | None = None, foreach_batch=None,
          state_partitions: int | None = None) -> StreamingQuery:
    """Start a query. ``state_partitions`` chooses the number of state (and
    shuffle) partitions of a new checkpoint; size it for the state at scale,
    it cannot change later."""
    with _shuffle_partitions(stream.sparkSession, state_partitions):
        return _start(stream, out_dir, checkpoint_dir, fmt, output_mode, processing_time,
                      available_now, options, query_name, foreach_batch)


def _start(stream, out_dir, checkpoint_dir, fmt, output_mode, processing_time, available_now,
           options, query_name, foreach_batch) -> StreamingQuery:
    w = stream.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint_dir)
    if query_name:
        w = w.queryName(query_name)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    if foreach_batch is not None:
        return w.foreachBatch(foreach_batch).start()
    w = w.format(fmt)
    return w.start(out_dir) if out_dir else w.start()


def run_available_now(stream: DataFrame, out_dir: str | None, checkpoint_dir: str,
                      fmt: str = "parquet", output_mode: str = "append", timeout_s: float | None = None,
                      foreach_batch=None, options: dict | None = None,
                      state_partitions: int | None = None) -> StreamingQuery:
    """Process all available input, wait (without a limit unless ``timeout_s`` is given), stop;
    raise on failure."""
    q = start(stream, out_dir, checkpoint_dir, fmt, output_mode, available_now=True,
              foreach_batch=foreach_batch, options=options, state_partitions=state_partitions)
    try:
        done = q.awaitTermination(timeout_s) if timeout_s is not None else q.awaitTermination()
        if done is False:
            raise TimeoutError(f"streaming query did not finish in {timeout_s}s")
        err = q.exception()
        if err is not None:
            raise RuntimeError(f"streaming query failed: {err}")
    finally:
        q.stop()
    return q


def dropped_by_watermark(query: StreamingQuery) -> int:
    """State rows (of windows: distinct window and key, a batch each) that a query has dropped because they
    came behind the watermark, over the micro-batches it still reports
    (``spark.sql.streaming.numRecentProgressUpdates``, 100 by default; more are an error, not a smaller count)."""
    reports = query.recentProgress
    if reports and reports[0].batchId > 0 and len(reports) >= _reports_kept(query):
        raise RuntimeError("more micro-batches than the session keeps progress reports of")
    held = sum((r.observedMetrics[LATE]["late"] or 0) for r in reports if LATE in r.observedMetrics)
    return held + sum(op.numRowsDroppedByWatermark for r in reports for op in r.stateOperators)


def _reports_kept(query: StreamingQuery) -> int:
    from pyspark.sql import SparkSession
    return int(SparkSession.active().conf.get("spark.sql.streaming.numRecentProgressUpdates", "100"))


def state_rows(spark, checkpoint_dir: str, operator: int = 0) -> DataFrame:
    """The state of a stopped query's stateful operator as of its last batch: key and value structs. An
    aggregation's value holds the buffers in the order of its aggregates; their fields are numbered
    (``max_2``) because several may bear one name. Windows that are held as buckets come out as windows, in the
    same form."""
    if is_held(spark, checkpoint_dir, operator):
        return held_state(spark, checkpoint_dir, operator)
    rows = spark.read.format("statestore").option("operatorId", str(operator)).load(checkpoint_dir)
    fields = rows.schema["value"].dataType.fields
    numbered = StructType([StructField(f"{f.name}_{k}", f.dataType) for k, f in enumerate(fields)])
    return rows.select("key", F.col("value").cast(numbered).alias("value"))
