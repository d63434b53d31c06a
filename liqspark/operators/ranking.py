"""Global row_number without a single-partition window.

``row_number() OVER (ORDER BY ...)`` with no PARTITION BY moves every row into
one task. Here the rows are range-partitioned on the sort key instead, sorted
inside each partition, and numbered locally; each partition then adds the
number of rows in all partitions before it:

1. ``repartitionByRange(key)`` + ``sortWithinPartitions(key)`` (without an
   explicit count AQE sizes the partitions; coalesced neighbours of a range
   partitioning are still contiguous ranges, so the order holds);
2. ``monotonically_increasing_id`` = partition id << 33 | position, taken in
   sorted order, so it carries both the partition and the local position;
3. reliable ``checkpoint()``: range bounds come from sampling, so the tagged
   rows are pinned in the shared checkpoint folder before they are read twice
   (an executor loss cannot re-draw the bounds between the two reads);
4. count per partition (one row per partition), cumulative offsets over those
   few rows, broadcast back (its size is bounded by ``n``, not by the data).

Ties must be broken by the caller (include a unique column in ``order``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def global_row_number(df: DataFrame, order: Sequence[Column], out_col: str = "rn",
                      total_col: str | None = None, num_partitions: int | None = None) -> DataFrame:
    """Add ``out_col`` = 1-based position of each row in ``order`` (and optionally
    ``total_col`` = number of rows), computed across many tasks.
    ``num_partitions`` fixes the range partition count (default: AQE decides)."""
    checkpoint_root(df.sparkSession)
    if num_partitions:
        ranged = df.repartitionByRange(num_partitions, *order)
    else:
        ranged = df.repartitionByRange(*order)
    ordered = ranged.sortWithinPartitions(*order)
    tagged = ordered.withColumn("_rid", F.monotonically_increasing_id()).checkpoint(eager=True)
    tagged = tagged.select(
        "*",
        F.shiftright(F.col("_rid"), _POS_BITS).alias("_pid"),
        F.col("_rid").bitwiseAND(F.lit(_POS_MASK)).alias("_pos"),
    )
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("__off"),
        F.sum("_n").over(Window.partitionBy()).alias("__total"),
    )
    out = tagged.join(F.broadcast(offsets), "_pid", "inner")
    out = out.withColumn(out_col, F.col("__off") + F.col("_pos") + F.lit(1))
    if total_col:
        out = out.withColumn(total_col, F.col("__total"))
    return out.drop("_rid", "_pid", "_pos", "__off", "__total")
