"""Bond quote liquidity analytics on Spark.

Batch: clean exchange / OTC quotes, relative bid-ask spreads, two-level
medians, a distributed global rank, a join with the bond list.
Streaming: JSON quote events, watermarked sliding windows, a size-checked
broadcast join with the batch metrics, file / JDBC / upsert sinks.

Everything is DataFrame / SQL / Structured Streaming; see README.md.
"""

__all__ = ["session", "schemas"]
