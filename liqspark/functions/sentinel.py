"""Far-date sentinel for sinks whose TIMESTAMP type ends in 2038.

Dates after the cut-off are replaced by a fixed sentinel; null stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, TimestampNTZType

# Fixed values of the original sink: cut-off and replacement.
FAR_DATE_CUTOFF = "2037-12-30 00:00:00"
FAR_DATE_REPLACEMENT = "1970-01-01 04:00:01"


def far_date_sentinel(col: Column | str, ts_type: DataType = TimestampNTZType(),
                      cutoff: str = FAR_DATE_CUTOFF,
                      replacement: str = FAR_DATE_REPLACEMENT) -> Column:
    """``replacement`` where ``col > cutoff``, else ``col`` (typed literals, not strings)."""
    col = F.col(col) if isinstance(col, str) else col
    cut = F.lit(cutoff).cast(ts_type)
    rep = F.lit(replacement).cast(ts_type)
    return F.when(col > cut, rep).otherwise(col)


def apply_far_date_sentinel(df: DataFrame, columns=("maturity_date", "date_of_end_placing"),
                            cutoff: str = FAR_DATE_CUTOFF,
                            replacement: str = FAR_DATE_REPLACEMENT) -> DataFrame:
    """Apply the sentinel to ``columns`` of ``df``, keeping each column's type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({
        c: far_date_sentinel(c, types[c], cutoff, replacement) for c in columns if c in types
    })
