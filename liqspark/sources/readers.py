"""CSV scans of the three daily inputs, with all-string reader schemas.

No ``inferSchema``: inference costs a full extra pass per file and lets one
bad value change a column's type. Values are typed later with ``try_cast``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..schemas import RAW_BONDS, RAW_EXCHANGE, RAW_OTC

# Stands for a missing value inside the CSV parser; with its default, the empty string, a quoted one is null too.
NO_VALUE = "\u0000"


def read_csv(spark: SparkSession, path: str, schema: StructType,
             min_partitions: int | None = None) -> DataFrame:
    """Header CSV -> the schema's columns, picked by header name (files may carry
    more columns, in any order). Without inference every column is a string,
    which is what the all-string raw schemas expect. Nothing between two commas is null, a quoted empty
    string is a value (and a bad one where a number is due), as ``write_csv`` writes them.

    Files are split by ``spark.sql.files.maxPartitionBytes``; only a caller who
    knows of one large unsplittable file (gzip) asks for ``min_partitions``,
    which shuffles the whole scan."""
    raw = spark.read.option("header", True).option("inferSchema", False).option("nullValue", NO_VALUE).csv(path)
    picked = raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
    return picked.repartition(min_partitions) if min_partitions else picked


def read_exchange_quotes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_EXCHANGE)


def read_otc_quotes(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_OTC)


def read_bond_list(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, RAW_BONDS)


def read_parquet_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
