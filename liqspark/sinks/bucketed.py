"""Tables bucketed by their join key, so that two large sides meet without a shuffle.

Both sides are written once in the same number of buckets; every later join reads bucket with
bucket. A key that holds much of one side (a bond with a third of the quotes) would be one
bucket, read by one task; ``salts`` spreads each key over that many, and the other side, of
one row a key, is written once a salt.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

SALT = "_salt"


@dataclass(frozen=True)
class Bucketed:
    """Where a table lies and how it is bucketed: all that a later session needs to read it."""

    path: str
    schema: StructType
    key: str
    buckets: int
    salts: int

    def read(self, spark: SparkSession) -> DataFrame:
        """The table with its buckets known to the planner. The entry in the session's catalog is
        there only while the plan is made; the files stay."""
        name = f"bucketed_{uuid.uuid4().hex[:12]}"
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{self.key}`, {SALT}) "
                  f"SORTED BY (`{self.key}`, {SALT}) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")
        try:
            return spark.table(name)
        finally:
            spark.sql(f"DROP TABLE {name}")


def _write(df: DataFrame, path: str, key: str, buckets: int, salts: int) -> Bucketed:
    spark, name = df.sparkSession, f"bucketed_{uuid.uuid4().hex[:12]}"
    # Hashed as buckets are: one file a bucket, not one a task and bucket.
    placed = df.repartition(buckets, F.col(key), F.col(SALT))
    placed.write.bucketBy(buckets, key, SALT).sortBy(key, SALT).format("parquet").option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    return Bucketed(path, StructType([StructField(f.name, f.dataType) for f in df.schema.fields]), key, buckets, salts)


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, salts: int = 1) -> Bucketed:
    """The side with many rows a key. Rows of a key are dealt over the salts by a hash of the whole row;
    equal rows stay together. ``path`` must be new."""
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts)).cast(IntegerType())
    return _write(df.withColumn(SALT, salt), path, key, buckets, salts)


def write_bucketed_lookup(df: DataFrame, path: str, key: str, buckets: int, salts: int = 1) -> Bucketed:
    """The side with few rows a key: each is written once for every salt."""
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    return _write(df.withColumn(SALT, salt), path, key, buckets, salts)


def join_bucketed(spark: SparkSession, left: Bucketed, right: Bucketed, how: str = "inner") -> DataFrame:
    """``left`` (many rows a key) joined with the lookup ``right`` on their keys, bucket by bucket: a
    sort-merge join without an exchange. Null keys match nothing. Columns of both sides but the salt;
    their names must differ, but for a key of the same name, which is the left's."""
    if (left.buckets, left.salts) != (right.buckets, right.salts):
        raise ValueError(f"{left.buckets} buckets of {left.salts} salts can't meet {right.buckets} of {right.salts}")
    a, b = left.read(spark), right.read(spark).hint("merge")
    joined = a.join(b, (a[left.key] == b[right.key]) & (a[SALT] == b[SALT]), how)
    joined = joined.drop(a[SALT]).drop(b[SALT])
    return joined.drop(b[right.key]) if left.key == right.key else joined
