"""Reading the corpus tables and keeping intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import prepare, remove_scratch, scratch_dir

BATCH_ROWS = 500  # texts that a Python task holds at a time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the corpus tables; the path is read by Spark only, so any store works."""
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read again: lineage is
    cut in storage that outlives any executor."""
    return Scratch().table(df, name)


class Scratch:
    """Stored tables that an operator needs only until its result is stored itself."""

    def __init__(self):
        self.held = []

    def table(self, df: DataFrame, name: str) -> DataFrame:
        spark = df.sparkSession
        path = scratch_dir(spark, f"llm-{name}")
        df.write.parquet(path)
        self.held.append((spark, path))
        return spark.read.schema(df.schema).parquet(path)

    def clear(self) -> None:
        """Delete the tables; call it when no result is still to be read from them."""
        for spark, path in self.held:
            remove_scratch(spark, path)
        self.held = []


def text_of(df: DataFrame, text_col: str = "text"):
    """The text column with null read as the empty string."""
    return F.coalesce(F.col(text_col), F.lit(""))


def whole_row(df: DataFrame):
    """All columns as one struct ``carried``: whatever they are called, they clash with no column of an operator."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("carried")


def fresh_names(df: DataFrame, *names: str) -> list[str]:
    """``names``, each made longer until no column of ``df`` is called so. A row that keeps its own columns beside
    such helpers costs the optimizer less than a struct whose fields a hash of the whole row refers to."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken or f"_right_{name}".lower() in taken:
            name += "_"
        out.append(name)
    return out


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
