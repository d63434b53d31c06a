"""Session defaults and shared-storage locations.

Scratch and checkpoint data always live under the folder the cluster names in
``spark.checkpoint.dir``. Where that is unset a local session gets a fresh
temporary folder; a cluster session is refused, since its executors share no
local disk.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings the library relies on. Session-level SQL confs only, so they can be
# applied to a session someone else built.
SQL_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Window state grows with the data: keep it off the JVM heap (RocksDB) and
    # checkpoint only the per-batch changes. Fixed for a checkpoint at its first run.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # A micro-batch lists its landed files in one task a file (up to 10,000 tasks, all scheduled by the
    # driver); a task may take many.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "96",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "liqspark", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults; UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = (builder.config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true"))
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_DEFAULTS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    prepare(spark)
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the SQL defaults and make sure a checkpoint folder exists."""
    for key, value in SQL_DEFAULTS.items():
        spark.conf.set(key, value)
    checkpoint_root(spark)
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a local one only if none is configured."""
    sc = spark.sparkContext
    configured = sc.getCheckpointDir()
    if configured:
        return configured
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {sc.master} share")
        conf_dir = tempfile.mkdtemp(prefix="liqspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the file system that Spark reads ``path`` with holds it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def _located(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_folder(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds."""
    fs, target = _located(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(target)]


def write_small_file(spark: SparkSession, path: str, text: str) -> None:
    """A new file of a few kilobytes; an existing one is an error."""
    fs, target = _located(spark, path)
    out = fs.create(target, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def read_small_file(spark: SparkSession, path: str) -> str:
    fs, target = _located(spark, path)
    data = fs.open(target)
    try:
        return bytes(data.readAllBytes()).decode()
    finally:
        data.close()


def move_file(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file; False if there is one of that name already."""
    fs, target = _located(spark, path)
    return not path_exists(spark, to) and fs.rename(target, spark._jvm.org.apache.hadoop.fs.Path(to))


def remove_path(spark: SparkSession, path: str) -> None:
    fs, target = _located(spark, path)
    fs.delete(target, True)


def remove_scratch(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_dir`` named; anything else is refused."""
    root = spark._jvm.org.apache.hadoop.fs.Path(checkpoint_root(spark))
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.makeQualified(target.getParent()).toString() != fs.makeQualified(root).toString():
        raise ValueError(f"{path} is not a scratch folder")
    fs.delete(target, True)

