"""Streaming upsert: keep the newest row per key in a partitioned table, safe against a crash at any point.

Layout of the table's folder::

    data/<version>-<id>/_partition=<value>/   files of the partitions that one commit has rewritten
    _versions/<version>.json                  which folder holds each partition as of that commit

The file of the highest version is the pointer that readers follow. Each micro-batch (``foreachBatch``):

1. reduce the batch to its newest row per key (an aggregate, skew-safe);
2. read the present folders of the partitions that the batch touches (a null value is a partition like any other);
3. newest row per key over (old rows of those partitions) + (batch rows), written to a fresh folder:
   nothing that a reader or a replay needs is overwritten;
4. switch: the next version's file is written aside and renamed. Without it the fresh folder is no
   part of the table, so a batch is in the table whole or not at all.

A replay after a failure merges the same rows again: the newest row per key of rows already
merged is the same table. Two writers can't both commit one version; the second fails and is
replayed by its stream. ``vacuum`` deletes the folders of older versions. Where the target is an
RDBMS, the same reduced batch goes to a staging table and one set-based MERGE; that variant needs a
database and is not run here.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import latest_quote
from ..session import list_folder, move_file, path_exists, read_small_file, remove_path, write_small_file

PARTITION = "_partition"


def _root(target: str) -> str:
    return target.rstrip("/")


def _versions(spark: SparkSession, target: str) -> list[int]:
    folder = f"{_root(target)}/_versions"
    names = list_folder(spark, folder) if path_exists(spark, folder) else []
    return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json") and n[0] != ".")


def _manifest(spark: SparkSession, target: str, version: int) -> dict[str, str]:
    """Partition folder name -> folder relative to the table."""
    return json.loads(read_small_file(spark, f"{_root(target)}/_versions/{version:012d}.json"))


def current_version(spark: SparkSession, target: str) -> int | None:
    """The version that readers see; None where there is no table yet."""
    found = _versions(spark, target)
    return found[-1] if found else None


def _folder_name(value) -> str:
    return f"{PARTITION}=" + ("__HIVE_DEFAULT_PARTITION__" if value is None else value)


def read_upserted(spark: SparkSession, target: str, schema=None, partitions: Sequence | None = None,
                  version: int | None = None) -> DataFrame:
    """The table as of ``version`` (default: the current one), one consistent state whatever is being
    written meanwhile. ``partitions`` reads only the folders of those partition values (as text, None for null)."""
    version = current_version(spark, target) if version is None else version
    if version is None:
        raise FileNotFoundError(f"no upserted table in {target}")
    held = _manifest(spark, target, version)
    wanted = held if partitions is None else {_folder_name(p) for p in partitions} & held.keys()
    folders = [f"{_root(target)}/{held[p]}" for p in sorted(wanted)]
    reader = spark.read.option("recursiveFileLookup", True)
    if schema is not None:
        reader = reader.schema(schema)
    if not folders:
        if schema is None:
            raise FileNotFoundError(f"no such partitions in {target}")
        return spark.createDataFrame([], schema)
    return reader.parquet(*folders)


def _switch(spark: SparkSession, target: str, version: int, manifest: dict[str, str]) -> None:
    """Make ``manifest`` the current version: one rename, which fails if the version exists."""
    folder = f"{_root(target)}/_versions"
    aside = f"{folder}/.{uuid.uuid4().hex}"
    write_small_file(spark, aside, json.dumps(manifest, sort_keys=True))
    if not move_file(spark, aside, f"{folder}/{version:012d}.json"):
        remove_path(spark, aside)
        raise RuntimeError(f"version {version} of {target} has been written by another writer")


def upsert_latest(batch: DataFrame, target: str, keys: Sequence[str] = ("bond", "tg", "date"),
                  ts_col: str = "update_ts", partition_col: str = "date") -> None:
    """Merge a batch into the table. The touched partition values (one small row each) come to the driver."""
    spark = batch.sparkSession
    newest = latest_quote(batch, keys, ts_col)
    version = current_version(spark, target)
    held = _manifest(spark, target, version) if version is not None else {}
    touched = [r[0] for r in newest.select(F.col(partition_col).cast("string")).distinct().collect()]
    if not touched and version is not None:
        return
    merged = newest
    if any(_folder_name(p) in held for p in touched):
        old = read_upserted(spark, target, newest.schema, touched, version)
        merged = latest_quote(old.unionByName(newest), keys, ts_col).select(*newest.columns)
    number = (version or 0) + 1
    fresh = f"data/{number:012d}-{uuid.uuid4().hex[:12]}"
    merged.withColumn(PARTITION, F.col(partition_col).cast("string")).write.partitionBy(PARTITION).parquet(f"{_root(target)}/{fresh}")
    # The writer escapes characters in folder names, so the names are taken from the folder.
    written = {n: f"{fresh}/{n}" for n in list_folder(spark, f"{_root(target)}/{fresh}") if n.startswith(f"{PARTITION}=")}
    _switch(spark, target, number, {**held, **written})


def vacuum(spark: SparkSession, target: str, keep: int = 1) -> int:
    """Delete data folders and version files that the last ``keep`` versions don't use, those of failed
    commits too; returns how many folders. Run it while no batch is being written and no older version is being read."""
    versions = _versions(spark, target)
    kept = versions[-max(keep, 1):]
    used = {f.split("/")[1] for v in kept for f in _manifest(spark, target, v).values()}
    stale = [n for n in list_folder(spark, f"{_root(target)}/data") if n not in used]
    for v in versions[:-max(keep, 1)]:
        remove_path(spark, f"{_root(target)}/_versions/{v:012d}.json")
    for n in stale:
        remove_path(spark, f"{_root(target)}/data/{n}")
    return len(stale)


def upsert_writer(target: str, keys: Sequence[str] = ("bond", "tg", "date"),
                  ts_col: str = "update_ts", partition_col: str = "date"):
    """A ``foreachBatch`` function bound to ``target``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        # The batch plan is read more than once; persist it for this batch only.
        batch.persist()
        try:
            upsert_latest(batch, target, keys, ts_col, partition_col)
        finally:
            batch.unpersist()
    return write
