"""Prefix trie of conversations, its subtree totals by time-forward processing.

1. Turns are numbered by one global sort (conversation, turn, role, text), so a long conversation is
   many tasks' work. The key of a prefix is the sum of a 96-bit hash of every turn with
   its place: equal for equal sequences, and a running total needs no turn's text.
2. A node is a distinct prefix: one aggregation of the turns by key, combined before it is shuffled.
   A node's load is the number of turns at or below it over all its members.
3. A subtree of a load of at most ``SHARD`` whose parent has more is kept together; a shard is the
   partition that holds a number of them. Its nodes are sorted in reverse level order by Spark's external sort. One pass over
   them sends every node's totals to its parent through a priority queue ordered as the nodes
   are, which spills to disk: a node finds its children's messages at the queue's head.
4. The totals of the shards' roots go on to the nodes above them, level by level in reverse, a
   small aggregation each. There are as many such levels as the longest path of nodes with a
   load above ``SHARD``.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ranking import global_row_number
from .running import running_total
from .tables import Scratch

FAMILY = 20  # conversations c - c % FAMILY lend their first turns
LENT = 4  # unsigned crc32 of the decimal id, modulo this, is the number of turns lent
WORD = r"[^\x20\x09-\x0D]+"
SHARD = 512  # load of a subtree that stays together
SLOT = 1024  # turns of a conversation, or ids of members, that one row or task step gathers
SALTS = 32
QUEUE = 100_000  # messages of a queue that are held in memory

KEY = "decimal(38,0)"
TOTALS = "n_children bigint, n_leaves bigint, saved_tokens bigint"


class SpillingQueue:
    """A priority queue of picklable tuples: the smallest first. More than ``most`` of them go
    to disk as a sorted run, of which only the head stays in memory."""

    def __init__(self, most: int = QUEUE):
        self.most, self.heap, self.runs = most, [], []

    def push(self, item: tuple) -> None:
        if len(self.heap) >= self.most:
            run = tempfile.TemporaryFile()
            for x in sorted(self.heap):
                pickle.dump(x, run)
            run.seek(0)
            self.heap = []
            self._advance(run)
        heapq.heappush(self.heap, item)

    def _advance(self, run) -> None:
        try:
            heapq.heappush(self.runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def head(self):
        """The smallest item, or None."""
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            return self.runs[0][0]
        return self.heap[0] if self.heap else None

    def pop(self) -> tuple:
        if self.runs and (not self.heap or self.runs[0][0] < self.heap[0]):
            item, _, run = heapq.heappop(self.runs)
            self._advance(run)
            return item
        return heapq.heappop(self.heap)


def _forward_task(most: int):
    """Nodes in reverse level order (depth, key, parent, is_root, n_convs, words) with their totals."""
    def run(batches):
        queue = SpillingQueue(most)
        for batch in batches:
            found = []
            for depth, key, parent, is_root, n, words in zip(*[batch.column(k).to_pylist() for k in range(6)]):
                children = leaves = saved = 0
                while (head := queue.head()) and head[:2] == (-depth, key):
                    _, _, more, less = queue.pop()
                    children, leaves, saved = children + 1, leaves + more, saved + less
                leaves, saved = leaves or 1, saved + (n - 1) * words
                if not is_root:
                    queue.push((1 - depth, parent, leaves, saved))
                found.append((key, children, leaves, saved))
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.decimal128(38, 0)), *[
                pa.array([f[k] for f in found], pa.int64()) for k in (1, 2, 3)]], names=["key", "n_children", "n_leaves", "saved_tokens"])

    return run


def _ends_task(batches):
    """SHA-256 of the ids of every key, from pieces in order."""
    key, state = None, None
    for batch in batches:
        done = []
        for k, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if k != key:
                if state is not None:
                    done.append((key, state.hexdigest()))
                key, state = k, hashlib.sha256(piece.encode())
            else:
                state.update(b"," + piece.encode())
        yield _ends(done)
    if state is not None:
        yield _ends([(key, state.hexdigest())])


def _ends(rows) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.decimal128(38, 0)), pa.array([r[1] for r in rows], pa.string())],
                                      names=["key", "ends_sha256"])


def rebuilt_turns(turns: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv_id, depth, role, text) of every turn, and (conv_id, length)
    of every conversation, turnless ones too."""
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")).where("conv_id is not null")
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    numbered = scratch.table(global_row_number(rows, order, "n").drop("turn"), "turns")
    lent = F.crc32(F.col("conv_id").cast("string").cast("binary")) % LENT
    convs = numbered.groupBy("conv_id").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("own"))
    convs = scratch.table(convs.withColumns({"h": lent, "base": F.col("conv_id") - F.col("conv_id") % FAMILY}), "conversations")
    sizes = convs.select(F.col("conv_id").alias("base"), F.col("own").alias("base_own"))
    convs = convs.join(sizes, "base", "left").withColumn("got", F.least("h", F.coalesce("base_own", F.lit(0))))
    own = numbered.join(convs, "conv_id").withColumn("place", F.col("n") - F.col("first") + 1)
    mine = own.where("place > h").select("conv_id", (F.col("got") + F.col("place") - F.col("h")).alias("depth"), "role", "text")
    heads = own.where(f"conv_id % {FAMILY} = 0 and place < {LENT}").select(F.col("conv_id").alias("base"), F.col("place").alias("depth"), "role", "text")
    borrowed = convs.select("conv_id", "base", "h").join(heads, "base").where("depth <= h").select("conv_id", "depth", "role", "text")
    lengths = convs.select("conv_id", (F.col("got") + F.greatest(F.lit(0), F.col("own") - F.col("h"))).alias("length"))
    return mine.union(borrowed), lengths


def _turn_value():
    """A 96-bit hash of a turn and its place."""
    mark = F.md5(F.concat_ws(":", F.col("depth").cast("string"), F.length("role").cast("string"), "role", "text"))
    half = lambda at: F.conv(F.substring(mark, at, 12), 16, 10).cast("decimal(20,0)")
    return (half(1) * F.lit(Decimal(1 << 48)) + half(13)).cast("decimal(30,0)")


def conversation_trie(turns: DataFrame, shard: int = SHARD, queue: int = QUEUE) -> DataFrame:
    """One row per node of the trie of the rebuilt conversations: conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by turn, null first, equal ones by role and text; a null role or text is empty;
    repeated rows are repeated turns. Rows without a conv_id belong to no conversation and are left out.
    Other columns are ignored; an empty table has no root and gives an empty result. A node's own share of
    saved_tokens counts its text for every member but one.
    """
    spark, scratch = turns.sparkSession, Scratch()
    rows, lengths = rebuilt_turns(turns, scratch)
    lengths = scratch.table(lengths, "lengths")
    hashed = scratch.table(rows.select("conv_id", "depth", F.regexp_count("text", F.lit(WORD)).cast("bigint").alias("words"), _turn_value().alias("value"),
                                       F.expr(f"depth div {SLOT}").alias("slot")), "hashed")
    keyed = running_total(hashed, ["conv_id"], "slot", [F.col("depth")], "value", "key").join(lengths, "conv_id")
    keyed = scratch.table(keyed.select("conv_id", "depth", "words", "length", F.col("key").cast(KEY).alias("key"),
                                       (F.col("key") - F.col("value")).cast(KEY).alias("parent")), "keyed")

    # Nodes: the root and all distinct prefixes.
    load = F.col("length") - F.col("depth") + 1
    nodes = keyed.groupBy("key").agg(F.min("depth").alias("depth"), F.min("parent").alias("parent"), F.min("conv_id").alias("conv_id"),
                                     F.count(F.lit(1)).alias("n_convs"), F.min("words").alias("words"), F.sum(load).alias("load"))
    root = lengths.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.sum("length").alias("load")).where("n_convs > 0")
    root = root.select(F.lit(0).cast(KEY).alias("key"), F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast(KEY).alias("parent"), "conv_id", "n_convs",
                       F.lit(0).cast("bigint").alias("words"), "load")
    nodes = scratch.table(nodes.select(*root.columns).union(root).withColumn("above", (F.col("load") > shard) | (F.col("depth") == 0)), "nodes")

    # Shards: the highest prefix of a conversation that isn't above them names its subtree.
    above = nodes.where("above and depth > 0").select("key", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(1).alias("known"))
    salted = keyed.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    below = salted.join(above, ["key", "salt"], "left_anti")
    tops = below.groupBy("conv_id").agg(F.min_by("key", "depth").alias("top"))
    light = scratch.table(nodes.where("not above").join(tops, "conv_id").select("key", "depth", "parent", "n_convs", "words", "top"), "light")
    order = [F.col("depth").desc(), F.col("key")]
    dealt = light.repartition("top").sortWithinPartitions(*order)
    within = dealt.select("depth", "key", "parent", (F.col("key") == F.col("top")).alias("is_root"), "n_convs", "words")
    done = scratch.table(within.mapInArrow(_forward_task(queue), f"key {KEY}, {TOTALS}"), "totals")

    # Across shard roots: the nodes above, from the deepest level to the root.
    roots = light.where("key = top").select("key", "parent", "depth").join(done, "key")
    mail = scratch.table(roots.select(F.col("parent").alias("key"), (F.col("depth") - 1).alias("depth"), "n_leaves", "saved_tokens"), "mail")
    high = nodes.where("above").select("key", "depth", "parent", "n_convs", "words")
    deepest = high.agg(F.max("depth")).first()[0]
    levels = []
    for depth in range(-1 if deepest is None else deepest, -1, -1):
        got = mail.where(F.col("depth") == depth)
        if levels:
            last = levels[-1]
            got = got.union(last.select(F.col("parent").alias("key"), F.lit(depth).cast("bigint").alias("depth"), "n_leaves", "saved_tokens"))
        got = got.groupBy("key").agg(F.count(F.lit(1)).alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved"))
        level = high.where(F.col("depth") == depth).join(got, "key", "left")
        levels.append(scratch.table(level.select(
            "key", "parent", F.coalesce("n_children", F.lit(0)).alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"),
            (F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens")), "level"))
    for level in levels:
        done = done.union(level.drop("parent"))

    # Members that end at a node, in pieces of at most 2 * SLOT ids.
    ends = keyed.where("depth = length").select("key", "conv_id").union(lengths.where("length = 0").select(F.lit(0).cast(KEY).alias("key"), "conv_id"))
    pieces = ends.groupBy("key", F.expr(f"conv_id div {SLOT}").alias("slot")).agg(
        F.array_join(F.array_sort(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))
    hashes = (pieces.repartition("key").sortWithinPartitions("key", "slot").select("key", "ids")
              .mapInArrow(_ends_task, f"key {KEY}, ends_sha256 string"))

    # A parent above the shards may have any number of children, so it meets them in parts.
    names = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"), "above")
    child = nodes.where("depth > 0").select("key", "parent", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int").alias("salt"))
    few = child.join(names.where("not above").drop("above"), "parent").select("key", "parent_conv_id")
    many = names.where("above").drop("above").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    parents = few.union(child.join(many, ["parent", "salt"]).select("key", "parent_conv_id"))
    none = hashlib.sha256(b"").hexdigest()
    return (nodes.select("key", "conv_id", "depth", "n_convs").join(done, "key").join(parents, "key", "left").join(hashes, "key", "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(none)).alias("ends_sha256")))
