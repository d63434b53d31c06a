"""Context-triggered piecewise hashing.

A rolling hash over seven bytes ends a chunk wherever it falls into one of ``b`` classes, so
the places depend on the text near them only. Every chunk gives one of 64 signs; a
fingerprint is ``b:signs:signs at 2b``. ``b`` is the power of two that leaves about 24 to 48
chunks; a chunk that grows to ``2b`` without a boundary ends there, so that a text which
repeats a few words has chunks too. Where that gives more than 64 chunks ``b`` is doubled until it
does not: every chunk has a sign, and a signature at most 64. Two fingerprints compare by edit distance where they share a block size.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .tables import shuffle_partitions, stored, text_of

ROLL = 7
CHUNKS = 48
LONGEST = 2  # blocks in a chunk
MOST_SIGNS = 64
COMMON = 5  # signs in a row that alike signatures share
SIGNS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)


def block_bits(n_bytes: int) -> int:
    bits = 1
    while (CHUNKS << bits) < n_bytes:
        bits += 1
    return bits


def boundaries(ends: np.ndarray, n: int, longest: int) -> np.ndarray:
    """0, the given ends, further ones in every gap longer than ``longest``, and n."""
    edge = np.concatenate(([0], ends[ends < n], [n])).astype(np.int64)
    more = np.maximum(np.diff(edge) - 1, 0) // longest
    if not more.any():
        return edge
    step = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    return np.sort(np.concatenate((edge, np.repeat(edge[:-1], more) + step * longest)))


def _edges(rolling: np.ndarray, n: int, level: int) -> np.ndarray:
    """Chunk edges of a text of ``n`` bytes for blocks of ``1 << level``."""
    if 1 << level > 2 * n + ROLL:  # beyond the text: no boundary but its ends
        return np.array([0, n], np.int64)
    hit = (rolling >> H.U64(64 - level)) == H.U64((1 << level) - 1)
    return boundaries(np.flatnonzero(hit) + ROLL, n, LONGEST << level)


def fingerprints(texts: list[bytes], hasher: H.PrefixHasher) -> list[str]:
    """The fingerprint of every text; equal texts have equal ones."""
    out = []
    for _, part in H.groups(texts):
        data, begins = H.joined(part)
        sums = hasher.prefix(data)
        at = np.arange(len(data) - ROLL + 1) if len(data) >= ROLL else np.zeros(0, np.int64)
        rolling = hasher.span(sums, at, at + ROLL)
        for text, a in zip(part, begins.tolist()):
            n, bits = len(text), block_bits(len(text))
            mine = rolling[a:max(a, a + n - ROLL + 1)]
            edges = [_edges(mine, n, bits), _edges(mine, n, bits + 1)]
            while len(edges[0]) > MOST_SIGNS + 1:
                bits += 1
                edges = [edges[1], _edges(mine, n, bits + 1)]
            signs = []
            for edge in edges:
                edge = edge + a
                signs.append(SIGNS[(hasher.span(sums, edge[:-1], edge[1:]) >> H.U64(58)).astype(np.int64)].tobytes().decode() if n else "")
            out.append(f"{1 << bits}:{signs[0]}:{signs[1]}")
    return out


def common_length(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of ``a`` at once as bits."""
    masks: dict[str, int] = {}
    for k, sign in enumerate(a):
        masks[sign] = masks.get(sign, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for sign in b:
        hit = row & masks.get(sign, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _alike(a: str, b: str) -> float:
    """1 - insertions and deletions / signs of both; 0 without a common run of signs."""
    if not a or not b:
        return 0.0
    k = min(COMMON, len(a), len(b))
    runs = {a[i:i + k] for i in range(len(a) - k + 1)}
    if not any(b[i:i + k] in runs for i in range(len(b) - k + 1)):
        return 0.0
    return 2 * common_length(a, b) / (len(a) + len(b))


def likeness(x: str, y: str) -> float:
    """0 to 1: equal fingerprints 1, without a common block size 0."""
    if x == y:
        return 1.0
    (b, b1, b2), (c, c1, c2) = x.split(":"), y.split(":")
    b, c = int(b), int(c)
    if b == c:
        return max(_alike(b1, c1), _alike(b2, c2))
    return _alike(b1, c2) if b == 2 * c else _alike(b2, c1) if c == 2 * b else 0.0


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
EDGE = ", pid int, head string, tail string"


def edited_text(text: str, following: str) -> str:
    """``text`` with its last half (rounded down) replaced by as many first characters of
    the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _judged(pairs, hasher) -> dict:
    """Result columns of (doc_id, text, following text)."""
    edited = [edited_text(t, f).encode() for _, t, f in pairs]
    own = fingerprints([t.encode() for _, t, _ in pairs], hasher)
    new = fingerprints(edited, hasher)
    after = fingerprints([f.encode() for _, _, f in pairs], hasher)
    return {"doc_id": pa.array([d for d, _, _ in pairs], pa.int64()), "n_chars": pa.array([len(t) for _, t, _ in pairs], pa.int64()),
            "edited_sha256": [hashlib.sha256(e).hexdigest() for e in edited], "fingerprint": own, "edited_fingerprint": new,
            "near_edited": pa.array([likeness(a, b) for a, b in zip(own, new)], pa.float64()),
            "near_next": pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())}


def _ordered_task(batches):
    """Judges every row of a sorted partition by the row after it. The first row's text and
    the last row come out apart, for the neighbouring partitions."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
                        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
                        ("pid", pa.int32()), ("head", pa.string()), ("tail", pa.string())])

    def edge(doc_id, head, tail):
        row = {f.name: [None] for f in schema}
        return pa.RecordBatch.from_pydict(row | {"doc_id": [doc_id], "pid": [TaskContext.get().partitionId()], "head": [head], "tail": [tail]}, schema=schema)

    hasher, last = H.PrefixHasher(), None
    for batch in batches:
        rows = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        if not rows:
            continue
        if last is None:
            yield edge(None, rows[0][1], None)
        rows = ([last] if last else []) + rows
        last = rows[-1]
        pairs = [(d, t, f) for (d, t), (_, f) in zip(rows, rows[1:])]
        if pairs:
            n = len(pairs)
            yield pa.RecordBatch.from_pydict(_judged(pairs, hasher) | {"pid": pa.nulls(n, pa.int32()), "head": pa.nulls(n, pa.string()),
                                                                       "tail": pa.nulls(n, pa.string())}, schema=schema)
    if last:
        yield edge(last[0], None, last[1])


def _edge_task(batches):
    hasher = H.PrefixHasher()
    for batch in batches:
        yield pa.RecordBatch.from_pydict(_judged(list(zip(*[batch.column(k).to_pylist() for k in range(3)])), hasher))


def fingerprint_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next, where the edited text takes its end from the next document.

    Documents go by id, null ids first, equal ids by a hash of the text; the last is followed by the first,
    a lone document by itself. A null text is empty; two empty texts are alike by 1.
    Repeated rows stay repeated; other columns are ignored; an empty table gives an empty
    result. The rows are range-partitioned once; only the first and last row of every
    partition meet the neighbouring one in a second, small step.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(docs, text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    ranged = source.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order, "text")
    rows = stored(ranged.mapInArrow(_ordered_task, RESULT + EDGE), "fingerprints")
    heads = rows.where("head is not null").select("pid", "head")
    every = Window.orderBy("pid")  # one row a partition, numbers only
    follow = heads.select("pid", F.coalesce(F.lead("pid").over(every), F.first("pid").over(every)).alias("after"))
    tails = rows.where("tail is not null").select("pid", "doc_id", "tail").join(follow, "pid")
    edges = tails.join(heads.select(F.col("pid").alias("after"), "head"), "after").select("doc_id", "tail", "head")
    names = [f.split()[0] for f in RESULT.split(", ")]
    return rows.where("pid is null").select(*names).unionByName(edges.mapInArrow(_edge_task, RESULT))
