"""Approximate nearest neighbours by multiprobe p-stable hashing.

1. Largest inner product becomes smallest distance: with M the largest norm, a row x is the unit
   vector (x / M, sqrt(1 - |x|^2 / M^2)) and a query q is (q / |q|, 0).
2. Every table has ``projections`` Gaussian directions a and offsets b; a row's bucket is the
   cells floor((a x + b) / w) together. Every row is in every table.
3. A neighbour at distance r has its projections at a normal distance of deviation r from the
   query's, so each cell along each direction has a chance, and a bucket the product of them.
   A query visits the buckets of a table in falling chance (its own first) until the chances
   add up to the table's part of ``target``: with t tables 1 - (1 - target)^(1/t). r is the
   median distance of the k-th neighbour of ``SAMPLE`` queries, found exactly (a bounded sample
   against all rows); w is ``WIDTH`` r.
4. Rows and probes of a bucket meet in blocks of about ``BLOCK`` x ``BLOCK``, so a bucket that
   holds most rows, or that most queries visit, is many tasks' work. A task passes on the best k
   of each query only; merged over all tables they are ranked by their exact inner products.
5. A query that has met fewer than k rows is compared with all rows, in the same blocks.

Nothing depends on the table's size but the number of rows in a bucket.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .tables import Scratch

NEAREST = 20
TABLES = 8
PROJECTIONS = 8
WIDTH = 2.2  # cell width, in distances of the k-th neighbour
TARGET = 0.95
SAMPLE = 64
BLOCK = 4096
SEED = 20240
HELD = 1 << 18  # found rows that a task holds before it keeps the best k of each query
NEVER = 1e-7  # cells of a smaller chance are not visited

FOUND = "query_id bigint, vec_id bigint, score double"
PLACED = "kind int, tab int, bucket bigint, vec_id bigint, embedding array<double>"


class Tables:
    """The hash tables: directions and offsets follow from the seed."""

    def __init__(self, dim: int, largest: float, radius: float, tables: int, projections: int, width: float, target: float):
        rng = np.random.default_rng(SEED)
        self.largest, self.radius = largest, max(radius, 1e-6)
        self.width = width * self.radius
        self.a = rng.normal(size=(tables, dim + 1, projections))
        self.b = rng.uniform(0, self.width, size=(tables, projections))
        self.mix = rng.integers(1, 1 << 62, size=projections, dtype=np.int64) | 1
        self.each = 1 - (1 - target) ** (1 / tables)

    def bucket(self, cells: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return H.mix((cells.astype(np.int64) * self.mix).sum(axis=-1).view(np.uint64)).view(np.int64)

    def rows(self, x: np.ndarray) -> np.ndarray:
        """Buckets (rows x tables) of the rows of the index."""
        unit = x / self.largest
        rest = np.sqrt(np.maximum(0.0, 1 - (unit * unit).sum(axis=1)))
        return self._buckets(np.column_stack([unit, rest]))

    def _buckets(self, unit: np.ndarray) -> np.ndarray:
        return np.stack([self.bucket(np.floor((unit @ a + b) / self.width)) for a, b in zip(self.a, self.b)], axis=1)

    def probes(self, q: np.ndarray):
        """(table, bucket) in the order of a query's visits."""
        unit = np.append(q / np.linalg.norm(q), 0.0)
        for t, (a, b) in enumerate(zip(self.a, self.b)):
            at = unit @ a + b
            cells = [c for c, _ in visits(at, self.width, self.radius, self.each)]
            for bucket in self.bucket(np.array(cells)).tolist():
                yield t, bucket


def _normal(x: float) -> float:
    return 0.5 * (1 + math.erf(x / math.sqrt(2)))


def visits(at: np.ndarray, width: float, radius: float, target: float):
    """(cells, chance) of the buckets that hold a neighbour, in falling chance, until the
    chances add up to ``target``; the query's own bucket first. ``at`` are the query's
    projections with their offsets."""
    best, steps, home = [], [], []
    for d, x in enumerate(at.tolist()):
        own, reach = math.floor(x / width), int(6 * radius / width) + 1
        cells = [(_normal(((c + 1) * width - x) / radius) - _normal((c * width - x) / radius), c) for c in range(own - reach, own + reach + 1)]
        cells.sort(reverse=True)
        home.append(own)
        best.append(cells[0][1])
        steps += [(math.log(cells[0][0] / p), d, c) for p, c in cells[1:] if p > NEVER]
    steps.sort()
    top = 1.0
    for d, x in enumerate(at.tolist()):
        top *= _normal(((best[d] + 1) * width - x) / radius) - _normal((best[d] * width - x) / radius)
    first = tuple(home)
    yield first, 0.0
    total, queue = 0.0, [(0.0, ())]
    while queue and total < target:
        cost, chosen = heapq.heappop(queue)
        dims = [steps[j][1] for j in chosen]
        if len(set(dims)) == len(dims):
            cells = list(best)
            for j in chosen:
                cells[steps[j][1]] = steps[j][2]
            chance = top * math.exp(-cost)
            total += chance
            if tuple(cells) != first:
                yield tuple(cells), chance
        last = chosen[-1] if chosen else -1
        if last + 1 < len(steps):  # one more step, or the last step for the next dearer one
            heapq.heappush(queue, (cost + steps[last + 1][0], (*chosen, last + 1)))
            if chosen:
                heapq.heappush(queue, (cost - steps[last][0] + steps[last + 1][0], (*chosen[:-1], last + 1)))


def _matrix(column, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)


def _lists(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), pa.array(x.reshape(-1)))


def _index_task(tables: Tables, dim: int):
    """A row for every row and table: its bucket."""
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                x, ids, n = _matrix(batch.column(1), dim), batch.column(0), batch.num_rows
                buckets = tables.rows(x)
                for t in range(buckets.shape[1]):
                    yield pa.RecordBatch.from_arrays([pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, t, np.int32)), pa.array(buckets[:, t]),
                                                      ids, _lists(x)], names=["kind", "tab", "bucket", "vec_id", "embedding"])

    return run


def _probe_task(tables: Tables, dim: int):
    """A row for every bucket that a query visits."""
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            for vec_id, q in zip(batch.column(0).to_pylist(), _matrix(batch.column(1), dim)):
                where = list(tables.probes(q))
                n = len(where)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.ones(n, np.int32)), pa.array([t for t, _ in where], pa.int32()), pa.array([b for _, b in where], pa.int64()),
                    pa.array(np.full(n, vec_id, np.int64)), _lists(np.tile(q, (n, 1)))], names=["kind", "tab", "bucket", "vec_id", "embedding"])

    return run


def inner_products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products row by row, added up in the order of the components: the same pair has
    the same one wherever it is worked out."""
    total = np.zeros(len(q))
    for d in range(q.shape[1]):
        total += q[:, d] * x[:, d]
    return total


class Best:
    """The best k rows of every query that a task has met."""

    def __init__(self, k: int):
        self.k, self.number, self.bar = k, {}, np.zeros(0)
        self.rows, self.held = [], 0

    def numbers(self, ids) -> np.ndarray:
        out = np.array([self.number.setdefault(i, len(self.number)) for i in ids], np.int64)
        if len(self.number) > len(self.bar):
            self.bar = np.concatenate([self.bar, np.full(len(self.number) + 1024 - len(self.bar), -np.inf)])
        return out

    def meet(self, ids: np.ndarray, q: np.ndarray, own: np.ndarray, x: np.ndarray) -> None:
        """Queries ``q`` against rows ``x``; a row is no neighbour of itself."""
        who = self.numbers(ids.tolist())
        rough = q @ x.T
        slack = 1e-9 * np.linalg.norm(q, axis=1) * np.sqrt((x * x).sum(axis=1).max())
        bar = self.bar[who]
        if x.shape[0] > self.k + 1:  # one place more: the query itself may be among them
            bar = np.maximum(bar, np.partition(rough, -self.k - 1, axis=1)[:, -self.k - 1])
        a, b = np.nonzero(rough >= (bar - slack)[:, None])
        keep = ids[a] != own[b]
        a, b = a[keep], b[keep]
        for at in range(0, len(a), HELD):
            i, j = a[at:at + HELD], b[at:at + HELD]
            self.rows.append((who[i], ids[i], own[j], inner_products(q[i], x[j])))
            self.held += len(i)
            if self.held >= HELD:
                self.reduce()

    def reduce(self) -> None:
        if not self.rows:
            return
        who, ids, own, score = (np.concatenate(c) for c in zip(*self.rows))
        order = np.lexsort((own, -score, who))
        who, ids, own, score = who[order], ids[order], own[order], score[order]
        fresh = np.ones(len(who), bool)
        fresh[1:] = (who[1:] != who[:-1]) | (own[1:] != own[:-1]) | (score[1:] != score[:-1])
        who, ids, own, score = who[fresh], ids[fresh], own[fresh], score[fresh]
        start = np.searchsorted(who, who)
        place = np.arange(len(who)) - start
        keep = place < self.k
        last = place == self.k - 1
        self.bar[who[last]] = score[last]
        self.rows, self.held = [(who[keep], ids[keep], own[keep], score[keep])], 0

    def result(self):
        self.reduce()
        for _, ids, own, score in self.rows:
            yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(own), pa.array(score)], names=["query_id", "vec_id", "score"])
        self.rows, self.number, self.bar = [], {}, np.zeros(0)


def _meet_task(k: int, dim: int, most: int = 8 * HELD):
    """Rows sorted by block, in each the rows of the index before the queries."""
    def run(batches):
        best, block, index, number = Best(k), None, [], []
        x = own = None
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in range(5)], axis=1)  # tab, bucket, two parts, kind
            cut = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            ids, vectors = batch.column(5).to_numpy(), _matrix(batch.column(6), dim)
            for a, b in zip(np.append(0, cut), np.append(cut, len(keys))):
                key = tuple(keys[a, :4])
                if key != block:
                    block, index, number, x = key, [], [], None
                if keys[a, 4] == 0:
                    index.append(vectors[a:b])
                    number.append(ids[a:b])
                    continue
                if not index:
                    continue
                if x is None:
                    x, own = np.concatenate(index), np.concatenate(number)
                for i in range(a, b, 256):
                    best.meet(ids[i:min(b, i + 256)], vectors[i:min(b, i + 256)], own, x)
            if len(best.number) * k > most:  # many queries: hand over what there is
                yield from best.result()
        yield from best.result()

    return run


def _met(placed: DataFrame, k: int, dim: int) -> DataFrame:
    """(query_id, vec_id, score) of the best k rows a query finds in each task, from rows
    (kind, tab, bucket, vec_id, embedding, parts of the bucket's rows, parts of its queries)."""
    part = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n))
    every = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    own = F.col("kind") == 0
    dealt = (placed.withColumn("x", F.explode(F.when(own, F.array(part("row_parts"))).otherwise(every("row_parts"))))
             .withColumn("y", F.explode(F.when(own, every("query_parts")).otherwise(F.array(part("query_parts"))))))
    block = ["tab", "bucket", "x", "y"]
    return (dealt.repartition(*block).sortWithinPartitions(*block, "kind").select(*block, "kind", "vec_id", "embedding")
            .mapInArrow(_meet_task(k, dim), FOUND))


def _sized(placed: DataFrame) -> DataFrame:
    """Buckets that hold rows and are visited, with the parts they are dealt in."""
    return (placed.groupBy("tab", "bucket").agg(F.count_if(F.col("kind") == 0).alias("rows"), F.count_if(F.col("kind") == 1).alias("queries"))
            .where("rows > 0 and queries > 0")
            .select("tab", "bucket", F.expr(f"1 + rows div {BLOCK}").alias("row_parts"), F.expr(f"1 + queries div {BLOCK}").alias("query_parts")))


def _top(found: DataFrame, k: int) -> DataFrame:
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _against_all(queries: DataFrame, rows: DataFrame, n_queries: int, n_rows: int, k: int, dim: int) -> DataFrame:
    """Exact neighbours: every query against every row, in blocks."""
    both = rows.select(F.lit(0).alias("kind"), "vec_id", "embedding").union(queries.select(F.lit(1).alias("kind"), "vec_id", "embedding"))
    return _met(both.select("kind", F.lit(0).alias("tab"), F.lit(0).cast("bigint").alias("bucket"), "vec_id", "embedding",
                            F.lit(1 + n_rows // BLOCK).cast("bigint").alias("row_parts"), F.lit(1 + n_queries // BLOCK).cast("bigint").alias("query_parts")), k, dim)


def usable_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, embedding) in double precision, one row an id (the smallest vector of rows that share
    it). Left out: null ids, null, empty or zero vectors, null or non-finite components."""
    e = F.col(vector_col).cast("array<double>")
    rows = table.select(F.col(id_col).cast("bigint").alias("vec_id"), e.alias("embedding")).where("vec_id is not null and size(embedding) > 0")
    bad = F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    rows = rows.where(~bad & F.exists("embedding", lambda v: v != 0))
    return rows.groupBy("vec_id").agg(F.min("embedding").alias("embedding"))


def nearest_neighbours(table: DataFrame, is_query="vec_id % 20 = 0", k: int = NEAREST, id_col: str = "vec_id", vector_col: str = "embedding",
                       tables: int = TABLES, projections: int = PROJECTIONS, width: float = WIDTH, target: float = TARGET) -> DataFrame:
    """The k rows of the largest inner product found for each query (rows of ``is_query``, a
    condition on vec_id): query_id, rank, vec_id, score.

    A row is no candidate for the query of its own id; of rows that share an id one counts. Ties
    go to the smaller id. Vectors null, empty, zero or with null or non-finite components take no part,
    nor do those of another length than most have (of equally many, the longer). Fewer than
    k candidates are all returned. Other columns are ignored; an empty table gives an empty result.
    """
    spark, scratch = table.sparkSession, Scratch()
    rows = scratch.table(usable_vectors(table, id_col, vector_col), "vectors")
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))
    shape = rows.groupBy(F.size("embedding").alias("dim")).agg(F.count(F.lit(1)).alias("n"), F.max(norm).alias("largest"))
    shape = shape.orderBy(F.desc("n"), F.desc("dim")).first()
    if shape is None:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    dim, n = shape["dim"], shape["n"]
    rows = rows.where(F.size("embedding") == dim)
    queries = rows.where(is_query)

    # The distance of the k-th neighbour, from a sample of at most SAMPLE queries.
    some = queries.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE)
    near = _top(_against_all(some, rows, SAMPLE, n, k, dim), k).groupBy("query_id").agg(F.min("score").alias("score"))
    spread = near.join(some.select(F.col("vec_id").alias("query_id"), norm.alias("norm")), "query_id").select(
        F.sqrt(F.greatest(F.lit(0.0), 2 - 2 * F.col("score") / (F.col("norm") * shape["largest"]))).alias("r"))
    radius = spread.agg(F.percentile("r", 0.5)).first()[0] or 1.0

    family = Tables(dim, shape["largest"], radius, tables, projections, width, target)
    index = rows.select("vec_id", "embedding").mapInArrow(_index_task(family, dim), PLACED)
    probes = queries.select("vec_id", "embedding").mapInArrow(_probe_task(family, dim), PLACED)
    placed = scratch.table(index.union(probes), "buckets")
    found = scratch.table(_met(placed.join(_sized(placed), ["tab", "bucket"]), k, dim), "found")
    top = _top(found, k)

    # Queries that met too few rows see them all.
    enough = top.groupBy("query_id").count().where(F.col("count") >= min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
    rest = scratch.table(queries.join(enough, "vec_id", "left_anti"), "rest")
    left = rest.count()
    if left:
        found = found.union(scratch.table(_against_all(rest, rows, left, n, k, dim), "rest-found"))
    return _top(found, k).select("query_id", "rank", "vec_id", "score")
