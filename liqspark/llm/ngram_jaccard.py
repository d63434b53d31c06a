"""N-gram Jaccard join with adaptive multi-match prefixes.

Every text is the set of its distinct five-word shingles (A-Z lower-cased, words split at
ASCII white space). Two texts link when ``100 * |A & B| >= 75 * |A | B|``; the result gives
each document the smallest document of its component.

1. Equal sets are one class; everything after works on classes.
2. A count sketch of fixed size (``2 ** sketch_bits`` counters, summed over all documents)
   estimates how common each shingle is. All sets are ordered by (estimate, shingle), rare
   first.
3. Two linked sets of a and b shingles share at least ``o = ceil(3 (a + b) / 7)``. So for
   any l their prefixes of ``a - o + l`` and ``b - o + l`` shingles share at least l. A set
   of n emits ``n - ceil(3 n / 4) + l`` shingles. l starts at 1 and grows with the estimated
   number of candidates that the prefix would meet; a pair must share min(l of both).
4. Each posting list first proposes two partners for each class: its neighbour in size order,
   and the class with the fewest rarer shingles before the list's own (of a group of near
   copies, the one with the fewest edits). Each class keeps the best of either kind, so the
   work is linear in the postings. Verified links make provisional components, which swallow
   large groups of near copies.
5. Only lists that still hold two components propose pairs, and only across components, and
   only where the places of the shared shingle leave room for ``o`` common ones: before it at
   most as many as either prefix shares with any class (a shingle that no other prefix holds
   can't be in a set whose prefix reaches past it), from it on what the shorter rest holds.
   Every linked pair meets in the base prefixes (l = 1), so only their lists are searched; a
   pair found there is verified if the prefixes lengthened to l share l shingles. Nothing is lost: a pair inside one
   component needs no link, every other pair above the threshold meets the prefix bound.

Shingles and classes are told apart by 64-bit hashes; verification compares hashed sets.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import hashing as H
from .components import connected_components
from .tables import Scratch, stored, text_of

NGRAM = 5
SKETCH_BITS = 20
SKETCH_PARTS = 16  # pieces in which a task hands over its sketch
MOST_EXTRA = 8  # largest l
HOT_LIST = 50_000  # estimated postings from which a list is dealt over several tasks
RECENT = 200_000  # classes that a task remembers, so as to emit each once
SPLIT_SALTS = 64

SETS = "doc_id bigint, text_id bigint, n_shingles bigint, class_id bigint, part int, sketch binary"
POSTINGS = "token bigint, class_id bigint, shape bigint, need int, salt int"
# A shape holds the set's size and the shingle's rank in it: size << 31 | rank.
RANK_BITS = 31


def _class_ids(sets: list[np.ndarray]) -> np.ndarray:
    """A hash of each set."""
    return H.mix(np.array([H.mix(s * H.BASE).sum() + H.U64(len(s)) for s in sets], np.uint64)).view(np.int64)


def _texts(column) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _sets_task(ngram: int, bits: int):
    """A row for each document, then the task's sketch in SKETCH_PARTS rows."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_id", pa.int64()), ("n_shingles", pa.int64()), ("class_id", pa.int64()),
                        ("part", pa.int32()), ("sketch", pa.binary())])

    def run(batches):
        hasher, counts, any_row = H.PrefixHasher(), np.zeros(1 << bits, np.int64), False
        for batch in batches:
            any_row = any_row or batch.num_rows > 0
            texts = _texts(batch.column(1))
            for first, part in H.groups(texts):
                sets = H.shingle_sets(part, ngram, hasher)
                every = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
                counts += np.bincount((every >> H.U64(64 - bits)).astype(np.int64), minlength=1 << bits)
                n = len(part)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), batch.column(2).slice(first, n), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(_class_ids(sets)), pa.array(np.full(n, -1, np.int32)),
                    pa.nulls(n, pa.binary())], schema=schema)
        if any_row:
            pieces = counts.reshape(SKETCH_PARTS, -1)
            none = pa.nulls(SKETCH_PARTS, pa.int64())
            yield pa.RecordBatch.from_arrays([
                none, none, none, none, pa.array(np.arange(SKETCH_PARTS, dtype=np.int32)),
                pa.array([zlib.compress(p.tobytes(), 1) for p in pieces], pa.binary())], schema=schema)

    return run


def _add_sketches(batches):
    """Sums sketches by part; the rows stream, so any number of them fits."""
    held: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, piece in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts = np.frombuffer(zlib.decompress(piece), np.int64)
            held[part] = held[part] + counts if part in held else counts
    yield pa.RecordBatch.from_pydict({
        "part": pa.array(list(held), pa.int32()),
        "sketch": pa.array([zlib.compress(x.tobytes(), 1) for x in held.values()], pa.binary())})


def _sketch(sets: DataFrame, bits: int) -> np.ndarray:
    """The summed sketch: ``2 ** bits`` counters, whatever the corpus."""
    rows = sets.where("part >= 0").select("part", "sketch", (F.rand(7) * SPLIT_SALTS).cast("int").alias("salt"))
    first = rows.repartition("part", "salt").select("part", "sketch").mapInArrow(_add_sketches, "part int, sketch binary")
    total = first.repartition("part").mapInArrow(_add_sketches, "part int, sketch binary").collect()
    counts = np.zeros((SKETCH_PARTS, (1 << bits) // SKETCH_PARTS), np.int64)
    for row in total:
        counts[row["part"]] += np.frombuffer(zlib.decompress(row["sketch"]), np.int64)
    return counts.reshape(-1)


def usual_level(counts: np.ndarray) -> float:
    """What a counter of the sketch holds without any common shingle."""
    return counts.mean() * 1.5 + 8


def prefix_of(tokens: np.ndarray, counts: np.ndarray, usual: float, most_extra: int = MOST_EXTRA):
    """The prefix of one set in rare-first order, its l, and the estimates of its shingles.

    The estimated candidate cost is what the base prefix's lists hold above the sketch's
    usual level; each doubling of it asks for one more shared shingle, up to ``most_extra``.
    """
    bits = int(len(counts)).bit_length() - 1
    guess = counts[(tokens >> H.U64(64 - bits)).astype(np.int64)]
    order = np.lexsort((tokens, guess))
    n = len(tokens)
    base = n - (3 * n + 3) // 4 + 1
    cost = np.maximum(guess[order[:base]] - usual, 0).sum()
    need = 1 + min(most_extra - 1, int(np.log2(1 + cost / 64)), n - base)
    chosen = order[: base + need - 1]
    return tokens[chosen], need, guess[chosen]


def _postings_task(ngram: int, counts_of):
    names = ["token", "class_id", "shape", "need", "salt"]

    def run(batches):
        hasher, counts = H.PrefixHasher(), counts_of.value
        usual, seen = usual_level(counts), set()
        for batch in batches:
            texts = _texts(batch.column(1))
            for _, part in H.groups(texts):
                sets = H.shingle_sets(part, ngram, hasher)
                classes = _class_ids(sets)
                rows = []
                for c, tokens in zip(classes.tolist(), sets):
                    if not len(tokens) or c in seen:
                        continue
                    if len(seen) >= RECENT:
                        seen.clear()
                    seen.add(c)
                    prefix, need, guess = prefix_of(tokens, counts, usual)
                    k = len(prefix)
                    lots = np.maximum(guess - usual, 0).astype(np.int64) // HOT_LIST
                    rows.append((prefix.view(np.int64), np.full(k, c, np.int64),
                                 (len(tokens) << RANK_BITS) + np.arange(k, dtype=np.int64),
                                 np.full(k, need, np.int32), np.where(lots > 0, 1 + (c & 0x7FFFFFFF) % (lots + 1), 0).astype(np.int32)))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*rows)], names=names)

    return run


def _packed_task(batches):
    """Texts compressed before they are shuffled."""
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
            [zlib.compress(t, 1) for t in _texts(batch.column(1))], pa.binary())], names=["doc_id", "packed"])


def _verify_task(ngram: int):
    def run(batches):
        hasher = H.PrefixHasher()
        for batch in batches:
            a, b, left, right = (batch.column(k).to_pylist() for k in range(4))
            sets = H.shingle_sets([zlib.decompress(t) for pair in zip(left, right) for t in pair], ngram, hasher)
            keep = []
            for x, y in zip(sets[::2], sets[1::2]):
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= 75 * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()).filter(pa.array(keep, pa.bool_())) for v in (a, b)], names=["a", "b"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, ngram: int) -> DataFrame:
    """The pairs (a, b) of classes whose sets reach the threshold."""
    left = texts.select(F.col("class_id").alias("a"), F.col("packed").alias("x"))
    right = texts.select(F.col("class_id").alias("b"), F.col("packed").alias("y"))
    return (pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "x", "y")
            .mapInArrow(_verify_task(ngram), "a bigint, b bigint"))


def ngram_jaccard(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  ngram: int = NGRAM, sketch_bits: int = SKETCH_BITS) -> DataFrame:
    """One row per document: doc_id, n_shingles, text_id (xxhash64 of the text), component_id,
    class_id (smallest doc_id with the same set), group_id (64-bit hash of the component, null
    without shingles: where ids repeat, two components may bear the same component_id).

    Null and blank texts have no shingles and link with nothing; their component is their own
    id. A null id stays null as component and names no class, but links its neighbours. Repeated rows stay
    repeated; rows that share an id are told apart by their texts, so different texts under one
    id are linked only if they are alike. Other columns are ignored. An empty table gives an
    empty result.
    """
    spark, scratch = docs.sparkSession, Scratch()
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(docs, text_col).alias("text"))
    sets = stored(source.withColumn("text_id", F.xxhash64("text")).mapInArrow(_sets_task(ngram, sketch_bits), SETS), "sets")
    rows = sets.where("part < 0").select("doc_id", "text_id", "n_shingles", "class_id")
    counts_of = spark.sparkContext.broadcast(_sketch(sets, sketch_bits))

    # Posting lists: neighbours in size order, for lists of two classes or more.
    postings = source.mapInArrow(_postings_task(ngram, counts_of), POSTINGS)
    by_list = Window.partitionBy("token", "salt").orderBy("shape", "class_id")
    fresh = postings.withColumn("last", F.lag("class_id").over(by_list)).where("last is null or last <> class_id")
    by_rank = Window.partitionBy("token", "salt").orderBy(F.col("shape").bitwiseAND(F.lit((1 << RANK_BITS) - 1)), "class_id")
    live = scratch.table(fresh.withColumn("next", F.lead("class_id").over(by_list))
                  .where("last is not null or next is not null or salt > 0")
                  .select("token", "class_id", "shape", "need", "last", F.first("class_id").over(by_rank).alias("leader")), "postings")

    # First links: the neighbour and the leader that share most lists with the class.
    partners = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("other")) for k, c in enumerate(("last", "leader"))]))
    near = (live.select("class_id", partners.alias("p")).select("class_id", "p.kind", "p.other").where("other <> class_id")
            .groupBy("class_id", "kind", "other").count()
            .groupBy("class_id", "kind").agg(F.max_by("other", F.struct("count", "other")).alias("other"))
            .select(F.least("class_id", "other").alias("a"), F.greatest("class_id", "other").alias("b")).distinct())
    taking_part = live.select("class_id").distinct()
    holders = (rows.where("n_shingles > 0 and doc_id is not null").groupBy("class_id").agg(F.min("doc_id").alias("doc_id"))
               .join(taking_part, "class_id", "left_semi"))
    # Texts under one id may differ, so the set behind each text is looked at again.
    packed = source.where("doc_id is not null").mapInArrow(_packed_task, "doc_id bigint, packed binary")
    held = packed.join(holders.hint("shuffle_hash"), "doc_id")
    # Classes whose documents all lack an id are found by their text: one of each reaches the join.
    nameless = (rows.where("n_shingles > 0").groupBy("class_id").agg(F.min("doc_id").alias("some"), F.min("text_id").alias("text_id"))
                .where("some is null").select("class_id", F.col("text_id").alias("doc_id")).join(taking_part, "class_id", "left_semi"))
    loose = (source.where("doc_id is null").select(F.xxhash64("text").alias("doc_id"), "text")
             .mapInArrow(_packed_task, "doc_id bigint, packed binary").dropDuplicates(["doc_id"]))
    held = held.unionByName(loose.join(nameless.hint("shuffle_hash"), "doc_id"))
    texts = scratch.table(held.mapInArrow(_right_set(ngram), "class_id bigint, packed binary"), "texts")
    first = scratch.table(_verified(near, texts, ngram), "links")
    known = connected_components(first, scratch)

    # The rest: pairs across components from lists that hold more than one.
    rank = F.col("shape").bitwiseAND(F.lit((1 << RANK_BITS) - 1))
    placed = (live.join(known.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
              .withColumns({"component": F.coalesce("component", "class_id"),
                            "before": F.row_number().over(Window.partitionBy("class_id").orderBy(rank)) - 1}))
    mixed = placed.groupBy("token").agg(F.min("component").alias("p"), F.max("component").alias("q")).where("p <> q")
    open_lists = scratch.table(placed.join(mixed.select("token"), "token", "left_semi")
                        .select("token", "class_id", "component", "need", "before", F.shiftright("shape", RANK_BITS).alias("n"),
                                rank.alias("rank")), "open")
    x, y = (open_lists.select(*[F.col(c).alias(c if c == "token" else f"{c}_{s}") for c in open_lists.columns]) for s in "xy")
    share = F.expr("(3 * (n_x + n_y) + 6) div 7")
    met = (x.join(y, "token")
           .where("component_x <> component_y and class_id_x < class_id_y and 4 * n_x >= 3 * n_y and 4 * n_y >= 3 * n_x")
           .where((F.col("rank_x") <= F.col("n_x") - share) & (F.col("rank_y") <= F.col("n_y") - share))
           .where(F.least("before_x", "before_y") + F.least(F.col("n_x") - F.col("rank_x"), F.col("n_y") - F.col("rank_y")) >= share)
           .select(F.col("class_id_x").alias("a"), F.col("class_id_y").alias("b"), "n_x", "n_y", F.least("need_x", "need_y").alias("need"),
                   share.alias("share")).distinct())
    met = scratch.table(met, "met")
    prefixes = live.groupBy("class_id").agg(F.collect_list(F.struct(rank.alias("rank"), "token")).alias("held"))
    upto = lambda held, n: F.transform(F.filter(held, lambda h: h["rank"] < F.col(n) - F.col("share") + F.col("need")), lambda h: h["token"])
    pairs = (met.join(prefixes.select(F.col("class_id").alias("a"), F.col("held").alias("held_x")), "a")
             .join(prefixes.select(F.col("class_id").alias("b"), F.col("held").alias("held_y")), "b")
             .where(F.size(F.array_intersect(upto("held_x", "n_x"), upto("held_y", "n_y"))) >= F.col("need")))
    second = _verified(pairs, texts, ngram)
    parts = connected_components(scratch.table(first.union(second), "links"), scratch)

    # Back to documents: a component is named by the smallest doc_id of its classes.
    classes = (rows.where("n_shingles > 0").groupBy("class_id").agg(F.min("doc_id").alias("least"))
               .join(parts.withColumnRenamed("node", "class_id"), "class_id", "left"))
    classes = stored(classes.withColumn("component", F.coalesce("component", "class_id")), "classes")
    scratch.clear()
    names = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    named = classes.join(names, "component").select("class_id", "least", "component_id", "component")
    empty = F.col("n_shingles") == 0
    return (rows.join(named, "class_id", "left")
            .select("doc_id", "n_shingles", "text_id",
                    F.when(F.col("doc_id").isNull(), None).when(empty, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                    F.when(empty, F.col("doc_id")).otherwise(F.col("least")).alias("class_id"),
                    F.when(~empty, F.col("component")).alias("group_id")))


def _right_set(ngram: int):
    """Keeps the texts whose set is the class that the id stands for, repeated rows once."""
    def run(batches):
        hasher, seen = H.PrefixHasher(), set()
        for batch in batches:
            packed, wanted = batch.column("packed"), np.array(batch.column("class_id").to_pylist(), np.int64)
            sets = H.shingle_sets([zlib.decompress(p) for p in packed.to_pylist()], ngram, hasher)
            right = (_class_ids(sets) == wanted).tolist()
            keep = pa.array([ok and not (c in seen or seen.add(c)) for ok, c in zip(right, wanted.tolist())], pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(wanted).filter(keep), packed.filter(keep)], names=["class_id", "packed"])

    return run
