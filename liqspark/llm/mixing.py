"""Mixing sources to target weights by weighted fair queueing, in DataFrame functions only.

Every source is a queue of its documents in an order shuffled by a hash of the id, run
through twice. Its packets are pieces of at most 64 words, in order; a packet's virtual finish
time is the words of its source up to its end, divided by the source's target, so all sources
come to their targets together at time 1. The packets of all sources are sorted by finish time
and cut at the total budget, the sum of the targets. Nothing else ends a source: what it takes
differs from its target by about a packet, however long its documents are.

Each running total is kept per slot (a piece of the hash range, or of the finish times), so a
source that holds most rows is spread over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .running import join_same, running_total
from .tables import fresh_names, stored, text_of

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SLOTS = 4096
PACKET = 64  # words in a packet at most


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """One row per source: source, source_size, number, target.

    Sources in code point order, null last, take the weights in turn. Targets share ``share``
    times all words by weight; a target stops at ``most`` times its source's size and the
    excess goes to the others by weight, until none is above. The sources are taken by how
    soon they reach their bound; the first that doesn't fixes the rate of all after it.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    every, named = Window.partitionBy(), Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumns({"number": F.row_number().over(named), "total": F.sum("source_size").over(every)})
    turn = F.col("number") % len(weights)
    weight = F.coalesce(*[F.when(turn == (k + 1) % len(weights), float(w)) for k, w in enumerate(weights)])
    sources = sources.withColumns({"weight": weight, "bound": (F.col("source_size") * most).cast("double")})
    sources = sources.withColumns({"full_at": F.col("bound") / F.col("weight"), "weights": F.sum("weight").over(every)})
    earlier = Window.orderBy("full_at", "number").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(earlier), F.lit(0.0))
    sources = sources.withColumn("rate", (F.lit(share) * F.col("total") - before("bound")) / (F.col("weights") - before("weight")))
    rate = F.max(F.when(F.col("full_at") > F.col("rate"), F.col("rate"))).over(every)
    target = F.coalesce(F.least("bound", F.col("weight") * rate), F.col("bound"))
    return sources.select("source", "source_size", "number", target.alias("target"))


def mix_packets(sized: DataFrame, most: int = MOST, share: float = SHARE, packet: int = PACKET, **shares) -> DataFrame:
    """The packets of ``sized`` (doc_id, source, size, mark and other columns): those columns,
    source_size, target, row (number, slot, seq: names the document's row), copy (the pass over the
    document), words (that the mix takes), finish and running (words of the queue up to this packet).

    Every row has a packet at least; those of a row without words hold none and come last.
    """
    targets = stored(source_targets(sized, most=most, share=share, **shares), "targets")
    rows = join_same(sized, targets.hint("shuffle_hash"), ["source"])
    rows = rows.withColumn("slot", F.conv(F.substring("mark", 1, 3), 16, 10).cast("int"))
    order = [F.col(c) for c in ("mark", "size", *sorted(set(sized.columns) - {"mark", "size"}))]
    queued = running_total(rows, ["number"], "slot", order, "size", "upto")
    queued = queued.withColumn("seq", F.row_number().over(Window.partitionBy("number", "slot").orderBy(*order)))
    queued = queued.withColumn("pieces", F.ceil(F.col("size") / packet))
    last = F.when(F.col("pieces") > 0, most * F.col("pieces") - 1).otherwise(0)
    packets = queued.withColumn("piece", F.explode(F.sequence(F.lit(0).cast("bigint"), last.cast("bigint"))))
    copy, part = F.floor(F.col("piece") / F.greatest(F.lit(1), "pieces")), F.col("piece") % F.greatest(F.lit(1), "pieces")
    packets = packets.withColumns({"copy": copy, "offered": F.least(F.lit(packet), F.col("size") - part * packet).cast("bigint"),
                                   "begin": F.col("upto") - F.col("size") + copy * F.col("source_size") + part * packet})
    packets = packets.withColumn("finish", F.when(F.col("offered") > 0, (F.col("begin") + F.col("offered")) / F.col("target")))
    # Slots rise with the finish time: evenly up to 2, by its logarithm after it (sources of small weight end late).
    # Packets without words come after all others, spread by their place in the shuffle.
    time = F.when(F.col("finish") <= 2, F.floor(F.col("finish") * SLOTS)).otherwise(2 * SLOTS + F.floor(F.log2(F.col("finish") / 2) * SLOTS))
    packets = packets.withColumn("time", F.coalesce(time, F.lit(1 << 40) + F.col("slot")))
    packets = running_total(packets, [], "time", [F.col("finish"), F.col("number"), F.col("begin")], "offered", "running")
    budget = targets.agg(F.floor(F.sum("source_size") * min(share, most)).alias("budget"))  # the sum of the targets
    packets = packets.join(F.broadcast(budget))  # one row
    words = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("offered"), F.col("budget") - F.col("running") + F.col("offered")))
    return packets.select(*sized.columns, "source_size", "target", F.struct("number", "slot", "seq").alias("row"),
                          "copy", words.alias("words"), "finish", "running")


def sized_documents(docs: DataFrame, keep: dict, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                    seed: str = "mix") -> DataFrame:
    """doc_id, source, size, mark (its place in the shuffle: a hash of the id, without one of the
    text) and the ``keep`` columns of every document, without its text."""
    text = text_of(docs, text_col)
    name = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("null:"), F.md5(text)))
    return stored(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
                              F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
                              F.md5(F.concat_ws(":", F.lit(seed), name)).alias("mark"), *[c.alias(n) for n, c in keep.items()]), "sizes")


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    A null text has no words and nothing is taken of it; a null source is a source of its
    own; rows without an id are shuffled by their texts. Rows of equal id and size are
    interchangeable, so reruns agree. Without any words all targets are 0. Other columns are
    ignored; an empty table gives an empty result.
    """
    packets = mix_packets(sized_documents(docs, {}, id_col, text_col, source_col), **shares)
    return packets.groupBy("row").agg(*[F.first(c).alias(c) for c in ("doc_id", "source", "size", "source_size", "target")],
                                      F.sum("words").alias("taken")).drop("row")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **shares) -> DataFrame:
    """The mix itself: ``docs`` with a row for each pass over a document that the mix takes; a pass
    that the budget ends keeps the text's first words. Rows that share id and size go by a hash of the whole
    row, so the mix does not depend on the order in which they are read."""
    whole = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    packets = mix_packets(sized_documents(docs, {"whole": whole}, id_col, text_col, source_col), **shares)
    names = ("doc_id", "whole", "words", "size")
    taken = packets.groupBy("row", "copy").agg(F.sum("words").alias("words"), *[F.first(c).alias(c) for c in ("doc_id", "whole", "size")]).where("words > 0")
    name, mark, words, size, once = fresh_names(docs, "_name", "_whole", "_words", "_size", "_once")
    taken = taken.select(*[F.col(c).alias(f) for c, f in zip(names, (name, mark, words, size))])
    marked = docs.withColumns({name: F.col(id_col), mark: whole})
    of_equals = F.row_number().over(Window.partitionBy(name, mark).orderBy(F.lit(1)))  # one row stands for each that is taken
    joined = join_same(marked.withColumn(once, of_equals).where(F.col(once) == 1), taken, [name, mark])
    head = F.array_join(F.slice(F.regexp_extract_all(text_col, F.lit(r"[\x20\x09-\x0D]*" + WORD), F.lit(0)), 1, F.col(words).cast("int")), "")
    cut = F.when(F.col(words) < F.col(size), head).otherwise(F.col(text_col))
    return joined.select(*[cut.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns])
