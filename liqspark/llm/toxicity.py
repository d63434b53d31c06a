"""Toxicity by maximum-scoring segments of token log-odds.

1. Log-odds. Tokens are runs of ASCII letters, digits and non-ASCII bytes, A-Z lower-cased.
   The share of a token's occurrences that lie in toxic documents has a Dirichlet prior
   centred on the share of its six-byte prefix, that on the four-byte prefix, that on the
   share of all tokens. A token scores its log-odds above the overall share, less ``DRIFT``,
   so ordinary text drifts down.
2. Segments. One linear scan finds all maximal scoring segments of a text.
3. Calibration. The labelled documents fall into three folds, and each is scored by the
   log-odds of the other two. There the best segment of clean documents follows an
   extreme-value law; its scale and shift turn each segment's score into -ln(expected number
   in clean text). A document's evidence is the sum over its significant segments, and a
   logistic curve on it gives the score.

Bound: at most about ``MOST_LABELS`` labelled rows are learnt from, picked by a hash of the id.
The log-odds table keeps every token and prefix of theirs; every document is scored whole.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .tables import Scratch, text_of

HEADS = (6, 4)
# Prior tokens and drift, picked on fold 3 with models of folds 0 and 1 (sf0.1), so without
# the held-out rows.
STRENGTH = 8.0
DRIFT = 2.0
FOLDS = (0, 1, 3)  # crc32(doc_id) mod 4; 2 is held out
MOST_LABELS = 1 << 16
THRESHOLD = 0.3
EVIDENCE = (-20.0, 60.0)
LEVEL_MARK = [H.U64(x) for x in (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F)]
EULER = 0.5772156649015329


@dataclass
class ToxicityModel:
    """Scores of tokens and prefixes, in plain arrays that executors need nothing of ours to read."""

    keys: np.ndarray  # sorted token and prefix hashes
    scores: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    slope: float = 1.0
    intercept: float = 0.0

    @property
    def toxic(self) -> np.ndarray:
        """What is learnt of the keys, under the name that it had as counts."""
        return self.scores

    def plain(self) -> tuple:
        return self.keys, self.scores, self.scale, self.shift, self.slope, self.intercept


def token_scores(keys: np.ndarray, scores: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Scores of tokens given by the hashes of the word and its prefixes: that of the longest one
    known, which has its shorter ones for a prior; without any, the drift."""
    out = np.full(len(levels[0]), -DRIFT)
    if len(keys):
        for k in range(len(levels) - 1, -1, -1):
            key = levels[k] ^ LEVEL_MARK[k]
            at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            out = np.where(keys[at] == key, scores[at], out)
    return out


def segments(positions: np.ndarray, scores: np.ndarray, before: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text, given its positive
    tokens: their positions, scores and the running total before each. Linear time."""
    held: list[list] = []  # [first, last, total before, total after, nearest earlier with a smaller total before]
    for at, score, left in zip(positions.tolist(), scores.tolist(), before.tolist()):
        new = [at, at, left, left + score, -1]
        while True:
            j = len(held) - 1
            while j >= 0 and held[j][2] >= new[2]:
                j = held[j][4]
            new[4] = j
            if j < 0 or held[j][3] >= new[3]:
                held.append(new)
                break
            new[0], new[2] = held[j][0], held[j][2]
            del held[j:]
    return [(a, b, right - left) for a, b, left, right, _ in held]


def _tokens(part: list[bytes], hasher):
    """Hash levels of all tokens of the texts, and the first token of each text."""
    data, begins = H.joined([t.lower() for t in part])
    hashes, start, _, *heads = H.words(data, hasher, H.NOT_ALNUM, HEADS)
    return [hashes, *heads], np.searchsorted(start, np.append(begins, len(data)))


def _texts(column) -> list[bytes]:
    return [b"" if t is None else t for t in column.cast(pa.binary()).to_pylist()]


def _count_task(batches):
    """(key, parent, level, fold, toxic, total): token counts of labelled texts; the parent is the next
    shorter prefix. The counts of a batch are added up before they leave the task."""
    hasher = H.PrefixHasher()
    for batch in batches:
        texts, toxic, group = _texts(batch.column(0)), np.array(batch.column(1).to_pylist()), np.array(batch.column(2).to_pylist())
        for g in FOLDS:
            chosen = np.flatnonzero(group == g)
            if not len(chosen):
                continue
            held = {}
            for first, part in H.groups([texts[k] for k in chosen]):
                levels, edge = _tokens(part, hasher)
                bad = np.repeat(toxic[chosen[first:first + len(part)]], np.diff(edge)).astype(np.int64)
                for k, hashes in enumerate(levels):
                    above = levels[k + 1] ^ LEVEL_MARK[k + 1] if k < len(HEADS) else np.zeros_like(hashes)
                    held.setdefault(k, []).append((hashes ^ LEVEL_MARK[k], above, bad))
            for k, rows in held.items():
                keys, above, bad = (np.concatenate(x) for x in zip(*rows))
                found, first, place = np.unique(keys, return_index=True, return_inverse=True)
                yield pa.RecordBatch.from_pydict({
                    "key": pa.array(found.view(np.int64)), "parent": pa.array(above[first].view(np.int64)), "level": pa.array(np.full(len(found), k, np.int32)),
                    "fold": pa.array(np.full(len(found), g, np.int32)), "toxic": pa.array(np.bincount(place, bad, len(found)).astype(np.int64)),
                    "total": pa.array(np.bincount(place, minlength=len(found)).astype(np.int64))})


def _scan(texts: list[bytes], keys: np.ndarray, known: np.ndarray, hasher):
    """(tokens, segments) of each text."""
    for _, part in H.groups(texts):
        levels, edge = _tokens(part, hasher)
        distinct, at, place = np.unique(levels[0], return_index=True, return_inverse=True)
        scores = token_scores(keys, known, [level[at] for level in levels])[place]
        total = np.cumsum(scores)
        good = np.flatnonzero(scores > 0)
        cut = np.searchsorted(good, edge)
        for k in range(len(part)):
            a, mine = edge[k], good[cut[k]:cut[k + 1]]
            yield int(edge[k + 1] - a), segments(mine - a, scores[mine], total[mine] - scores[mine]) if len(mine) else []


def _best_task(models_of):
    """(toxic, tokens, scores of the segments) of labelled texts, each by the model of the
    other folds."""
    def run(batches):
        hasher, (keys, models) = H.PrefixHasher(), models_of.value
        for batch in batches:
            texts, fold = _texts(batch.column(0)), np.array(batch.column(2).to_pylist())
            for g in FOLDS:
                mine = np.flatnonzero(fold == g)
                rows = list(_scan([texts[k] for k in mine], keys, models[g], hasher))
                yield pa.RecordBatch.from_pydict({
                    "toxic": batch.column(1).take(pa.array(mine)).cast(pa.int32()), "tokens": pa.array([n for n, _ in rows], pa.int64()),
                    "scores": pa.array([[s for _, _, s in found] for _, found in rows], pa.list_(pa.float64()))})

    return run


def evidence(scores, tokens: int, scale: float, shift: float) -> float:
    """-ln(expected number in clean text), summed over the significant segments; that of the
    best segment if none is."""
    each = [scale * s - shift - math.log(max(tokens, 1)) for s in scores] or [EVIDENCE[0]]
    x = sum(e for e in each if e > 0) or max(each)
    return min(max(x, EVIDENCE[0]), EVIDENCE[1])


def _evidence_task(scale: float, shift: float):
    def run(batches):
        for batch in batches:
            x = [round(evidence(s, n, scale, shift), 1) for n, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_pydict({"toxic": batch.column(0), "x": pa.array(x, pa.float64())})

    return run


def _logistic(bins) -> tuple[float, float]:
    """Slope and intercept of a lightly damped logistic curve over (x, toxic, count)."""
    if not bins:
        return 1.0, 0.0
    x, y, n = (np.array(v, float) for v in zip(*bins))
    w, design = np.zeros(2), np.stack([x, np.ones_like(x)])
    damp = np.diag([0.5, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        step = np.linalg.solve((design * (n * p * (1 - p))) @ design.T + damp, design @ (n * (p - y)) + damp @ w)
        w = w - np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def held_out(doc_id):
    """Rows whose crc32(doc_id as text) mod 4 is 2 are never learnt from."""
    return _fold(doc_id) == 2


def _fold(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def learn_toxicity(docs: DataFrame, labels: DataFrame, most_labels: int = MOST_LABELS) -> ToxicityModel:
    """Fits the model on the labelled rows that are not held out (three folds of four). Rows without a label are
    not used; of several labels of one document the highest counts."""
    spark, scratch = docs.sparkSession, Scratch()
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    n = known.count()
    sample = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(n, 1))) < most_labels)
    learnt = docs.select("doc_id", text_of(docs).alias("text")).join(F.broadcast(sample), "doc_id")
    learnt = learnt.select("text", "toxic", _fold(F.col("doc_id")).cast("int").alias("fold"))

    models = {"all": FOLDS} | {g: [f for f in FOLDS if f != g] for g in FOLDS}
    keys, scores = _scores(learnt, models, scratch)
    model = ToxicityModel(keys, scores["all"])
    others = spark.sparkContext.broadcast((keys, {g: scores[g] for g in FOLDS}))
    best = learnt.mapInArrow(_best_task(others), "toxic int, tokens bigint, scores array<double>")
    best = scratch.table(best, "best")
    others.destroy()
    clean = best.where("toxic = 0 and tokens > 0").withColumn("top", F.coalesce(F.array_max("scores"), F.lit(0.0)))
    law = clean.agg(F.stddev("top").alias("sd"), F.avg("top").alias("top"), F.avg(F.log("tokens")).alias("logs")).first()
    if law["sd"]:
        model.scale = math.pi / (math.sqrt(6) * max(law["sd"], 0.1))
        model.shift = model.scale * law["top"] - law["logs"] - EULER
    bins = best.mapInArrow(_evidence_task(model.scale, model.shift), "toxic int, x double").groupBy("x", "toxic").count().collect()
    model.slope, model.intercept = _logistic([(r["x"], r["toxic"], r["count"]) for r in bins])
    scratch.clear()
    return model


def _scores(learnt: DataFrame, models: dict, scratch: Scratch) -> tuple[np.ndarray, dict]:
    """Sorted keys and their scores in each model (name: folds). Counts and scores are tables; only
    eight bytes a key and four a score, of at most ``MOST_LABELS`` rows' tokens and prefixes, come to the driver."""
    counts = learnt.mapInArrow(_count_task, "key bigint, parent bigint, level int, fold int, toxic bigint, total bigint").groupBy("key", "parent", "level")
    counts = scratch.table(counts.agg(*[F.sum(F.when(F.col("fold") == g, F.col(c)).otherwise(0)).alias(f"{c}_{g}") for c in ("toxic", "total") for g in FOLDS]), "counts")
    of = lambda c, folds: sum((F.col(f"{c}_{g}") for g in folds), F.lit(0))
    sizes = counts.where("level = 0").agg(*[F.sum(of(c, folds)).alias(f"{c} {m}") for m, folds in models.items() for c in ("toxic", "total")]).first()
    share = {m: (sizes[f"toxic {m}"] or 0) / max(1, sizes[f"total {m}"] or 0) for m in models}
    rows, every = None, []
    for level in range(len(HEADS), -1, -1):
        here = counts.where(F.col("level") == level)
        prior = {m: F.lit(share[m]) if rows is None else F.col(f"prior_{m}") for m in models}
        if rows is not None:
            here = here.join(rows.select(F.col("key").alias("parent"), *[F.col(f"rate_{m}").alias(f"prior_{m}") for m in models]), "parent")
        rates = [((of("toxic", folds) + STRENGTH * prior[m]) / (of("total", folds) + STRENGTH)).alias(f"rate_{m}") for m, folds in models.items()]
        rows = scratch.table(here.select("key", *rates), "rates")
        every.append(rows)
    odds = lambda p: F.log(p / (1 - p))
    score = [(odds(F.col(f"rate_{m}")) - odds(F.lit(share[m])) - DRIFT if 0 < share[m] < 1 else F.lit(-DRIFT)).cast("float").alias(f"{m}") for m in models]
    table = reduce(DataFrame.union, every).select("key", *score).toArrow()
    keys = table["key"].to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], {m: table[f"{m}"].to_numpy()[order] for m in models}


def _score_task(model_of):
    def run(batches):
        hasher, (keys, scores, scale, shift, slope, intercept) = H.PrefixHasher(), model_of.value
        for batch in batches:
            score, passages = [], []
            for n, found in _scan(_texts(batch.column(1)), keys, scores, hasher):
                x = evidence([s for _, _, s in found], n, scale, shift)
                score.append(1 / (1 + math.exp(-slope * x - intercept)))
                known = [(a, b, s) for a, b, s in found if scale * s - shift - math.log(max(n, 1)) > 0]
                passages.append(",".join(f"{a}:{b + 1}" for a, b, _ in known))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(score, pa.float64()),
                                              "passages": pa.array(passages, pa.string())})

    return run


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, passages (``first:end`` token
    positions of the significant segments, in the order of the text).

    A null text counts as empty; an empty text has no segments and the lowest evidence. A null
    id is kept and not held out; repeated rows stay repeated; other columns are ignored; an
    empty table gives an empty result. Without labels no token stands out and all documents
    score alike.
    """
    model_of = docs.sparkSession.sparkContext.broadcast(model.plain())
    scored = docs.select(F.col("doc_id").cast("bigint"), text_of(docs).alias("text")).mapInArrow(
        _score_task(model_of), "doc_id bigint, score double, passages string")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"), "passages")


def keep_clean(docs: DataFrame, model: ToxicityModel, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns. The texts
    are judged where they are, without a join."""
    model_of = docs.sparkSession.sparkContext.broadcast(model.plain())
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text_of(docs).alias("_text"))
    kept = held.mapInArrow(_keep_task(model_of, threshold), held.schema)
    return kept.select("row.*")


def _keep_task(model_of, threshold: float):
    def run(batches):
        hasher, (keys, scores, scale, shift, slope, intercept) = H.PrefixHasher(), model_of.value
        for batch in batches:
            keep = []
            for n, found in _scan(_texts(batch.column(1)), keys, scores, hasher):
                x = evidence([s for _, _, s in found], n, scale, shift)
                keep.append(1 / (1 + math.exp(-slope * x - intercept)) < threshold)
            yield batch.filter(pa.array(keep, pa.bool_()))

    return run
