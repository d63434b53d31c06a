"""Quality rules as a ledger of failure bits.

Every rule is evaluated once per document: the ledger holds the measurements and one bit for
each rule that failed. A policy is a version name and the rules that count; applying one, or
asking what a policy would keep without one of its rules, only looks at the bits.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashing as H
from .tables import text_of

WINDOW = 8
SYMBOLS = b"[#*$%&|<>]"[1:-1]

# Rules in the order of their bits: name, condition of failure.
RULES = (
    ("few_words", "n_words < 20"),
    ("repeated_words", "100 * n_repeat_words > 30 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("repeated_lines", "2 * n_dup_lines > n_lines"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 20 * n_words"),
    ("shouting", "n_upper > 20 and 2 * n_upper > n_upper + n_lower"),
)
BASE = ("few_words", "repeated_words")
# Versioned policies; the last is the one in force.
POLICIES = {"v1": BASE, "v2": (*BASE, "symbols"), "v3": tuple(name for name, _ in RULES)}
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_lower")


def _table(test) -> np.ndarray:
    return np.array([bool(test(k)) for k in range(256)])


SYMBOL = _table(lambda k: k in SYMBOLS)
POINT = _table(lambda k: not 0x80 <= k < 0xC0) & ~H.WHITE
UPPER, LOWER = _table(lambda k: 0x41 <= k <= 0x5A), _table(lambda k: 0x61 <= k <= 0x7A)


def repeated_words(hashes: np.ndarray, width: int = WINDOW) -> int:
    """Words that lie in a run of ``width`` words found twice or more."""
    runs = H.windows(hashes, width)
    if len(runs) < 2:
        return 0
    _, place, count = np.unique(runs, return_inverse=True, return_counts=True)
    if len(count) == len(runs):
        return 0
    edge = np.zeros(len(hashes) + 1, np.int64)
    again = np.flatnonzero(count[place] > 1)
    np.add.at(edge, again, 1)
    np.add.at(edge, again + width, -1)
    return int((np.cumsum(edge) > 0).sum())


def _lines(text: bytes) -> tuple[int, int]:
    """Lines with a word, and how many of them equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def _measure_task(batches):
    hasher = H.PrefixHasher()
    for batch in batches:
        texts = [b"" if t is None else t for t in batch.column(1).cast(pa.binary()).to_pylist()]
        columns: dict[str, list] = {name: [] for name in MEASURES}
        for _, part in H.groups(texts):
            data, begins = H.joined(part)
            hashes, start, _ = H.words(data, hasher)
            edge = np.searchsorted(start, np.append(begins, len(data)))
            for name, kind in (("word_chars", POINT), ("n_symbols", SYMBOL), ("n_upper", UPPER), ("n_lower", LOWER)):
                columns[name].append(np.add.reduceat(kind[data].astype(np.int64), begins))
            lines = [_lines(t) for t in part]
            columns["n_lines"].append([n for n, _ in lines])
            columns["n_dup_lines"].append([n for _, n in lines])
            columns["n_words"].append(np.diff(edge))
            columns["n_repeat_words"].append([repeated_words(hashes[a:b]) for a, b in zip(edge[:-1], edge[1:])])
        joined = {name: pa.array(np.concatenate(v).astype(np.int64) if v else [], pa.int64()) for name, v in columns.items()}
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), **joined})


def quality_ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules=RULES) -> DataFrame:
    """doc_id, the measurements and ``fail_bits`` (bit k: rule k failed) of every document.

    A null text has no words and no lines. Ids, also null ones and repeated ones, are kept as
    they are, one row per document; other columns are ignored; an empty table gives an empty
    ledger.
    """
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(docs, text_col).alias("text"))
    measured = source.mapInArrow(_measure_task, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))
    bits = " + ".join(f"if({test}, {1 << k}L, 0L)" for k, (_, test) in enumerate(rules))
    return measured.withColumn("fail_bits", F.expr(bits))


def mask_of(names, rules=RULES) -> int:
    return sum(1 << k for k, (name, _) in enumerate(rules) if name in names)


def apply_policy(ledger: DataFrame, policy: str, policies=POLICIES, rules=RULES) -> DataFrame:
    """The ledger with policy, base_failed, kept and sole_rule: the one rule without which the
    policy would keep the document."""
    counts = F.col("fail_bits").bitwiseAND(F.lit(mask_of(policies[policy], rules)))
    names = F.array(*[F.lit(name) for name, _ in rules])
    sole = F.when(F.bit_count(counts) == 1, F.element_at(names, F.log2(counts.cast("double")).cast("int") + 1))
    return ledger.withColumns({"policy": F.lit(policy), "base_failed": F.col("fail_bits").bitwiseAND(F.lit(mask_of(BASE, rules))) != 0,
                               "kept": counts == 0, "sole_rule": sole})


def ablations(ledger: DataFrame, policies=POLICIES, rules=RULES) -> DataFrame:
    """For every policy and each of its rules: failed (documents that fail the rule), alone
    (those that fail no other of the policy), kept and kept_without. One pass counts the
    documents by their bits; the rest works on those few rows."""
    counts = ledger.groupBy("fail_bits").agg(F.count("*").alias("n"))
    spark = ledger.sparkSession
    wanted = spark.createDataFrame([(p, name, mask_of(names, rules), mask_of([name], rules)) for p, names in policies.items()
                                    for name in names], "policy string, rule string, mask bigint, bit bigint")
    hit = F.col("fail_bits").bitwiseAND(F.col("mask"))
    total = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return (counts.join(F.broadcast(wanted)).groupBy("policy", "rule")
            .agg(total(hit.bitwiseAND(F.col("bit")) != 0).alias("failed"), total(hit == F.col("bit")).alias("alone"),
                 total(hit == 0).alias("kept"), total((hit == 0) | (hit == F.col("bit"))).alias("kept_without")))
