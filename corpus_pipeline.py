"""A training corpus from ``documents``: toxic documents go, one document of each group of near
copies stays, secrets are masked, sources are mixed to their target weights, and what is left
is encoded.

Every stage is a function (spark, docs, sf_dir) -> DataFrame. The result of each is written as
Parquet in the shared folder and read again as the next one's ``docs``; all but the last keep
the columns of ``documents``. Null or empty texts, repeated rows, further columns and empty
tables pass as the operators define them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from liqspark.llm import mixing, ngram_jaccard, pieces, queries, secrets, toxicity
from liqspark.llm.tables import fresh_names, stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` without the documents that are predicted to be toxic. The model is learnt from
    the labels of all documents given."""
    model = toxicity.learn_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the row with the smallest doc_id (of rows that
    share it, the smallest text hash; of equal rows, one). Unlike texts under one id are groups of
    their own. Rows without an id or without words are copies of nothing and stay."""
    linked = stored(ngram_jaccard.ngram_jaccard(docs), "groups")
    first = (linked.where("doc_id is not null and n_shingles > 0").groupBy("group_id")
             .agg(F.min(F.struct("doc_id", "text_id")).alias("first")).select("first.*"))
    grouped = F.col("doc_id").isNotNull() & F.coalesce(F.col("text").rlike(mixing.WORD), F.lit(False))
    text_id, place = fresh_names(docs, "_text_id", "_place")
    # Rows that share id and text go by a hash of the whole row, so any arrangement keeps the same one.
    same = Window.partitionBy("doc_id", text_id).orderBy(F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    kept = (docs.withColumn(text_id, F.xxhash64("text")).where(grouped)
            .join(first.withColumnRenamed("text_id", text_id).hint("shuffle_hash"), ["doc_id", text_id], "left_semi")
            .withColumn(place, F.row_number().over(same)).where(F.col(place) == 1))
    return kept.drop(text_id, place).select(*[F.col(f"`{c}`") for c in docs.columns]).unionByName(docs.where(~grouped))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``docs`` with every secret in a text masked; n_chars follows the text."""
    masked = secrets.redact_secrets(docs)
    return _measured(masked)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of all sources: a row for every pass over a document that the mix takes; the last
    one of a source keeps the words that its target has room for."""
    return _measured(mixing.mixed_documents(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every document of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return pieces.encode_documents(docs, pieces.model_bytes(queries.tokenizer_path()))


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


STAGES = [("toxicity", drop_toxic), ("ngram_jaccard", drop_near_copies), ("secret_scan", mask_secrets),
          ("source_mix", mix), ("sentencepiece", encode)]

# Log-odds, prefix joins and segmentation have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
