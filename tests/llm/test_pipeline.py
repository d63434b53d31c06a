"""The pipeline against plain Python, and every stage on odd rows."""

import hashlib

import pytest
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from conftest import SF
from liqspark.llm import queries
from liqspark.llm.tables import stored, table


def test_stages_are_listed():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "secret_scan", "source_mix", "sentencepiece"]


def test_pipeline_matches_brute_force(spark, docs):
    import sentencepiece
    predicted = {r.doc_id: r.predicted for r in queries.op4_toxicity(spark, SF).collect()}
    kept = {r.doc_id: r for r in docs.collect() if not predicted[r.doc_id]}
    group = brute.components({d: brute.shingles(r.text) for d, r in kept.items()})
    texts = {d: r.text for d, r in kept.items() if group[d] == d}
    for d, text in texts.items():
        merged = []
        for a, _, b, _ in brute.secret_spans(text):
            if merged and a < merged[-1][1]:
                merged[-1][1] = max(b, merged[-1][1])
            else:
                merged.append([a, b])
        for a, b in reversed(merged):
            text = text[:a] + "[SECRET]" + text[b:]
        texts[d] = text
    rows = [(d, kept[d].source, t) for d, t in texts.items()]
    processor = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    want = []
    passes, size, _ = brute.mix_passes(rows)
    for d, _, words in passes:
        text = texts[d] if words == size[d] else texts[d][:[m.end() for m in brute.WHITE.finditer(texts[d])][words - 1]]
        want.append((d, len(processor.encode(text)), hashlib.sha256(",".join(map(str, processor.encode(text))).encode()).hexdigest()))
    got = [(r.doc_id, r.n_tokens, r.ids_sha256) for r in corpus_pipeline.run(spark, SF).collect()]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stage_on_odd_rows_and_on_none(spark, odd, empty, name, stage):
    out = stage(spark, odd, SF)
    if name != "sentencepiece":
        assert out.columns == odd.columns
    n = out.count()
    assert n <= 2 * odd.count() and (n > 0)
    if name == "ngram_jaccard":
        assert sorted(r.doc_id or 0 for r in out.collect()) == [0, 1, 2, 3, 4, 5, 7, 9, 10]
    if name == "secret_scan":
        assert out.where(F.col("text").contains("[SECRET]")).count() == 1 and n == odd.count()
    if name == "sentencepiece":
        assert n == odd.count()
    none = stage(spark, stored(empty, "empty"), SF)
    assert none.count() == 0


def test_toxic_documents_go_and_clean_ones_stay(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    kept = corpus_pipeline.drop_toxic(spark, docs, sf).select("doc_id").join(labels, "doc_id").groupBy("toxic").count().collect()
    all_ = {r.toxic: r["count"] for r in labels.groupBy("toxic").count().collect()}
    left = {r.toxic: r["count"] for r in kept}
    assert left[0] >= 0.95 * all_[0] and left.get(1, 0) <= 0.4 * all_[1]


def test_unlike_texts_under_one_id_stay(spark, docs):
    """One id holds two texts, each the smallest of its own group of copies; and an equal row."""
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (1, b), (2, a + " end"), (3, b + " end"), (4, c), (5, c)]
    given = spark.createDataFrame([(d, t, "en", "s", len(t)) for d, t in rows], docs.schema).repartition(3)
    kept = corpus_pipeline.drop_near_copies(spark, given, SF).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(1, a), (1, b), (4, c)]


CLASH = ("_mark", "_once", "_doc", "_text_id", "_place", "_words", "_spans", "doc_id_", "carried", "whole", "words", "size", "mark", "once", "place",
         "row", "copy", "slot", "spans", "text_id", "number", "target", "running", "a.b")


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES[:4])
def test_further_columns_come_back_unchanged(spark, odd, name, stage):
    """Columns named like those that the operators use inside, and one with a dot."""
    docs = odd.drop("class_id").select("*", *[F.concat(F.lit(c + ":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(c) for c in CLASH])
    out = stage(spark, stored(docs, "clash"), SF)
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[c] == f"{c}:{'none' if r.doc_id is None else r.doc_id}" for r in rows for c in CLASH)


def test_mix_does_not_depend_on_the_order_of_rows(spark, docs):
    """Rows of equal size under one id or none, in three arrangements."""
    rows = [(None if k % 2 else 7, f"w{k} " * 30, "en", "s" if k % 3 else "t", k) for k in range(40)]
    mixes = []
    for arranged in (rows, rows[::-1], rows[1::2] + rows[::2]):
        given = stored(spark.createDataFrame(arranged, docs.schema).repartition(5), "arranged")
        mixes.append(sorted((r.text, r.source, r.n_chars) for r in corpus_pipeline.mix(spark, given, SF).collect()))
    assert mixes[0] == mixes[1] == mixes[2] and len(mixes[0]) > 40
