"""The registered queries: against DuckDB where SQL can express them, else against plain Python."""

import hashlib
import os
import sys

import duckdb
import pytest

import brute
from conftest import SF
from liqspark.llm import fingerprint, queries, toxicity
from liqspark.llm.tables import table

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))), "tools"))
TABLES = ("documents", "pages", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    from check_oracle import compare
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    result = compare(spark, name, queries.QUERIES[name], queries.ORACLES[name], SF, con)
    assert result.get("values_match") and result["types_match"], result


def texts(docs):
    return {r.doc_id: r.text for r in docs.collect()}


def test_jaccard_matches_brute_force(spark, docs):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op3_ngram_jaccard(spark, SF).collect()}
    sets = {d: brute.shingles(t) for d, t in texts(docs).items()}
    want = brute.components(sets)
    assert got == {d: (len(sets[d]), want[d]) for d in sets}


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    rows = queries.op4_toxicity(spark, sf).join(table(spark, sf, "labels"), "doc_id").where("held_out").collect()
    bad, good = [r.score for r in rows if r.toxic], [r.score for r in rows if not r.toxic]
    assert sum((a > b) + (a == b) / 2 for a in bad for b in good) / (len(bad) * len(good)) > 0.75
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)


def test_fingerprints_match_brute_force(spark, docs):
    from liqspark.llm.hashing import PrefixHasher
    rows = sorted(texts(docs).items())
    got = {r.doc_id: r for r in queries.op7_fingerprint(spark, SF).collect()}
    assert len(got) == len(rows)
    for k, (d, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        half = len(text) // 2
        edited = text[:len(text) - half] + following[:half]
        a, b, c = fingerprint.fingerprints([text.encode(), edited.encode(), following.encode()], PrefixHasher())
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b)
        assert (r.near_edited, r.near_next) == (fingerprint.likeness(a, b), fingerprint.likeness(a, c))
    edited, after = [[getattr(r, c) for r in got.values()] for c in ("near_edited", "near_next")]
    assert sum(edited) / len(edited) > 0.45 and sum(after) / len(after) < 0.05


def test_sentencepiece_matches_the_library(spark, docs):
    import sentencepiece
    processor = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer_path())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for d, text in texts(docs).items():
        ids = processor.encode(text)
        want[d] = (len(ids), sha(",".join(map(str, ids))), sha(processor.decode(ids)))
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op8_sentencepiece(spark, SF).collect()}
    assert got == want


def test_secret_scan_base_and_mix_match_python(spark, docs):
    want = {}
    for d, text in texts(docs).items():
        spans = brute.secret_spans(text)
        line = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in spans)
        want[d] = (*[sum(s[3] == k for s in spans) for k in ("assign", "access", "hex")], hashlib.sha256(line.encode()).hexdigest())
    got = {r.doc_id: (r.n_assign, r.n_access, r.n_hex, r.base_sha256) for r in queries.op2_secret_scan(spark, SF).collect()}
    assert got == want
    rows = [(r.doc_id, r.source, r.text) for r in docs.collect()]
    taken, size, goal = brute.mix(rows)
    mixed = {r.doc_id: r for r in queries.op5_source_mix(spark, SF).collect()}
    assert {d: r.taken for d, r in mixed.items()} == taken
    assert all(abs(r.target - goal[r.source]) < 1e-6 and r.taken <= 2 * r.size == 2 * size[r.doc_id] for r in mixed.values())


def test_toxicity_never_learns_from_held_out_rows(spark, docs):
    from pyspark.sql import functions as F
    labels = table(spark, SF, "labels")
    turned = labels.withColumn("toxic", F.when(toxicity.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = toxicity.learn_toxicity(docs, labels), toxicity.learn_toxicity(docs, turned)
    assert (a.keys == b.keys).all() and (a.toxic == b.toxic).all() and a.slope == b.slope and a.scale == b.scale
