"""Nearest neighbours, cross-tokenizer alignment and the conversation trie against brute force, and odd rows."""

import random
from collections import defaultdict

import numpy as np
import pytest

import brute
from liqspark.llm import alignment, neighbours, pieces, queries, trie
from liqspark.llm.tables import table

VECTORS = "vec_id bigint, embedding array<float>, label int"


# Nearest neighbours

def exact(rows, is_query, k=20):
    """{query: [(score, vec_id)]} of the k largest inner products, ties to the smaller id."""
    ids, x = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], float)
    out = {}
    for i in np.flatnonzero([is_query(v) for v in ids]):
        score = neighbours.inner_products(np.tile(x[i], (len(x), 1)), x)
        order = [j for j in np.lexsort((ids, -score)) if j != i][:k]
        out[int(ids[i])] = [(score[j], int(ids[j])) for j in order]
    return out


def found(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out[r.query_id]) + 1
        out[r.query_id].append((r.score, r.vec_id))
    return dict(out)


def recall(got, want):
    assert got.keys() == want.keys()
    return np.mean([len({v for _, v in want[q]} & {v for _, v in got[q]}) / max(1, len(want[q])) for q in want])


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_neighbours_recall_and_scores(spark, sf):
    df = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got, want = found(queries.op11_nearest_neighbours(spark, f"/root/testdata/{sf}")), exact(rows, lambda v: v % 20 == 0)
    assert recall(got, want) >= 0.9
    vectors = {v: np.array([e], float) for v, e in rows}
    for q, near in got.items():
        assert near == sorted(near, key=lambda n: (-n[0], n[1])) and len(near) == 20
        assert all(s == neighbours.inner_products(vectors[q], vectors[v])[0] for s, v in near)


def test_neighbours_of_unequal_lengths_and_a_hot_group(spark, monkeypatch):
    """Norms from 0.1 to 10, and a third of the rows almost one vector, in small blocks."""
    monkeypatch.setattr(neighbours, "BLOCK", 64)
    monkeypatch.setattr(neighbours, "HELD", 500)
    rng = np.random.default_rng(3)
    x = rng.normal(size=(1500, 16)) * np.exp(rng.uniform(-2.3, 2.3, size=(1500, 1)))
    x[:500] = x[0] + rng.normal(size=(500, 16)) * 1e-3
    rows = [(i, [float(np.float32(v)) for v in r]) for i, r in enumerate(x)]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).repartition(4)
    got = found(neighbours.nearest_neighbours(df))
    assert recall(got, exact(rows, lambda v: v % 20 == 0)) >= 0.9
    assert got == found(neighbours.nearest_neighbours(df.repartition(7)))  # arrival order changes nothing


def test_neighbours_ties_few_candidates_and_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1), (7, [1.0, 1.0], 1), (3, [1.0, 5.0], 1), (20, [-1.0, 2.0], 1), (20, [-1.0, 2.0], 1), (5, None, 1), (6, [0.0, 0.0], 1),
            (40, [nan, 1.0], 1), (60, [1.0, None], 1), (80, [inf, 1.0], 1), (None, [1.0, 1.0], 1), (100, [1.0, 2.0, 3.0], 1), (120, [], 1)]
    df = spark.createDataFrame(rows, VECTORS).withColumnRenamed("label", "bucket")
    got = found(neighbours.nearest_neighbours(df))
    assert got == {0: [(1.0, 3), (1.0, 7), (-1.0, 20)], 20: [(9.0, 3), (1.0, 7), (-1.0, 0)]}
    assert found(neighbours.nearest_neighbours(df, k=2))[0] == [(1.0, 3), (1.0, 7)]
    assert neighbours.nearest_neighbours(df.limit(0)).count() == 0
    assert neighbours.nearest_neighbours(df.where("vec_id = 0")).count() == 0


def test_visits_fall_in_chance_and_reach_the_target():
    at, seen = np.array([0.3, 5.9, -2.2]), list(neighbours.visits(np.array([0.3, 5.9, -2.2]), 2.0, 1.0, 0.9))
    chances = [c for _, c in seen[1:]]
    assert seen[0][0] == (0, 2, -2) and chances == sorted(chances, reverse=True)
    assert len({c for c, _ in seen}) == len(seen)
    rng = np.random.default_rng(1)
    cells = np.floor((at + rng.normal(size=(20000, 3))) / 2.0)
    assert abs(np.mean([tuple(c) in {s for s, _ in seen} for c in cells]) - 0.9) < 0.06


# Cross-tokenizer alignment

@pytest.fixture(scope="module")
def models():
    with open(queries.tokenizer_path("byte_bpe_50k.json"), encoding="utf-8") as f:
        byte_model = f.read()
    return byte_model, pieces.model_bytes(queries.tokenizer_path())


def libraries(models):
    import sentencepiece
    from tokenizers import Tokenizer

    a, b, alphabet = Tokenizer.from_str(models[0]), sentencepiece.SentencePieceProcessor(model_proto=models[1]), alignment.byte_alphabet()
    a.encode_special_tokens = True
    bytes_a = {k: bytes(alphabet.get(c, 0) for c in t) for t, k in a.get_vocab().items()}
    bytes_b = lambda k: bytes([int(b.id_to_piece(k)[3:5], 16)]) if b.is_byte(k) else b.id_to_piece(k).replace("▁", " ").encode()
    return a, b, bytes_a, bytes_b


PARTS = [" ", "  ", "\n", "\t", " ", "　", "\r\n", "a", "the", "é", "字", "😀", "'s", "'S", "1", "23", "…", "<s>", "<|endoftext|>", "<0x0A>", "▁",
         "xxxxxxx", "\x1c", "\x85", "​", "don't", "İ", "\x00", "A", "_", "--", "é"]


def test_alignment_of_odd_texts(spark, models, monkeypatch):
    """Against the libraries on whole texts; also in tiny blocks, and with every text cut into tiny parts."""
    rng = random.Random(5)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 14))) for _ in range(1500)] + [None, "", " ", "  ", "x" * 20000, "ab \n" * 3000, "the cat"] + ["the cat"] * 30
    df = spark.createDataFrame([(k % 1400, t, "x") for k, t in enumerate(texts)], "doc_id bigint, text string, block string").repartition(3)
    want = sorted(((k % 1400, *row) for k, row in enumerate(brute.aligned(texts, *libraries(models)))), key=repr)
    got = sorted((tuple(r) for r in alignment.align_tokenizers(df, *models, block_docs=100, block_links=700).collect()), key=repr)
    assert got == want and sum(r[1] == 0 for r in want) > 100
    aligner = alignment.Aligner(*models, run_bytes=3)
    whole = alignment.Aligner(*models)
    for text in texts:
        if text:
            (x,), (y,) = alignment.documents(aligner, [text]), alignment.documents(whole, [text])
            assert x.row() == y.row()
    assert any(len(aligner.parts(t)) > 3 for t in texts if t)


def test_alignment_query_is_the_brute_force(spark, models):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = docs.select("doc_id", "text").collect()
    want = sorted(((r.doc_id, *w) for r, w in zip(rows, brute.aligned([r.text for r in rows], *libraries(models)))), key=repr)
    assert sorted((tuple(r) for r in queries.op12_tokenizer_alignment(spark, "/root/testdata/sf0.001").collect()), key=repr) == want
    assert alignment.align_tokenizers(docs.limit(0), *models).count() == 0
    pairs = alignment.aligned_pairs(docs, *models)
    assert pairs.agg({"links": "sum"}).first()[0] == sum(w[4] for w in want)


def test_planes_hold_multiplicities():
    keys = np.array([7, 7, 9, 7, 9])
    docs, times = np.array([0, 1, 1, 4, 2]), np.array([1, 3, 2, 4, 1])
    rows = alignment.planes(keys, docs, times, 5)
    told = defaultdict(int)
    for pair, plane, dense, bits in zip(rows["pair"], rows["plane"], rows["dense"], rows["bits"]):
        who = np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")) if dense else np.frombuffer(bits, "<u2")
        for d in who:
            told[int(pair), int(d)] += 1 << int(plane)
    assert told == {(7, 0): 1, (7, 1): 3, (7, 4): 4, (9, 1): 2, (9, 2): 1}
    for pair, n, links in ((7, 3, 8), (9, 2, 3)):
        mine = rows["pair"] == pair
        assert rows["docs"][mine].sum() == n and rows["links"][mine].sum() == links


def test_wide_groups_are_counted_by_distinct_pairs(models, monkeypatch):
    text = "ab cd ab cd ab cd 字字字 " * 5
    (plain,) = alignment.documents(alignment.Aligner(*models), [text])
    monkeypatch.setattr(alignment, "WIDE", 0)
    (wide,) = alignment.documents(alignment.Aligner(*models), [text])
    assert plain.row() == wide.row() and [p.tolist() for p in plain.pairs[0]] == [p.tolist() for p in wide.pairs[0]]


# Conversation trie

def test_trie_of_hot_turns_and_odd_rows(spark):
    """Copies, a first turn that most share, long and turnless conversations, null ids, turns, roles and texts, equal
    turns, negative ids; also with shards of one node and a queue that spills."""
    rng = random.Random(2)
    rows = []
    for c in list(range(0, 160)) + [-5, -20, -21, 2 ** 62]:
        turns = [("user", "hello there")] if c % 3 else [("user", f"only {c}")]
        turns += [(rng.choice(["user", "bot"]), rng.choice(["yes", "no", "one two  three"])) for _ in range(rng.randrange(0, 5))]
        rows += [(c, k, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(200, k, "user", f"turn {k % 7}") for k in range(300)] + [(201, 0, "u", "x")] * 3
    rows += [(300, None, None, None), (300, -4, "a", "b"), (300, 2, "b", "z"), (300, 2, "a", "z"), (None, 1, "a", "b"), (302, 1, "a", "")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, depth int").repartition(5)
    want = brute.trie(rows)
    for shard, queue in ((512, 100_000), (40, 3), (1, 1)):
        if shard == 1:  # as many levels as the longest path has nodes: without the long conversation
            keep = [r for r in rows if r[0] != 200]
            got = trie.conversation_trie(df.where("conv_id <> 200 or conv_id is null"), shard=shard, queue=queue)
            assert sorted((tuple(r) for r in got.collect()), key=repr) == brute.trie(keep)
        else:
            few = [r for r in rows if r[0] != 200 or r[1] < 60]
            part = df.where("conv_id <> 200 or conv_id is null or turn < 60") if shard == 40 else df
            got = sorted((tuple(r) for r in trie.conversation_trie(part, shard=shard, queue=queue).collect()), key=repr)
            assert got == (brute.trie(few) if shard == 40 else want)
    assert trie.conversation_trie(df.limit(0)).count() == 0


def test_spilling_queue_is_in_order():
    rng, queue, out = random.Random(4), trie.SpillingQueue(most=7), []
    items = [(rng.randrange(50), k) for k in range(300)]
    for k, item in enumerate(items):
        queue.push(item)
        if k % 5 == 4:
            assert queue.head() == min(set(items[:k + 1]) - set(out))
            out.append(queue.pop())
    while queue.head():
        out.append(queue.pop())
    assert sorted(out) == sorted(items) and len(queue.runs) == 0
