"""Cross-tokenizer alignment through inverted pair bitmaps.

Both tokenizers read a space and the text. Byte offsets where tokens of both end cut the tokens into
groups; all token occurrences A x B of a group are links. For every pair of ids the documents that hold
it linked are counted over the corpus, and the counts return to the documents.

1. Texts are taken in runs of about a megabyte, and the tokens of a run are grouped and linked by
   array operations on their byte offsets. A longer text is cut at spaces after another character than
   white space, which neither tokenizer puts a token across (checked when the models are
   loaded; otherwise it is taken whole).
2. A task numbers its documents in blocks of at most ``BLOCK_DOCS``. For every pair of a
   block it writes bit planes over the block's documents: plane k holds those whose number of links
   of the pair has bit k set. A plane is a sorted list of 16-bit numbers or, where that is
   shorter, a bitmap. The OR of a pair's planes has as many bits as documents hold the pair; the
   planes' bits, times two to the k, are its links. Blocks are disjoint, so both add up over blocks.
3. The postings (planes) meet their pair's score and go back to their block, where they
   are added up per document.

Memory follows the run, the block and the longest stretch without a space.
"""

from __future__ import annotations

import hashlib
import json
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .pieces import MARK, ChunkEncoder
from .tables import Scratch, text_of

CUT = re.compile(r"(?<=\S) ")  # neither tokenizer puts a token across
RUN_BYTES = 1 << 20  # text that is worked on at a time
BLOCK_DOCS = 8192
BLOCK_LINKS = 1 << 21  # linked pairs of a block before it is written
WIDE = 1 << 12  # links of a group from which only its distinct pairs are listed
# The word pattern of a byte-level pre-tokenizer (fixed value).
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

ROW = ("doc_id bigint, block bigint, place int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
       "pair bigint, plane int, dense boolean, bits binary, docs bigint, links bigint")
SUMS = "block bigint, place int, n_best bigint, count_sum bigint"


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in a byte-level vocabulary: itself where it
    prints, the next ones from U+0100 for the others, in order."""
    prints = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in prints]
    return {chr(b): b for b in prints} | {chr(0x100 + k): b for k, b in enumerate(others)}


class Vocabulary:
    """Bytes and lengths of a tokenizer's entries."""

    def __init__(self, entries: list[bytes]):
        self.length = np.array([len(e) for e in entries], np.int64)
        self.data = np.frombuffer(b"".join(entries), np.uint8)
        self.start = np.cumsum(self.length) - self.length

    def joined(self, ids: np.ndarray) -> np.ndarray:
        """The bytes of tokens one after another."""
        size = self.length[ids]
        return self.data[np.repeat(self.start[ids] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


class Aligner:
    """Encodes runs of texts with both tokenizers and links their tokens."""

    def __init__(self, byte_model: str, piece_model: bytes, run_bytes: int = RUN_BYTES):
        model, alphabet = json.loads(byte_model), byte_alphabet()
        vocab = model["model"]["vocab"]
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        entries = {k: bytes(alphabet[c] for c in t) for t, k in vocab.items() if t not in special}
        self.encode_a = self._ranked(model, entries) or self._library(byte_model)
        every = max([*entries, *special.values()]) + 1
        self.a = Vocabulary([entries.get(k, b"") for k in range(every)])
        pieces = ChunkEncoder(piece_model)
        self.processor, self.lone, self.n_b = pieces.processor, pieces.lone, pieces.processor.get_piece_size()
        self.b = Vocabulary([self._piece_bytes(k) for k in range(self.n_b)])
        self.separable = pieces.separable and self._plain(model)
        self.run_bytes = run_bytes
        left, right = [str(k) for k in range(every)], [str(k) for k in range(self.n_b)]
        # What a token writes: "id," inside its side of a group, "id|" at the end of A's, "id;" at the end of B's.
        self.written = [x + e for side, ends in ((left, ",|"), (right, ",;")) for e in ends for x in side]

    @staticmethod
    def _plain(model: dict) -> bool:
        before = model.get("pre_tokenizer") or {}
        return model.get("normalizer") is None and before.get("type") == "ByteLevel" and before.get("use_regex", True)

    def _ranked(self, model: dict, entries: dict[int, bytes]):
        """Encoding by ranks where the model merges in the order of its ids: the same ids, sooner."""
        vocab, merges = model["model"]["vocab"], model["model"]["merges"]
        made = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in merges]
        if not self._plain(model) or made != sorted(made) or model["model"].get("ignore_merges"):
            return None
        import tiktoken

        ranks = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks={e: k for k, e in entries.items()}, special_tokens={})
        return lambda texts: [ranks.encode_ordinary(t) for t in texts]

    @staticmethod
    def _library(byte_model: str):
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores belong to Spark's tasks
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_str(byte_model)
        tokenizer.encode_special_tokens = True
        return lambda texts: [e.ids for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _piece_bytes(self, k: int) -> bytes:
        piece = self.processor.id_to_piece(k)
        return bytes([int(piece[3:5], 16)]) if self.processor.is_byte(k) else piece.replace(MARK, " ").encode()

    def parts(self, text: str) -> list[str]:
        """A space and the text, in parts of about ``run_bytes`` characters that begin with a space."""
        whole, out, at = " " + text, [], 0
        while self.separable and len(whole) - at > self.run_bytes and (cut := CUT.search(whole, at + self.run_bytes)):
            out.append(whole[at:cut.start()])
            at = cut.start()
        return [*out, whole[at:]]

    def runs(self, texts):
        """(numbers, parts) of runs of about ``run_bytes`` characters; a long text's parts follow each other."""
        numbers, held, size = [], [], 0
        for k, text in enumerate(texts):
            for part in self.parts(text) if text else []:
                numbers.append(k)
                held.append(part)
                size += len(part)
                if size >= self.run_bytes:
                    yield numbers, held
                    numbers, held, size = [], [], 0
        if held:
            yield numbers, held

    def align(self, parts: list[str]):
        """For each part (tokens A, tokens B, groups, links) and the groups as text, or None where the bytes of
        either tokenizer differ; then part, pair and links of all pairs, a pair as often as groups hold it."""
        raw = [p.encode() for p in parts]
        a_ids, b_ids = self.encode_a(parts), self.processor.encode([p[1:] for p in parts], num_threads=1)
        b_ids = [ids if len(p) > 1 else [self.lone] for p, ids in zip(parts, b_ids)]
        good = []
        for k, (a, b) in enumerate(zip(a_ids, b_ids)):
            a_ids[k], b_ids[k] = a, b = np.array(a, np.int64), np.array(b, np.int64)
            want = np.frombuffer(raw[k], np.uint8)
            if all(v.length[i].sum() == len(want) and np.array_equal(v.joined(i), want) for v, i in ((self.a, a), (self.b, b))):
                good.append(k)
        found: list = [None] * len(parts)
        if not good:
            return found, *[np.zeros(0, np.int64)] * 3
        a, b = np.concatenate([a_ids[k] for k in good]), np.concatenate([b_ids[k] for k in good])
        of_a, of_b = (np.repeat(np.arange(len(good)), [len(ids[k]) for k in good]) for ids in (a_ids, b_ids))
        end_a, end_b = np.cumsum(self.a.length[a]), np.cumsum(self.b.length[b])
        mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
        mark[end_a] = 1
        mark[end_b] += 1
        last_a, last_b = mark[end_a] == 2, mark[end_b] == 2  # the tokens that end a group
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        size_a, size_b = np.bincount(group_a), np.bincount(group_b)
        first_a, first_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b

        # Groups as text: tokens of A and B in the order they are written.
        n_a, text = len(self.a.length), np.empty(len(a) + len(b), np.int64)
        text[np.arange(len(a)) + first_b[group_a]] = a + np.where(last_a, n_a, 0)
        text[np.arange(len(b)) + (first_a + size_a)[group_b]] = b + 2 * n_a + np.where(last_b, self.n_b, 0)
        per = np.bincount(of_a, minlength=len(good)) + np.bincount(of_b, minlength=len(good))
        group_of = of_a[last_a]
        products = size_a * size_b
        counts = np.stack([np.bincount(of_a, minlength=len(good)), np.bincount(of_b, minlength=len(good)), np.bincount(group_of, minlength=len(good)),
                           np.add.reduceat(products, np.searchsorted(group_of, np.arange(len(good))))], axis=1).tolist()
        written, at = self.written, 0
        for row, k in enumerate(good):
            found[k] = counts[row], "".join([written[x] for x in text[at:at + per[row]].tolist()])[:-1]
            at += per[row]

        # Links: every token of A with all of its group in B; wide groups by their distinct pairs.
        wide = products > WIDE
        own = np.flatnonzero(~wide[group_a])
        size = size_b[group_a[own]]
        other = np.repeat(first_b[group_a[own]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        part, pair = [np.repeat(of_a[own], size)], [(np.repeat(a[own], size) << 32) + b[other]]
        times = [np.ones(len(other), np.int64)]
        for g in np.flatnonzero(wide):
            (x, m), (y, n) = (np.unique(t[f:f + s], return_counts=True) for t, f, s in ((a, first_a[g], size_a[g]), (b, first_b[g], size_b[g])))
            part.append(np.full(len(x) * len(y), group_of[g]))
            pair.append(np.add.outer(x << 32, y).ravel())
            times.append(np.multiply.outer(m, n).ravel())
        return found, np.array(good)[np.concatenate(part)], np.concatenate(pair), np.concatenate(times)


def added(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, sorted, with the sums of their values."""
    order = np.argsort(keys, kind="stable")
    keys, values = keys[order], values[order]
    edge = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    return keys[edge], np.add.reduceat(values, edge) if len(edge) else values


def planes(keys: np.ndarray, docs: np.ndarray, times: np.ndarray, n_docs: int):
    """Rows (pair, plane, dense, bits, docs, links) of a block's (pair, document, links)."""
    order = np.argsort(keys, kind="stable")  # documents stay in order
    keys, docs, times = keys[order], docs[order].astype("<u2"), times[order]
    held = {k: [] for k in ("pair", "plane", "dense", "bits", "docs", "links")}
    lowest = np.zeros(len(keys), bool)
    lowest[np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))] = True
    edge = np.flatnonzero(lowest)
    present = np.diff(np.append(edge, len(keys)))  # bits of the OR of all planes
    told = np.zeros(len(edge), bool)
    number = np.cumsum(lowest) - 1
    plane = 0
    while (times >> plane).any():
        hit = np.flatnonzero((times >> plane) & 1)
        if len(hit):
            mine = number[hit]
            cut = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
            pair, end = mine[cut], np.append(cut[1:], len(hit))
            data, size = docs[hit], end - cut
            raw = data.tobytes()
            dense = 2 * size > (n_docs + 7) // 8
            for k, (a, b) in enumerate(zip(cut.tolist(), end.tolist())):
                if dense[k]:
                    bits = np.zeros(n_docs, np.uint8)
                    bits[data[a:b]] = 1
                    held["bits"].append(np.packbits(bits, bitorder="little").tobytes())
                else:
                    held["bits"].append(raw[2 * a:2 * b])
            held["pair"].append(keys[edge[pair]])
            held["plane"].append(np.full(len(pair), plane, np.int32))
            held["dense"].append(dense)
            held["docs"].append(np.where(told[pair], 0, present[pair]))
            held["links"].append(size.astype(np.int64) << plane)
            told[pair] = True
        plane += 1
    return {k: v if k == "bits" else np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in held.items()}


SCHEMA = pa.schema([("doc_id", pa.int64()), ("block", pa.int64()), ("place", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                    ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pair", pa.int64()), ("plane", pa.int32()),
                    ("dense", pa.bool_()), ("bits", pa.binary()), ("docs", pa.int64()), ("links", pa.int64())])


def _batch(n: int, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in SCHEMA], schema=SCHEMA)


def _posting_batches(block: int, found: list, n_docs: int):
    if not found:
        return
    keys, docs, times = (np.concatenate(c) for c in zip(*found))
    rows = planes(keys, docs, times, n_docs)
    n = len(rows["bits"])
    for at in range(0, n, 20_000):
        part = {k: v[at:at + 20_000] for k, v in rows.items()}
        size = len(part["bits"])
        yield _batch(size, part | {"block": np.full(size, block, np.int64)})


class Document:
    """What is known of a text so far, part by part."""

    def __init__(self):
        self.total, self.state, self.good, self.begun = np.zeros(4, np.int64), hashlib.sha256(), True, False
        self.pairs: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, found) -> None:
        if found is None:
            self.good, self.pairs = False, []
        elif self.good:
            self.total += found[0]
            self.state.update((";" if self.begun else "").encode() + found[1].encode())
            self.begun = True

    def row(self) -> list:
        return [*self.total.tolist(), self.state.hexdigest()] if self.good and self.begun else [0, 0, 0, 0, ""]


class Block:
    """Documents of a task and their pairs, up to the block's bounds."""

    def __init__(self, number: int):
        self.number, self.rows, self.found, self.links = number, [], [], 0

    def add(self, doc_id, document: Document) -> None:
        if document.good:
            for pair, times in document.pairs:
                self.found.append((pair, np.full(len(pair), len(self.rows), np.int64), times))
                self.links += len(pair)
        self.rows.append([doc_id, self.number, len(self.rows), *document.row()])

    def batches(self):
        names = ["doc_id", "block", "place", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
        if self.rows:
            yield _batch(len(self.rows), dict(zip(names, zip(*self.rows))))
            yield from _posting_batches(self.number, self.found, len(self.rows))


def documents(aligner: Aligner, texts: list[str]):
    """A ``Document`` for every text in turn."""
    done, open_ = 0, Document()
    for numbers, parts in aligner.runs(texts):
        found, part, pair, times = aligner.align(parts)
        order = np.argsort(part, kind="stable")
        part, pair, times = part[order], pair[order], times[order]
        cut = np.searchsorted(part, np.arange(len(parts) + 1))
        for k, (number, one) in enumerate(zip(numbers, found)):
            while done < number:
                yield open_
                done, open_ = done + 1, Document()
            open_.add(one)
            if open_.good:
                open_.pairs.append(added(pair[cut[k]:cut[k + 1]], times[cut[k]:cut[k + 1]]))
                if len(open_.pairs) > 1:
                    open_.pairs = [added(*(np.concatenate(c) for c in zip(*open_.pairs)))]
    while done < len(texts):
        yield open_
        done, open_ = done + 1, Document()


def _align_task(models_of, block_docs: int, block_links: int):
    """A row for every document, and the postings of each block of them."""
    def run(batches):
        aligner, number = None, 0
        block = Block(TaskContext.get().partitionId() << 24)
        for batch in batches:
            aligner = aligner or Aligner(*models_of.value)
            ids = batch.column(0).to_pylist()
            for doc_id, document in zip(ids, documents(aligner, batch.column(1).to_pylist())):
                block.add(doc_id, document)
                if len(block.rows) >= block_docs or block.links >= block_links:
                    yield from block.batches()
                    block = Block(block.number + 1)
        yield from block.batches()

    return run


def _return_task(batches):
    """Scores added up per document; rows (block, plane, dense, bits, count, best) sorted by block."""
    block, sums = None, np.zeros((2, 0), np.int64)

    def out():
        n = sums.shape[1]
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, block, np.int64)), pa.array(np.arange(n, dtype=np.int32)), pa.array(sums[0]), pa.array(sums[1])],
                                          names=["block", "place", "n_best", "count_sum"])

    for batch in batches:
        blocks, plane, dense = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy(zero_copy_only=False)
        count, best = batch.column(4).to_numpy(), batch.column(5).to_numpy(zero_copy_only=False).astype(np.int64)
        cut = np.flatnonzero(np.append(True, blocks[1:] != blocks[:-1])) if len(blocks) else []
        for a, b in zip(cut, np.append(cut[1:], len(blocks)) if len(blocks) else []):
            if blocks[a] != block:
                if block is not None:
                    yield out()
                block, sums = int(blocks[a]), np.zeros((2, 0), np.int64)
            bits = batch.column(3).slice(a, b - a).to_pylist()
            lists = np.flatnonzero(~dense[a:b])
            who = np.frombuffer(b"".join([bits[k] for k in lists]), "<u2")
            size = np.array([len(bits[k]) // 2 for k in lists], np.int64)
            places, weights = [who.astype(np.int64)], [np.repeat(lists + a, size)]
            for k in np.flatnonzero(dense[a:b]):
                one = np.flatnonzero(np.unpackbits(np.frombuffer(bits[k], np.uint8), bitorder="little"))
                places.append(one)
                weights.append(np.full(len(one), k + a))
            place, row = np.concatenate(places), np.concatenate(weights)
            n = int(place.max()) + 1 if len(place) else 0
            if n > sums.shape[1]:
                sums = np.concatenate([sums, np.zeros((2, n - sums.shape[1]), np.int64)], axis=1)
            times = np.left_shift(1, plane[row].astype(np.int64))
            np.add.at(sums[0], place, times * best[row])
            np.add.at(sums[1], place, times * count[row])
    if block is not None:
        yield out()


def _postings(docs: DataFrame, byte_model: str, piece_model: bytes, id_col: str, text_col: str, block_docs: int, block_links: int) -> DataFrame:
    models_of = docs.sparkSession.sparkContext.broadcast((byte_model, piece_model))
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(docs, text_col).alias("text"))
    return source.mapInArrow(_align_task(models_of, block_docs, block_links), ROW)


def _scores(postings: DataFrame) -> DataFrame:
    """One row per pair: pair, a, b, count (documents), links, best (whether no pair of its A id has more documents)."""
    counts = postings.groupBy("pair").agg(F.sum("docs").alias("count"), F.sum("links").alias("links"))
    counts = counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(F.lit((1 << 32) - 1))})
    most = counts.groupBy("a").agg(F.max("count").alias("most"))
    return counts.join(most, "a").select("pair", "a", "b", "count", "links", (F.col("count") == F.col("most")).alias("best"))


def aligned_pairs(docs: DataFrame, byte_model: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The linked pairs of ids over all documents: a, b, count (documents), links, best."""
    return _scores(_postings(docs, byte_model, piece_model, id_col, text_col, BLOCK_DOCS, BLOCK_LINKS).where("pair is not null")).drop("pair")


def align_tokenizers(docs: DataFrame, byte_model: str, piece_model: bytes, id_col: str = "doc_id", text_col: str = "text",
                     block_docs: int = BLOCK_DOCS, block_links: int = BLOCK_LINKS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    ``byte_model`` is the JSON of a byte-level BPE, ``piece_model`` the bytes of a SentencePiece
    model that puts a space before a text. Texts that are null, empty or that a tokenizer doesn't give
    back byte for byte have no tokens: zeros and ''. Every row is a document of its own, so repeated rows
    count each and null ids stay; other columns are ignored; an empty table gives an empty result.
    """
    scratch = Scratch()
    rows = scratch.table(_postings(docs, byte_model, piece_model, id_col, text_col, block_docs, block_links), "postings")
    postings = rows.where("pair is not null")
    scores = scratch.table(_scores(postings).select("pair", "count", "best"), "scores")
    scored = postings.select("pair", "block", "plane", "dense", "bits").join(scores, "pair")
    back = (scored.repartition("block").sortWithinPartitions("block").select("block", "plane", "dense", "bits", "count", "best")
            .mapInArrow(_return_task, SUMS))
    return (rows.where("place is not null").join(back, ["block", "place"], "left")
            .select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", F.lit(0)).alias("n_best"),
                    F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
