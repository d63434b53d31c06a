"""SentencePiece encoding and decoding through a table of distinct chunks.

Where no piece of the model holds a whitespace marker after another character, segmentation
cannot cross the start of a marked word. A text is then cut before every marker that follows
another character, and each distinct chunk of the whole corpus is segmented once:

1. Every task cuts its documents into blocks of about ``BLOCK_CHUNKS`` chunks. A block sends its
   distinct chunks, in order of first use, in one packed row to each of ``parts`` parts of the table
   (by a hash of the chunk), and a row that says which chunk stands at which position.
2. A part of the table meets all rows of its chunks, segments a chunk when it is new, and
   answers every row with the ids.
3. The answers of a block meet its positions again; ids are joined back and decoded.

A part gets one row from a block however often a chunk occurs, so no frequent word makes a hot
task. A block ends after the document that fills it; a document of any length is within one block.
Chunks of more than ``MOST_CHUNK`` characters, and those of a part beyond ``MOST_CHARS``
characters, are segmented again for each block that holds them: the results are the same.
A model with pieces across markers is used on whole texts instead.
"""

from __future__ import annotations

import bz2
import hashlib
import re
import zlib
from array import array
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import shuffle_partitions, text_of

MARK = "▁"
MOST_CHUNKS = 400_000
MOST_CHARS = 64_000_000
MOST_CHUNK = 4096  # longer chunks are segmented anew each time, not kept
CHUNK = re.compile(f"[ {MARK}]+[^ {MARK}]*")
BLOCK_CHUNKS = 1 << 20
JOINED_ROWS = 500
POSITIONS = -1  # the part of a block's row of positions
PACKED = "slot int, block bigint, part int, packed binary, doc_ids array<bigint>, counts array<bigint>"
PACKED_ARROW = pa.schema([("slot", pa.int32()), ("block", pa.int64()), ("part", pa.int32()), ("packed", pa.binary()),
                          ("doc_ids", pa.list_(pa.int64())), ("counts", pa.list_(pa.int64()))])
RESULT = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"


class ChunkEncoder:
    """Encodes and decodes texts with a SentencePiece model through its chunk table."""

    def __init__(self, model: bytes, most_chunks: int = MOST_CHUNKS, most_chars: int = MOST_CHARS):
        import sentencepiece

        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.most_chunks, self.most_chars, self.chars = most_chunks, most_chars, 0
        pieces = [self.processor.id_to_piece(k) for k in range(self.processor.get_piece_size())]
        self.lone = self.processor.piece_to_id(MARK)
        self.separable = MARK in pieces and not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces) and self._plain()
        self.table: dict[str, tuple[int, str, str]] = {}

    def _plain(self) -> bool:
        """Whether the model puts a marker before a text and keeps all spaces."""
        sample = "a  b\n c"
        return self.processor.decode(self.processor.encode(sample)) == sample and self.processor.encode(" ") != self.processor.encode("")

    def ids(self, chunks: list[str]) -> list[list[int]]:
        """Ids of chunks, each of which begins with a marker: the model puts the first one
        before a text by itself."""
        found = self.processor.encode([c[1:] for c in chunks], num_threads=1) if chunks else []
        return [[self.lone] if len(c) == 1 else ids for c, ids in zip(chunks, found)]

    def segment(self, chunk: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text and the decoded text of a chunk."""
        (ids,) = self.ids([chunk])
        return len(ids), ",".join(map(str, ids)), " " + self.processor.decode(ids)

    def chunk(self, chunk: str) -> tuple[int, str, str]:
        found = self.table.get(chunk)
        if found is None:
            found = self.segment(chunk)
            if len(chunk) <= MOST_CHUNK:
                size = len(chunk) + len(found[1]) + len(found[2])
                if len(self.table) >= self.most_chunks or self.chars + size > self.most_chars:
                    self.table.clear()
                    self.chars = 0
                self.table[chunk] = found
                self.chars += size
        return found

    def run(self, text: str) -> tuple[int, str, str]:
        """Number of ids, the ids as text, and the decoded text."""
        if not self.separable:
            ids = self.processor.encode(text)
            return len(ids), ",".join(map(str, ids)), self.processor.decode(ids)
        if not text:
            return 0, "", ""
        get, new = self.table.get, self.chunk
        rows = [get(c) or new(c) for c in CHUNK.findall(" " + text)]
        return sum(r[0] for r in rows), ",".join([r[1] for r in rows]), "".join([r[2] for r in rows])[1:]


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays of whole numbers, each in the fewest bytes that hold its largest."""
    out = []
    for values in arrays:
        width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
        kept = values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
        out.append(np.array([len(values), width], "<u8").tobytes() + kept.tobytes())
    return bz2.compress(b"".join(out))


def _unpack(packed: bytes) -> list[np.ndarray]:
    raw, at, out = bz2.decompress(packed), 0, []
    while at < len(raw):
        n, width = (int(x) for x in np.frombuffer(raw, "<u8", 2, at))
        values = np.zeros((n, 8), np.uint8)
        values[:, :width] = np.frombuffer(raw, np.uint8, n * width, at + 16).reshape(n, width)
        out.append(values.view("<u8").reshape(-1).astype(np.int32))
        at += 16 + n * width
    return out


def pack_words(words: list[str]) -> bytes:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    sizes = _pack(lengths)
    return len(sizes).to_bytes(4, "little") + sizes + bz2.compress("".join(words).encode())


def unpack_words(packed: bytes) -> list[str]:
    end = 4 + int.from_bytes(packed[:4], "little")
    ends = np.cumsum(_unpack(packed[4:end])[0])
    text, starts = bz2.decompress(packed[end:]).decode(), np.concatenate([[0], ends[:-1]])
    return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist())]


def pack_block(number: dict[str, int], numbers: array, parts: int) -> tuple[dict[int, list[str]], bytes]:
    """Distinct chunks of a block by part, each list in order of first use, and the packed
    positions: whether a chunk is used for the first time, which earlier one it repeats, and
    the parts of the new ones. ``number`` counts the distinct chunks by first use, ``numbers``
    are those of the chunks in order."""
    codes = np.frombuffer(numbers, np.int32) if numbers else np.empty(0, np.int32)
    highest = np.maximum.accumulate(codes)
    new = np.ones(len(codes), bool)
    new[1:] = highest[1:] > highest[:-1]
    part_of = [zlib.crc32(c.encode()) % parts for c in number]
    lists: dict[int, list[str]] = {}
    for chunk, part in zip(number, part_of):
        lists.setdefault(part, []).append(chunk)
    return lists, _pack(np.array([len(codes)]), np.packbits(new).astype(np.int64), codes[~new], np.array(part_of, np.int64))


def join_back(positions: bytes, answers: dict[int, tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a block in order, and where those of each position end. ``answers`` holds the
    number of ids of each chunk of a part, and the ids."""
    (size,), flags, old, part_of = _unpack(positions)
    if {p: len(n) for p, (n, _) in answers.items()} != dict(zip(*(x.tolist() for x in np.unique(part_of, return_counts=True)))):
        raise RuntimeError("a block and its chunks differ: the documents came in another order when a task ran again")
    new = np.unpackbits(flags.astype(np.uint8))[:size].astype(bool)
    codes = np.empty(size, np.int32)
    codes[new], codes[~new] = np.arange(len(part_of)), old
    if not size:
        return codes, codes
    ordered = [answers[p] for p in sorted(answers)]
    by_part, ids = np.concatenate([n for n, _ in ordered]), np.concatenate([i for _, i in ordered])
    place = np.argsort(part_of, kind="stable")
    size_of, start = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    size_of[place], start[place] = by_part, np.cumsum(by_part) - by_part
    each = size_of[codes]
    ends = np.cumsum(each)
    return ids[np.repeat(start[codes] - (ends - each), each) + np.arange(ends[-1])], ends


def _blocks_task(parts: int, block_chunks: int):
    """Documents to packed rows of blocks."""
    def rows(place, doc_ids, counts, number, numbers):
        lists, positions = pack_block(number, numbers, parts)
        words = {part: pack_words(lists[part]) for part in lists}
        name = hashlib.blake2b(f"{TaskContext.get().partitionId()}:{place}".encode(), digest_size=8)
        for packed in (positions, *words.values()):
            name.update(packed)
        block = int.from_bytes(name.digest(), "little", signed=True)
        columns = [[*words, block % parts], [block] * (len(words) + 1), [*words, POSITIONS], [*words.values(), positions],
                   [None] * len(words) + [doc_ids], [None] * len(words) + [counts]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, PACKED_ARROW)], schema=PACKED_ARROW)

    def run(batches):
        place, doc_ids, counts, number, numbers = 0, [], [], defaultdict(count().__next__), array("i")
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                found = CHUNK.findall(" " + text) if text else []
                doc_ids.append(doc_id)
                counts.append(len(found))
                numbers.extend(map(number.__getitem__, found))
                if len(numbers) >= block_chunks or len(doc_ids) >= block_chunks:
                    yield rows(place, doc_ids, counts, number, numbers)
                    place, doc_ids, counts, number, numbers = place + 1, [], [], defaultdict(count().__next__), array("i")
        if doc_ids:
            yield rows(place, doc_ids, counts, number, numbers)

    return run


def _table_task(model_of):
    """Chunks of a part to ids; rows come part by part. Rows of positions pass."""
    def run(batches):
        encoder, slot, known, chars = ChunkEncoder(model_of.value), None, {}, 0
        for batch in batches:
            packed = batch.column(3).to_pylist()
            for k, (at, part) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist())):
                if part == POSITIONS:
                    continue
                if at != slot or chars > MOST_CHARS:
                    slot, known, chars = at, {}, 0
                words = unpack_words(packed[k])
                fresh = [w for w in words if w not in known]
                found = dict(zip(fresh, encoder.ids(fresh)))
                answer = [found[w] if w in found else known[w] for w in words]
                kept = {w: i for w, i in found.items() if len(w) <= MOST_CHUNK}
                known |= kept
                chars += sum(map(len, kept))
                packed[k] = _pack(np.fromiter(map(len, answer), np.int64, len(answer)), np.array([i for ids in answer for i in ids], np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(packed, pa.binary()), *batch.columns[4:]], schema=PACKED_ARROW)

    return run


def _join_task(finish):
    """Answers and positions, block by block and the positions first, to what ``finish`` makes of ids."""
    def run(batches):
        block, answers, held = None, {}, None

        def documents():
            ids, ends = join_back(held[0], answers)
            last = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(np.array(held[2], np.int64))])].tolist()
            for k in range(0, len(held[1]), JOINED_ROWS):
                bounds = last[k:k + JOINED_ROWS + 1]
                yield finish(held[1][k:k + JOINED_ROWS], [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])])

        for batch in batches:
            for row in zip(*(batch.column(c) for c in range(1, 6))):
                at, part, packed, doc_ids, counts = (x.as_py() for x in row)
                if part == POSITIONS:
                    if held:
                        yield from documents()
                    block, answers, held = at, {}, (packed, doc_ids, counts)
                elif at != block:
                    raise RuntimeError("chunks of a block without its positions: the documents came in another order when a task ran again")
                else:
                    answers[part] = tuple(_unpack(packed))
        if held:
            yield from documents()

    return run


def _digests(model_of):
    """Number of ids, their digest and that of the decoded text."""
    held = []

    def finish(doc_ids, ids):
        if not held:
            processor = ChunkEncoder(model_of.value).processor
            held.extend([processor, [str(k) for k in range(processor.get_piece_size())]])
        processor, names = held
        listed = [hashlib.sha256(",".join(map(names.__getitem__, i)).encode()).hexdigest() for i in ids]
        decoded = [hashlib.sha256(processor.decode(i).encode()).hexdigest() for i in ids]
        return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "n_tokens": pa.array(map(len, ids), pa.int64()),
                                           "ids_sha256": pa.array(listed, pa.string()), "decoded_sha256": pa.array(decoded, pa.string())})

    return finish


def _tokens(doc_ids, ids):
    return pa.RecordBatch.from_pydict({"doc_id": pa.array(doc_ids, pa.int64()), "ids": pa.array(ids, pa.list_(pa.int32()))})


def _whole_texts_task(model_of, finish):
    """For models with pieces across markers."""
    def run(batches):
        encoder = ChunkEncoder(model_of.value)
        for batch in batches:
            yield finish(batch.column(0).to_pylist(), [encoder.processor.encode(text) for text in batch.column(1).to_pylist()])

    return run


def model_bytes(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, model: bytes, id_col: str = "doc_id", text_col: str = "text", tokens: bool = False,
                     block_chunks: int = BLOCK_CHUNKS, parts: int | None = None) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256; with ``tokens`` doc_id
    and the ids themselves.

    A null text is empty and has no ids. Ids of documents are kept as they are, null and
    repeated ones too; other columns are ignored; an empty table gives an empty result. The
    model's bytes (a fixed half megabyte) go to every executor. ``parts`` (twice the shuffle
    partitions if not given) should grow with the number of distinct chunks: a task holds those of
    one part. ``docs`` is best read from files, whose rows come in the same order when a task runs
    again; a block that meets chunks of another order ends the job with an error.
    """
    spark = docs.sparkSession
    model_of = spark.sparkContext.broadcast(model)
    source = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), text_of(docs, text_col).alias("text"))
    finish, result = (_tokens, "doc_id bigint, ids array<int>") if tokens else (_digests(model_of), RESULT)
    if not ChunkEncoder(model).separable:
        return source.mapInArrow(_whole_texts_task(model_of, finish), result)
    slots = shuffle_partitions(spark)
    answered = (source.mapInArrow(_blocks_task(parts or 2 * slots, block_chunks), PACKED)
                .repartition(slots, "slot").sortWithinPartitions("slot", "block")
                .mapInArrow(_table_task(model_of), PACKED))
    return answered.repartition(slots, "block").sortWithinPartitions("block", "part").mapInArrow(_join_task(finish), result)
