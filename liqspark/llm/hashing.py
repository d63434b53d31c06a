"""Vectorised hashing of words, shingles and byte windows for use inside Arrow tasks.

All hashes are 64-bit and depend only on the bytes, so tasks, retries and sessions agree.
Texts are handled in slices of about one megabyte cut at word ends; memory therefore
follows the longest word or the longest text, not the Arrow batch.
"""

from __future__ import annotations

import numpy as np

SLICE_BYTES = 1 << 20
U64 = np.uint64
BASE = U64(0x9E3779B97F4A7C15)
BASE_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# The white space that separates words: space and 0x09 to 0x0D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

# Everything in ASCII but letters and digits; bytes of multi-byte characters belong to words.
NOT_ALNUM = np.ones(256, dtype=bool)
NOT_ALNUM[0x80:] = False
NOT_ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = False


def mix(x):
    """Finalise 64-bit values (xor-shift and multiply, as in splitmix64)."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * BASE)


class PrefixHasher:
    """Polynomial prefix hashes of byte slices; powers are kept between slices."""

    def __init__(self):
        self.up = self.down = np.ones(0, dtype=np.uint64)

    def powers(self, n: int):
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 4096)
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                p = np.full(size, base, dtype=np.uint64)
                p[0] = U64(1)
                setattr(self, name, np.multiply.accumulate(p))
        return self.up, self.down

    def prefix(self, data: np.ndarray) -> np.ndarray:
        """``len(data) + 1`` running sums; see ``span``."""
        up, _ = self.powers(len(data) + 1)
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
        return sums

    def span(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of the bytes ``[start, end)``, the same wherever they stand."""
        _, down = self.powers(len(sums))
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64))


def slices(data: np.ndarray, separator: np.ndarray, size: int = SLICE_BYTES):
    """(start, end) of slices of about ``size`` bytes that end before a separator."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + size)
        while end < n and not separator[data[end]]:
            ahead = separator[data[end:end + size]]
            end += int(ahead.argmax()) if ahead.any() else len(ahead)
        yield at, end
        at = end


def words(data: np.ndarray, hasher: PrefixHasher, separator: np.ndarray = WHITE, heads=()):
    """Hash, start and end of every word, and for each length in ``heads`` the hash of the
    word's first so many bytes."""
    found = []
    for at, end in slices(data, separator):
        part = data[at:end]
        inside = ~separator[part]
        edge = np.diff(np.concatenate(([False], inside, [False])).view(np.int8))
        start, stop = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = hasher.prefix(part)
        row = [hasher.span(sums, start, stop), start + at, stop + at]
        row += [hasher.span(sums, start, np.minimum(stop, start + k)) for k in heads]
        found.append(row)
    if not found:
        empty = np.zeros(0, dtype=np.int64)
        return [empty.astype(np.uint64), empty, empty] + [empty.astype(np.uint64) for _ in heads]
    return [np.concatenate(x) for x in zip(*found)]


def groups(texts: list[bytes], size: int = SLICE_BYTES):
    """(first, texts) for runs of texts that hold about ``size`` bytes together."""
    first, held, total = 0, [], 0
    for k, text in enumerate(texts):
        held.append(text)
        total += len(text) + 1
        if total >= size:
            yield first, held
            first, held, total = k + 1, [], 0
    if held:
        yield first, held


def joined(texts: list[bytes]):
    """The texts in one byte array, a newline after each, and the start of each."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return data, ends - np.array([len(t) + 1 for t in texts])


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words (across texts too; callers mask)."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    total = np.full(n, U64(width), dtype=np.uint64)
    for k in range(width):
        factor = U64((0xD6E8FEB86659FD93 * (2 * k + 1) + 2 * k) & 0xFFFFFFFFFFFFFFFF | 1)
        total += hashes[k:k + n] * factor
    return mix(total)


def shingle_sets(texts: list[bytes], width: int, hasher: PrefixHasher) -> list[np.ndarray]:
    """Sorted distinct shingles of each text: runs of ``width`` words of the A-Z-lowered
    text; a text with fewer words has its whole sequence as its one shingle."""
    out: list[np.ndarray] = []
    for _, part in groups(texts):
        data, begins = joined([t.lower() for t in part])
        hashes, start, _ = words(data, hasher)
        first = np.searchsorted(start, np.append(begins, len(data)))
        runs = windows(hashes, width)
        for a, b in zip(first[:-1], first[1:]):
            if b - a >= width:
                out.append(np.unique(runs[a:b - width + 1]))
            elif b > a:
                out.append(windows(hashes[a:b], b - a))
            else:
                out.append(np.zeros(0, dtype=np.uint64))
    return out
