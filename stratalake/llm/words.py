"""Words of many texts at once, as numpy arrays over the UTF-8 bytes of an Arrow column.

Used inside tasks only. A word is a run of bytes outside ``\\x20 \\x09-\\x0D``; no UTF-8 byte
of a longer character is one of these, so words may be cut on bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text worked on at once; a longer single text is worked on alone.
CHUNK_BYTES = 4 << 20

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the finalizer of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Longer words, in bytes, are hashed one by one by BLAKE2.
LONG = 512
#: By number: a mask of so many low bytes.
LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
EIGHT = np.array([0x9E3779B97F4A7C15], dtype=np.uint64)


class Hasher:
    """64-bit hashes of words and of word n-grams, the same in every process for one seed.

    A word is folded eight bytes at a time through ``mix``, with its length: no sum or product of
    letters, which words of a regular shape could cancel. Words of up to eight bytes and one
    length never share a hash. An n-gram is folded from halves in the same way.
    """

    def __init__(self, seed: int, fold_case: bool = False) -> None:
        self.key = seed.to_bytes(8, "little")
        self.start = mix(np.array([seed], dtype=np.uint64) + EIGHT)
        self.fold = np.arange(256, dtype=np.uint8)
        if fold_case:
            self.fold[ord("A") : ord("Z") + 1] += 32

    def words(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        data = np.append(self.fold[data], np.zeros(8, np.uint8))
        eight = np.ndarray(len(data) - 7, dtype="<u8", buffer=data, strides=(1,))  # the eight bytes at each place
        out = mix(size.astype(np.uint64) + self.start)
        left, at = np.flatnonzero(size <= LONG), 0
        while len(left):
            rest = size[left] - at
            block = eight[start[left] + at] & LOW[np.minimum(rest, 8)]
            out[left] = mix((out[left] ^ block) * EIGHT)
            left, at = left[rest > 8], at + 8
        for i in np.flatnonzero(size > LONG).tolist():
            digest = hashlib.blake2b(data[start[i] : end[i]].tobytes(), digest_size=8, key=self.key).digest()
            out[i] = int.from_bytes(digest, "little")
        return out

    def grams(self, words: np.ndarray, start: np.ndarray, n) -> np.ndarray:
        """Hash of the ``n`` words that start at each position; ``n`` may be an array."""
        if isinstance(n, np.ndarray):
            out = np.zeros(len(start), np.uint64)
            for many in np.unique(n).tolist():
                out[n == many] = self.grams(words, start[n == many], many)
            return out
        if not len(start):
            return np.zeros(0, np.uint64)
        hashes, reach = words, 1
        while 2 * reach <= n:
            hashes = mix(hashes[: len(hashes) - reach] * EIGHT ^ hashes[reach:])
            reach *= 2
        # two stretches that overlap cover the rest
        return mix((hashes[start] + self.start) * EIGHT ^ hashes[start + n - reach])


@dataclass
class Texts:
    """Some texts and their words. ``first`` has one entry more than there are texts."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    def positions(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where a run of ``n`` words of one text starts, and the number of runs per text."""
        runs = np.maximum(np.diff(self.first) - n + 1, 0)
        skip = np.repeat(self.first[:-1] - (np.cumsum(runs) - runs), runs)
        return np.arange(len(skip)) + skip, runs


def split_words(text: pa.Array) -> Texts:
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + len(text) + 1]
    buffer = text.buffers()[2]
    data = np.frombuffer(buffer, dtype=np.uint8) if buffer else np.zeros(0, dtype=np.uint8)
    data, offsets = data[offsets[0] : offsets[-1]], offsets - offsets[0]
    inside = ~SPACE[data]
    after = np.ones(len(data) + 1, dtype=bool)  # a word may start, or has ended, here
    after[1:] = ~np.append(inside, False)[:-1] if len(data) else True
    after[offsets] = True
    start = np.flatnonzero(inside & after[:-1])
    closed = np.append(~inside, True)
    closed[offsets] = True
    end = np.flatnonzero(inside & closed[1:]) + 1
    return Texts(data, start, end, np.searchsorted(start, offsets))


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches cut so that each holds about ``most`` bytes of text, or one text."""
    for batch in batches:
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(size, dtype=np.int64)
        at = 0
        while at < len(total):
            before = total[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(at, to - at)
            at = to
