"""Byte-level BPE encoding and decoding of whole texts.

The vocabulary is a ``tokenizers`` JSON file, named by a path that executors read from their own
installation; only ranks and ids are taken from it, the algorithm is here. A short word is held
as a contiguous array of part boundaries with the rank of each neighbouring pair beside it: the
smallest rank is found by a scan, its boundary is deleted, and the two ranks next to it are
looked up again. The words that a block of texts brings for the first time go through these
steps side by side, a row of one array each. A long word would make the scans quadratic, so it keeps its pairs in a heap.

Text is cut as the file's byte-level pre-tokenizer does; special tokens in a text are cut out
first and get their own id. Letters and digits are those of the ``regex`` package; characters
that Unicode added after version 15 may be cut otherwise than by an older library. Null text: no ids, decoded as empty. Each row is encoded by itself,
so repeated rows and ids do no harm.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.words import chunks

#: Fixed value: how a byte-level pre-tokenizer cuts text.
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of up to so many bytes are merged together; longer ones by themselves, with a heap.
SHORT = (8, 16, 32, 64)
#: Encoded words a task remembers before it starts again.
REMEMBERED = 300_000
NO_RANK = (1 << 31) - 1


def byte_letters() -> dict[int, str]:
    """The printable letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(other)}


class BytePairs:
    """Encoder and decoder of one vocabulary file; made once per task."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        vocab = content["model"]["vocab"]
        letters = byte_letters()
        bytes_of = {letter: byte for byte, letter in letters.items()}
        merges = [(vocab[left], vocab[right], vocab[left + right]) for left, right in content["model"]["merges"]]
        self.single = np.array([vocab[letters[b]] for b in range(256)], np.int32)
        self.rank = {(left, right): rank for rank, (left, right, _) in enumerate(merges)}
        self.merged = np.array([new for *_, new in merges], np.int32)
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.bytes = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, at in vocab.items():
            self.bytes[at] = bytes(bytes_of[c] for c in token)
        for token, at in self.special.items():
            self.bytes[at] = token.encode()
        keys = np.array([left * len(self.bytes) + right for left, right, _ in merges])
        self.key_rank = np.argsort(keys)
        self.keys = keys[self.key_rank]
        self.decimal = [str(at) for at in range(len(self.bytes))]
        longest_first = sorted(self.special, key=len, reverse=True)
        self.cut_special = regex.compile("|".join(map(regex.escape, longest_first))) if self.special else None
        self.find_words = regex.compile(CUT).findall
        self.known: dict[str, tuple[int, ...]] = {}

    def encode(self, text: str) -> list[int]:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[list[int]]:
        """Ids per text. Words not met before are merged together, whatever text they are in."""
        pieces = [self._pieces(text) for text in texts]
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        fresh = list({w for words in chain.from_iterable(pieces) if type(words) is list for w in words if w not in known})
        known.update(zip(fresh, self.merge([w.encode() for w in fresh])))
        get = known.__getitem__
        return [
            list(chain.from_iterable((x,) if type(x) is int else chain.from_iterable(map(get, x)) for x in parts))
            for parts in pieces
        ]

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")

    def _pieces(self, text: str) -> list:
        """The words between special tokens, as lists, and the ids of these tokens."""
        if not any(token in text for token in self.special):
            return [self.find_words(text)]
        pieces, at = [], 0
        for hit in self.cut_special.finditer(text):
            pieces += [self.find_words(text[at : hit.start()]), self.special[hit[0]]]
            at = hit.end()
        return [*pieces, self.find_words(text[at:])]

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        out: list = [None] * len(words)
        size = np.fromiter(map(len, words), np.int64, len(words))
        for low, high in zip((0, *SHORT), SHORT):  # words of about one length share a matrix
            at = np.flatnonzero((size > low) & (size <= high))
            for i in range(0, len(at), 1 << 15):
                self._scan(words, at[i : i + (1 << 15)], size, out)
        for i in np.flatnonzero(size > SHORT[-1]):
            out[i] = tuple(self._heap([self.single[b] for b in words[i]]))
        return out

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left.astype(np.int64) * len(self.bytes) + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.key_rank[at], NO_RANK)

    def _scan(self, words: list[bytes], at: np.ndarray, size: np.ndarray, out: list) -> None:
        """One row per word: its part ids without gaps, and the rank of each neighbouring pair."""
        size = size[at]
        ids = np.full((len(at), size.max() + 1), -1, np.int32)
        ids[np.arange(ids.shape[1]) < size[:, None]] = self.single[np.frombuffer(b"".join([words[i] for i in at]), np.uint8)]
        ranks = self._ranks(ids[:, :-1], ids[:, 1:])
        while len(at):
            least = ranks.argmin(1)
            rank = ranks[np.arange(len(at)), least]
            done = rank == NO_RANK
            if done.any():
                for i, row in zip(at[done].tolist(), ids[done].tolist()):
                    out[i] = tuple(row[: row.index(-1)])
                going = ~done
                at, ids, ranks, least, rank = at[going], ids[going], ranks[going], least[going], rank[going]
                if not len(at):
                    break
            row, behind = np.arange(len(at)), np.arange(ids.shape[1] - 1) >= least[:, None]
            ids[row, least] = self.merged[rank]
            later = behind & (np.arange(ids.shape[1] - 1) > least[:, None])
            ids[:, :-1] = np.where(later, ids[:, 1:], ids[:, :-1])
            ids[:, -1] = -1
            ranks[:, :-1] = np.where(behind[:, :-1], ranks[:, 1:], ranks[:, :-1])
            ranks[:, -1] = NO_RANK
            ranks[row, least] = self._ranks(ids[row, least], ids[row, least + 1])
            left = np.maximum(least - 1, 0)
            ranks[row, left] = np.where(least > 0, self._ranks(ids[row, left], ids[row, left + 1]), ranks[row, left])

    def _heap(self, ids: list) -> list[int]:
        """The same merges, leftmost of the smallest rank first, from a heap of pairs."""
        before, after = list(range(-1, len(ids) - 1)), [*range(1, len(ids)), -1]
        heap = []

        def offer(i: int) -> None:
            j = after[i] if i >= 0 else -1
            if j >= 0 and (ids[i], ids[j]) in self.rank:
                heapq.heappush(heap, (self.rank[ids[i], ids[j]], i, ids[i], ids[j]))

        for i in range(len(ids) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            j = after[i]
            if j < 0 or ids[i] != left or ids[j] != right:
                continue  # one of the two was merged meanwhile
            ids[i], ids[j] = int(self.merged[self.rank[left, right]]), -1
            after[i] = after[j]
            if after[i] >= 0:
                before[after[i]] = i
            after[j] = -1
            offer(before[i])
            offer(i)
        return [x for x in ids if x >= 0]



@lru_cache(maxsize=2)
def byte_pairs(path: str) -> BytePairs:
    """One per process, so that a Python worker's later tasks find it made."""
    return BytePairs(path)


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, ids, decoded``: the ids of each text, and the text they decode to."""
    return _mapped(docs, path, "doc_id long, ids array<int>, decoded string", _row)


def encode_digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``, without moving the ids themselves."""
    return _mapped(docs, path, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", _digests)


def _row(pairs: BytePairs, ids: list[int]):
    return ids, pairs.decode(ids)


def _digests(pairs: BytePairs, ids: list[int]):
    listed = ",".join(map(pairs.decimal.__getitem__, ids))
    whole = pairs.decode(ids)
    return len(ids), hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(whole.encode()).hexdigest()


KINDS = {"long": pa.int64(), "string": pa.string(), "array<int>": pa.list_(pa.int32())}


def _mapped(docs: DataFrame, path: str | None, ddl: str, of) -> DataFrame:
    """``path`` None: the public byte-level vocabulary, found by each executor on its own."""
    schema = pa.schema([(name, KINDS[kind]) for name, kind in (c.split() for c in ddl.split(", "))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = byte_pairs(path or vocabulary_path())
        for batch in chunks(batches):
            texts = [text or "" for text in batch.column("text").to_pylist()]
            made = [of(pairs, ids) for ids in pairs.encode_all(texts)]
            columns = [pa.array(x, kind) for x, kind in zip(zip(*made), schema.types[1:])]
            yield pa.record_batch([batch.column("doc_id"), *columns], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ddl)


def op5_bpe(spark, sf_dir):
    return encode_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"))
