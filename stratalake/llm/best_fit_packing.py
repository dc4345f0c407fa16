"""Best-fit packing of token sequences, bulk-synchronous.

Documents are to share sequences of ``capacity`` tokens; each has a gap, the tokens that are still
free. Documents of more than half a sequence open one each, as no two of them fit together. Then,
in rounds:

1. documents and gaps are range-sorted by size;
2. each range is swept from its largest documents down, and a document goes to its successor, the
   smallest gap that is not below its size;
3. documents that meet one gap are served in order of rank, larger ones first; those that come
   too late go on to the next gap, or to the next round;
4. gaps shrink by what they took, and the next round sorts them anew, over half as many ranges.

When one range holds all and nothing fits any more, as many empty sequences are opened as the
remaining tokens fill at least, and rounds go on until every document has its place.

Documents of one size are interchangeable, and so are sequences with one gap. So a round does not
move documents but runs of them: a size, the rank of its first document and their number; a gap,
the number of its first sequence and their number. That is at most a row per size and a few per
sweep, whatever the input, and a size that a third of all documents have is one row. Documents
themselves move once, to be range-sorted by size and ranked; each then finds its run by its rank.
Ranks are counted per range and size, so no task sees more than its range.

Sizes must be from 1 to ``capacity``; rows with other sizes or null are refused by an error.
Repeated rows are packed once each. An empty table gives an empty table. Of equal sizes any order
is as good, so sequence numbers may differ between runs; their number does not.
"""

from __future__ import annotations

import json
import os
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.llm.bpe import CUT, byte_letters
from stratalake.llm.words import chunks
from stratalake.sources.scratch import stored

CAPACITY, END = 1024, 2
#: Ranges of the first round; each later round has half as many.
RANGES = 8
#: Bytes of text encoded at once, and characters of a text that goes to the slower library.
CHUNK, LARGE = 1 << 20, 1 << 19

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
#: A run in a sweep. Documents: size, rank of the first, number. Gaps: gap, number of the first
#: sequence, number of sequences, tokens used in each. Placed: size, rank of the first, number,
#: first sequence, documents per sequence, tokens used before.
RUN = "kind int, size long, first long, n long, sequence long, each long, used long"
DOCUMENTS, GAPS, PLACED = 0, 1, 2


class Ids:
    """Token ids of texts as the ``tokenizers`` library gives them, special tokens in a text included.

    Where a file's ids are its merge ranks, as in byte-level vocabularies, ``tiktoken`` finds the
    same ids in a quarter of the time; texts above ``LARGE`` and other files go to ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task is one core of many
        from tokenizers import Tokenizer

        self.slow = Tokenizer.from_file(path)
        self.slow.no_truncation()
        self.slow.no_padding()
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.fast = self._ranked(content)

    @staticmethod
    def _ranked(content: dict):
        import tiktoken

        letters = {letter: byte for byte, letter in byte_letters().items()}
        model, added = content["model"], {x["content"]: x["id"] for x in content["added_tokens"]}
        vocab = {token: at for token, at in model["vocab"].items() if token not in added}
        single = max((at for token, at in vocab.items() if len(token) == 1), default=0) + 1
        merged = ["".join(pair.split(" ") if isinstance(pair, str) else pair) for pair in model["merges"]]
        byte_level = (content["pre_tokenizer"] or {}).get("type") == "ByteLevel" and not content["normalizer"]
        in_order = all(vocab.get(token) == single + i for i, token in enumerate(merged))
        if not byte_level or not in_order or content["pre_tokenizer"].get("add_prefix_space"):
            return None
        ranks = {bytes(letters[c] for c in token): at for token, at in vocab.items()}
        return tiktoken.Encoding("ranks", pat_str=CUT, mergeable_ranks=ranks, special_tokens=added)

    def of(self, text: str) -> np.ndarray:
        if self.fast is None or len(text) > LARGE:
            return np.array(self.slow.encode(text, add_special_tokens=False).ids, dtype="<u4")
        return self.fast.encode_to_numpy(text, allowed_special="all")


@lru_cache(maxsize=2)
def ids_of(path: str) -> Ids:
    """One per process."""
    return Ids(path)


def token_pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, end: int = END, ids: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` and, if asked for, the ``ids`` of each piece.

    A document's tokens end with ``end``. Where they are more than ``capacity`` they are cut from
    the back into full pieces, and what is left is the first piece. Null text is empty. Tokens do
    not leave the task unless ``ids`` is set.
    """
    ddl = PIECES + (", ids array<int>" if ids else "")
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<int>": pa.list_(pa.int32())}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path is None:
            import public_tokenizers

        made = ids_of(path or public_tokenizers.path("byte_bpe_50k.json"))
        for batch in chunks(batches, most=CHUNK):
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                tokens = np.append(made.of(text or ""), end).astype("<u4")
                at, stop, piece = 0, len(tokens) % capacity or capacity, 0
                while at < len(tokens):
                    part = tokens[at:stop]
                    row = (doc_id, piece, at, len(part), zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if ids else row)
                    at, stop, piece = stop, stop + capacity, piece + 1
            columns = zip(*rows) if rows else [[]] * len(schema)
            yield pa.record_batch([pa.array(list(c), kind) for c, kind in zip(columns, schema.types)], schema=schema)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, ddl)


def ranked(items: DataFrame, size: str, capacity: int) -> DataFrame:
    """The rows, range-sorted by size, with their range and their rank among those of one size in it."""
    plain = T.StructType([*items.schema.fields, T.StructField("__part", T.IntegerType()), T.StructField("__rank", T.LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            sizes = batch.column(size).to_numpy(zero_copy_only=False)
            if len(sizes) and not (sizes.min() >= 1 and sizes.max() <= capacity):  # NaN stands for null here
                raise ValueError(f"sizes must be from 1 to {capacity}")
            sizes = sizes.astype(np.int64)
            order = np.argsort(sizes, kind="stable")
            many = np.bincount(sizes, minlength=capacity + 1)
            rank = np.empty(len(sizes), np.int64)
            rank[order] = np.arange(len(sizes)) - np.repeat(np.cumsum(many) - many, many)
            rank += seen[sizes]
            seen += many
            batch = batch.append_column("__part", pa.array(np.full(len(sizes), part, np.int32)))
            yield batch.append_column("__rank", pa.array(rank))

    others = [F.col(f"`{c}`") for c in items.columns if c != size and isinstance(items.schema[c].dataType, T.AtomicType)]
    return items.repartitionByRange(F.col(f"`{size}`").desc(), *others).mapInArrow(work, plain)


def sweep(rows: list[tuple]) -> list[tuple]:
    """Documents of some range of sizes go to the smallest gaps that hold them, larger ones first."""
    gaps = sorted((size, first, n, used) for kind, size, first, n, _, _, used in rows if kind == GAPS)
    out = []
    for size, first, n in sorted(((r[1], r[2], r[3]) for r in rows if r[0] == DOCUMENTS), key=lambda r: (-r[0], r[1])):
        while n:
            i = bisect_left(gaps, (size,))
            if i == len(gaps):
                out.append((DOCUMENTS, size, first, n, 0, 0, 0))
                break
            gap, sequence, many, used = gaps.pop(i)
            each = min(gap // size, n)
            filled = min(many, n // each)
            out.append((PLACED, size, first, filled * each, sequence, each, used))
            first, n = first + filled * each, n - filled * each
            insort(gaps, (gap - each * size, sequence, filled, used + each * size))
            if filled < many:
                insort(gaps, (gap, sequence + filled, many - filled, used))
    return out + [(GAPS, gap, first, n, 0, 0, used) for gap, first, n, used in gaps if gap]


def swept(spark: SparkSession, rows: list[tuple], ranges: int) -> list[tuple]:
    """One round: the runs range-sorted by size, each range swept by a task."""
    names = [c.split()[0] for c in RUN.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [tuple(x[c] for c in names) for batch in batches for x in batch.to_pylist()]
        done = sweep(held)
        if done:
            yield pa.record_batch([pa.array(c, pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(zip(*done))], names=names)

    runs = spark.createDataFrame(rows, RUN)
    # of one size, documents stand before gaps, which so lie in the range of the documents below them
    runs = runs.repartitionByRange(ranges, "size", "kind", "first") if ranges > 1 else runs.coalesce(1)
    return [tuple(r) for r in runs.mapInArrow(work, RUN).collect()]


def places(spark: SparkSession, counts: dict[int, int], capacity: int, ranges: int = RANGES) -> list[tuple]:
    """Where the documents of each size go, as PLACED runs; ``counts`` has a number for each size."""
    left = [(DOCUMENTS, size, 0, n, 0, 0, 0) for size, n in sorted(counts.items())]
    gaps, placed, opened = [], [], 0
    for _, size, _, n, *_ in [d for d in left if 2 * d[1] > capacity]:
        placed.append((PLACED, size, 0, n, opened, 1, 0))
        gaps += [(GAPS, capacity - size, opened, n, 0, 0, size)] if size < capacity else []
        opened += n
    left = [d for d in left if 2 * d[1] <= capacity]
    while left:
        rows = swept(spark, left + gaps, ranges) if gaps else left
        placed += [r for r in rows if r[0] == PLACED]
        left, gaps = ([r for r in rows if r[0] == kind] for kind in (DOCUMENTS, GAPS))
        if ranges > 1:
            ranges //= 2
        elif left:  # nothing fits: open sequences for the rest
            new = -(-sum(r[1] * r[3] for r in left) // capacity)
            gaps.append((GAPS, capacity, opened, new, 0, 0, 0))
            opened += new
    return placed


def pack(items: DataFrame, size: str = "length", capacity: int = CAPACITY) -> DataFrame:
    """The rows with ``sequence_id`` and ``offset``: their sequence, and their place in it.

    Sequences are filled from 0 without gaps. Other columns go along unchanged.
    """
    rows = stored(ranked(items, size, capacity), "ranked")
    counted = rows.groupBy(F.col(f"`{size}`").cast("long").alias("size"), "__part").count().collect()  # ranges + sizes at most
    before, counts = {}, {}
    for x in sorted(counted):
        before[x["__part"], x["size"]] = counts.get(x["size"], 0)
        counts[x["size"]] = counts.get(x["size"], 0) + x["count"]
    found = np.array(sorted(r[1:] for r in places(items.sparkSession, counts, capacity)), np.int64).reshape(-1, 6)
    key = (found[:, 0] << 40) + found[:, 1]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, part = (batch.column(c).to_numpy().astype(np.int64) for c in (size, "__part"))
            pairs, at = np.unique(part * (capacity + 1) + sizes, return_inverse=True)
            base = np.array([before[divmod(p, capacity + 1)] for p in pairs.tolist()], np.int64)
            rank = batch.column("__rank").to_numpy() + base[at]
            run = found[np.searchsorted(key, (sizes << 40) + rank, side="right") - 1]
            rank = rank - run[:, 1]
            made = {"sequence_id": run[:, 3] + rank // run[:, 4], "offset": run[:, 5] + rank % run[:, 4] * sizes}
            batch = batch.drop_columns(["__part", "__rank"])
            for name, values in made.items():
                batch = batch.append_column(name, pa.array(values))
            yield batch

    fields = [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())]
    return rows.mapInArrow(work, T.StructType([*items.schema.fields, *fields]))


def op13_best_fit_packing(spark, sf_dir):
    return pack(token_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet")))
