"""Removal of repeated word windows, exact, behind a count-min prefilter.

A window is ``window`` consecutive words of one text. Each word covered by a window whose word
sequence also starts somewhere else is removed; windows are judged on the input.

Three passes:

1. Every partition counts the anchors of its windows in a count-min sketch; the sketches are
   merged by slice. A window's anchor is the smallest ``GRAM``-word hash inside it, the rightmost
   of equal ones, so two places that hold the same window have two different anchor places with
   one content: the merged count is never below the number of places of a window.
2. Windows whose anchor is estimated to occur once are unique and stop here. The others are
   combined inside a block of texts (one row per different window) and grouped by anchor, so a
   run of neighbouring windows travels together; equal windows are found by a 128-bit BLAKE2
   digest of their words.
3. The covered word ranges go back to their texts, which are cut.

The sketch has a fixed size. On larger inputs it lets more unique windows through to pass 2; it
never loses one.

Null text: no words. Null ids are kept. Rows with the same id and text get the same answer, and
their windows count as repeated. Texts shorter than a window are kept whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.words import Hasher, Texts, chunks, mix, split_words
from stratalake.sources.scratch import stored

WINDOW = 35
GRAM = 8
#: Counters per row of the sketch, rows, and counters per slice that is merged on its own.
WIDTH, ROWS, SLICE = 1 << 26, 2, 1 << 16
#: Bytes of text worked on at once, and anchors a task gathers before it sends them on.
CHUNK, HELD = 2 << 20, 1_500_000

SKETCH = "row int, slice int, once binary, more binary"
CANDIDATES = "bucket long, k1 long, k2 long, a int, b int, runs binary, hash1 binary, hash2 binary, many1 binary, many2 binary"
RANGES = "k1 long, k2 long, a int, b int"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in ddl.split(", "))])


def slots(anchors: np.ndarray) -> list[np.ndarray]:
    """The counter of each anchor in each row of the sketch."""
    spread = mix(anchors ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return [((spread >> np.uint64(32 * row)) & np.uint64(WIDTH - 1)).astype(np.int64) for row in range(ROWS)]


class Windows:
    """The windows of some texts: where they start, and where their anchors are."""

    def __init__(self, texts: Texts, hasher: Hasher, window: int) -> None:
        gram = min(GRAM, window)
        self.words = hasher.words(texts.data, texts.start, texts.end)
        self.start, self.per_text = texts.positions(window)
        every = np.arange(max(len(self.words) - gram + 1, 0))
        grams = hasher.grams(self.words, every, gram)
        least, reach, width = every, 1, window - gram + 1
        while len(least) and reach < width:  # the span covered doubles until it is the window
            step = min(reach, width - reach)
            left, right = least[: max(len(least) - step, 0)], least[step:]
            least = np.where(grams[right] <= grams[left], right, left)
            reach += step
        self.anchor = least[self.start] if len(self.start) else self.start
        self.content = grams[self.anchor] if len(self.start) else np.zeros(0, np.uint64)


def sketch(docs: DataFrame, window: int) -> list[np.ndarray]:
    """Per row of the merged sketch, one bit per counter: whether it counts more than one."""
    schema = _schema(SKETCH)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, held = Hasher(3), []

        def send() -> Iterator[pa.RecordBatch]:
            for row, slot in enumerate(slots(np.concatenate(held))):
                slot, n = np.unique(slot, return_counts=True)
                at, inside = slot // SLICE, (slot % SLICE).astype(np.uint16)
                parts = np.unique(at)
                lead = np.append(np.searchsorted(at, parts), len(at))
                cuts = [(inside[i:j], n[i:j] > 1) for i, j in zip(lead, lead[1:])]
                once, more = [x[~m].tobytes() for x, m in cuts], [x[m].tobytes() for x, m in cuts]
                columns = [np.full(len(parts), row, np.int32), parts.astype(np.int32)]
                yield pa.record_batch([*map(pa.array, columns), pa.array(once, pa.binary()), pa.array(more, pa.binary())], schema=schema)
            held.clear()

        for batch in chunks(batches, most=CHUNK):
            found = Windows(split_words(batch.column("text")), hasher, window)
            held.append(found.content[np.append(True, np.diff(found.anchor) > 0)[: len(found.anchor)]])
            if sum(map(len, held)) > HELD:  # bounds what a task holds; parts add up later
                yield from send()
        if held:
            yield from send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merged: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for x in batch.to_pylist():
                part = merged.setdefault((x["row"], x["slice"]), np.zeros(SLICE, np.uint8))
                once = np.frombuffer(x["once"], np.uint16)
                part[once] = np.minimum(part[once] + 1, 2)
                part[np.frombuffer(x["more"], np.uint16)] = 2
        for (row, at), part in merged.items():
            if (part > 1).any():
                yield pa.record_batch([[row], [at], [b""], [np.packbits(part > 1).tobytes()]], schema=schema)

    merged = docs.select("text").mapInArrow(count, SKETCH).repartition("row", "slice").mapInArrow(merge, SKETCH)
    rows = [np.zeros(WIDTH // 8, np.uint8) for _ in range(ROWS)]
    for x in merged.select("row", "slice", "more").toLocalIterator():  # ROWS * WIDTH bits at most
        at = x["slice"] * SLICE // 8
        rows[x["row"]][at : at + SLICE // 8] = np.frombuffer(x["more"], np.uint8)
    return rows


def digests(texts: Texts, start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Two longs of BLAKE2 of the words of each window, whatever stands between them in the text."""
    size = texts.end - texts.start
    first = np.append(0, np.cumsum(size + 1))
    joined = np.full(first[-1], 0x20, np.uint8)
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    joined[inside + np.repeat(first[:-1], size)] = texts.data[inside + np.repeat(texts.start, size)]
    whole = memoryview(joined)
    made = b"".join(blake2b(whole[i:j], digest_size=16).digest() for i, j in zip(first[start].tolist(), (first[start + window] - 1).tolist()))
    both = np.frombuffer(made, np.uint64).reshape(-1, 2)
    return both[:, 0], both[:, 1]


def candidates(keyed: DataFrame, bits: list[np.ndarray], window: int, buckets: int) -> DataFrame:
    """The windows that may be repeated, by anchor; ranges known to be repeated as they are."""
    schema, shared = _schema(CANDIDATES), keyed.sparkSession.sparkContext.broadcast(bits)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, rows = Hasher(3), shared.value
        for batch in chunks(batches, most=CHUNK):
            texts = split_words(batch.column("text"))
            found = Windows(texts, hasher, window)
            maybe = np.ones(len(found.start), bool)
            for row, slot in enumerate(slots(found.content)):
                maybe &= (rows[row][slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
            start, content = found.start[maybe], found.content[maybe]
            if not len(start):
                continue
            hash1, hash2 = digests(texts, start, window)
            text = np.repeat(np.arange(len(batch)), found.per_text)[maybe]
            at = (start - texts.first[text]).astype(np.int32)
            k1, k2 = (batch.column(k).to_numpy()[text] for k in ("k1", "k2"))
            order = np.lexsort((hash2, hash1))
            same = (np.diff(hash1[order]) == 0) & (np.diff(hash2[order]) == 0)
            head = np.append(True, ~same)
            many = np.zeros(len(start), bool)
            many[order] = np.append(same, False) | np.append(False, same)
            witness = np.zeros(len(start), bool)
            witness[order[head]] = True
            witness &= many
            bucket = (mix(content) % np.uint64(buckets)).astype(np.int64)
            yield from _ranges(k1[many], k2[many], at[many], at[many] + window, k1[many] % buckets, schema)
            ask = ~many
            order = np.argsort(bucket[ask], kind="stable")
            b, a, x1, x2, h1, h2 = (v[ask][order] for v in (bucket, at, k1, k2, hash1, hash2))
            other = np.argsort(bucket[witness], kind="stable")
            wb, w1, w2 = (v[witness][other] for v in (bucket, hash1, hash2))
            for n in np.union1d(b, wb).tolist():
                i, j = np.searchsorted(b, [n, n + 1])
                u, v = np.searchsorted(wb, [n, n + 1])
                cut = (np.diff(a[i:j]) != 1) | (np.diff(x1[i:j]) != 0) | (np.diff(x2[i:j]) != 0)
                lead = np.flatnonzero(np.append(True, cut)) if j > i else np.zeros(0, np.int64)
                length = np.diff(np.append(lead, j - i))
                runs = np.column_stack([x1[i:j][lead], x2[i:j][lead], a[i:j][lead], length]).astype(np.int64)
                blobs = [x.tobytes() for x in (runs, h1[i:j], h2[i:j], w1[u:v], w2[u:v])]
                yield pa.record_batch([[n], [None], [None], [None], [None], *[[x] for x in blobs]], schema=schema)

    return keyed.mapInArrow(send, CANDIDATES)


def _ranges(k1, k2, a, b, bucket, schema) -> Iterator[pa.RecordBatch]:
    """Word ranges [a, b), joined where one begins inside the one before."""
    if len(a):
        order = np.lexsort((a, k2, k1))
        k1, k2, a, b = k1[order], k2[order], a[order], b[order]
        lead = np.flatnonzero(np.append(True, (np.diff(k1) != 0) | (np.diff(k2) != 0) | (a[1:] > b[:-1])))
        last = np.append(lead[1:], len(a)) - 1
        columns = [k1[lead], k2[lead], a[lead].astype(np.int32), b[last].astype(np.int32)]
        if bucket is not None:
            columns = [bucket[order][lead], *columns, *[pa.nulls(len(lead), pa.binary())] * 5]
        yield pa.record_batch([pa.array(x) if isinstance(x, np.ndarray) else x for x in columns], schema=schema)


def _repeated(window: int):
    schema = _schema(RANGES)

    def decide(table: pa.Table) -> pa.Table:
        known = table.filter(table["runs"].is_null()).select(["k1", "k2", "a", "b"])
        asked = table.filter(table["runs"].is_valid())

        def joined(name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(asked[name].to_pylist()), kind)

        runs = joined("runs", np.int64).reshape(-1, 4)
        hash1, hash2 = ([joined(a + n, np.uint64) for a in ("hash", "many")] for n in "12")
        n = len(hash1[0])
        h1, h2 = np.concatenate(hash1), np.concatenate(hash2)
        order = np.lexsort((h2, h1))
        same = (np.diff(h1[order]) == 0) & (np.diff(h2[order]) == 0)
        hit = np.zeros(len(h1), bool)
        if len(h1):
            hit[order] = np.append(same, False) | np.append(False, same)
        hit = hit[:n]
        k1, k2 = (np.repeat(runs[:, c], runs[:, 3])[hit] for c in (0, 1))
        lead = np.cumsum(runs[:, 3]) - runs[:, 3]
        at = (np.repeat(runs[:, 2] - lead, runs[:, 3]) + np.arange(n))[hit]
        return pa.concat_tables([known, *map(pa.table, _tables(k1, k2, at, at + window, schema))])

    return decide


def _tables(k1, k2, a, b, schema) -> list[pa.Table]:
    return [pa.Table.from_batches([x]) for x in _ranges(k1, k2, a, b, None, schema)]


KEPT = "doc_id long, n_words long, n_removed long, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: each text without the words of repeated windows.

    ``kept`` holds the remaining words, unchanged, joined by one space.
    """
    spark = docs.sparkSession
    keyed = docs.select(
        F.col("doc_id").cast("long"), "text", F.coalesce("doc_id", F.lit(0)).cast("long").alias("k1"), F.xxhash64("doc_id", "text").alias("k2")
    )
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = sketch(docs, window)
    asked = candidates(keyed.select("k1", "k2", "text"), bits, window, buckets)
    found = asked.groupBy("bucket").applyInArrow(_repeated(window), RANGES)
    covered = found.groupBy("k1", "k2").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("covered"))
    covered = stored(covered, "repeats")
    schema = _schema(KEPT)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            total, removed, kept = [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("covered").to_pylist(), strict=True):
                words, rest, done = (text or "").encode().split(), [], 0
                for x in ranges or ():
                    rest += words[done : x["a"]]
                    done = max(done, x["b"])
                rest = rest + words[done:] if ranges else words
                total.append(len(words))
                removed.append(len(words) - len(rest))
                kept.append(b" ".join(rest).decode())
            yield pa.record_batch([batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], schema=schema)

    return (
        keyed.join(covered, ["k1", "k2"], "left")
        .select("doc_id", "text", "covered")
        .mapInArrow(cut, KEPT)
    )


def op3_substring_dedup(spark, sf_dir):
    kept = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
