"""Fixed-size sets of 64-bit values that every task can hold: membership with false positives.

``repeated`` is a counting sketch of one row: what it says occurs once, does occur once.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from stratalake.llm.words import mix

#: Bits of a set (16 MiB) and of a counting sketch (64 MiB), and of a slice merged by itself.
SIZE, WIDE, SLICE = 1 << 27, 1 << 29, 1 << 16
#: Values a task gathers before it sends them on.
HELD = 1_500_000


def _place(values: np.ndarray, size: int = SIZE) -> np.ndarray:
    return (mix(values.astype(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(size - 1)).astype(np.int64)


def contains(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    place = _place(values, 8 * len(bits))
    return (bits[place >> 3] >> (7 - (place & 7)).astype(np.uint8) & 1).astype(bool)


def collect_set(df: DataFrame, column: str) -> np.ndarray:
    """The values of a long column as one set; at most SIZE bits reach the driver."""
    schema = pa.schema([("slice", pa.int32()), ("bits", pa.binary())])

    def slices(places: Iterator[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for at, inside in places:
            held.setdefault(at, np.zeros(SLICE, bool))[inside] = True
        for at, inside in held.items():
            yield pa.record_batch([[at], [np.packbits(inside).tobytes()]], schema=schema)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def places():
            for batch in batches:
                place = np.sort(_place(batch.column(0).to_numpy()))
                cut = np.flatnonzero(np.diff(place // SLICE)) + 1
                for part in np.split(place, cut) if len(place) else ():
                    yield int(part[0] // SLICE), part % SLICE

        yield from slices(places())

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (x for batch in batches for x in batch.to_pylist())
        yield from slices((x["slice"], np.unpackbits(np.frombuffer(x["bits"], np.uint8)).astype(bool)) for x in rows)

    merged = df.select(column).mapInArrow(each, "slice int, bits binary").repartition("slice").mapInArrow(merge, "slice int, bits binary")
    bits = np.zeros(SIZE // 8, np.uint8)
    for x in merged.toLocalIterator():
        at = x["slice"] * SLICE // 8
        bits[at : at + SLICE // 8] = np.frombuffer(x["bits"], np.uint8)
    return bits


def repeated(source: DataFrame, values: Callable[[Iterator[pa.RecordBatch]], Iterator[np.ndarray]]) -> np.ndarray:
    """The places of a sketch that more than one value falls on, as a set for ``contains``."""
    ddl = "slice int, once binary, more binary"
    schema = pa.schema([("slice", pa.int32()), ("once", pa.binary()), ("more", pa.binary())])

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def send() -> pa.RecordBatch:
            place, n = np.unique(np.concatenate(held), return_counts=True)
            at = place // SLICE
            rows, inside = np.unique(at), (place % SLICE).astype(np.uint16)
            lead = np.append(np.searchsorted(at, rows), len(at))
            parts = [(inside[i:j], n[i:j] > 1) for i, j in zip(lead, lead[1:])]
            once, more = [p[~m].tobytes() for p, m in parts], [p[m].tobytes() for p, m in parts]
            return pa.record_batch([pa.array(rows.astype(np.int32)), pa.array(once, pa.binary()), pa.array(more, pa.binary())], schema=schema)

        for found in values(batches):
            held.append(_place(found, WIDE))
            if sum(map(len, held)) > HELD:
                yield send()
                held.clear()
        if held:
            yield send()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, np.ndarray] = {}
        for batch in batches:
            for x in batch.to_pylist():
                part = counts.setdefault(x["slice"], np.zeros(SLICE, np.uint8))
                once = np.frombuffer(x["once"], np.uint16)
                part[once] = np.minimum(part[once] + 1, 2)
                part[np.frombuffer(x["more"], np.uint16)] = 2
        for at, part in counts.items():
            yield pa.record_batch([[at], [b""], [np.packbits(part > 1).tobytes()]], schema=schema)

    merged = source.mapInArrow(each, ddl).repartition("slice").mapInArrow(merge, ddl)
    bits = np.zeros(WIDE // 8, np.uint8)
    for x in merged.toLocalIterator():
        at = x["slice"] * SLICE // 8
        bits[at : at + SLICE // 8] = np.frombuffer(x["more"], np.uint8)
    return bits
