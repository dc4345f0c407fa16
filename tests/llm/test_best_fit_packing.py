"""Packings are whole, gapless and close to the least number of sequences."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratalake.llm.best_fit_packing import op13_best_fit_packing, pack, sweep, token_pieces


def path():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def checked(rows, capacity):
    """The number of sequences, after each was found to be filled from 0 without gaps."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append((row.offset, row.length))
    for parts in sequences.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        assert end <= capacity
    return len(sequences)


def best_fit_decreasing(sizes, capacity):
    gaps = []
    for size in sorted(sizes, reverse=True):
        fits = [g for g in gaps if g >= size]
        gap = min(fits) if fits else capacity
        if fits:
            gaps.remove(gap)
        gaps.append(gap - size)
    return len(gaps)


def shapes():
    pick = random.Random(5)
    return {
        "uniform": [pick.randint(1, 64) for _ in range(900)],
        "small": [pick.randint(1, 6) for _ in range(700)],
        "one size": [21] * 700,
        "two sizes": [30] * 300 + [7] * 500,
        "large": [pick.randint(33, 64) for _ in range(200)],
        "full": [64] * 20 + [1],
        "one": [5],
    }


@pytest.mark.parametrize("shape", shapes())
def test_as_few_sequences_as_best_fit_decreasing(spark, shape):
    sizes = shapes()[shape]
    items = spark.createDataFrame([(i, n, "x") for i, n in enumerate(sizes)], "doc_id long, length long, block string")
    rows = pack(items, "length", 64).collect()
    assert sorted((r.doc_id, r.length, r.block) for r in rows) == [(i, n, "x") for i, n in enumerate(sizes)]
    assert checked(rows, 64) <= best_fit_decreasing(sizes, 64) + 1


def test_sweep_serves_larger_documents_first():
    rows = [(0, 5, 0, 3, 0, 0, 0), (0, 4, 0, 2, 0, 0, 0), (1, 5, 7, 2, 0, 0, 59), (1, 9, 9, 1, 0, 0, 55)]
    done = sweep(rows)
    assert (2, 5, 0, 2, 7, 1, 59) in done  # two of the three in the gaps of their size
    assert (2, 5, 2, 1, 9, 1, 55) in done and (2, 4, 0, 1, 9, 1, 60) in done
    assert (0, 4, 1, 1, 0, 0, 0) in done and len(done) == 4


def test_sizes_that_do_not_fit_are_refused(spark):
    for size in (0, 65, None):
        with pytest.raises(Exception, match="sizes must be"):
            pack(spark.createDataFrame([(1, size)], "doc_id long, length long"), "length", 64).collect()
    assert pack(spark.createDataFrame([], "doc_id long, length long"), "length", 64).collect() == []


def test_query_against_the_tokenizer(spark, texts, tmp_path):
    pick = random.Random(8)
    words = ["river", "stone", "quietly", "42", "über", "<|endoftext|>", "日本"]
    rows = [(i, " ".join(pick.choices(words, k=pick.choice([0, 1, 5, 30, 200, 900])))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "a b" * 6000), (503, " x" * 1023), (504, " x" * 1024), (505, "same"), (505, "same"), (None, "none")]
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_best_fit_packing(spark, str(tmp_path)).collect()
    made, expected = Tokenizer.from_file(path()), []
    for doc_id, text in rows:
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 2]
        cuts = list(range(len(ids), 0, -1024))[::-1]
        for piece, stop in enumerate(cuts):
            start = cuts[piece - 1] if piece else 0
            part = np.array(ids[start:stop], "<u4")
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted((tuple(r)[:5] for r in found), key=key) == sorted(expected, key=key)
    assert checked(found, 1024) <= best_fit_decreasing([r.length for r in found], 1024) + 1


def test_ids_of_pieces(spark, texts):
    rows = token_pieces(texts([(1, "one two three four five six")]), capacity=4, ids=True).collect()
    rows.sort(key=lambda r: r.piece)
    assert [r.length for r in rows] == [3, 4] and [r.start for r in rows] == [0, 3]
    assert [i for r in rows for i in r.ids] == [*Tokenizer.from_file(path()).encode("one two three four five six").ids, 2]
