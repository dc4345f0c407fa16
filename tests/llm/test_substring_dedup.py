from __future__ import annotations

import collections
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from stratalake.llm.substring_dedup import op3_substring_dedup, remove_repeats


def brute(rows, window):
    texts = [(doc_id, (text or "").encode().split()) for doc_id, text in rows]
    count = collections.Counter(tuple(w[k : k + window]) for _, w in texts for k in range(len(w) - window + 1))
    for doc_id, words in texts:
        gone = set()
        for k in range(len(words) - window + 1):
            if count[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        kept = b" ".join(w for i, w in enumerate(words) if i not in gone)
        yield doc_id, len(words), len(gone), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("window", [3, 12])
def test_equals_brute_force(texts, window):
    rng = random.Random(window)
    draw = lambda: None if rng.random() < 0.1 else " ".join(rng.choice("ab") for _ in range(rng.randint(0, 25)))
    rows = [(None if rng.random() < 0.1 else rng.randint(0, 30), draw()) for _ in range(60)] + [(5, "a " * 50)] * 2
    found = remove_repeats(texts(rows), window).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256))
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(map(str, brute(rows, window)))


def test_nothing(texts):
    assert remove_repeats(texts([])).collect() == []


def test_query_on_the_smallest_tables(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op3_substring_dedup(spark, folder).collect())) == sorted(brute(rows, 35))


def test_windows_that_differ_in_one_word_of_like_shape_stay(texts):
    one, two = "a", "b"
    while len(one) < 1024:
        one, two = one + two, two + one
    same = " ".join(f"w{i}" for i in range(34))
    rows = [(1, f"{same} {one}"), (2, f"{same} {two}"), (3, "x " * 200_000)]
    got = {r.doc_id: r.n_removed for r in remove_repeats(texts(rows)).collect()}
    assert got == {1: 0, 2: 0, 3: 200_000}


def test_blanks_between_words_make_no_difference(texts):
    words = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(words)), (2, "\n\t ".join(words))]
    assert {r.n_removed for r in remove_repeats(texts(rows)).collect()} == {40}
