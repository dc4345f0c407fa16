from __future__ import annotations

import hashlib
import random

import pytest

from stratalake.llm.bpe import BytePairs, encode, op5_bpe, vocabulary_path

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(vocabulary_path())


@pytest.fixture(scope="module")
def pairs():
    return BytePairs(vocabulary_path())


def test_equals_the_library(library, pairs):
    rng = random.Random(1)
    parts = ["the", " ", "  ", "\n", "é", "漢", "'s", "'ll", "1", "😀", "<|endoftext|>", "<|endof", "thing", "ing", "aaaa", "\t", "..."]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    texts += ["a" * 5000, "ab" * 3000, "thing" * 3000, "é" * 999, "!" * 3000, " " * 3000, ""]
    for text, ids in zip(texts, pairs.encode_all(texts)):
        assert ids == library.encode(text, add_special_tokens=False).ids, text[:40]
        assert pairs.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_heap_and_scan_agree(pairs):
    rng = random.Random(2)
    for _ in range(200):
        word = "".join(rng.choice("abethinges ") for _ in range(rng.randint(1, 60))).encode()
        assert pairs.merge([word])[0] == tuple(pairs._heap([int(pairs.single[b]) for b in word]))


def test_rows_without_text(texts):
    found = {r.doc_id: (list(r.ids), r.decoded) for r in encode(texts([(1, None), (2, ""), (None, "a")])).collect()}
    assert found[1] == found[2] == ([], "") and found[None][1] == "a"
    assert encode(texts([])).collect() == []


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
    expected = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        expected.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(tuple, op5_bpe(spark, folder).collect())) == sorted(expected)
