from __future__ import annotations

import random

import numpy as np
import pyarrow as pa

from stratalake.llm.words import Hasher, chunks, split_words


def draw(rng, letters=" \nabcé\x0b", most=30):
    return None if rng.random() < 0.1 else "".join(rng.choice(letters) for _ in range(rng.randint(0, most)))


def test_words_are_those_of_bytes_split():
    rng = random.Random(1)
    for _ in range(200):
        texts = [draw(rng) for _ in range(rng.randint(0, 6))]
        found = split_words(pa.array(["skipped", *texts], pa.string()).slice(1))
        words = [
            [bytes(found.data[found.start[i] : found.end[i]]) for i in range(found.first[d], found.first[d + 1])]
            for d in range(len(texts))
        ]
        assert words == [(text or "").encode().split() for text in texts]


def test_equal_words_and_grams_have_equal_hashes_wherever_they_are():
    rng = random.Random(2)
    one, two = {}, {}
    hasher = Hasher(1)
    for _ in range(100):
        texts = [draw(rng, "ab é", 60) for _ in range(4)]
        found = split_words(pa.array(texts, pa.string()))
        flat = [w for text in texts for w in (text or "").encode().split()]
        words = hasher.words(found.data, found.start, found.end)
        place, runs = found.positions(3)
        assert runs.tolist() == [max(len((t or "").split()) - 2, 0) for t in texts]
        for word, value in zip(flat, words.tolist()):
            assert one.setdefault(word, value) == value
        for at, value in zip(place.tolist(), hasher.grams(words, place, 3).tolist()):
            assert two.setdefault(tuple(flat[at : at + 3]), value) == value
    assert len(set(one.values())) == len(one) and len(set(two.values())) == len(two)


def test_case_is_folded_for_ascii_only():
    hasher = Hasher(1, fold_case=True)
    found = split_words(pa.array(["ABC abc É é"]))
    a, b, c, d = hasher.words(found.data, found.start, found.end).tolist()
    assert a == b and c != d


def test_chunks_cut_by_bytes_and_keep_long_texts_whole():
    batch = pa.record_batch([pa.array(["aa", None, "b" * 50, "c", ""])], names=["text"])
    parts = [p.column(0).to_pylist() for p in chunks([batch], most=4)]
    assert parts == [["aa", None], ["b" * 50], ["c", ""]]
    assert np.concatenate([p for p in parts]).tolist() == batch.column(0).to_pylist()


def doubled(length):
    """Words of one length that any polynomial modulo a power of two confuses: ab, abba, abbabaab, ..."""
    one, two = "a", "b"
    while len(one) < length:
        one, two = one + two, two + one
    return one, two


def test_words_of_one_shape_are_told_apart():
    words = [w for length in (2, 8, 64, 512, 1024, 4096) for w in doubled(length)]
    for seed in (1, 3, 5, 8):
        hasher = Hasher(seed)
        found = split_words(pa.array([" ".join(words)]))
        hashes = hasher.words(found.data, found.start, found.end)
        assert len(set(hashes.tolist())) == len(words)
        short = split_words(pa.array([" ".join(x) for x in doubled(64)]))  # and so are such sequences of words
        flat = hasher.words(short.data, short.start, short.end)
        assert len(set(hasher.grams(flat, np.array([0, 64]), 64).tolist())) == 2


def test_grams_of_several_sizes_at_once():
    hasher, found = Hasher(2), split_words(pa.array(["a b c d e f g"]))
    words = hasher.words(found.data, found.start, found.end)
    sizes = np.array([1, 2, 3, 5, 5])
    got = hasher.grams(words, np.arange(5)[[0, 0, 1, 1, 2]], sizes).tolist()
    assert got == [hasher.grams(words, np.array([i]), n)[0] for i, n in zip([0, 0, 1, 1, 2], sizes.tolist())]
    assert len(set(got)) == 5
