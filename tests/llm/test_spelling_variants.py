"""Near words and forms against comparisons of all pairs."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import pytest

from stratalake.llm.spelling_variants import op11_spelling_variants, shared, spelling_variants, word_counts


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(counts, times=10):
    rows, form = {}, {}
    for word, n in counts.items():
        others = [w for w in counts if near(word, w)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best is not None and counts[best] >= times * n else None
        rows[word] = [n, len(others)]

    def root(word):
        return word if form[word] is None else root(form[word])

    return {w: (form[w], root(w), n, k, counts.get(form[w])) for w, (n, k) in rows.items()}


def found(spark, counts):
    rows = spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()
    assert len(rows) == len(counts)
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows}


def random_counts(seed):
    """Words over few letters, so that they are near in many ways, with stretches of one letter."""
    pick = random.Random(seed)
    words = {"".join(pick.choice("aabé") for _ in range(pick.randint(1, 9))) for _ in range(500)}
    return {w: pick.choice([2, 3, 30, 30, 400, 5000]) for w in words}


@pytest.mark.parametrize("seed", [1, 2])
def test_random_words_against_all_pairs(spark, seed):
    counts = random_counts(seed)
    got = found(spark, counts)
    assert got == brute(counts)
    assert sum(r[0] is not None for r in got.values()) > 50
    assert any(r[0] is not None and r[0] != r[1] for r in got.values())  # a chain


def test_edge_cases(spark):
    long = "x" * 3000
    counts = {"aaaaaaa": 5, "aaaaaaaa": 50, "aaaaaaab": 50, long: 2, long + "y": 20, long[:-1] + "z": 20, "alonealone": 9}
    got = found(spark, counts)
    assert got == brute(counts)
    assert got["aaaaaaa"] == ("aaaaaaaa", "aaaaaaaa", 5, 2, 50)  # of equal counts the smaller word
    assert got["alonealone"] == (None, "alonealone", 9, 0, None)
    assert found(spark, {"onlyone": 2}) == {"onlyone": (None, "onlyone", 2, 0, None)}
    assert spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []


@pytest.mark.parametrize(("a", "b", "n"), [("", "", 0), ("", "a", 0), ("abc", "abd", 2), ("ab", "abc", 2), ("x" * 90 + "a", "x" * 90 + "b", 90)])
def test_common_prefix(a, b, n):
    assert shared(a, b) == shared(b, a) == n


def text_of(seed, n):
    pick = random.Random(seed)
    stems = ["evening", "morning", "Électric", "windowés", "station", "stations", "nightfall", "Dampfschiff", "中文windows", "short"]
    return " ".join(pick.choices(stems, weights=[30, 20, 10, 5, 8, 4, 3, 3, 2, 9], k=n))


def test_words_of_texts(spark, texts):
    rows = [(1, "Evening EVENING evening! ÉVENINGé ×evening"), (None, None), (2, ""), (3, "x" * 50_000), (3, "x" * 50_000)]
    got = {r.word: r.n for r in word_counts(texts(rows)).collect()}
    # only A to Z change their case, and the multiplication sign lies among the letters
    assert got == {"evening": 3, "x" * 50_000: 2}


def expected(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc_id}:{run}".encode())
            counts[run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    return brute({w: n for w, n in counts.items() if len(w) >= 7 and n >= 2})


def test_query_against_brute_force(spark, texts, tmp_path):
    rows = [(i, text_of(i, 40)) for i in range(400)] + [(900, None), (901, "")]
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in op11_spelling_variants(spark, str(tmp_path)).collect()}
    assert got == expected(rows)
    assert sum(r[0] is not None for r in got.values()) > 5
