"""Runs against a brute-force search over all periods and places."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from stratalake.llm.periodic_runs import find_runs, op12_periodic_runs, periodic_runs


def smallest_period(words):
    return next(p for p in range(1, len(words) + 1) if all(words[i] == words[i - p] for i in range(p, len(words))))


def brute(words, least, times):
    """Every maximal stretch of each period, kept where the period is its smallest."""
    n, runs = len(words), []
    for period in range(1, n // times + 1):
        same = [words[i] == words[i + period] for i in range(n - period)]
        i = 0
        while i < len(same):
            j = i
            while j < len(same) and same[j]:
                j += 1
            length = j - i + period
            if j > i and length >= max(least, times * period) and smallest_period(words[i : i + length]) == period:
                runs.append((i, length, period))
            i = j + 1
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapse(words, runs):
    gone = {i for start, length, period in runs for i in range(start + period, start + length)}
    return [w for i, w in enumerate(words) if i not in gone]


def periodic_words(seed):
    """Words with periods inside periods, runs that touch, and plain stretches."""
    pick = random.Random(seed)
    words = []
    while len(words) < 220:
        root = [pick.choice("ab" if pick.random() < 0.5 else "abcdef") for _ in range(pick.randint(1, 12))]
        if pick.random() < 0.3:
            root = root * 2 + root[:1]
        words += (root * pick.randint(1, 9))[: pick.randint(1, 90)]
    return words


@pytest.mark.parametrize("least", [2, 24])
def test_random_words_against_brute_force(least):
    texts = [periodic_words(seed) for seed in range(60)] + [["x"] * 100, list("ab" * 40), [], ["x"]]
    numbers = {w: i for i, w in enumerate("abcdefx")}
    words = np.array([numbers[w] for text in texts for w in text], np.int64)
    sizes = [len(t) for t in texts]
    owner = np.repeat(np.arange(len(texts)), sizes)
    rows = find_runs(words, owner, max(sizes), least, 3)
    first = np.append(0, np.cumsum(sizes))
    found = 0
    for i, text in enumerate(texts):
        own = rows[(rows[:, 0] >= first[i]) & (rows[:, 0] < first[i + 1])] - (first[i], 0, 0)
        assert [tuple(r) for r in own.tolist()] == brute(text, least, 3)
        found += len(own)
    assert found > 60


def test_edge_cases(texts):
    long = " ".join(f"w{i % 1001}" for i in range(60_000))
    rows = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (None, "na " * 24),
        (5, "na " * 23),
        (6, long),
        (6, long),
        (7, "a b " * 30),  # a no-break space is part of a word
    ]
    found = sorted(periodic_runs(texts(rows)).collect(), key=lambda r: (r.doc_id or 0, r.n_words))
    runs = {(r.doc_id, r.n_words): [tuple(x) for x in r.runs] for r in found}
    assert len(found) == 8
    assert runs[(None, 24)] == [(0, 24, 1)] and runs[(5, 23)] == [] and runs[(1, 0)] == []
    assert runs[(6, 60_000)] == [(0, 60_000, 1001)] and runs[(7, 30)] == [(0, 30, 1)]
    kept = {r.doc_id: r.collapsed for r in found}
    assert kept[None] == "na" and kept[5] == " ".join(["na"] * 23) and kept[1] == kept[3] == ""
    assert kept[6] == " ".join(f"w{i}" for i in range(1001))


def test_empty_table(texts):
    assert periodic_runs(texts([])).collect() == []


def expected(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words, 24, 3)
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    return (
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{x},{p}\n" for s, x, p in runs).encode()),
        sha(b" ".join(collapse(words, runs))),
    )


def test_query_against_brute_force(spark, texts, tmp_path):
    pick = random.Random(3)
    rows = [(i, " ".join(pick.choice(["sun", "sea", f"x{pick.randint(0, 40)}"]) for _ in range(pick.randint(0, 150)))) for i in range(300)]
    rows += [(1000, None), (1001, "la " * 70), (1002, "do re " * 40 + "mi")]
    texts(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r[0]: tuple(r)[1:] for r in op12_periodic_runs(spark, str(tmp_path)).collect()}
    assert got == {i: expected(i, text) for i, text in rows}
    assert sum(r[0] > 0 for r in got.values()) > 10
