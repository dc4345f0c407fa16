from __future__ import annotations

import collections
import os
import random

import pytest

from stratalake.llm import jaccard_join
from stratalake.llm.jaccard_join import near_duplicates, op8_jaccard_join, without_near_duplicates

LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def brute(rows, k=5):
    sets, where = [], collections.defaultdict(list)
    for _, text in rows:
        w = (text or "").encode().translate(LOWER).split()
        sets.append({tuple(w)} if 0 < len(w) < k else {tuple(w[a : a + k]) for a in range(len(w) - k + 1)})
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for a, s in enumerate(sets):
        common = collections.Counter(b for t in s for b in where[t])
        for b, n in common.items():
            if 100 * n >= 75 * (len(s) + len(sets[b]) - n):
                parent[top(a)] = top(b)
        for t in s:
            where[t].append(a)
    least = {}
    for a, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(a)] = min(least.get(top(a), doc_id), doc_id)
    return [(i, len(sets[a]), least.get(top(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)]


def near_copies(seed, n):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefghijklmnop") * rng.randint(1, 2) for _ in range(m)] for m in (5, 7, 8, 9, 12, 20, 40, 90, 200)]
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 1, 2, 3, 5])):
            words[rng.randrange(len(words))] = rng.choice(["x", "Y", "zz"])
        if rng.random() < 0.2:
            words = words[: rng.randint(0, len(words))]
        if rng.random() < 0.3:
            words += [rng.choice("qrs") for _ in range(rng.randint(1, 12))]
        yield rng.choice([None, i, i, i, i, i - 1]), rng.choice([None] + [" ".join(words)] * 30)


@pytest.mark.parametrize("common", [5, 64])
def test_equals_brute_force(texts, monkeypatch, common):
    monkeypatch.setattr(jaccard_join, "COMMON", common)
    rows = list(near_copies(common, 500))
    assert sorted(str(tuple(r)) for r in near_duplicates(texts(rows).repartition(3)).collect()) == sorted(map(str, brute(rows)))


def test_families_of_near_copies_in_blocks(texts, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK", 16)
    rng, rows = random.Random(3), []
    for _ in range(3):
        base = [f"w{rng.randrange(10**6)}" for _ in range(60)]
        for _ in range(70):
            words = list(base)
            for _ in range(rng.randint(0, 3)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), " ".join(words)))
    expected = brute(rows)
    assert 3 < len({c for _, _, c in expected}) < len(rows) / 2
    assert sorted(map(tuple, near_duplicates(texts(rows).repartition(3)).collect())) == sorted(expected)


def test_one_row_of_each_group_stays(texts):
    one, other = "a b c d e f g h", "p q r s t u"
    rows = [(2, one), (1, one), (1, one), (None, one), (None, other), (5, None), (5, None), (6, "")]
    kept = without_near_duplicates(texts(rows)).select("doc_id", "text").collect()
    assert sorted(str(tuple(r)) for r in kept) == sorted(map(str, [(1, one), (None, other), (5, None), (5, None), (6, "")]))
    assert without_near_duplicates(texts([])).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, op8_jaccard_join(spark, folder).collect())) == sorted(brute(rows))


def test_words_of_like_shape_do_not_link_texts(texts):
    one, two = "a", "b"
    while len(one) < 1024:
        one, two = one + two, two + one
    rows = near_duplicates(texts([(1, one), (2, two), (3, "y " * 50_000)])).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {1: (1, 1), 2: (1, 2), 3: (1, 3)}


@pytest.mark.parametrize(("sparse", "few"), [(0, 1), (10**6, 1), (0, 10**6)])
def test_crowded_and_sparse_groups(texts, monkeypatch, sparse, few):
    monkeypatch.setattr(jaccard_join, "SPARSE", sparse)
    monkeypatch.setattr(jaccard_join, "FEW", few)
    rows = list(near_copies(11, 250))
    assert sorted(str(tuple(r)) for r in near_duplicates(texts(rows).repartition(3)).collect()) == sorted(map(str, brute(rows)))


def test_what_tasks_hold_is_given_up(spark, texts, monkeypatch):
    sent, kept = [], type(spark.sparkContext).broadcast

    def broadcast(self, value):
        sent.append(kept(self, value))
        return sent[-1]

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    near_duplicates(texts([(i, f"a b c d e f g h i j k l m n o p q r {i % 2}") for i in range(4)]))
    assert len(sent) > 2
    assert not [b for b in sent if os.path.exists(b._path)]
