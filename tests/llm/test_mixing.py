from __future__ import annotations

import random

import pytest

from stratalake.llm.mixing import mixed, op7_mixing

SCHEMA = "doc_id long, text string, source string"


def targets(rows):
    size = {}
    for _, text, source in rows:
        size[source] = size.get(source, 0) + len((text or "").encode().split())
    names = sorted(size, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, out = sum(size.values()), set(names), {}
    while open_:
        total = sum(weight[s] for s in open_)
        above = {s for s in open_ if left * weight[s] / total > 3 * size[s]}
        if not above:
            return size, out | {s: left * weight[s] / total for s in open_}
        out |= {s: 3 * size[s] for s in above}
        left -= sum(3 * size[s] for s in above)
        open_ -= above
    return size, out


def check(rows, found, slack):
    size, target = targets(rows)
    taken = {}
    assert len(found) == len(rows)
    for r in found:
        assert r.source_size == size[r.source] and r.target == pytest.approx(target[r.source])
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for source in size:
        assert abs(taken[source] - target[source]) <= slack, source


def test_targets_are_met(texts):
    rng = random.Random(3)
    words = lambda: rng.choice([None, "", "a b c", "x " * rng.randint(1, 400)])
    rows = [(rng.randint(0, 50), words(), rng.choice(["a", "a", "a", "b", "é", "z", "", None])) for _ in range(300)]
    keep = ("doc_id", "source")
    found = mixed(texts(rows, SCHEMA).drop("size"), keep).collect()
    check(rows, found, 32)
    assert sorted(map(str, found)) == sorted(map(str, mixed(texts(rows, SCHEMA), keep).collect()))


def test_small_source_is_taken_three_times(texts):
    rows = [(1, "w " * 100, "a"), (2, "w " * 2000, "b")]
    by = {r.doc_id: r for r in mixed(texts(rows, SCHEMA)).collect()}
    assert by[1].target == 300 and 288 <= by[1].taken <= 300 and by[1].copies == 3
    assert by[2].target == 1800 and by[2].copies == 1


def test_nothing_and_no_words(texts):
    assert mixed(texts([], SCHEMA)).collect() == []
    row = mixed(texts([(1, None, None)], SCHEMA)).first()
    assert (row["size"], row.target, row.taken, row.copies) == (0, 0.0, 0, 0)


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "source")
    found = op7_mixing(spark, folder).join(docs.select("doc_id", "source"), "doc_id").collect()
    check([tuple(r) for r in docs.collect()], found, 32 * 4)
