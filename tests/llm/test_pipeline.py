from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from stratalake.sources.scratch import stored

from test_jaccard_join import brute

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_is_registered():
    names = list(contract.queries())
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = [(None, "un deux trois quatre cinq six", None, None, None), (None, None, None, None, None), (7, "", None, None, 0), (8, "12 34", "en", "src1", 5)]
    docs = docs.unionByName(docs.limit(20)).unionByName(spark.createDataFrame(odd, docs.schema))
    seen = [docs]
    for _, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], FOLDER)))
    language, unique, clean, mix, tokens = seen[1:]
    assert all(d.columns == docs.columns for d in seen[1:5])
    assert language.count() == docs.count() - 3  # null, empty and without letters
    rows = [(r.doc_id, r.text) for r in language.collect()]
    groups = {(c, i) if i is None else c for i, n, c in brute(rows)}
    assert unique.count() == len(groups)
    assert clean.count() == unique.count() and clean.filter("text LIKE '%@%.%' AND text NOT LIKE '%[EMAIL]%'").count() == 0
    assert mix.join(clean, "doc_id", "left_anti").filter("doc_id IS NOT NULL").count() == 0
    assert tokens.count() == mix.count()


def test_no_documents(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stored(stage(spark, docs, FOLDER))
    assert docs.count() == 0
