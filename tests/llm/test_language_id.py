from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from stratalake.llm.language_id import Filters, fit, grams, op10_language_id, predict


def test_grams_stay_inside_words():
    value, owner = grams(pa.array(["Ab, cde", None, "wxyz"]))
    text = [int(v).to_bytes(4, "big").decode() for v in value]
    assert list(zip(text, owner.tolist())) == [(" cde", 0), ("cde ", 0), (" wxy", 2), ("wxyz", 2), ("xyz ", 2)]


def test_more_languages_than_a_plane_holds():
    languages = [f"l{i:02}" for i in range(20)]
    texts = [chr(ord("a") + i) * 4 for i in range(20)]
    values = [grams(pa.array([t]))[0] for t in texts]
    filters = Filters.build(languages, np.concatenate(values), np.repeat(np.arange(20), [len(v) for v in values]))
    assert filters.judge(pa.array(texts))[0] == languages


def test_rows_without_letters(spark, texts):
    filters = fit(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    rows = [(1, None), (2, ""), (3, "123 .."), (4, "漢字"), (5, "the of and"), (None, "the of and")]
    found = {r.doc_id: (r.lang_pred, r.score) for r in predict(texts(rows), filters, "doc_id").collect()}
    assert found[1] == found[2] == found[3] == ("und", 0.0)
    assert found[4][1] == 0.0 and found[4][0] in filters.languages and found[5][0] == found[None][0] == "en"
    assert predict(texts([]), filters, "doc_id").collect() == []


def test_nothing_to_learn_from(texts):
    assert fit(texts([], "doc_id long, text string, lang string")) is None
    assert predict(texts([(1, "abc")]), None, "doc_id").first().lang_pred == "und"


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang").collect()}
    found = op10_language_id(spark, folder).collect()
    assert {r.doc_id: r.held_out for r in found} == {i: zlib.crc32(str(i).encode()) % 3 == 1 for i in lang}
    held = [r for r in found if r.held_out]
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in found)
