from __future__ import annotations

import hashlib
import random

from pyspark.sql import functions as F

from stratalake.llm.chat_format import HOSTILE, format_conversations, masked, op4_chat_format

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    talks = {}
    for conv, turn, role, text in rows:
        talks.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        whole = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learned = "".join(text for *_, role, text in turns if role == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        yield conv, len(turns), digest(whole), len(learned), digest(learned)


def measured(done):
    lines = F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    done = done.withColumn("learned", masked(F.col("formatted"), F.col("loss")))
    return done.select("conv_id", F.size("turns"), F.sha2(F.array_join(lines, ""), 256), F.length("learned"), F.sha2("learned", 256))


def test_hostile_texts_and_roles_read_back(texts):
    rng = random.Random(1)
    parts = ["###", "#", "\\", "</turn>", "\n", "\n</turn>\n", ": ", "### User: ", "a", "é😀", "</", "turn>", "\\###", "$1"]
    roles = ["user", "assistant", "system", None, "", "tool: x", "### ", "</turn>"]
    rows = [
        (rng.choice([None, *range(20)]), rng.choice([None, 0, 1, 2, 3]), rng.choice(roles), None if rng.random() < 0.1 else "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
        for _ in range(600)
    ]
    rows += [(99, 0, "assistant", "\\" * 100_000 + "x"), (99, 1, "user", "</turn>\\")]
    found = measured(format_conversations(texts(rows, SCHEMA)))
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(map(str, brute(rows)))


def test_clean_text_stays_as_it_is(texts):
    row = format_conversations(texts([(1, 0, "user", "a \\ b"), (1, 1, "assistant", "c")], SCHEMA)).first()
    assert row.formatted == "### User: a \\ b\n</turn>\n### Assistant: c\n</turn>\n"
    assert [row.formatted[x.start : x.stop] for x in row.loss] == ["c"]


def test_nothing(texts):
    assert format_conversations(texts([], SCHEMA)).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", HOSTILE), (-7, 1, "assistant", HOSTILE)]
    assert sorted(tuple(r)[:5] for r in op4_chat_format(spark, folder).collect()) == sorted(brute(rows))
