r"""Periodic runs of words by the dictionary of basic factors.

A run is a stretch of neighbouring words with smallest period q, at least ``least`` words and
``times`` periods long, that no neighbouring word extends. For each power of two a text's factors
of that many words get whole numbers: words are numbered exactly, and a factor of twice the length
is numbered by the pair of its halves. Only places whose factor occurs again go on to the next
power, as a longer factor there could not occur again either.

A place whose next occurrence is d words on, where d is above half the factor's length and not
above the length, proposes the period d: the occurrences overlap or touch, so the words between
repeat. Inside a run of period q, factors of the first power of two not below q recur every q
words and no sooner, so neighbouring places with one distance are one arithmetic progression, and
it reaches as far as the run: ``b - a + d + length`` words for places a to b. By the same argument
each run is proposed once, by one power of two.

Texts of a block go through these steps together, as numpy arrays inside one task; nothing is
shuffled. Work is O(n log n) in the words of a text and memory is a few arrays of its words.

Null or empty text: no words and no runs. Null ids are kept. Every row is judged by itself, so
repeated rows and ids do no harm; other columns are not read. A text of any length is worked on
whole, and one that is longer than a block is a block by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.llm.words import chunks

LEAST, TIMES = 24, 3
#: Bytes of text worked on at once.
CHUNK = 2 << 20
SPACES = r"[\x20\x09-\x0D]+"

RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])
DDL = "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string"


def proposals(words: np.ndarray, text: np.ndarray, longest: int, times: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Places, distances to the next occurrence and factor length, for each power of two.

    ``words`` are the numbers of all words, ``text`` the number of the text of each.
    """
    place, length = np.arange(len(words)), 1
    key = text * (words.max(initial=0) + 1) + words  # factors of different texts have different numbers
    while len(place) and times * (length // 2 + 1) <= longest:
        order = np.argsort(key, kind="stable")
        at, same = place[order], np.diff(key[order]) == 0
        apart = np.diff(at)
        near = same & (apart > length // 2) & (apart <= length)
        yield at[:-1][near], apart[near], length
        again = np.append(same, False) | np.append(False, same)
        number = np.full(len(words), -1)
        number[at[again]] = np.append(0, np.cumsum(~same))[again]
        left = np.sort(at[again])
        left = left[left + length < len(words)]
        left = left[(number[left + length] >= 0) & (text[left] == text[left + length])]
        place, key = left, number[left] * (len(words) + 1) + number[left + length]
        length *= 2


def find_runs(words: np.ndarray, text: np.ndarray, longest: int, least: int, times: int) -> np.ndarray:
    """Rows of start, length and period, in order of start, then period; starts count from the first word of all."""
    found = [np.zeros((0, 3), np.int64)]
    for place, apart, length in proposals(words, text, longest, times):
        order = np.argsort(place)
        place, apart = place[order], apart[order]
        new = np.append(True, (np.diff(place) != 1) | (np.diff(apart) != 0))[: len(place)]
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(place))[: len(first)] - 1
        found.append(np.column_stack([place[first], place[last] - place[first] + apart[first] + length, apart[first]]))
    rows = np.concatenate(found)
    rows = rows[rows[:, 1] >= np.maximum(least, times * rows[:, 2])]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def kept_words(n: int, runs: np.ndarray) -> np.ndarray:
    """A mask of the words that no run holds beyond its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] == 0


def periodic_runs(docs: DataFrame, least: int = LEAST, times: int = TIMES) -> DataFrame:
    """``doc_id, n_words, runs, collapsed``: each text's runs, and the text without repetitions.

    Runs are ``start`` (number of a word, from 0), ``length`` and ``period`` in words, by start,
    then period. ``collapsed`` holds the words that remain, unchanged, joined by one space.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, most=CHUNK):
            # bytes.split cuts at the same six characters as the pattern of a word
            texts = [(text or b"").split() for text in batch.column("text").cast(pa.binary()).to_pylist()]
            sizes = np.array([len(words) for words in texts], np.int64)
            first = np.append(0, np.cumsum(sizes))
            coded = pa.array([w for words in texts for w in words], pa.large_binary()).dictionary_encode()
            numbers = coded.indices.to_numpy().astype(np.int64)
            rows = find_runs(numbers, np.repeat(np.arange(len(sizes)), sizes), int(sizes.max(initial=0)), least, times)
            of = np.searchsorted(rows[:, 0], first)
            runs, collapsed = [], []
            for i, words in enumerate(texts):
                own = rows[of[i] : of[i + 1]] - (first[i], 0, 0)
                runs.append([dict(zip(("start", "length", "period"), row)) for row in own.tolist()])
                if len(own):
                    words = [words[j] for j in np.flatnonzero(kept_words(len(words), own)).tolist()]
                collapsed.append(b" ".join(words))
            columns = [batch.column("doc_id"), pa.array(sizes), pa.array(runs, SCHEMA.field("runs").type)]
            yield pa.record_batch([*columns, pa.array(collapsed, pa.binary()).cast(pa.string())], schema=SCHEMA)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, DDL)


def strongest(runs: Column) -> Column:
    """The run with the greatest length / period; ties: smallest start, then period. Null without runs."""

    def order(a: Column, b: Column) -> Column:
        left, right = a["length"] * b["period"], b["length"] * a["period"]
        apart = F.when(left != right, F.when(left > right, -1).otherwise(1))
        start = F.when(a["start"] != b["start"], F.when(a["start"] < b["start"], -1).otherwise(1))
        period = F.when(a["period"] != b["period"], F.when(a["period"] < b["period"], -1).otherwise(1))
        return F.coalesce(apart, start, period, F.lit(0))

    return F.get(F.array_sort(runs, order), F.lit(0))


def echoed(docs: DataFrame) -> DataFrame:
    """``doc_id, text``; the end of every tenth text repeats some of its words, as the query's contract says.

    Null ids: their texts stay as they are.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)
    rows = docs.select("doc_id", "text", h.alias("h"), g.alias("g"))
    words = F.filter(F.split("text", SPACES), lambda w: w != "")
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words))
    n = F.size("words").cast("long")
    rows = rows.withColumn("a", F.when(n > 0, F.col("g") % n))
    period = 1 + F.floor((n - F.col("a")) / (3 + F.col("g") % 8))
    rows = rows.withColumn("p", F.when(n > 0, period))

    def source(w: Column, i: Column) -> Column:
        back = F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))
        return F.get(F.col("words"), back.cast("int"))

    repeated = F.array_join(F.transform("words", source), " ")
    return rows.select("doc_id", F.when(n > 0, repeated).otherwise(F.col("text")).alias("text"))


def op12_periodic_runs(spark, sf_dir):
    found = periodic_runs(echoed(spark.read.parquet(f"{sf_dir}/documents.parquet")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    found = found.withColumn("best", strongest(F.col("runs")))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{name}").alias(name) for name in ("start", "length", "period")],
        F.expr("best.length * 1000 DIV best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
