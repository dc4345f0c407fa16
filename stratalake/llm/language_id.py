"""Language identification by language-bitmask n-gram filters.

Training notes which languages use each letter n-gram often enough, and stores that as a Bloom
filter of bitmasks: ``HASHES`` slots per n-gram, each slot a mask with one bit per language. One
lookup, the AND of the slots, returns all languages that may contain the n-gram. A text is judged
by counting, per language, the n-grams whose mask has its bit. A filter that is filled to a
share f answers "contained" for f**HASHES of all unknown n-grams, so that many are taken off
each count before the largest decides.

The model is fitted on a bounded sample (about ``per_language`` whole texts of each language,
chosen by a hash of the id); prediction covers every row. A prediction sees the text only.

Null text or no letter: ``und``, score 0. Letters, but no n-gram of any filter: the language with
most training rows, score 0. No training rows at all: ``und`` everywhere. Ties go to the language
with more training rows, then by name. Repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.words import chunks, mix

UNDETERMINED = "und"
#: Bytes of an n-gram, slots of the filter, and slots looked up for each n-gram.
GRAM, SLOTS, HASHES = 4, 1 << 20, 2
#: Whole training texts of each language, about.
PER_LANGUAGE = 2_000
#: An n-gram is a language's if seen so often, and at this share of its highest frequency.
LEAST_SEEN, LEAST_SHARE = 3, 0.2

BLANK = 0x20
_FOLD = np.full(256, BLANK, np.uint8)  # every ASCII byte but a letter parts words
_FOLD[0x80:] = np.arange(0x80, 0x100)
for _c in range(26):
    _FOLD[[ord("A") + _c, ord("a") + _c]] = ord("a") + _c


def grams(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of the texts, as 32-bit values, and the text that each is from.

    Texts are parted by a blank; n-grams with a blank anywhere but at one end are left out.
    """
    text = pc.fill_null(text.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset : text.offset + len(text) + 1]
    buffer = text.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[offsets[0] : offsets[-1]] if buffer else np.zeros(0, np.uint8)
    offsets = offsets - offsets[0] + np.arange(len(offsets))  # room for a blank before each text
    place = np.ones(offsets[-1] + 1, bool)
    place[offsets] = False
    line = np.full(len(place), BLANK, np.uint8)
    line[place] = _FOLD[data]
    last = len(line) - GRAM + 1
    if last <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    value = np.zeros(last, np.uint32)
    for i in range(GRAM):
        value = (value << np.uint32(8)) | line[i : i + last]
    blank = line == BLANK
    whole = ~np.logical_or.reduce([blank[i : i + last] for i in range(1, GRAM - 1)]) & ~(blank[:last] & blank[GRAM - 1 :])
    at = np.flatnonzero(whole)
    return value[at], np.searchsorted(offsets, at, side="right") - 1


def places(values: np.ndarray) -> list[np.ndarray]:
    spread = mix(values.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return [((spread >> np.uint64(32 * i)) & np.uint64(SLOTS - 1)).astype(np.int64) for i in range(HASHES)]


@dataclass
class Filters:
    """``slots`` has one plane of 8 languages per row; ``false_rate`` is per language."""

    languages: list[str]
    slots: np.ndarray
    false_rate: np.ndarray

    @classmethod
    def build(cls, languages: list[str], values: np.ndarray, owners: np.ndarray) -> Filters:
        slots = np.zeros(((len(languages) + 7) // 8, SLOTS), np.uint8)
        for i in range(len(languages)):
            for place in places(values[owners == i]):
                slots[i // 8][place] |= np.uint8(1 << i % 8)
        filled = np.array([(slots[i // 8] >> (i % 8) & 1).mean() for i in range(len(languages))])
        return cls(languages, slots, filled**HASHES)

    def counts(self, text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Per text: its number of n-grams, and of those that each language contains."""
        values, owner = grams(text)
        total = np.bincount(owner, minlength=len(text)).astype(float)
        found = np.zeros((len(text), len(self.languages)))
        at = places(values)
        for plane in range(len(self.slots)):
            mask = np.bitwise_and.reduce([self.slots[plane][p] for p in at])
            for i in range(8 * plane, min(8 * plane + 8, len(self.languages))):
                found[:, i] = np.bincount(owner[(mask >> (i % 8) & 1).astype(bool)], minlength=len(text))
        return total, found

    def judge(self, text: pa.Array) -> tuple[list[str], list[float]]:
        total, found = self.counts(text)
        real = np.clip((found - total[:, None] * self.false_rate) / (1 - self.false_rate), 0, None)
        best = real.argmax(1)
        every = real.sum(1)
        score = np.divide(real[np.arange(len(best)), best], every, out=np.zeros(len(best)), where=every > 0)
        letters = [t is not None and any(map(str.isalpha, t)) for t in text.to_pylist()]
        return (
            [self.languages[i] if ok else UNDETERMINED for i, ok in zip(best.tolist(), letters)],
            [s if ok else 0.0 for s, ok in zip(score.tolist(), letters)],
        )


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> Filters | None:
    """Filters from ``doc_id, text, lang``; rows without a language or text are not used."""
    labelled = labelled.select("doc_id", "text", "lang").filter("lang IS NOT NULL AND text IS NOT NULL")
    rows = {x["lang"]: x["n"] for x in labelled.groupBy("lang").agg(F.count("*").alias("n")).toLocalIterator()}
    if not rows:
        return None
    languages = sorted(rows, key=lambda lang: (-rows[lang], lang))
    share = F.coalesce(*[F.when(F.col("lang") == x, F.lit(min(1.0, per_language / rows[x]))) for x in languages])
    drawn = F.pmod(F.xxhash64(F.lit("language sample"), "doc_id"), F.lit(1 << 30)) < share * float(1 << 30)
    schema = pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("seen", pa.int64())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches):
            values, owner = grams(batch.column("text"))
            spoken = np.array([languages.index(x) for x in batch.column("lang").to_pylist()])
            both, n = np.unique((spoken[owner].astype(np.uint64) << np.uint64(32)) | values, return_counts=True)
            name = pa.array([languages[i] for i in (both >> np.uint64(32)).tolist()], pa.string())
            yield pa.record_batch([name, pa.array((both & np.uint64(0xFFFFFFFF)).astype(np.int64)), pa.array(n)], schema=schema)

    seen = labelled.filter(drawn).mapInArrow(count, "lang string, gram long, seen long")
    seen = seen.groupBy("lang", "gram").agg(F.sum("seen").alias("seen"))
    seen = seen.withColumn("rate", F.col("seen") / F.sum("seen").over(Window.partitionBy("lang")))
    top = F.max("rate").over(Window.partitionBy("gram"))
    chosen = seen.withColumn("top", top).filter((F.col("seen") >= LEAST_SEEN) & (F.col("rate") >= LEAST_SHARE * F.col("top")))
    kept = chosen.select("lang", "gram").toArrow()  # bounded by the sample
    owners = np.array([languages.index(x) for x in kept["lang"].to_pylist()], np.int64)
    return Filters.build(languages, kept["gram"].to_numpy().astype(np.uint32), owners)


def predict(docs: DataFrame, filters: Filters | None, *keep: str) -> DataFrame:
    """The columns ``keep`` of each row with ``lang_pred`` and ``score``."""
    if filters is None:
        return docs.select(*keep, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    inner = [f"__{i}" for i in range(len(keep))]
    source = docs.select(F.col("text").alias("__text"), *[F.col(k).alias(i) for k, i in zip(keep, inner)])
    shared = docs.sparkSession.sparkContext.broadcast(filters)
    kinds = [f"{i} {source.schema[i].dataType.simpleString()}" for i in inner]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "__text"):
            language, score = shared.value.judge(batch.column("__text"))
            columns = [batch.column(i) for i in inner] + [pa.array(language, pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*inner, "lang_pred", "score"])

    judged = source.mapInArrow(run, ", ".join([*kinds, "lang_pred string", "score double"]))
    return judged.select(*[F.col(i).alias(k) for k, i in zip(keep, inner)], "lang_pred", "score")


def held_out() -> Column:
    """Rows that nothing is learned from; a null id is neither held out nor learned from."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1


def op10_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    filters = fit(docs.filter(~held_out()))
    judged = predict(docs, filters, "doc_id")
    return judged.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
