r"""Spelling variants by a trie-node pair dictionary.

Two words are near if they differ by exactly one inserted, deleted or replaced code point. All
near pairs are found exactly, and no pair of words is compared:

1. Words are range-sorted; a walk along each range numbers the nodes of their trie, as neighbours
   share the nodes of their common prefix. Nodes that the last word of a range shares with the
   first of the next get the earlier numbers; that needs a row per range on the driver. The same
   for reversed words gives the nodes of a trie of suffixes. Equal numbers mean equal prefixes,
   or suffixes, so strings of any length are whole numbers from here on.
2. A word gives the pair (prefix node, suffix node) around each of its code points, which skips
   that one, and around each place between them. Two words with an equal pair that skips have the
   same length and one replaced code point; a pair that skips one and a pair between are a word
   and the same with one code point more. In a stretch of equal code points only the first is
   skipped for that second meaning, so that each such pair of words meets once.
3. Pairs meet by their two numbers. The words of one pair differ in one code point, so a meeting
   has no more members than there are letters, and one whole word; each member takes the number
   of the others and the best of them, without listing pairs.

A word's form is its near word of largest count (ties: the smallest in code-point order), if that
is ``times`` the word's own or more. Counts grow along forms, so they make no rings; the end of
each chain, the root, is found by pointer jumping.

Null text has no words; null or repeated ids and rows count as they are. Words without near words
have 0 of them. An empty table gives an empty table. A word of any length is worked on, its work
is linear in its length. Other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.llm.words import chunks
from stratalake.sources.scratch import stored

#: Least code points of a word, least occurrences, and how many times a form is more frequent.
LEAST, OFTEN, TIMES = 7, 2, 10
#: Different words that a task counts before it sends them, and numbers that it emits at once.
HELD, ROWS = 300_000, 1 << 16
#: Bits of a node's number inside its range, and of a word's number.
BITS = 40
LOCAL = (1 << BITS) - 1
#: Latin letters: in Latin-1 one byte each, whose bytes.lower changes A to Z only.
LETTERS = rb"[a-z\xc0-\xff]"
#: What a row of the dictionary stands for.
REPLACED, SKIPPED, WHOLE = 0, 1, 2

Edit = Callable[[int | None], Callable[[bytes], bytes]]


def word_counts(docs: DataFrame, least: int = LEAST, often: int = OFTEN, edit: Edit | None = None) -> DataFrame:
    """``word, n``: words of at least ``least`` letters that occur ``often`` times or more.

    A word is a maximal run of A-Z, a-z and U+00C0 to U+00FF, with A-Z in lower case. ``edit``
    takes an id and returns a function of a run (in Latin-1) to the word it stands for.
    """
    find = re.compile(LETTERS + b"{%d,}" % least).findall
    schema = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[bytes] = Counter()

        def send() -> pa.RecordBatch:
            made = pa.record_batch([pa.array([w.decode("latin-1") for w in held], pa.string()), pa.array(list(held.values()), pa.int64())], schema=schema)
            held.clear()
            return made

        for batch in chunks(batches):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                # other characters become question marks, one each, which are no letters
                runs = Counter(find((text or "").encode("latin-1", "replace").lower()))
                if edit is None:
                    held.update(runs)
                    continue
                change = edit(doc_id)
                for run, n in runs.items():
                    word = change(run)
                    if len(word) >= least:
                        held[word] += n
            if len(held) > HELD:
                yield send()
        yield send()

    each = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(work, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= often)


def shared(left: str, right: str) -> int:
    """Length of the common prefix."""
    most = min(len(left), len(right))
    if left[:most] == right[:most]:
        return most
    low = 0
    while most - low > 16:  # long words are halved, the rest is read
        middle = (low + most) // 2
        low, most = (middle, most) if left[low:middle] == right[low:middle] else (low, middle)
    return next((i for i in range(low, most) if left[i] != right[i]), most)


def numbered(words: DataFrame, key: str) -> DataFrame:
    """The rows with ``part``, ``at`` (place in the range) and ``path`` (nodes along ``key``, root first).

    Numbers hold the range in their high bits. The nodes of a range's first word come first.
    """
    columns = [c for c in words.columns if c != key] + [key]
    kinds = {**dict(words.dtypes), "part": "int", "at": "bigint", "path": "binary"}

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at, fresh = TaskContext.get().partitionId(), 0, 0
        before, path = "", np.zeros(1, np.int64)
        for batch in batches:
            paths = []
            for word in batch.column(key).to_pylist():
                keep = shared(before, word)
                new = np.arange(fresh, fresh + len(word) - keep) + ((part + 1) << BITS)
                before, path, fresh = word, np.concatenate([path[: keep + 1], new]), fresh + len(new)
                paths.append(path.tobytes())
            place = np.arange(at, at + len(batch))
            at += len(batch)
            batch = batch.append_column("part", pa.array(np.full(len(batch), part, np.int32)))
            batch = batch.append_column("at", pa.array(place))
            yield batch.append_column("path", pa.array(paths, pa.binary()))

    sorted_ = words.select(*columns).repartitionByRange(key).sortWithinPartitions(key)
    return sorted_.mapInArrow(work, ", ".join(f"{c} {kinds[c]}" for c in [*columns, "part", "at", "path"]))


def renumbered(path: np.ndarray, part: int, carry: np.ndarray) -> np.ndarray:
    """The path with the nodes that an earlier range has as well under their earlier numbers."""
    local = path & LOCAL
    old = (path >> BITS == part + 1) & (local < len(carry))
    return np.where(old, carry[np.where(old, local, 0)] if len(carry) else path, path)


def carried(table: DataFrame, key: str) -> tuple[dict[int, np.ndarray], dict[int, int]]:
    """Per range: the earlier numbers of its first word's first nodes, and its place among the ranges.

    One row per range comes to the driver, with its first and last word.
    """
    ends = table.groupBy("part").agg(F.min(key).alias("first"), F.max(F.struct(key, "path")).alias("last"))
    carry, order, before, path = {}, {}, "", np.zeros(1, np.int64)
    for x in sorted(ends.collect(), key=lambda x: x["first"]):
        carry[x["part"]] = path[1 : shared(before, x["first"]) + 1]
        order[x["part"]] = len(order)
        path = renumbered(np.frombuffer(x["last"]["path"], np.int64), x["part"], carry[x["part"]])
        before = x["last"][key]
    return carry, order


def with_tries(words: DataFrame) -> DataFrame:
    """``id, word, n, front, back``: words in order of code points, with prefix and suffix nodes."""
    ends = stored(numbered(words.select("word", "n", F.reverse("word").alias("ending")), "ending"), "suffixes")
    late, _ = carried(ends, "ending")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = zip(batch.column("part").to_pylist(), batch.column("path").to_pylist())
            back = [renumbered(np.frombuffer(path, np.int64), part, late[part]).tobytes() for part, path in rows]
            yield pa.record_batch([batch.column("word"), batch.column("n"), pa.array(back, pa.binary())], names=["word", "n", "back"])

    settled = ends.select("word", "n", "part", "path").mapInArrow(settle, "word string, n long, back binary")
    begins = stored(numbered(settled, "word"), "prefixes")
    early, order = carried(begins, "word")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = batch.column("part").to_pylist()
            front = [renumbered(np.frombuffer(path, np.int64), p, early[p]).tobytes() for p, path in zip(part, batch.column("path").to_pylist())]
            name = np.array([order[p] << BITS for p in part], np.int64) + batch.column("at").to_numpy()
            columns = [pa.array(name), batch.column("word"), batch.column("n"), pa.array(front, pa.binary()), batch.column("back")]
            yield pa.record_batch(columns, names=["id", "word", "n", "front", "back"])

    return begins.mapInArrow(number, "id long, word string, n long, front binary, back binary")


def dictionary(words: DataFrame) -> DataFrame:
    """``prefix, suffix, kind, id, n``: the node pairs of each word."""
    schema = pa.schema([("prefix", pa.int64()), ("suffix", pa.int64()), ("kind", pa.int8()), ("id", pa.int64()), ("n", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for name, word, n, front, back in zip(*(batch.column(c).to_pylist() for c in ("id", "word", "n", "front", "back"))):
                front, back = (np.frombuffer(x, np.int64) for x in (front, back))
                letters = np.frombuffer(word.encode("utf-32-le"), np.uint32)
                kind = np.where(np.append(True, np.diff(letters) != 0), SKIPPED, REPLACED)
                prefix, suffix = np.concatenate([front[:-1], front]), np.concatenate([back[-2::-1], back[::-1]])
                kind = np.concatenate([kind, np.full(len(front), WHOLE)]).astype(np.int8)
                held.append((prefix, suffix, kind, np.full(len(kind), name), np.full(len(kind), n)))
                size += len(kind)
                if size > ROWS:
                    yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)
                    held, size = [], 0
            if held:
                yield pa.record_batch([pa.array(np.concatenate(c)) for c in zip(*held)], schema=schema)

    return words.mapInArrow(work, "prefix long, suffix long, kind byte, id long, n long")


MEETING = pa.schema([("id", pa.int64()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.int64())])


def met(prefix: np.ndarray, suffix: np.ndarray, kind: np.ndarray, name: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """For each member of the meetings of some whole pairs: its near words there, and the best of them."""
    order = np.lexsort((name, -n, suffix, prefix))
    prefix, suffix, kind, name, n = (x[order] for x in (prefix, suffix, kind, name, n))
    group = np.cumsum(np.append(0, (np.diff(prefix) != 0) | (np.diff(suffix) != 0)))[: len(name)]
    groups = int(group[-1]) + 1 if len(group) else 0

    def leading(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Members chosen of each group, and the first and second of them (-1 if there is none)."""
        at = np.flatnonzero(chosen)
        many = np.bincount(group[at], minlength=groups)
        first = np.cumsum(many) - many
        one, two = np.full(groups, -1), np.full(groups, -1)
        one[many > 0] = at[first[many > 0]]
        two[many > 1] = at[first[many > 1] + 1]
        return many, one, two

    many, one, two = leading(kind != WHOLE)
    skips, skip, _ = leading(kind == SKIPPED)
    whole = np.full(groups, -1)
    whole[group[kind == WHOLE]] = np.flatnonzero(kind == WHOLE)
    place = np.arange(len(name))
    other = np.where(one[group] == place, two[group], one[group])
    near = many[group] - 1
    with_whole = (kind == SKIPPED) & (whole[group] >= 0)
    near = np.where(kind == WHOLE, skips[group], near + with_whole)
    best = np.where(kind == WHOLE, skip[group], other)
    rival = np.where(with_whole, whole[group], -1)
    better = (rival >= 0) & ((best < 0) | (n[rival] > n[best]) | ((n[rival] == n[best]) & (name[rival] < name[best])))
    best = np.where(better, rival, best)
    some = near > 0
    return pa.record_batch([pa.array(x) for x in (name[some], near[some], n[best[some]], name[best[some]])], schema=MEETING)


def near_words(words: DataFrame) -> DataFrame:
    """``id, n_near, best_n, best`` of the words that have near words."""
    names = ("prefix", "suffix", "kind", "id", "n")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in names]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows)]
            change = np.flatnonzero((np.diff(rows[0]) != 0) | (np.diff(rows[1]) != 0))
            cut = int(change[-1]) + 1 if len(change) else 0  # the last pair may go on in the next batch
            if cut:
                yield met(*(x[:cut] for x in rows))
            rest = [x[cut:] for x in rows]
        if rest is not None and len(rest[0]):
            yield met(*rest)

    pairs = dictionary(words).repartition("prefix", "suffix").sortWithinPartitions("prefix", "suffix")
    found = pairs.mapInArrow(work, "id long, near long, best_n long, best long")
    most = F.max(F.struct("best_n", (-F.col("best")).alias("low"))).alias("most")
    total = found.groupBy("id").agg(F.sum("near").alias("n_near"), most)
    return total.select("id", "n_near", F.col("most.best_n").alias("best_n"), (-F.col("most.low")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``id, root`` from ``id, form``: the end of each chain of forms, by pointer jumping."""
    reached = stored(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        ahead = reached.select(F.col("id").alias("root"), F.col("root").alias("next"))
        further = reached.join(ahead, "root", "left")
        reached = stored(further.select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        moved = not reached.filter("moved").isEmpty()
        reached = reached.select("id", "root")
        if not moved:
            return reached


def spelling_variants(counts: DataFrame, times: int = TIMES) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of each word of ``word, n``; words must be distinct."""
    words = stored(with_tries(counts.select("word", F.col("n").cast("long").alias("n"))), "words")
    near = stored(near_words(words), "near")
    names = words.select("id", "word", "n")
    rows = names.join(near, "id", "left")
    formed = F.col("best_n") >= times * F.col("n")
    rows = stored(rows.select("*", F.when(formed, F.col("best")).alias("form_id"), F.when(formed, F.col("best_n")).alias("form_n")), "forms")
    edges = rows.filter("form_id IS NOT NULL").select("id", F.col("form_id").alias("form"))
    ends = roots(edges)
    spelled = lambda column: names.select(F.col("id").alias(f"{column}_id"), F.col("word").alias(column))
    named = edges.withColumnRenamed("form", "form_id").join(ends.withColumnRenamed("root", "root_id"), "id")
    named = named.join(spelled("form"), "form_id").join(spelled("root"), "root_id").select("id", "form", "root")
    return rows.join(named, "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n"
    )


def damaged(doc_id: int | None) -> Callable[[bytes], bytes]:
    """Runs with one code point lost here and there, as the query's contract says; null ids are empty."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())

    def change(run: bytes) -> bytes:
        h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), start)
        return run if h % 31 else run[: h % len(run)] + run[h % len(run) + 1 :]

    return change


def op11_spelling_variants(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return spelling_variants(stored(word_counts(docs, edit=damaged), "counts"))
