"""N-gram Jaccard join: parity sketches joined by pigeonhole, then verified exactly.

A document is the set of its distinct shingles. Texts with one set form a class, and only
classes are joined. Sizes fall into bands that grow by 4/3, so two sets with a similarity of 3/4
lie in one band or in neighbouring ones; a set takes part in its own band and in the next.

In a band whose largest size is U, two linked sets differ in at most D = 2 U / 7 shingles. The
sketch of a set is P > D words of 64 bits: each shingle flips the bits of its own hash in one
word. A shingle that only one of two sets has changes one word, so the number of differing words
is a lower bound of the difference, and two linked sets have all but D words in common. A set
with more than D non-empty words therefore shares a non-empty word with each of its partners:
joining on (band, word number, word) finds every linked pair.

More than that: a linked set has all but D of its non-empty words in common, and the first D + 1
non-empty words of both hold a common one. So a counting sketch of all words comes first. A set
with fewer words that may be repeated than its size demands is in no pair; the others send their
first D + 1 words, where these may be repeated.

That bound holds for any subset of the shingles. Shingles that many texts share are left out
first, as their words would join unlike texts; sets that keep too few others use their whole
sketch among themselves, and sets too small even for that use their shingles.

Groups of classes with a common word are compared in three rounds: first each class with that first
of a group with which it shares most groups; after components are known, the pairs of a group that
is still apart which may be linked by their folded sketches, or where these are many, each class with
the hub, which is the member nearest to the majority of the group's sketches (of several hubs the
nearest); last, in groups that had a hub, all classes that are in different components yet.
So a group of thousands of near copies costs about two comparisons each, and no linked pair is left
untested unless it is in one component already. Before two sets are moved, their parity sketches of
single bits are compared: the Hamming distance cannot be above the difference of the sets. It is
compared inside groups by folded sketches first.

Null or empty texts: no shingles, linked with nothing. Rows without an id are no candidates for
``component_id`` and get their component's, or null. Repeated ids are judged by their texts.
Sets, and words of a band, are told apart by 64 bits; comparison is on 64-bit shingle hashes, which
are no sums or products of letters (``words.Hasher``). Very long texts are worked on alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.llm.bits import collect_set, contains, repeated
from stratalake.llm.words import Hasher, chunks, mix, split_words
from stratalake.sources.scratch import drop_stored, stored

SHINGLE = 5
#: Linked at NUMERATOR / DENOMINATOR or more.
NUMERATOR, DENOMINATOR = 75, 100
#: A shingle of so many texts, counted where one task sees it more than once, is common.
COMMON = 64
RARE, WHOLE, SINGLE = 1, 2, 3
#: Bytes of text, and shingles, that a task works on at once.
CHUNK, HELD = 2 << 20, 1_500_000
#: Classes of a group that one task compares with each other, or with as many.
BLOCK = 1024
#: Bytes of folded sketches, at least; those of large sets have half of the sketch.
BRIEF = 64
#: Groups of more classes are left out where one component holds them, before sketches are moved.
FEW = 64
#: Pairs for each member that a group is compared by; if more may be linked, it is compared with a hub.
SPARSE = 2


def _bands(most: int) -> np.ndarray:
    """The least size of each band, beyond ``most``."""
    sizes = [1]
    while sizes[-1] <= 2 * most + 2:
        sizes.append(max(sizes[-1] + 1, -(-sizes[-1] * DENOMINATOR // NUMERATOR)))
    return np.array(sizes)


class Sets:
    """The distinct shingles of some texts: ``tokens`` sorted within each text, ``first`` places."""

    def __init__(self, text: pa.Array, hasher: Hasher, shingle: int) -> None:
        texts = split_words(text)
        words = hasher.words(texts.data, texts.start, texts.end)
        count = np.diff(texts.first)
        runs = np.where(count > 0, np.maximum(count - shingle + 1, 1), 0)
        owner = np.repeat(np.arange(len(runs)), runs)
        inside = np.arange(len(owner)) - np.repeat(np.cumsum(runs) - runs, runs)
        grams = hasher.grams(words, texts.first[:-1][owner] + inside, np.minimum(count, shingle)[owner])
        if len(runs) < 1 << 16:  # one sort of longs: the text, then the high bits of the hash
            order = np.argsort((owner.astype(np.uint64) << np.uint64(48)) | (grams >> np.uint64(16)))
        else:
            order = np.lexsort((grams, owner))
        grams, owner = grams[order], owner[order]
        fresh = np.append(True, (np.diff(owner) != 0) | (np.diff(grams) != 0))[: len(grams)]
        self.tokens, self.owner = grams[fresh], owner[fresh]
        self.size = np.bincount(self.owner, minlength=len(runs))
        self.first = np.append(0, np.cumsum(self.size))
        spread = np.zeros(len(self.tokens) + 1, np.uint64)
        np.cumsum(mix(self.tokens ^ np.uint64(0x2545F4914F6CDD1D)), out=spread[1:])
        total = spread[self.first[1:]] - spread[self.first[:-1]]
        self.name = mix(total + self.size.astype(np.uint64)).astype(np.int64)  # of the class

    def parity(self, i: int) -> bytes:
        """One bit per place, flipped by each token that falls on it; at least 4 places a token."""
        places = 1 << max(6, int(4 * self.size[i] - 1).bit_length())
        at = (self.tokens[self.first[i] : self.first[i + 1]] & np.uint64(places - 1)).astype(np.int64)
        return np.packbits(np.bincount(at, minlength=places) & 1).tobytes()

    def only(self, texts: np.ndarray) -> np.ndarray:
        """Places of the tokens of some texts, given as a mask."""
        return np.flatnonzero(texts[self.owner])


def _fresh(sets: Sets, seen: set) -> np.ndarray:
    """A mask of the texts whose class this task meets for the first time."""
    mask = np.zeros(len(sets.size), bool)
    for i, name in enumerate(sets.name.tolist()):
        if sets.size[i] and name not in seen:
            seen.add(name)
            mask[i] = True
    return mask


def class_rows(docs: DataFrame, shingle: int) -> DataFrame:
    """``doc_id, text_key, n_shingles, name, parity, brief``.

    The name of the class is null without shingles; the sketch ``parity`` and what it folds to,
    ``brief``, are given once a task and class.
    """
    schema = pa.schema([*((c, pa.int64()) for c in ("doc_id", "text_key", "n_shingles", "name")), ("parity", pa.binary()), ("brief", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(8, fold_case=True), set()
        for batch in chunks(batches, most=CHUNK):
            sets = Sets(batch.column("text"), hasher, shingle)
            name = pa.array(sets.name, mask=sets.size == 0)
            parity = [sets.parity(i) if new else None for i, new in enumerate(_fresh(sets, seen).tolist())]
            brief = [p and folded(p, min(len(p), max(BRIEF, len(p) // 2))).tobytes() for p in parity]
            columns = [batch.column("doc_id"), batch.column("text_key"), pa.array(sets.size.astype(np.int64)), name, pa.array(parity, pa.binary()), pa.array(brief, pa.binary())]
            yield pa.record_batch(columns, schema=schema)

    return docs.mapInArrow(run, "doc_id long, text_key long, n_shingles long, name long, parity binary, brief binary")


def common_shingles(docs: DataFrame, shingle: int) -> np.ndarray:
    """The shingles of many different texts, as a set of bits."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, held = Hasher(8, fold_case=True), set(), []

        def send() -> Iterator[pa.RecordBatch]:
            token, many = np.unique(np.concatenate(held), return_counts=True)
            token, many = token[many > 1].astype(np.int64), many[many > 1]
            for i in range(0, len(token), 1 << 16):
                yield pa.record_batch([pa.array(token[i : i + (1 << 16)]), pa.array(many[i : i + (1 << 16)])], schema=schema)

        for batch in chunks(batches, most=CHUNK):
            sets = Sets(batch.column("text"), hasher, shingle)
            held.append(sets.tokens[sets.only(_fresh(sets, seen))])
            if sum(map(len, held)) > HELD:  # bounds what a task holds; counts of parts add up later
                yield from send()
                held.clear()
        if held:
            yield from send()

    counts = docs.select("text").mapInArrow(run, "token long, n long")
    return collect_set(counts.groupBy("token").agg(F.sum("n").alias("n")).filter(F.col("n") >= COMMON), "token")


def sketch_words(sets: Sets, places: np.ndarray, texts: np.ndarray, band: np.ndarray, parts: np.ndarray, kind: int):
    """Non-empty words of the sketches of ``texts`` from the tokens at ``places``.

    Gives the text (as its rank in ``texts``) and the key of each word, and the number of words
    per text. ``band`` and ``parts`` are per entry of ``texts``.
    """
    rank = np.full(len(sets.size), -1)
    rank[texts] = np.arange(len(texts))
    owner = rank[sets.owner[places]]
    token, owner = sets.tokens[places[owner >= 0]], owner[owner >= 0]
    part = ((mix(token + np.uint64(kind)) >> np.uint64(32)) * parts.astype(np.uint64)[owner] >> np.uint64(32)).astype(np.int64)
    lead = np.cumsum(parts) - parts
    slot = lead[owner] + part
    word = np.zeros(int(parts.sum()), np.uint64)
    np.bitwise_xor.at(word, slot, mix(token ^ np.uint64(0x9E3779B97F4A7C15)))
    used = np.flatnonzero(np.bincount(slot, minlength=len(word)))
    owner = np.repeat(np.arange(len(texts)), parts)[used]
    label = (band[owner].astype(np.uint64) << np.uint64(40)) | (np.uint64(kind) << np.uint64(36)) | (used - lead[owner]).astype(np.uint64)
    return owner, mix(word[used] ^ mix(label)), np.bincount(owner, minlength=len(texts))


def word_keys(sets: Sets, chosen: np.ndarray, common: np.ndarray, repeats: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(class name, key) of the words of the chosen texts, in the bands they take part in.

    With ``repeats``, only those that finding every linked pair needs.
    """
    texts = np.flatnonzero(chosen)
    if not len(texts):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    bands = _bands(int(sets.size.max()))
    rare = np.flatnonzero(~contains(common, sets.tokens))
    names, keys = [], []
    for up in (0, 1):
        band = np.searchsorted(bands, sets.size[texts], side="right") - 1 + up
        differ = 2 * (bands[band + 1] - 1) * (DENOMINATOR - NUMERATOR) // (DENOMINATOR + NUMERATOR)
        able = (differ > 0) & (sets.size[texts] * DENOMINATOR >= NUMERATOR * bands[band])
        left, band, differ = texts[able], band[able], differ[able]
        parts = differ + 2 + differ // 2
        for kind in (RARE, WHOLE):
            mask = np.zeros(len(sets.size), bool)
            mask[left] = True
            places = rare if kind == RARE else sets.only(mask)
            owner, key, words = sketch_words(sets, places, left, band, parts, kind)
            if repeats is not None:
                again = contains(repeats, key)
                enough = np.bincount(owner[again], minlength=len(left)) >= np.maximum(words - differ, 1)
                number = np.arange(len(owner)) - (np.cumsum(words) - words)[owner]
                sent = again & enough[owner] & (number <= differ[owner])
                owner, key = owner[sent], key[sent]
            names.append(sets.name[left[owner]])
            keys.append(key)
            few = words <= differ  # these may share only empty words with a partner that also has few
            left, band, differ, parts = left[few], band[few], differ[few], parts[few]
        mask = np.zeros(len(sets.size), bool)
        mask[left] = True
        single = sets.only(mask)
        rank = np.zeros(len(sets.size), np.int64)
        rank[left] = band
        key = mix(sets.tokens[single] ^ mix((rank[sets.owner[single]].astype(np.uint64) << np.uint64(40)) | np.uint64(SINGLE << 36)))
        if repeats is not None:
            again = contains(repeats, key)
            single, key = single[again], key[again]
        names.append(sets.name[sets.owner[single]])
        keys.append(key)
    return np.concatenate(names), np.concatenate(keys)


def repeated_words(docs: DataFrame, common: Broadcast, shingle: int) -> np.ndarray:
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        hasher, seen = Hasher(8, fold_case=True), set()
        for batch in chunks(batches, most=CHUNK):
            sets = Sets(batch.column("text"), hasher, shingle)
            yield word_keys(sets, _fresh(sets, seen), common.value)[1]

    return repeated(docs.select("text"), words)


def groups(docs: DataFrame, common: Broadcast, repeats: Broadcast, shingle: int, buckets: int) -> DataFrame:
    """``members, n``: names (sorted, 8 bytes each) of classes with n sketch words in common."""
    schema = pa.schema([("bucket", pa.int64()), ("key", pa.binary()), ("name", pa.binary())])

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen = Hasher(8, fold_case=True), set()
        for batch in chunks(batches, most=CHUNK):
            sets = Sets(batch.column("text"), hasher, shingle)
            name, key = word_keys(sets, _fresh(sets, seen), common.value, repeats.value)
            bucket = (key % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            bucket, name, key = bucket[order], name[order], (key[order] >> np.uint64(32)).astype(np.uint32)
            cut = np.flatnonzero(np.diff(bucket)) + 1
            lead = np.append(0, cut)[: len(bucket)]
            stop = np.append(cut, len(bucket))
            blobs = [[x[i:j].tobytes() for i, j in zip(lead, stop)] for x in (key, name)]
            yield pa.record_batch([pa.array(bucket[lead]), pa.array(blobs[0], pa.binary()), pa.array(blobs[1], pa.binary())], schema=schema)

    def gather(table: pa.Table) -> pa.Table:
        key = np.frombuffer(b"".join(table["key"].to_pylist()), np.uint32)
        name = np.frombuffer(b"".join(table["name"].to_pylist()), np.int64)
        order = np.lexsort((name, key))
        key, name = key[order], name[order]
        fresh = np.append(True, (np.diff(key) != 0) | (np.diff(name) != 0))[: len(key)]
        key, name = key[fresh], name[fresh]
        lead = np.flatnonzero(np.append(True, np.diff(key) != 0))[: len(key)]
        size = np.diff(np.append(lead, len(key)))
        members = Counter(name[i : i + n].tobytes() for i, n in zip(lead[size > 1].tolist(), size[size > 1].tolist()))
        return pa.table([pa.array(list(members), pa.binary()), pa.array(list(members.values()), pa.int64())], names=["members", "n"])

    sent = docs.select("text").mapInArrow(send, "bucket long, key binary, name binary")
    return sent.groupBy("bucket").applyInArrow(gather, "members binary, n long").groupBy("members").agg(F.sum("n").alias("n"))


PAIR = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def names_of(members: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The names of all groups one after the other, and how many each has."""
    blobs = members.to_pylist()
    return np.frombuffer(b"".join(blobs), np.int64), np.array([len(x) // 8 for x in blobs], np.int64)


def first_pairs(found: DataFrame) -> DataFrame:
    """Each class with the first of a group: of several, that with most words in common."""
    schema = pa.schema([*PAIR, ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, many = names_of(batch.column("members"))
            lead = np.cumsum(many) - many
            others = np.ones(len(name), bool)
            others[lead] = False
            row = (np.repeat(name[lead], many - 1), name[others], np.repeat(batch.column("n").to_numpy(), many - 1))
            yield pa.record_batch([pa.array(x) for x in row], schema=schema)

    shared = found.mapInArrow(run, "a long, b long, n long").groupBy("a", "b").agg(F.sum("n").alias("n"))
    best = shared.groupBy("b").agg(F.max(F.struct("n", "a")).alias("most"))
    return best.select("most.a", "b")


def fits(m: np.ndarray, n: np.ndarray, apart: np.ndarray) -> np.ndarray:
    """Whether sets of m and n shingles that differ in ``apart`` places at least can be linked."""
    sizes = np.minimum(m, n) * DENOMINATOR >= NUMERATOR * np.maximum(m, n)
    return sizes & (apart * (DENOMINATOR + NUMERATOR) <= (m + n) * (DENOMINATOR - NUMERATOR))


def folded(parity: bytes, size: int) -> np.ndarray:
    """A parity sketch with fewer places."""
    return np.bitwise_xor.reduce(np.frombuffer(parity, np.uint8).reshape(-1, size), axis=0)


def members_of(found: DataFrame) -> DataFrame:
    """``g, at, many, node``: the numbered groups, a row per member."""
    schema = pa.schema([("g", pa.int64()), ("at", pa.int32()), ("many", pa.int32()), ("node", pa.int64())])

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, many = names_of(batch.column("members"))
            at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            row = (np.repeat(batch.column("g").to_numpy(), many), at.astype(np.int32), np.repeat(many, many).astype(np.int32), name)
            yield pa.record_batch([pa.array(x) for x in row], schema=schema)

    # the number of a group is made once: everything below reads the stored rows
    each = found.select(F.monotonically_increasing_id().alias("g"), "members").mapInArrow(names, "g long, at int, many int, node long")
    return stored(each, "members")


def apart_members(each: DataFrame, labels: DataFrame) -> DataFrame:
    """The groups whose members are not in one component."""
    reach = each.select("g", "node").join(labels, "node", "left").groupBy("g")
    reach = reach.agg(F.min(F.coalesce("label", "node")).alias("low"), F.max(F.coalesce("label", "node")).alias("high"))
    return each.join(reach.filter("low < high").select("g"), "g", "left_semi").select(each.columns)


def labelled(each: DataFrame, labels: DataFrame, classes: DataFrame, sketch: str) -> DataFrame:
    """``g, at, many, node, label, size`` and the sketch of each member."""
    nodes = classes.select(F.col("name").alias("node"), "size", sketch).join(labels, "node", "left")
    nodes = nodes.select("node", F.coalesce("label", "node").alias("label"), "size", sketch)
    return each.select("g", "at", "many", "node").join(nodes, "node")


def bits_of(sketches: list[bytes]) -> np.ndarray:
    """A row of 64-bit numbers for each sketch, folded to the shortest."""
    least = min(map(len, sketches))
    return np.frombuffer(b"".join(x if len(x) == least else folded(x, least).tobytes() for x in sketches), np.uint64).reshape(len(sketches), -1)


def close_pairs(bits: np.ndarray, size: np.ndarray, label: np.ndarray, most: float = np.inf) -> tuple[np.ndarray, np.ndarray] | None:
    """Pairs of different labels that may be linked by their sketches, or None if they are more than ``most``."""
    step = max(1, (1 << 18) // bits.size)  # rows compared with all others at once
    one, two, n = [], [], 0
    for i in range(0, len(bits), step):
        differ = np.bitwise_count(bits[i : i + step, None] ^ bits).sum(axis=2, dtype=np.int64)
        a, b = np.nonzero((label[i : i + step, None] != label) & fits(size[i : i + step, None], size, differ))
        a, b = a[a + i < b] + i, b[a + i < b]
        one.append(a)
        two.append(b)
        n += len(a)
        if n > most:
            return None
    return np.concatenate(one), np.concatenate(two)


def met_pairs(rows: DataFrame, buckets: int) -> DataFrame:
    """What groups that are not in one component are compared by, from ``labelled`` rows with ``brief``.

    A negative ``far``: the pairs ``a, b`` of a group with few that may be linked. Other groups, in
    blocks, give each class ``a`` with the hub ``b`` and how ``far`` it is, and the hub with itself.
    """
    schema = pa.schema([("g", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("far", pa.float64())])
    rows = rows.withColumn("own", F.floor(F.col("at") / BLOCK).cast("int"))
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("g", "own"), F.lit(buckets)))

    def meet(table: pa.Table) -> pa.Table:
        g, own, many, node, label, size = (table[c].to_numpy() for c in ("g", "own", "many", "node", "label", "size"))
        brief = table["brief"].combine_chunks()
        order = np.lexsort((node, own, g))
        g, own, many, node, label, size = (x[order] for x in (g, own, many, node, label, size))
        brief = table["brief"].take(pa.array(order)).to_pylist()
        lead = np.flatnonzero(np.append(True, (np.diff(g) != 0) | (np.diff(own) != 0)))
        apart = (np.minimum.reduceat(label, lead) < np.maximum.reduceat(label, lead)) | (many[lead] > BLOCK)
        out = []
        for i, j in zip(lead[apart].tolist(), np.append(lead[1:], len(g))[apart].tolist()):
            at, whole = slice(i, j), many[i] <= BLOCK
            bits = bits_of(brief[at])
            close = close_pairs(bits, size[at], label[at], SPARSE * (j - i)) if whole else None
            if close:
                a, b = node[at][close[0]], node[at][close[1]]
                out.append((np.zeros(len(a), np.int64), np.minimum(a, b), np.maximum(a, b), np.full(len(a), -1.0)))
                continue
            each = np.unpackbits(bits.view(np.uint8), axis=1)
            most = np.packbits(2 * each.sum(axis=0, dtype=np.int64) >= j - i).view(np.uint64)
            hub = np.lexsort((node[at], np.bitwise_count(bits ^ most).sum(axis=1, dtype=np.int64)))[0]
            differ = np.bitwise_count(bits ^ bits[hub]).sum(axis=1, dtype=np.int64)
            keep = (label[at] != label[at][hub]) & fits(size[at], size[at][hub], differ)
            keep[hub] = True  # the row that names the group
            far = differ / (size[at] + size[at][hub])
            out.append((np.full(keep.sum(), g[i]), node[at][keep], np.full(keep.sum(), node[at][hub]), far[keep]))
        return pa.table([np.concatenate(x) for x in zip(*out)], schema=schema) if out else schema.empty_table()

    rows = rows.select("bucket", "g", "own", "many", "node", "label", "size", "brief")
    return rows.groupBy("bucket").applyInArrow(meet, "g long, a long, b long, far double")


def near_pairs(met: DataFrame, tested: DataFrame) -> DataFrame:
    """The pairs of ``met_pairs``: of several hubs of a class the nearest.

    A row per class leaves the hubs, however many groups it is in.
    """
    hubs = met.filter("far >= 0 AND a <> b").groupBy(F.col("a").alias("node")).agg(F.min(F.struct("far", "b")).alias("best"))
    hubs = hubs.select(F.least("node", "best.b").alias("a"), F.greatest("node", "best.b").alias("b"))
    pairs = met.filter("far < 0").select("a", "b").unionByName(hubs).distinct()
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def later_pairs(each: DataFrame, labels: DataFrame, classes: DataFrame, tested: DataFrame, buckets: int) -> DataFrame:
    """Pairs of one group that are in different components and may be linked by their sketches.

    Sketches are compared inside the group, so that unlike texts with a common word make no row.
    """
    open_ = labelled(apart_members(each, labels), labels, classes, "parity")
    # a large group is cut in blocks, and each pair of blocks is compared by itself
    own, last = F.floor(F.col("at") / BLOCK).cast("int"), F.floor((F.col("many") - 1) / BLOCK).cast("int")
    open_ = open_.select("g", "node", "label", "size", "parity", own.alias("own"), F.explode(F.sequence(F.lit(0), last)).alias("other"))
    open_ = open_.select("g", "node", "label", "size", "parity", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))

    def cross(table: pa.Table) -> pa.Table:
        g, low, high, own, node, label, size = (table[c].to_numpy() for c in ("g", "low", "high", "own", "node", "label", "size"))
        order = np.lexsort((node, high, low, g))
        g, low, high, own, node, label, size = (x[order] for x in (g, low, high, own, node, label, size))
        parity = table["parity"].take(pa.array(order)).to_pylist()
        lead = np.flatnonzero(np.append(True, (np.diff(g) != 0) | (np.diff(low) != 0) | (np.diff(high) != 0)))
        some = np.minimum.reduceat(label, lead) < np.maximum.reduceat(label, lead)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for i, j in zip(lead[some].tolist(), np.append(lead[1:], len(g))[some].tolist()):
            a, b = close_pairs(bits_of(parity[i:j]), size[i:j], label[i:j])
            a, b = a + i, b + i
            meant = (low[a] == high[a]) | (own[a] != own[b])
            out.append((np.minimum(node[a], node[b])[meant], np.maximum(node[a], node[b])[meant]))
        return pa.table([np.concatenate(x) for x in zip(*out)], schema=PAIR)

    open_ = open_.withColumn("bucket", F.pmod(F.xxhash64("g", "low", "high"), F.lit(buckets)))
    pairs = open_.groupBy("bucket").applyInArrow(cross, "a long, b long").distinct()
    return pairs.join(tested.select("a", "b"), ["a", "b"], "left_anti")


def alike(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose sizes and parity sketches do not rule a link out."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            m, n = (batch.column(c).to_numpy() for c in ("m", "n"))
            apart = []
            for one, two in zip(batch.column("one").to_pylist(), batch.column("two").to_pylist()):
                least = min(len(one), len(two))
                apart.append(int(np.bitwise_count(folded(one, least) ^ folded(two, least)).sum(dtype=np.int64)))
            keep = fits(m, n, np.array(apart, np.int64))
            yield pa.record_batch([pc.filter(batch.column(c), pa.array(keep, pa.bool_())) for c in ("a", "b")], schema=PAIR)

    of = lambda name, n, parity: classes.select(F.col("name").alias(name), F.col("size").alias(n), F.col("parity").alias(parity))
    joined = pairs.join(of("a", "m", "one"), "a").join(of("b", "n", "two"), "b")
    return joined.select("a", "b", "m", "n", "one", "two").mapInArrow(compare, "a long, b long")


def linked(docs: DataFrame, rows: DataFrame, pairs: DataFrame, shingle: int) -> DataFrame:
    """The pairs whose sets are similar enough, by comparing the sets.

    One text of each class is moved, which is smaller than its set.
    """
    names = pairs.select(F.explode(F.array("a", "b")).alias("name")).distinct()
    chosen = rows.join(names, "name", "left_semi").groupBy("name").agg(F.min("text_key").alias("text_key"))
    chosen = stored(chosen, "chosen")
    shared = docs.sparkSession.sparkContext.broadcast(collect_set(chosen, "text_key"))

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            key = batch.column("text_key").to_numpy()
            take = [i for i in np.flatnonzero(contains(shared.value, key)).tolist() if not (key[i] in seen or seen.add(key[i]))]
            yield batch.take(pa.array(take, pa.int64()))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(8, fold_case=True)
        for batch in chunks(batches, "two", CHUNK):
            a, at, of = np.unique(batch.column("a").to_numpy(), return_index=True, return_inverse=True)
            one, two = Sets(batch.column("one").take(pa.array(at)), hasher, shingle), Sets(batch.column("two"), hasher, shingle)
            keep = []
            for i, j in enumerate(of.tolist()):
                x, y = one.tokens[one.first[j] : one.first[j + 1]], two.tokens[two.first[i] : two.first[i + 1]]
                small, large = min(len(x), len(y)), max(len(x), len(y))
                if small * DENOMINATOR < NUMERATOR * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(DENOMINATOR * both >= NUMERATOR * (small + large - both))
            yield pa.record_batch([pc.filter(batch.column(c), pa.array(keep, pa.bool_())) for c in ("a", "b")], schema=PAIR)

    texts = docs.select("text_key", "text").mapInArrow(wanted, "text_key long, text string").join(chosen, "text_key")
    texts = texts.groupBy("name").agg(F.first("text").alias("text"))
    joined = pairs.join(texts.select(F.col("name").alias("b"), F.col("text").alias("two")), "b")
    joined = joined.join(texts.select(F.col("name").alias("a"), F.col("text").alias("one")), "a")
    links = stored(joined.select("a", "b", "one", "two").mapInArrow(compare, "a long, b long"), "links")
    shared.destroy()
    drop_stored(chosen)
    return links


def components(links: DataFrame) -> DataFrame:
    """``node, label``: the smallest node of each connected component, for linked nodes.

    Each round takes the smallest label of the neighbours and then the label of the label, so
    long chains shrink by doubling.
    """
    edges = stored(links.select(F.explode(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))).alias("e")).select("e.*"), "edges")
    new = labels = stored(edges.groupBy(F.col("a").alias("node")).agg(F.least(F.min("a"), F.min("b")).alias("label")), "labels")
    while True:
        old = new
        near = edges.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        lower = labels.join(near, "node").select("node", "label", F.least("label", "near").alias("lower"))
        lower = stored(lower, "lower")
        jump = lower.select(F.col("node").alias("lower"), F.col("lower").alias("next"))
        new = stored(lower.join(jump, "lower").select("node", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "labels")
        drop_stored(old, lower)
        labels = new.select("node", "label")
        if new.filter("moved").isEmpty():
            drop_stored(edges)
            return labels


def judged(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, text_key, n_shingles, group, component_id`` of each row.

    ``group`` names the component, null without shingles; ``text_key`` is a hash of the text.
    """
    docs = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key"))
    spark = docs.sparkSession
    buckets = 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    whole = stored(class_rows(docs, shingle), "classes")
    classes = whole.filter("parity IS NOT NULL").groupBy("name").agg(F.first("n_shingles").alias("size"), F.first("parity").alias("parity"), F.first("brief").alias("brief"))
    classes = stored(classes, "sketches")
    rows = stored(whole.select("doc_id", "text_key", "n_shingles", "name"), "rows")
    drop_stored(whole)
    # what every task holds is given up as soon as it was read
    common = spark.sparkContext.broadcast(common_shingles(docs, shingle))
    repeats = spark.sparkContext.broadcast(repeated_words(docs, common, shingle))
    found = stored(groups(docs, common, repeats, shingle, buckets), "groups")
    common.destroy()
    repeats.destroy()
    first = stored(first_pairs(found), "pairs")
    links = linked(docs, rows, stored(alike(first, classes), "alike"), shingle)
    labels = components(links)
    each = members_of(found)
    drop_stored(found)
    met = each.filter(F.col("many") <= FEW).unionByName(apart_members(each.filter(F.col("many") > FEW), labels))
    met = stored(met_pairs(labelled(met, labels, classes, "brief"), buckets), "met")
    near = stored(near_pairs(met, first), "near")
    if not near.isEmpty():
        links = stored(links.unionByName(linked(docs, rows, stored(alike(near, classes), "alike"), shingle)), "links")
        labels = components(links)
    crowded = stored(each.join(met.filter("far >= 0").select("g").distinct(), "g", "left_semi"), "crowded")
    drop_stored(each, met)
    if not crowded.isEmpty():
        more = stored(later_pairs(crowded, labels, classes, first.select("a", "b").unionByName(near), buckets), "later")
        if not more.isEmpty():
            labels = components(links.unionByName(linked(docs, rows, more, shingle)))
    drop_stored(classes, crowded)
    names = rows.filter("name IS NOT NULL").groupBy("name").agg(F.min("doc_id").alias("least"))
    names = names.join(labels, F.col("name") == F.col("node"), "left").select("name", "least", F.coalesce("label", "name").alias("group"))
    names = stored(names, "names")
    ids = names.groupBy("group").agg(F.min("least").alias("component_id"))
    owner = stored(names.join(ids, "group").select("name", "group", "component_id"), "components")
    own = F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.join(owner, "name", "left").select("doc_id", "text_key", "n_shingles", "group", own.alias("component_id"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id``: the smallest id reachable by links."""
    return judged(docs, shingle).select("doc_id", "n_shingles", "component_id")


def without_near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """The rows that stay: one of each component, and every row without shingles.

    It is the row with the smallest id, then the smallest hash of its text; rows without an id
    come last, and of equal rows one stays.
    """
    rows = stored(judged(docs, shingle), "judged")
    order = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_key")
    first = rows.filter("group IS NOT NULL").groupBy("group").agg(F.min(order).alias("at")).select("at.doc_id", "at.text_key")
    key = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("__id")
    kept = first.select(key, F.col("text_key").alias("__text"), F.lit(True).alias("__one"))
    bare = rows.filter("group IS NULL").select(key, F.col("text_key").alias("__text"), F.lit(False).alias("__one")).distinct()
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("__text"))
    whole = whole.select("__row", key, "__text").join(kept.unionByName(bare), ["__id", "__text"])
    number = F.row_number().over(Window.partitionBy("__id", "__text").orderBy(F.lit(1)))
    return whole.withColumn("__n", number).filter("__n = 1 OR NOT __one").select("__row.*")


def op8_jaccard_join(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
