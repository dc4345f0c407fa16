"""Exact top-k search by a Voronoi join.

Pivots (a bounded, seeded draw of vectors) part the space; each vector belongs to the cell of its
nearest pivot. A cell's summary holds its pivot, its radius and the ids and distances of its
``k + 1`` members nearest to the pivot, of members with one id the nearest. For a query q and a member x of a cell with pivot p,

    q.p - |q| |x - p|  <=  q.x  <=  q.p + |q| |x - p|

so summaries alone give a score that ``k`` members with other ids than the query's reach, however
many rows have its id, and for each cell a score that none of its members exceeds. A query needs the cells that may hold a score of at least the first. Queries
of one cell travel in blocks. The data blocks are dealt to tiles of at most ``TILE`` bytes, and a query block goes once to each tile that
has a cell which one of its queries needs. A task holds one tile and meets a share of the tile's query blocks one by one; of the
scores it keeps the best ``k`` per query, and what does not reach these is never sorted. The number of tiles is
chosen so that copies of tiles and of queries and the scores sent on are few together. Tiles and blocks are dealt by number,
without a join, so that no estimate of sizes can have vectors sent to the driver.

Copies of one vector have one score with a query, and ties go to the smaller id; so of a vector
that is a large share of all rows only the rows of its ``k + 1`` smallest ids are searched: its others
can be no answer, whichever of these ids is the query's own. They are found from hashes and ids; the
vectors themselves, at most ``HEAVY``, are joined back. Cells are dealt in blocks of a bounded number
of vectors, so a hot cell is many tasks; what tasks have over in a cell is gathered into blocks of that
size, so that many small tasks make no more blocks than a few large ones. Only the pivots' summaries, at most ``PIVOTS`` rows, and a row per tile are sent to all tasks.

Components become floor(64 x). Null vectors, vectors with null or non-finite components, and of
several lengths those that differ from the most frequent one, take no part. Scores are exact:
they are computed on whole numbers, and one outside of 64 bits counts as the nearest inside. Ties
go to the smaller id; of rows with one id each is a candidate, and a query's own id is none; of
several query rows with one id the smallest vector asks. Null ids take no part. Blocks hold
components in 8, 16 or 32 bits where all fit and as doubles, which hold them exactly, elsewhere. Doubles of
2^500 and more, whose squares are infinite, take no part; single floats are never that large.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.scratch import drop_stored, stored

#: Pivots at most, vectors of a data block, queries of a query block.
PIVOTS, DATA_BLOCK, QUERY_BLOCK = 64, 1024, 256
#: Bytes of a tile's vectors, pairs of blocks that a task solves, and tasks for each core, of small tables too.
TILE, PAIRS, TURNS = 1 << 25, 1 << 19, 4
#: Vectors of more than one in so many rows are searched by their smallest ids.
HEAVY = 1024
SCALE = 64
#: Components are below this; squares of larger ones are infinite.
LIMIT = 2.0**500
#: Doubles of this size and more are whole numbers.
WHOLE = 2.0**52


def whole_vectors(rows: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """``vec_id, v``: vectors of whole numbers, all of one length."""
    x = F.col(embedding)
    good = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT))
    kept = rows.filter(F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0)).filter(good)

    def scaled(c: Column) -> Column:
        c = c.cast("double") * SCALE
        return F.when(F.abs(c) < WHOLE, F.floor(c).cast("double")).otherwise(c)

    kept = kept.select(F.col(vec_id).cast("long").alias("vec_id"), F.transform(x, scaled).alias("v"))
    usual = kept.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return kept.filter(F.size("v") == (usual["n"] if usual else 0))


def pivots(vectors: DataFrame, most: int) -> np.ndarray:
    """Different vectors, those with the ``most`` smallest hashes; only hashes are shuffled."""
    hashed = vectors.select("v", F.xxhash64("v").alias("h"))
    least = [x["h"] for x in hashed.select("h").distinct().orderBy("h").limit(most).toLocalIterator()]
    found = sorted(x["v"] for x in hashed.filter(F.col("h").isin(least)).select("v").distinct().toLocalIterator()) if least else []
    return np.array(found, np.float64) if found else np.zeros((0, 1))


def without_spare_copies(vectors: DataFrame, k: int) -> DataFrame:
    """The vectors, of each heavy one the rows of its ``k + 1`` smallest ids, of an id ``k`` rows at most.

    That loses no answer: a query leaves out the rows of one id, and of k others each has a row.
    """
    hashed = vectors.withColumn("h", F.xxhash64("v"))
    counts = hashed.groupBy("h").agg(F.count("*").alias("n"))
    least = max(2 * k, vectors.count() // HEAVY)
    heavy = [x["h"] for x in counts.filter(F.col("n") > least).select("h").toLocalIterator()]  # HEAVY at most
    if not heavy:
        return vectors
    # different vectors with one hash stay as they are
    forms = hashed.filter(F.col("h").isin(heavy)).groupBy("h").agg(F.min("v").alias("v"), F.max("v").alias("w"))
    forms = stored(forms.filter("v = w").select("h", "v"), "heavy")
    heavy = [x["h"] for x in forms.select("h").toLocalIterator()]
    copies = hashed.filter(F.col("h").isin(heavy)).groupBy("h", "vec_id").agg(F.least(F.count("*"), F.lit(k)).alias("n"))
    rank = F.row_number().over(Window.partitionBy("h").orderBy("vec_id"))
    first = copies.withColumn("rank", rank).filter(F.col("rank") <= k + 1)
    first = first.join(F.broadcast(forms), "h").select("vec_id", "v", F.explode(F.sequence(F.lit(1).cast("long"), "n")).alias("copy"))
    return hashed.filter(~F.col("h").isin(heavy)).select("vec_id", "v").unionByName(first.select("vec_id", "v"))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, width)


def packed(v: np.ndarray) -> bytes:
    """Whole numbers in 8, 16 or 32 bits, the first where all fit, else as doubles."""
    most = np.abs(v).max() if v.size else 0
    return v.astype(next((x for x in (np.int8, np.int16, np.int32) if most <= np.iinfo(x).max), np.float64)).tobytes()


def unpacked(data: bytes, rows: int, width: int) -> np.ndarray:
    kind = {1: np.int8, 2: np.int16, 4: np.int32, 8: np.float64}[len(data) // (rows * width)]
    return np.frombuffer(data, kind).reshape(rows, width)


def products(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: floats where these hold them, else 64 bits or the nearest number that has so many."""
    ends = float(np.abs(q).max()), float(np.abs(v).max())
    most = ends[0] * ends[1] * q.shape[1]
    for kind, bound in EXACT.items():
        if most < bound:
            return q.astype(kind) @ v.astype(kind).T
    if most < 2.0**62 and max(ends) < 2.0**62:
        return q.astype(np.int64) @ v.astype(np.int64).T
    whole = [[int(x) for x in row] for row in v]
    exact = [[sum(a * b for a, b in zip(asks, row)) for row in whole] for asks in ([int(x) for x in row] for row in q)]
    return np.array([[min(max(x, LEAST + 1), MOST) for x in row] for row in exact], np.int64)


#: Sums below these are exact in floats; the ends of 64 bits.
EXACT = {np.dtype(np.float32): 2.0**24, np.dtype(np.float64): 2.0**52}
LEAST, MOST = int(np.iinfo(np.int64).min), int(np.iinfo(np.int64).max)


def best(q_id: np.ndarray, q: np.ndarray, data: Iterable[tuple[np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query id, id and score of the ``k`` best of each query among blocks of ids and vectors, ties to the smaller id."""
    none = np.zeros(0, np.int64)
    held, fresh = [(none, none, none)], 0
    least, last = np.full(len(q_id), LEAST), np.full(len(q_id), MOST)  # score and id of the k-th so far

    def cut() -> None:
        rows, ids, score = (np.concatenate(x) for x in zip(*held))
        order = np.lexsort((ids, -score, rows))
        rows, ids, score = rows[order], ids[order], score[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        kth, kept = rank == k - 1, rank < k
        least[rows[kth]], last[rows[kth]] = score[kth], ids[kth]
        held[:] = [(rows[kept], ids[kept], score[kept])]

    for v_id, v in data:
        score = products(q, v)
        bound = least
        if score.dtype in EXACT:  # what is beyond the floats' bound is so for all scores here
            bound = np.clip(least, -EXACT[score.dtype], EXACT[score.dtype]).astype(score.dtype)
        places = np.flatnonzero(score >= bound[:, None])
        if len(places) > 4 * k * len(q_id) and len(v_id) > k:  # too many to sort: k of this block reach more
            others = np.where(q_id[:, None] == v_id[None, :], -np.inf if score.dtype in EXACT else LEAST, score)
            bound = np.maximum(bound, np.partition(others, -k, 1)[:, -k])
            places = np.flatnonzero(score >= bound[:, None])
        rows, cols = np.divmod(places, len(v_id))
        ids, found = v_id[cols], score.ravel()[places].astype(np.int64)
        kept = (ids != q_id[rows]) & ((found > least[rows]) | (ids < last[rows]))
        held.append((rows[kept], ids[kept], found[kept]))
        fresh += int(kept.sum())
        if fresh > k * len(q_id):
            cut()
            fresh = 0
    cut()
    rows, ids, score = held[0]
    return q_id[rows], ids, score


def blocks(vectors: DataFrame, centres: np.ndarray, size: int) -> DataFrame:
    """``cell, block, far, ids, vectors``: vectors by cell, in blocks of about ``size``, nearest to the pivot first."""
    width = centres.shape[1]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        norm, task, made = (centres**2).sum(1), TaskContext.get().partitionId(), count()
        held: dict[int, list] = {}

        def block(cell: int) -> pa.RecordBatch:
            ids, far, v = (np.concatenate(x) for x in zip(*held.pop(cell)))
            order = np.argsort(far, kind="stable")
            ids, far, v = ids[order], far[order], v[order]
            row = [cell, (task << 32) + next(made), far.tobytes(), ids.tobytes(), packed(v)]
            return pa.record_batch([pa.array([x], k) for x, k in zip(row, BLOCK.types)], schema=BLOCK)

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, v = batch.column("vec_id").to_numpy(), _matrix(batch.column("v"), width)
            squared = (v**2).sum(1)[:, None] - 2 * v @ centres.T + norm
            cells = squared.argmin(1)
            far = np.sqrt(((v - centres[cells]) ** 2).sum(1))
            for cell in np.unique(cells).tolist():
                at = np.flatnonzero(cells == cell)
                for i in range(0, len(at), size):
                    held.setdefault(cell, []).append((ids[at[i : i + size]], far[at[i : i + size]], v[at[i : i + size]]))
                    if sum(len(x[0]) for x in held[cell]) >= size:
                        yield block(cell)
        for cell in list(held):
            yield block(cell)

    return vectors.mapInArrow(assign, BLOCK_DDL)


BLOCK = pa.schema([("cell", pa.int64()), ("block", pa.int64()), ("far", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())])
BLOCK_DDL = "cell long, block long, far binary, ids binary, vectors binary"


def filled(parts: DataFrame, width: int, size: int) -> DataFrame:
    """The blocks, those of less than ``size`` vectors gathered into blocks of about that many."""
    parts = parts.withColumn("n", F.length("ids") / 8)
    small = parts.filter(F.col("n") < size)
    room = small.groupBy("cell").agg(F.ceil(F.sum("n") / size).alias("room"))  # PIVOTS rows at most
    dealt = small.join(F.broadcast(room), "cell").withColumn("bucket", F.pmod(F.xxhash64("block"), "room"))

    def gather(key: tuple, table: pa.Table) -> pa.Table:
        cell, bucket = (x.as_py() for x in key)
        kept = list(zip(*(table[c].to_pylist() for c in ("ids", "far", "vectors"))))
        ids, far = (np.frombuffer(b"".join(x[i] for x in kept), kind) for i, kind in ((0, np.int64), (1, np.float64)))
        v = np.concatenate([unpacked(x[2], len(x[0]) // 8, width) for x in kept])
        order = np.argsort(far, kind="stable")
        ids, far, v = ids[order], far[order], v[order]
        cuts = range(0, len(ids), 2 * size)  # numbers below zero are no task's
        rows = [[cell, -1 - (bucket << 20) - i, far[at : at + 2 * size].tobytes(), ids[at : at + 2 * size].tobytes(), packed(v[at : at + 2 * size])] for i, at in enumerate(cuts)]
        return pa.table([pa.array(x, k) for x, k in zip(zip(*rows), BLOCK.types)], schema=BLOCK)

    merged = dealt.select("bucket", *BLOCK.names).groupBy("cell", "bucket").applyInArrow(gather, BLOCK_DDL)
    return parts.filter(F.col("n") >= size).select(*BLOCK.names).unionByName(merged)


def nearest(ids: np.ndarray, far: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and distances of the ``most`` nearest different ids."""
    order = np.argsort(far, kind="stable")
    first = np.sort(np.unique(ids[order], return_index=True)[1])[:most]
    return ids[order][first], far[order][first]


def summaries(data: DataFrame, centres: np.ndarray, k: int) -> list[tuple[int, np.ndarray, np.ndarray, float]]:
    """Per cell: ids and distances of its k + 1 different ids nearest to the pivot, and its radius."""
    schema = pa.schema([("cell", pa.int64()), ("ids", pa.binary()), ("near", pa.binary()), ("radius", pa.float64())])

    def merge(held: dict, cell: int, ids: bytes, far: bytes, radius: float | None = None) -> None:
        ids, far = np.frombuffer(ids, np.int64), np.frombuffer(far)
        known, near, most = held.get(cell, (np.zeros(0, np.int64), np.zeros(0), 0.0))
        met = nearest(np.append(known, ids), np.append(near, far), k + 1)
        held[cell] = (*met, max(most, far[-1] if radius is None else radius))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray, float]] = {}
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                merge(held, *row)
        for cell, (ids, near, radius) in held.items():
            yield pa.record_batch([[cell], [ids.tobytes()], [near.tobytes()], [float(radius)]], schema=schema)

    ddl = "cell long, ids binary, near binary, radius double"
    parts = data.select("cell", "ids", "far").mapInArrow(cut, ddl)  # of each task PIVOTS rows at most
    merged = parts.repartition("cell").mapInArrow(cut, ddl).collect()  # PIVOTS rows at most
    return [(x["cell"], np.frombuffer(x["ids"], np.int64), np.frombuffer(x["near"]), x["radius"]) for x in sorted(merged, key=lambda x: x["cell"])]


def needed(q_ids: np.ndarray, queries: np.ndarray, centres: np.ndarray, cells: list[tuple[int, np.ndarray, np.ndarray, float]], k: int) -> list[int]:
    """Cells that may hold one of the k best scores of some query."""
    length = np.sqrt((queries**2).sum(1))[:, None]
    at = np.array([c for c, *_ in cells])
    middle = queries @ centres[at].T
    sure = [middle[:, [i]] - length * near[None, :] for i, (_, _, near, _) in enumerate(cells)]
    sure = np.concatenate(sure, 1)  # scores that so many members reach at least
    # a cell may name the query's own id, which is no candidate
    sure[q_ids[:, None] == np.concatenate([ids for _, ids, *_ in cells])[None, :]] = -np.inf
    least = -np.partition(-sure, k - 1, 1)[:, [k - 1]] if sure.shape[1] >= k else np.full((len(queries), 1), -np.inf)
    most = middle + length * np.array([r for *_, r in cells])[None, :]
    # rounding is in proportion to the lengths, also where products cancel
    slack = 1e-6 * (1 + length * (np.sqrt((centres[at] ** 2).sum(1)) + np.array([r for *_, r in cells]))[None, :])
    ends = (-(2.0**63), 2.0**63)  # scores beyond them are equal
    return at[(np.clip(most + slack, *ends) >= np.clip(least, *ends)).any(0)].tolist()


def tiles(sizes: dict[int, int], most: float) -> dict[int, tuple[int, int]]:
    """Per cell its first tile and how many it has, of ``most`` bytes: small cells share a tile, large ones have several."""
    place, following, room = {}, 0, 0.0
    for cell, size in sorted(sizes.items()):
        if size <= room:
            place[cell], room = (following - 1, 1), room - size
            continue
        spread = math.ceil(size / most)
        place[cell], room = (following, spread), most - size  # below 0 where there are several
        following += spread
    return place


def dealt(data: DataFrame, asked: DataFrame, to: Callable[[np.ndarray, np.ndarray], list[int]], width: int, k: int) -> DataFrame:
    """``task, asks, cells, cell, ids, vectors``: in a partition for each task its tile, then the query blocks that meet it there.

    ``to`` has the cells that a block of queries needs.
    """
    spark = data.sparkSession
    size = F.length("ids") + F.length("vectors")
    sizes = {x["cell"]: x for x in data.groupBy("cell").agg(F.sum(size).alias("size"), F.count("*").alias("n")).collect()}  # PIVOTS rows at most
    asking = asked.agg(F.sum(size).alias("size"), F.sum(F.length("ids")).alias("ids")).first()
    whole, least = sum(x["size"] for x in sizes.values()), TURNS * spark.sparkContext.defaultParallelism
    # each tile more is a copy of the queries and k scores for each, each tile less a copy of the rest for the tasks
    copies = math.sqrt(whole * least / ((asking["size"] or 0) + 2 * k * (asking["ids"] or 0) + 1))
    number = max(whole / TILE, min(copies, least, sum(x["n"] for x in sizes.values())), 1)
    place = tiles({cell: x["size"] for cell, x in sizes.items()}, whole / number)

    def met(ids: bytes, q: bytes) -> dict[int, list[int]]:
        """The cells that a block of queries needs, by tile."""
        asking, of = np.frombuffer(ids, np.int64), {}
        for cell in to(asking, unpacked(q, len(asking), width).astype(np.float64)):
            for tile in range(place[cell][0], sum(place[cell])):
                of.setdefault(tile, []).append(cell)
        return of

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, q in zip(batch.column("ids"), batch.column("vectors")):
                yield pa.record_batch([pa.array(met(ids.as_py(), q.as_py()), pa.int64())], names=["tile"])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist() if batch.num_rows else ():
                for tile, cells in met(row["ids"], row["vectors"]).items():  # one at a time, as blocks may be large
                    values = tile, row["block"], np.array(cells, np.int64).tobytes(), row["ids"], row["vectors"]
                    yield pa.record_batch([pa.array([x], kind) for x, kind in zip(values, ROUTE.types)], schema=ROUTE)

    asks = {x["tile"]: x["count"] for x in asked.select("ids", "vectors").mapInArrow(counted, "tile long").groupBy("tile").count().collect()}
    has = dict.fromkeys(asks, 0.0)  # data blocks
    for cell, (first, spread) in place.items():
        for tile in set(range(first, first + spread)) & set(has):
            has[tile] += sizes[cell]["n"] / spread
    pairs = sum(asks[tile] * has[tile] for tile in asks)
    turns, following = [], 0
    for tile, n in sorted(asks.items()):
        most = n * has[tile]
        share = max(math.ceil(most / PAIRS), min(n, math.ceil(least * most / pairs)))
        turns.append((tile, following, following + share - 1))
        following += share

    places = F.broadcast(spark.createDataFrame([(cell, *x) for cell, x in place.items()], "cell long, at long, spread long"))
    turns = F.broadcast(spark.createDataFrame(turns, "tile long, first long, last long"))
    tile = F.col("at") + F.pmod(F.xxhash64("block"), "spread")
    held = data.select("cell", "block", "ids", "vectors").join(places, "cell").withColumn("tile", tile).join(turns, "tile")
    held = held.withColumn("task", F.explode(F.sequence("first", "last"))).select("task", F.lit(0).alias("asks"), F.lit(None).cast("binary").alias("cells"), "cell", "ids", "vectors")
    sent = asked.mapInArrow(route, "tile long, block long, cells binary, ids binary, vectors binary").join(turns, "tile")
    task = F.col("first") + F.pmod(F.xxhash64("block"), F.col("last") - F.col("first") + 1)
    sent = sent.select(task.alias("task"), F.lit(1).alias("asks"), "cells", F.lit(None).cast("long").alias("cell"), "ids", "vectors")
    return held.unionByName(sent).repartitionById(max(1, following), F.col("task").cast("int")).sortWithinPartitions("task", "asks")


ROUTE = pa.schema([("tile", pa.int64()), ("block", pa.int64()), ("cells", pa.binary()), ("ids", pa.binary()), ("vectors", pa.binary())])


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best inner products of each query.

    Both frames have ``vec_id, v`` as ``whole_vectors`` makes them.
    """
    vectors = stored(vectors, "vectors")
    centres = pivots(vectors, PIVOTS)
    if not len(centres):
        return vectors.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.lit(0).cast("long").alias("score")).limit(0)
    width = centres.shape[1]

    def in_blocks(rows: DataFrame, size: int, label: str) -> DataFrame:
        parts = stored(blocks(rows, centres, size), "parts")
        made = stored(filled(parts, width, size), label)
        drop_stored(parts)
        return made

    data = in_blocks(without_spare_copies(vectors, k), DATA_BLOCK, "data")
    drop_stored(vectors)
    queries = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = in_blocks(queries, QUERY_BLOCK, "queries").select("block", "ids", "vectors")
    cells = summaries(data, centres, k)
    met = dealt(data, asked, lambda ids, q: needed(ids, q, centres, cells, k), width, k)
    names = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, tile = None, []
        for batch in batches:
            for at, cells, cell, ids, v in zip(*(batch.column(c) for c in ("task", "cells", "cell", "ids", "vectors"))):
                if at.as_py() != task:
                    task, tile = at.as_py(), []
                ids = np.frombuffer(ids.as_py(), np.int64)
                v = unpacked(v.as_py(), len(ids), width)
                if cells.as_py() is None:
                    tile.append((cell.as_py(), ids, v))
                    continue
                asks = set(np.frombuffer(cells.as_py(), np.int64).tolist())
                found = best(ids, v, ((x, y) for c, x, y in tile if c in asks), k)
                yield pa.record_batch([pa.array(x) for x in found], schema=names)

    found = met.mapInArrow(solve, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op6_voronoi_knn(spark, sf_dir):
    vectors = whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), "vec_id", "embedding")
    return top_k(vectors, vectors.filter("vec_id % 20 = 0"), 20)
