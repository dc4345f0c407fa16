"""Mixing sources to target weights by Sainte-Laguë apportionment, as DataFrame operations only.

The tokens of the mix are dealt as equal blocks of ``block`` words. The blocks go to sources by
highest quotients (target / 1, 3, 5, ...), and the blocks of a source go to its shards in the
same way by their sizes, so that every shard has a whole number of blocks to give. Inside a
shard, documents stand in an order drawn from the seed, as one stream of words cut into blocks;
the quota takes blocks from the front and starts over where it exceeds the stream.

Targets: a source's share of all words by its weight, at most ``repeats`` times its size; what
exceeds that is shared again by weight until no source is above (equal to one common level that
rises until the targets use up the total).

Null text: size 0. Null source: a source of its own, last. A size of 0 takes nothing. Repeated
rows and ids share one place in the order and are told apart by a running number, so they are
counted once each. The result depends on the rows and the seed only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratalake.sources.scratch import stored

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
REPEATS = 3
#: Words of a block.
BLOCK = 16
#: Documents of a shard, about, and the most shards.
SHARD_ROWS, MOST_SHARDS = 512, 1 << 16
SEED = 20


def words_in(text: Column) -> Column:
    """Number of words."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], repeats: int) -> DataFrame:
    """``source, source_size, weight, target``; one row per source, so windows over it are small."""
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1)
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", given)
    # Sources reach their limit in the order of limit / weight; below the common level, all before have.
    limit = repeats * F.col("source_size")
    rising = Window.orderBy(limit / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, after = rising.rowsBetween(Window.unboundedPreceding, -1), rising.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy()
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    total = total.withColumn("limit", limit.cast("double")).withColumn("level", left / F.sum("weight").over(after))
    # Levels fall from the first source that stays below its limit on: the highest of those holds.
    holds = F.max(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("level"))).over(every)
    return total.withColumn("holds", holds).select(
        "source", "source_size", "weight", F.least("limit", F.col("weight") * F.coalesce("holds", F.lit(0.0))).alias("target")
    )


def apportioned(rows: DataFrame, within: list[str], value: str, seats: str, order: list[Column]) -> DataFrame:
    """The rows with ``quota``: whole seats by highest quotients value / 1, 3, 5, ...

    ``seats`` names the column with the seats of each group. Far below its exact share a row
    wins every quotient, so only those near the share are laid out and ranked.
    """
    group = Window.partitionBy(*within)
    share = F.coalesce(F.try_divide(F.col(value).cast("double"), F.sum(F.col(value).cast("double")).over(group)), F.lit(0.0))
    reach = (F.ceil(share * F.count("*").over(group) / 2) + 2).cast("long")
    rows = rows.withColumn("share", share).withColumn("reach", reach)
    sure = F.greatest(F.lit(0), F.floor(F.col("share") * F.col(seats)) - F.col("reach"))
    rows = rows.withColumn("sure", F.when(F.col("share") > 0, sure).otherwise(0).cast("long"))
    rows = rows.withColumn("open", F.col(seats) - F.sum("sure").over(group))
    step = F.explode(F.sequence(F.lit(0).cast("long"), 2 * F.col("reach") + 1)).alias("step")
    tried = rows.filter("share > 0").select(*rows.columns, step)
    quotient = F.col(value) / (2 * (F.col("sure") + F.col("step")) + 1)
    rank = F.row_number().over(group.orderBy(quotient.desc(), *order, "step"))
    won = (F.max("sure") + F.count_if(F.col("rank") <= F.col("open"))).alias("quota")
    keys = [c for c in rows.columns if c not in ("share", "reach", "sure", "open")]
    return tried.withColumn("rank", rank).groupBy(*keys).agg(won)


def mixed(
    docs: DataFrame,
    keep: tuple[str, ...] = ("doc_id",),
    weights: tuple[int, ...] = WEIGHTS,
    repeats: int = REPEATS,
    block: int = BLOCK,
    seed: int = SEED,
) -> DataFrame:
    """``keep`` with ``size, source_size, target, taken, copies``.

    ``taken`` counts the words that the mix takes of a document, repeats counted; ``copies`` is
    the number of whole copies nearest to that.
    """
    source, text = F.col("source"), F.xxhash64(F.lit(seed), "doc_id", "text")
    own = [F.col(k).alias(f"__keep{i}") for i, k in enumerate(keep)]
    known = {"__source": source, "__id": F.col("doc_id"), "__size": words_in(F.col("text")), "__text": text}
    known = [c.alias(name) for name, c in known.items()]
    sizes = stored(docs.select(*known), "sizes")
    shards = min(max(sizes.count() // SHARD_ROWS, 1), MOST_SHARDS)
    shard = F.pmod(F.col("__text"), F.lit(shards)).alias("shard")

    counted = sizes.select(F.col("__source").alias("source"), shard, F.col("__size").alias("size"))
    cells = stored(counted.groupBy("source", "shard").agg(F.sum("size").alias("cell_size")), "cells")
    targets = source_targets(cells.select("source", F.col("cell_size").alias("size")), weights, repeats)
    name = [F.col("source").isNull(), F.encode("source", "UTF-8")]
    seats = F.round(F.sum("source_size").over(Window.partitionBy()) / block).cast("long")
    given = apportioned(targets.withColumn("seats", seats), [], "target", "seats", name)
    targets = stored(
        targets.alias("t").join(given.alias("g"), F.expr("t.source <=> g.source"), "left").select("t.*", F.coalesce("g.quota", F.lit(0)).alias("blocks")),
        "targets",
    )
    cells = cells.alias("c").join(targets.alias("t"), F.expr("c.source <=> t.source")).select("c.*", "source_size", "target", "blocks")
    dealt = apportioned(cells, ["source"], "cell_size", "blocks", [F.col("shard")])
    quotas = stored(dealt.select(F.col("source").alias("q_source"), F.col("shard").alias("q_shard"), "cell_size", "quota"), "quotas")

    rows = docs.select(*own, *known).withColumn("shard", shard)
    place = Window.partitionBy("__source", "shard").orderBy(F.xxhash64("__text"), "__text", "__id", "__size")
    rows = rows.withColumn("stop", F.sum("__size").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(quotas, F.expr("__source <=> q_source AND shard = q_shard"), "left")
    rows = rows.join(
        targets.select(F.col("source").alias("t_source"), F.col("source_size"), F.col("target")), F.expr("__source <=> t_source"), "left"
    )
    size, start = F.col("__size"), F.col("stop") - F.col("__size")
    limit = F.least(F.col("quota") * block, F.col("cell_size") * repeats)
    whole = F.coalesce(F.floor(F.try_divide(limit, F.col("cell_size"))), F.lit(0))
    rows = rows.withColumn("whole", whole).withColumn("rest", F.coalesce(limit - F.col("whole") * F.col("cell_size"), F.lit(0)))
    part = F.greatest(F.lit(0), F.least("stop", "rest") - start)
    nearest = F.col("whole") + F.when((size > 0) & (2 * part >= size), 1).otherwise(0)
    return rows.select(
        *[F.col(f"__keep{i}").alias(k) for i, k in enumerate(keep)],
        size.alias("size"),
        "source_size",
        "target",
        (F.col("whole") * size + part).alias("taken"),
        nearest.alias("copies"),
    )


def op7_mixing(spark, sf_dir):
    done = mixed(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return done.select("doc_id", "size", "source_size", "target", "taken")
