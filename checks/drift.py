"""Queries on deliveries whose types drift inside structs and arrays, and on numbers sent as text."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.registry import query
from checks.scratch import scratch_folder
from checks.trips_fixture import TRIPS_2024, load
from stratalake.functions.typed import coerce, field_types
from stratalake.operators.unify import unify
from stratalake.sources.lake import Lake
from stratalake.sources.landing import read_landing
from stratalake.spec import LOADED_AT


@query(
    """
SELECT event_id,
       CASE event_id % 3 WHEN 0 THEN CAST(user_id AS VARCHAR) WHEN 1 THEN 'u' || user_id END AS code,
       CASE event_id % 3 WHEN 1 THEN event_type END AS kind,
       CASE event_id % 3 WHEN 2 THEN CAST(user_id AS DOUBLE) ELSE CAST(event_id % 7 AS DOUBLE) END AS score,
       CASE event_id % 3 WHEN 1 THEN 3000000000 + user_id ELSE user_id END AS first_tag,
       CASE WHEN event_id % 3 = 2 THEN 1 ELSE 2 END AS tags,
       'array<bigint>' AS tags_type,
       CASE event_id % 3 WHEN 0 THEN 'trips_int.parquet' WHEN 1 THEN 'trips_extra.parquet'
                         ELSE 'trips_whole.parquet' END AS source_file
FROM events"""
)
def landing_nested_types(spark, sf_dir):
    """Structs with a field as INT, as text and absent, in other case and order; arrays of INT and BIGINT."""
    events = load(spark, sf_dir, "events")
    event, user = F.col("event_id"), F.col("user_id")
    small = (event % 7).cast("int")
    shapes = {
        "int": (
            F.struct(user.cast("int").alias("code"), F.struct(small.alias("score")).alias("inner")),
            F.array(user.cast("int"), F.lit(1)),
        ),
        "extra": (
            F.struct(
                F.struct(small.cast("bigint").alias("Score")).alias("Inner"),
                F.col("event_type").alias("kind"),
                F.concat(F.lit("u"), user.cast("string")).alias("Code"),
            ),
            F.array(F.lit(3_000_000_000) + user, F.lit(2).cast("bigint")),
        ),
        "whole": (F.struct(F.struct(user.cast("double").alias("score")).alias("inner")), F.array(user.cast("int"))),
    }
    lake = Lake(scratch_folder(spark), TRIPS_2024)
    for number, (period, (about, tags)) in enumerate(shapes.items()):
        part = events.filter(event % 3 == number).select("event_id", about.alias("about"), tags.alias("tags"))
        part.write.parquet(lake.landing(period))
    landed = read_landing(spark, [lake.landing(period) for period in shapes], "folder").drop(LOADED_AT)
    return landed.select(
        "event_id",
        *[F.col(f"about.{name}").alias(name) for name in ("code", "kind")],
        F.col("about.inner.score").alias("score"),
        F.get("tags", F.lit(0)).alias("first_tag"),
        F.size("tags").alias("tags"),
        F.typeof("tags").alias("tags_type"),
        "source_file",
    )


@query(
    """
SELECT event_id,
       CASE event_id % 8 WHEN 0 THEN 9007199254740993 + event_id
                         WHEN 1 THEN event_id * 1000
                         WHEN 2 THEN -event_id
                         WHEN 3 THEN 9223372036854775807 - event_id
                         WHEN 4 THEN event_id // 100
                         WHEN 7 THEN 9007199254740993 + event_id END AS whole,
       event_id % 8 IN (5, 6) AS lost
FROM events"""
)
def drift_text_exact(spark, sf_dir):
    """Whole numbers as text: with a point, an exponent or a fraction, beyond doubles, of 40 digits."""
    events = load(spark, sf_dir, "events")
    event = F.col("event_id")
    large = F.lit(9_007_199_254_740_993) + event
    number = event.cast("string")
    written = {
        0: F.concat(large.cast("string"), F.lit(".0")),
        1: F.concat(number, F.lit("E+3")),
        2: F.concat(F.lit(" -"), number, F.lit(".999999999999999999999 ")),
        3: (F.lit((1 << 63) - 1) - event).cast("string"),
        4: F.concat(number, F.lit("e-2")),
        5: F.concat(F.repeat(F.lit("7"), 40), number),
        6: F.concat(number, F.lit(" trips")),
    }
    text = F.coalesce(*[F.when(event % 8 == at, value) for at, value in written.items()])
    sent = unify(
        [
            events.filter(event % 8 < 7).select("event_id", text.alias("amount")),
            events.filter(event % 8 == 7).select("event_id", large.alias("amount")),
        ]
    )
    whole = coerce(F.col("amount"), field_types(sent)["amount"], "bigint")
    return sent.select("event_id", whole.alias("whole"), (F.col("amount").isNotNull() & whole.isNull()).alias("lost"))
