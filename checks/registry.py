"""Every query with its SQL oracle. The names follow the operators they exercise."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.scratch import scratch_folder
from checks.trips_fixture import (
    CLEAN_SQL,
    SILVER_SQL,
    TRIPS_2024,
    TRIPS_SQL,
    events_as_trips,
    load,
    trips,
)
from stratalake.functions.times import hour_bucket, month_bucket
from stratalake.functions.typed import wall_clock
from stratalake.operators import conform, gates, marts, reports
from stratalake.operators.keys import duplicate_rows
from stratalake.operators.unify import unify
from stratalake.plans.answers import hour_answer, month_answer, run_query
from stratalake.plans.stages import run_all, run_bronze
from stratalake.sources.lake import Lake, register_fact, register_layers, save_fact_table
from stratalake.sources.landing import read_landing
from stratalake.spec import LOADED_AT

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[build.__name__] = build
        ORACLES[build.__name__] = oracle
        return build

    return register


# --- ingestion -------------------------------------------------------------


def drifted_parts(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The trips as three deliveries whose schemas differ in type, case and columns.

    Each trip is in exactly one of them, by the type of its event.
    """
    source = events_as_trips(spark, sf_dir)
    shared = ("total_amount", "tpep_pickup_datetime", "tpep_dropoff_datetime")
    kind = F.col("event_type")
    sender = F.when(kind.isin("click", "view"), "int").when(kind == "signup", "extra")

    def delivery(name: str, *columns: Column) -> DataFrame:
        sent = F.coalesce(sender, F.lit("whole")) == name
        return source.filter(sent).select(*columns, *shared)

    vendor, riders = F.col("VendorID"), F.col("passenger_count")
    whole_riders = riders.cast("bigint").alias("passenger_count")
    return {
        "int": delivery("int", vendor.cast("int").alias("VendorID"), riders),
        "extra": delivery("extra", vendor, riders, kind),
        "whole": delivery("whole", vendor.alias("vendorid"), whole_riders),
    }


def land_trips(spark: SparkSession, sf_dir: str) -> Lake:
    """Writes the deliveries as the landing entries of a new lake."""
    lake = Lake(scratch_folder(spark), TRIPS_2024)
    for period, part in drifted_parts(spark, sf_dir).items():
        part.write.mode("overwrite").parquet(lake.landing(period))
    return lake


DELIVERED_SQL = """
SELECT VendorID, passenger_count, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime,
       CASE WHEN event_type = 'signup' THEN event_type END AS event_type"""
DELIVERY_NAME_SQL = """,
       CASE WHEN event_type IN ('click', 'view') THEN 'trips_int.parquet'
            WHEN event_type = 'signup' THEN 'trips_extra.parquet'
            ELSE 'trips_whole.parquet' END AS source_file"""


@query(TRIPS_SQL + DELIVERED_SQL + " FROM bronze")
def bronze_union_drift(spark, sf_dir):
    return unify(list(drifted_parts(spark, sf_dir).values()))


@query(TRIPS_SQL + DELIVERED_SQL + DELIVERY_NAME_SQL + " FROM bronze")
def landing_ingest(spark, sf_dir):
    """Writes the deliveries as Parquet and ingests them with lineage."""
    lake = land_trips(spark, sf_dir)
    paths = [lake.landing(period) for period in lake.spec.periods]
    return read_landing(spark, paths, lake.spec.lineage_level).drop(LOADED_AT)


@query(TRIPS_SQL + 'SELECT source_file, count(*) AS "count" FROM bronze GROUP BY 1')
def bronze_rows_by_file(spark, sf_dir):
    return reports.rows_by_file(trips(spark, sf_dir))


# --- reports on bronze ------------------------------------------------------

BROKEN_SQL = """
       count(*) AS total,
       count(*) FILTER (total_amount < 0) AS negative_amount,
       count(*) FILTER (tpep_pickup_datetime >= tpep_dropoff_datetime) AS bad_interval,
       count(*) FILTER (tpep_pickup_datetime < TIMESTAMP '2024-01-01'
                        OR tpep_pickup_datetime >= TIMESTAMP '2024-06-01') AS out_of_range"""

DISTINCT_KEYS_SQL = """(SELECT count(*) FROM (
    SELECT DISTINCT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount
    FROM {table}))"""


@query(
    TRIPS_SQL
    + """,
facts AS (
    SELECT """
    + BROKEN_SQL
    + """,
           count(*) FILTER (total_amount = 0) AS zero_amount,
           count(*) FILTER (passenger_count IS NULL) AS null_count,
           count(*) FILTER (passenger_count = 0) AS zero_count,
           count(*) - """
    + DISTINCT_KEYS_SQL.format(table="bronze")
    + """ AS duplicate_keys,
           min(tpep_pickup_datetime) AS first_start,
           max(tpep_pickup_datetime) AS last_start
    FROM bronze)
SELECT total, negative_amount, zero_amount, null_count, zero_count, bad_interval,
       out_of_range, duplicate_keys,
       round(100.0 * negative_amount / total, 2) AS negative_amount_pct,
       round(100.0 * zero_amount / total, 2) AS zero_amount_pct,
       round(100.0 * null_count / total, 2) AS null_count_pct,
       round(100.0 * zero_count / total, 2) AS zero_count_pct,
       round(100.0 * bad_interval / total, 2) AS bad_interval_pct,
       round(100.0 * out_of_range / total, 2) AS out_of_range_pct,
       round(100.0 * duplicate_keys / total, 2) AS duplicate_keys_pct,
       first_start, last_start
FROM facts"""
)
def bronze_profile(spark, sf_dir):
    return reports.profile(trips(spark, sf_dir), TRIPS_2024)


@query(
    CLEAN_SQL
    + "SELECT"
    + BROKEN_SQL
    + """,
       (SELECT count(*) FROM clean) AS accepted,
       count(*) FILTER (VendorID IS NOT NULL AND TRY_CAST(VendorID AS INTEGER) IS NULL)
       + count(*) FILTER (passenger_count IS NOT NULL
                          AND TRY_CAST(trunc(passenger_count) AS INTEGER) IS NULL)
         AS nulled_by_cast
FROM bronze"""
)
def discard_diagnostics(spark, sf_dir):
    return reports.diagnostics(trips(spark, sf_dir), TRIPS_2024)


@query(
    SILVER_SQL
    + "SELECT"
    + BROKEN_SQL
    + """,
       (SELECT count(*) FROM clean) - (SELECT count(*) FROM silver) AS duplicates,
       (SELECT count(*) FROM silver) AS kept,
       round(100.0 * (SELECT count(*) FROM silver) / count(*), 2) AS kept_pct
FROM bronze"""
)
def discard_report(spark, sf_dir):
    return reports.discard_report(trips(spark, sf_dir), TRIPS_2024)


@query(
    SILVER_SQL
    + """,
judged AS (
    SELECT CASE WHEN total_amount < 0 THEN 'negative_amount'
                WHEN tpep_pickup_datetime >= tpep_dropoff_datetime THEN 'bad_interval'
                WHEN tpep_pickup_datetime < TIMESTAMP '2024-01-01'
                     OR tpep_pickup_datetime >= TIMESTAMP '2024-06-01' THEN 'out_of_range'
                WHEN total_amount IS NULL OR tpep_pickup_datetime IS NULL
                     OR tpep_dropoff_datetime IS NULL THEN 'null_predicate'
           END AS reason
    FROM bronze)
SELECT reason, count(*) AS rows FROM judged WHERE reason IS NOT NULL GROUP BY reason
UNION ALL
SELECT 'duplicate_key', (SELECT count(*) FROM clean) - (SELECT count(*) FROM silver)
UNION ALL
SELECT 'kept', (SELECT count(*) FROM silver)"""
)
def reject_reasons(spark, sf_dir):
    return reports.reject_reasons(trips(spark, sf_dir), TRIPS_2024)


@query(
    TRIPS_SQL
    + "SELECT count(*) - "
    + DISTINCT_KEYS_SQL.format(table="bronze")
    + " AS duplicate_keys FROM bronze"
)
def duplicate_keys(spark, sf_dir):
    return duplicate_rows(trips(spark, sf_dir), TRIPS_2024.key)


# --- silver ------------------------------------------------------------------


@query(CLEAN_SQL + "SELECT * EXCLUDE (event_id, event_type) FROM clean")
def silver_clean(spark, sf_dir):
    return conform.clean(trips(spark, sf_dir), TRIPS_2024).drop(LOADED_AT)


@query(SILVER_SQL + "SELECT * FROM conformed")
def silver_conformed(spark, sf_dir):
    cleaned = conform.clean(trips(spark, sf_dir), TRIPS_2024)
    return conform.conform(cleaned, TRIPS_2024).drop(LOADED_AT)


@query(SILVER_SQL + "SELECT * FROM silver")
def silver_dedup(spark, sf_dir):
    return conform.silver(trips(spark, sf_dir), TRIPS_2024).drop(LOADED_AT)


# --- gates --------------------------------------------------------------------


@query(
    TRIPS_SQL
    + """,
n AS (SELECT count(*) AS rows, count(*) FILTER (source_file IS NULL) AS bad FROM bronze)
SELECT 1 AS rule_no, 'required_columns' AS rule, CAST(0 AS BIGINT) AS violations, rows,
       TRUE AS passed FROM n
UNION ALL SELECT 2, 'not_empty', 0, rows, rows > 0 FROM n
UNION ALL SELECT 3, 'lineage_present', bad, rows, bad = 0 FROM n"""
)
def gate_bronze_report(spark, sf_dir):
    return gates.bronze_report(trips(spark, sf_dir), TRIPS_2024)


def _silver_gate_sql(table: str) -> str:
    null_rules = [
        (f"not_all_null:{name}", f"CASE WHEN count({name}) = 0 THEN count(*) ELSE 0 END")
        for name in TRIPS_2024.required
    ]
    rules = [
        ("required_columns", "0"),
        ("not_empty", "0"),
        *null_rules,
        ("negative_amount", "count(*) FILTER (total_amount < 0)"),
        ("bad_interval", "count(*) FILTER (tpep_pickup_datetime >= tpep_dropoff_datetime)"),
        (
            "out_of_range",
            "count(*) FILTER (tpep_pickup_datetime < TIMESTAMP '2024-01-01'"
            " OR tpep_pickup_datetime >= TIMESTAMP '2024-06-01')",
        ),
        (
            "passenger_count_range",
            "count(*) FILTER (passenger_count < 0 OR passenger_count > 9)",
        ),
        ("unique_key", "count(*) - " + DISTINCT_KEYS_SQL.format(table=table)),
    ]
    branches = [
        f"SELECT {number} AS rule_no, '{name}' AS rule, CAST({count} AS BIGINT) AS violations,"
        f" count(*) AS rows FROM {table}"
        for number, (name, count) in enumerate(rules, start=1)
    ]
    measured = " UNION ALL ".join(branches)
    return (
        SILVER_SQL
        + f", measured AS ({measured}) SELECT *, CASE WHEN rule = 'not_empty' THEN rows > 0"
        " ELSE violations = 0 END AS passed FROM measured"
    )


@query(_silver_gate_sql("silver"))
def gate_silver_report(spark, sf_dir):
    return gates.silver_report(conform.silver(trips(spark, sf_dir), TRIPS_2024), TRIPS_2024)


@query(_silver_gate_sql("bronze"))
def gate_silver_report_on_bronze(spark, sf_dir):
    """The silver rules on raw data, where they must find something."""
    return gates.silver_report(trips(spark, sf_dir), TRIPS_2024)


@query(
    SILVER_SQL
    + "SELECT "
    + ", ".join(f"count(*) - count({name}) AS {name}_nulls" for name in TRIPS_2024.required)
    + " FROM silver"
)
def required_null_counts(spark, sf_dir):
    measured = gates.silver_metrics(conform.silver(trips(spark, sf_dir), TRIPS_2024), TRIPS_2024)
    return measured.select(*[f"{name}_nulls" for name in TRIPS_2024.required])


# --- gold and SQL -------------------------------------------------------------


def fact_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.fact(conform.silver(trips(spark, sf_dir), TRIPS_2024), TRIPS_2024)


@query(SILVER_SQL + "SELECT * FROM fact")
def fact_trips(spark, sf_dir):
    return fact_of(spark, sf_dir)


@query(
    SILVER_SQL
    + """
SELECT pickup_month, round(avg(total_amount), 2) AS avg_total_amount, count(*) AS trips
FROM fact GROUP BY pickup_month"""
)
def mart_amount_by_month(spark, sf_dir):
    return marts.month_mart(fact_of(spark, sf_dir), TRIPS_2024)


HOURS_SQL = """
SELECT pickup_hour, round(avg(passenger_count), 3) AS avg_passenger_count, count(*) AS trips
FROM fact WHERE pickup_month = '2024-05' AND passenger_count > 0
GROUP BY pickup_hour"""
MONTHS_SQL = """
SELECT pickup_month, round(avg(total_amount), 2) AS avg_total_amount_per_trip,
       count(*) AS trips, round(sum(total_amount), 2) AS total_revenue
FROM fact GROUP BY pickup_month"""


@query(SILVER_SQL + HOURS_SQL)
def mart_passengers_by_hour(spark, sf_dir):
    return marts.hour_mart(fact_of(spark, sf_dir), TRIPS_2024)


@query(SILVER_SQL + MONTHS_SQL)
def q1_sql(spark, sf_dir):
    fact_of(spark, sf_dir).createOrReplaceTempView("fact_trips")
    return month_answer(spark)


@query(SILVER_SQL + HOURS_SQL)
def q2_sql(spark, sf_dir):
    fact_of(spark, sf_dir).createOrReplaceTempView("fact_trips")
    return hour_answer(spark, month=TRIPS_2024.mart_month)


@query(TRIPS_SQL + "SELECT count(*) AS n FROM bronze")
def adhoc_count(spark, sf_dir):
    trips(spark, sf_dir).createOrReplaceTempView("bronze")
    return run_query(spark, "SELECT count(*) AS n FROM bronze")


@query(SILVER_SQL + MONTHS_SQL)
def medallion_month_answer(spark, sf_dir):
    """Landing files to published gold tables, then the question in SQL on the stored fact."""
    lake = land_trips(spark, sf_dir)
    run_all(spark, lake)
    return month_answer(spark, register_fact(spark, lake))


@query(SILVER_SQL + HOURS_SQL)
def medallion_hour_mart(spark, sf_dir):
    """Landing files to the stored hour mart, read back."""
    return run_all(spark, land_trips(spark, sf_dir)).hour_mart


@query(
    SILVER_SQL
    + """
SELECT 'bronze' AS layer, count(*) AS rows FROM bronze
UNION ALL SELECT 'silver', count(*) FROM silver
UNION ALL SELECT 'gold_fact', count(*) FROM fact"""
)
def medallion_layer_counts(spark, sf_dir):
    """Landing files to gold, then free SQL over a view per stored layer."""
    lake = land_trips(spark, sf_dir)
    run_all(spark, lake)
    counts = [
        f"SELECT '{view}' AS layer, count(*) AS rows FROM {view}"
        for view in register_layers(spark, lake)
    ]
    return run_query(spark, " UNION ALL ".join(counts))


# --- drift, subsets and nested folders ------------------------------------------

TEXT_DRIFT_SQL = (
    TRIPS_SQL
    + """,
sent AS (
    SELECT VendorID, total_amount, tpep_pickup_datetime, tpep_dropoff_datetime, source_file,
           passenger_count, event_id % 3 = 2 AND event_id % 17 = 0 AS lost
    FROM bronze)
"""
)


def text_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries: counts as doubles, as whole numbers, and as text that is no number at times."""
    source = events_as_trips(spark, sf_dir)
    event, riders = F.col("event_id"), F.col("passenger_count")
    text = F.when(event % 17 == 0, F.when(riders.isNotNull(), "x")).otherwise(riders.cast("bigint").cast("string"))
    others = [c for c in (*TRIPS_2024.required, "source_file", LOADED_AT) if c != "passenger_count"]
    shapes = {0: riders, 1: riders.cast("bigint"), 2: text}
    return unify(
        [
            source.filter(event % 3 == number).select(*others, shape.alias("passenger_count"))
            for number, shape in shapes.items()
        ]
    )


@query(
    TEXT_DRIFT_SQL
    + """
SELECT CAST(VendorID AS INTEGER) AS VendorID,
       CASE WHEN NOT lost THEN CAST(trunc(passenger_count) AS INTEGER) END AS passenger_count,
       total_amount, tpep_pickup_datetime, tpep_dropoff_datetime, source_file
FROM sent"""
)
def drift_text_conformed(spark, sf_dir):
    return conform.conform(text_drift(spark, sf_dir), TRIPS_2024).drop(LOADED_AT)


@query(
    TEXT_DRIFT_SQL
    + """
SELECT count(*) AS total, count(*) FILTER (lost AND passenger_count IS NOT NULL) AS nulled_by_cast
FROM sent"""
)
def drift_text_losses(spark, sf_dir):
    return reports.diagnostics(text_drift(spark, sf_dir), TRIPS_2024).select("total", "nulled_by_cast")


@query(TRIPS_SQL + DELIVERED_SQL + DELIVERY_NAME_SQL + " FROM bronze")
def landing_nested(spark, sf_dir):
    """Deliveries whose files lie in folders of their own, one of them named like a partition."""
    lake = Lake(scratch_folder(spark), replace(TRIPS_2024, lineage_level="folder"))
    for period, part in drifted_parts(spark, sf_dir).items():
        late = F.col("VendorID") % 2 == 0
        part.filter(~late).write.mode("overwrite").parquet(lake.landing(period))
        part.filter(late).write.parquet(f"{lake.landing(period)}/region=late")
    paths = [lake.landing(period) for period in lake.spec.periods]
    return read_landing(spark, paths, lake.spec.lineage_level).drop(LOADED_AT)


@query(
    TRIPS_SQL
    + DELIVERED_SQL
    + DELIVERY_NAME_SQL
    + " FROM bronze WHERE event_type IN ('click', 'view', 'signup')"
)
def bronze_subset(spark, sf_dir):
    """Two of three periods."""
    lake = land_trips(spark, sf_dir)
    return run_bronze(spark, lake, ["int", "extra"]).table.drop(LOADED_AT)


@query(
    SILVER_SQL.replace("FROM events", "FROM events WHERE event_type NOT IN ('click', 'view', 'signup')")
    + MONTHS_SQL
)
def medallion_subset_rerun(spark, sf_dir):
    """All periods, then one alone: nothing of the others may stay in the fact."""
    lake = land_trips(spark, sf_dir)
    run_all(spark, lake)
    run_all(spark, lake, ["whole"])
    return month_answer(spark, register_fact(spark, lake))


@query(SILVER_SQL + "SELECT * FROM fact")
def fact_catalog_table(spark, sf_dir):
    lake = land_trips(spark, sf_dir)
    run_all(spark, lake)
    return save_fact_table(spark, lake, f"fact_{uuid.uuid4().hex}")


# --- the same operators on tables as they are -----------------------------------


@query(
    """
SELECT strftime(l_shipdate, '%Y-%m') AS ship_month,
       round(avg(l_extendedprice), 2) AS avg_price, count(*) AS items
FROM lineitem GROUP BY 1"""
)
def monthly_amount_lineitem(spark, sf_dir):
    items = load(spark, sf_dir, "lineitem")
    month = month_bucket(wall_clock(items, "l_shipdate"))
    dated = items.select(month.alias("ship_month"), "l_extendedprice")
    return marts.average_by(dated, "ship_month", "l_extendedprice", 2, "avg_price", "items")


@query(
    """
SELECT CAST(hour(ts) AS INTEGER) AS event_hour,
       round(avg(value), 3) AS avg_value, count(*) AS events
FROM events WHERE value > 0 GROUP BY 1"""
)
def hourly_value_events(spark, sf_dir):
    events = load(spark, sf_dir, "events").filter(F.col("value") > 0)
    timed = events.select(hour_bucket(wall_clock(events, "ts")).alias("event_hour"), "value")
    return marts.average_by(timed, "event_hour", "value", 3, "avg_value", "events")


LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_ORDER = (
    "l_shipdate",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
    "l_returnflag",
    "l_linestatus",
)


@query(
    f"""
SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY {", ".join(LINE_KEY)}
                                 ORDER BY {", ".join(f"{c} NULLS LAST" for c in LINE_ORDER)}) AS rn
    FROM lineitem)
WHERE rn = 1"""
)
def lineitem_dedup(spark, sf_dir):
    return conform.keep_first(load(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER)


@query(
    """
SELECT (SELECT count(*) FROM lineitem)
       - (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem))
       AS duplicate_keys"""
)
def lineitem_duplicate_keys(spark, sf_dir):
    return duplicate_rows(load(spark, sf_dir, "lineitem"), LINE_KEY)


from checks import drift, faults  # noqa: E402, F401  (their queries register themselves above)
