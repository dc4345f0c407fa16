"""Queries on trips with planted faults, so that every rule has something to find.

``planted`` changes rows by their event's number; the SQL beside it says the same. Whole-table
faults (no rows, a column missing or wholly NULL) are tables of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.registry import BROKEN_SQL, land_trips, query
from checks.scratch import scratch_folder
from checks.trips_fixture import TRIPS_2024, TRIPS_SQL, events_as_trips
from stratalake.operators import gates, reports
from stratalake.plans.answers import DISPLAY_ROWS, run_query
from stratalake.plans.outcome import outcome
from stratalake.plans.stages import run_all, run_silver
from stratalake.sources.lake import Lake, read_layer
from stratalake.spec import LOADED_AT, SOURCE_FILE

TOO_LARGE = 1 << 40


def planted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fixture's bronze with rows of every fault."""
    source = events_as_trips(spark, sf_dir)
    number = F.col("event_id")

    def every(step: int, value: Column, column: str) -> Column:
        return F.when(number % step == 0, value).otherwise(F.col(column))

    riders = F.when(number % 71 == 0, -1.0).when(number % 67 == 0, 12.0).otherwise(F.col("passenger_count"))
    changed = {
        SOURCE_FILE: every(59, F.lit(None), SOURCE_FILE),
        LOADED_AT: every(61, F.lit(None), LOADED_AT),
        "VendorID": every(73, F.lit(TOO_LARGE) + number, "VendorID"),
        "total_amount": every(79, F.lit(0.0), "total_amount"),
        "passenger_count": riders,
    }
    return source.withColumns(changed).select(*TRIPS_2024.required, SOURCE_FILE, LOADED_AT)


PLANTED_SQL = (
    TRIPS_SQL
    + f""",
planted AS (
    SELECT CASE WHEN event_id % 73 = 0 THEN {TOO_LARGE} + event_id ELSE VendorID END AS VendorID,
           CASE WHEN event_id % 71 = 0 THEN -1.0 WHEN event_id % 67 = 0 THEN 12.0
                ELSE passenger_count END AS passenger_count,
           CASE WHEN event_id % 79 = 0 THEN 0.0 ELSE total_amount END AS total_amount,
           tpep_pickup_datetime, tpep_dropoff_datetime,
           event_id % 59 = 0 OR event_id % 61 = 0 AS no_lineage
    FROM bronze)"""
)


def by_fault(tables: dict[str, DataFrame], report) -> DataFrame:
    """The report of each table, one below the other."""
    reported = [report(table, TRIPS_2024).select(F.lit(fault).alias("fault"), "*") for fault, table in tables.items()]
    whole, *others = reported
    for other in others:
        whole = whole.unionByName(other)
    return whole


def _missing_sql(fault: str, column: str) -> str:
    return f"SELECT '{fault}' AS fault, 1 AS rule_no, 'required_columns: missing {column}' AS rule, CAST(1 AS BIGINT) AS violations, CAST(NULL AS BIGINT) AS rows, FALSE AS passed"


def _bronze_sql(fault: str, where: str) -> str:
    counted = f"(SELECT count(*) AS rows, count(*) FILTER (no_lineage) AS bad FROM planted WHERE {where})"
    return " UNION ALL ".join(
        f"SELECT '{fault}' AS fault, {number} AS rule_no, '{rule}' AS rule, CAST({bad} AS BIGINT) AS violations, rows, {passed} AS passed FROM {counted}"
        for number, (rule, bad, passed) in enumerate(
            [("required_columns", "0", "TRUE"), ("not_empty", "0", "rows > 0"), ("lineage_present", "bad", "bad = 0")], 1
        )
    )


@query(PLANTED_SQL + " UNION ALL ".join([_bronze_sql("rows", "TRUE"), _bronze_sql("empty", "FALSE"), _missing_sql("no origin", SOURCE_FILE)]))
def gate_bronze_report_dirty(spark, sf_dir):
    rows = planted(spark, sf_dir)
    return by_fault({"rows": rows, "empty": rows.filter(F.lit(False)), "no origin": rows.drop(SOURCE_FILE)}, gates.bronze_report)


def _silver_sql(fault: str, where: str = "TRUE", absent: str = "") -> str:
    """The silver rules on the planted rows, with one column wholly NULL."""
    typed = {
        "VendorID": "TRY_CAST(VendorID AS INTEGER)",
        "passenger_count": "CAST(trunc(passenger_count) AS INTEGER)",
        "total_amount": "total_amount",
        "tpep_pickup_datetime": "tpep_pickup_datetime",
        "tpep_dropoff_datetime": "tpep_dropoff_datetime",
    }
    columns = ", ".join(f"{f'CASE WHEN FALSE THEN {value} END' if name == absent else value} AS {name}" for name, value in typed.items())
    rows = f"(SELECT {columns} FROM planted WHERE {where})"
    keys = f"(SELECT count(*) FROM (SELECT DISTINCT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount FROM {rows}))"
    rules = [
        ("required_columns", "0"),
        ("not_empty", "0"),
        *[(f"not_all_null:{name}", f"CASE WHEN count({name}) = 0 THEN count(*) ELSE 0 END") for name in TRIPS_2024.required],
        ("negative_amount", "count(*) FILTER (total_amount < 0)"),
        ("bad_interval", "count(*) FILTER (tpep_pickup_datetime >= tpep_dropoff_datetime)"),
        ("out_of_range", "count(*) FILTER (tpep_pickup_datetime < TIMESTAMP '2024-01-01' OR tpep_pickup_datetime >= TIMESTAMP '2024-06-01')"),
        ("passenger_count_range", "count(*) FILTER (passenger_count < 0 OR passenger_count > 9)"),
        ("unique_key", f"count(*) - {keys}"),
    ]
    measured = " UNION ALL ".join(
        f"SELECT '{fault}' AS fault, {number} AS rule_no, '{rule}' AS rule, CAST({count} AS BIGINT) AS violations, count(*) AS rows FROM {rows}"
        for number, (rule, count) in enumerate(rules, 1)
    )
    return f"SELECT *, CASE WHEN rule = 'not_empty' THEN rows > 0 ELSE violations = 0 END AS passed FROM ({measured})"


@query(
    PLANTED_SQL
    + " UNION ALL ".join(
        [
            _silver_sql("rows"),
            _silver_sql("empty", "FALSE"),
            *[_silver_sql(f"null {name}", absent=name) for name in TRIPS_2024.required],
            _missing_sql("no amount", "total_amount"),
        ]
    )
)
def gate_silver_report_dirty(spark, sf_dir):
    rows = planted(spark, sf_dir)
    kinds = dict(rows.dtypes)
    wholly_null = {f"null {name}": rows.withColumn(name, F.lit(None).cast(kinds[name])) for name in TRIPS_2024.required}
    tables = {"rows": rows, "empty": rows.filter(F.lit(False)), **wholly_null, "no amount": rows.drop("total_amount")}
    return by_fault(tables, gates.silver_report)


@query(
    PLANTED_SQL
    + "SELECT"
    + BROKEN_SQL
    + """,
       count(*) FILTER (total_amount >= 0 AND tpep_pickup_datetime < tpep_dropoff_datetime
                        AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01'
                        AND tpep_pickup_datetime < TIMESTAMP '2024-06-01') AS accepted,
       count(*) FILTER (VendorID IS NOT NULL AND TRY_CAST(VendorID AS INTEGER) IS NULL) AS nulled_by_cast
FROM planted"""
)
def discard_diagnostics_dirty(spark, sf_dir):
    return reports.diagnostics(planted(spark, sf_dir), TRIPS_2024)


@query(
    PLANTED_SQL
    + """
SELECT count(*) AS total, count(*) FILTER (total_amount = 0) AS zero_amount,
       round(100.0 * count(*) FILTER (total_amount = 0) / count(*), 2) AS zero_amount_pct,
       count(*) FILTER (trunc(passenger_count) = 0) AS zero_count
FROM planted"""
)
def bronze_profile_dirty(spark, sf_dir):
    found = reports.profile(planted(spark, sf_dir), TRIPS_2024)
    return found.select("total", "zero_amount", "zero_amount_pct", "zero_count")


_COUNTS_SQL = """,
clean AS (
    SELECT DISTINCT TRY_CAST(VendorID AS INTEGER) AS VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount
    FROM bronze
    WHERE total_amount >= 0 AND tpep_pickup_datetime < tpep_dropoff_datetime
      AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-06-01'),
ranged AS (
    SELECT count(*) AS bad
    FROM (SELECT row_number() OVER (PARTITION BY VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, total_amount
                                    ORDER BY source_file, trunc(passenger_count) NULLS LAST) AS rn,
                 event_id % 67 = 0 AS crowded
          FROM (SELECT * REPLACE (CASE WHEN event_id % 67 = 0 THEN 12 ELSE passenger_count END AS passenger_count,
                                  CASE event_type WHEN 'click' THEN 'trips_int.parquet' WHEN 'view' THEN 'trips_int.parquet'
                                       WHEN 'signup' THEN 'trips_extra.parquet' ELSE 'trips_whole.parquet' END AS source_file)
                FROM bronze)
          WHERE total_amount >= 0 AND tpep_pickup_datetime < tpep_dropoff_datetime
            AND tpep_pickup_datetime >= TIMESTAMP '2024-01-01' AND tpep_pickup_datetime < TIMESTAMP '2024-06-01')
    WHERE rn = 1 AND crowded)
"""
_ROW_SQL = "SELECT '{0}' AS stage, {1} AS passed, {2} AS layer, {3} AS rule, CAST({4} AS BIGINT) AS violations, CAST({5} AS BIGINT) AS rows, '{6}' AS views"


@query(
    TRIPS_SQL
    + _COUNTS_SQL
    + " UNION ALL ".join(
        _ROW_SQL.format(*row)
        for row in [
            ("no layers", "TRUE", "NULL", "NULL", "NULL", "NULL", ""),
            ("input gate", "FALSE", "'bronze'", "'lineage_present'", "(SELECT count(*) FROM bronze WHERE event_id % 59 = 0)", "NULL", "bronze"),
            ("silver gate", "FALSE", "'silver'", "'passenger_count_range'", "(SELECT bad FROM ranged)", "NULL", "bronze"),
            ("whole run", "TRUE", "NULL", "NULL", "NULL", "(SELECT count(*) FROM clean)", "bronze,silver,gold_fact"),
            ("one load time", "TRUE", "NULL", "NULL", "NULL", "1", "bronze,silver,gold_fact"),
            ("display", "TRUE", "NULL", "NULL", "NULL", f"least({DISPLAY_ROWS}, (SELECT count(*) FROM bronze))", "bronze,silver,gold_fact"),
        ]
    )
)
def stage_outcomes(spark, sf_dir):
    """Stages that pass and stages that a gate stops, with what can be queried afterwards."""
    fresh = Lake(scratch_folder(spark), TRIPS_2024)
    rows = [outcome(spark, fresh, "no layers", lambda: None)]

    dirty = Lake(scratch_folder(spark), TRIPS_2024)
    source = events_as_trips(spark, sf_dir)
    no_origin = source.withColumn(SOURCE_FILE, F.when(F.col("event_id") % 59 != 0, F.col(SOURCE_FILE)))
    no_origin.select(*TRIPS_2024.required, SOURCE_FILE, LOADED_AT).write.parquet(dirty.path("bronze"))
    rows.append(outcome(spark, dirty, "input gate", lambda: run_silver(spark, dirty).rows))

    crowded = Lake(scratch_folder(spark), TRIPS_2024)
    riders = F.when(F.col("event_id") % 67 == 0, 12.0).otherwise(F.col("passenger_count"))
    kind = F.col("event_type")
    sender = F.when(kind.isin("click", "view"), "int").when(kind == "signup", "extra").otherwise("whole")
    for period in TRIPS_2024.periods:
        part = source.filter(sender == period).withColumn("passenger_count", riders)
        part.select(*TRIPS_2024.required).write.parquet(crowded.landing(period))
    rows.append(outcome(spark, crowded, "silver gate", lambda: run_all(spark, crowded).fact.count()))

    whole = land_trips(spark, sf_dir)
    rows.append(outcome(spark, whole, "whole run", lambda: run_all(spark, whole).fact.count()))
    loads = lambda: read_layer(spark, whole, "bronze").select(LOADED_AT).distinct().filter(f"{LOADED_AT} IS NOT NULL").count()
    rows.append(outcome(spark, whole, "one load time", loads))
    shown = lambda: run_query(spark, "SELECT * FROM bronze", DISPLAY_ROWS).count()
    rows.append(outcome(spark, whole, "display", shown))
    result, *others = rows
    for other in others:
        result = result.unionByName(other)
    return result
