"""Landing to gold, stage by stage. Stages hand over through stored tables only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from stratalake.operators.conform import silver
from stratalake.operators.gates import (
    bronze_columns,
    bronze_counts,
    bronze_verdicts,
    enforce,
    gate_silver,
    missing_columns,
    missing_report,
)
from stratalake.operators.marts import fact, hour_mart, month_mart
from stratalake.operators.reports import RULES, diagnostic_counts, percent, rows_by_file
from stratalake.plans.journal import finished, note
from stratalake.plans.sizing import BYTES_PER_REDUCER, shuffle_sized_for, table_bytes
from stratalake.sources.lake import Lake, publish_layer, read_layer, replace_layer, stage_layer
from stratalake.sources.landing import read_landing
from stratalake.spec import DatasetSpec

DISCARD_COLUMNS = ("total", *RULES, "duplicates", "kept")


@dataclass(frozen=True)
class BronzeResult:
    table: DataFrame
    rows: int
    counts: Row
    """Diagnostic counts, taken in the same pass as the gate."""

    @property
    def rows_by_file(self) -> DataFrame:
        """Rows of each landing entry."""
        return rows_by_file(self.table)


@dataclass(frozen=True)
class SilverResult:
    table: DataFrame
    rows: int
    discards: DataFrame
    """The discard report, and the values that a cast turned into NULL."""


@dataclass(frozen=True)
class GoldResult:
    fact: DataFrame
    month_mart: DataFrame
    hour_mart: DataFrame


def audit_bronze(bronze: DataFrame, lake: Lake) -> Row:
    """Bronze gate and cleaning diagnostics in one pass over the table."""
    missing = missing_columns(bronze, bronze_columns(lake.spec))
    if missing:
        enforce(missing_report(bronze, missing), "bronze")
    measured = bronze.agg(*bronze_counts(bronze), *diagnostic_counts(bronze, lake.spec))
    counts = measured.first()
    metrics = bronze.sparkSession.createDataFrame([counts], measured.schema)
    enforce(bronze_verdicts(metrics), "bronze")
    return counts


def run_bronze(spark: SparkSession, lake: Lake, periods: Sequence[str] | None = None) -> BronzeResult:
    """Ingests the named periods, or all of them, then audits what was written.

    Bronze holds exactly the periods named: a subset replaces the whole table.
    """
    paths = [lake.landing(period) for period in periods or lake.spec.periods]
    landed = read_landing(spark, paths, lake.spec.lineage_level)
    table = replace_layer(landed, lake, "bronze")
    counts = audit_bronze(table, lake)
    return BronzeResult(table, counts.rows, counts)


def run_silver(
    spark: SparkSession, lake: Lake, bronze: BronzeResult | None = None
) -> SilverResult:
    """Cleans, types and deduplicates; audits the staged table; then publishes it.

    Run on its own it audits bronze first. After ``run_bronze`` its result can be
    passed in, which saves that pass. If the gate fails, the old silver stays and
    the rejected one remains in staging for inspection.
    """
    source = bronze.table if bronze else read_layer(spark, lake, "bronze")
    counts = bronze.counts if bronze else audit_bronze(source, lake)
    with shuffle_sized_for(spark, table_bytes(source)):
        staged = stage_layer(silver(source, lake.spec), lake, "silver")
        rows = gate_silver(staged, lake.spec)["rows"]
    table = publish_layer(spark, lake, "silver")
    report = discards(spark, counts, rows)
    lost = F.lit(counts.nulled_by_cast).cast("bigint")
    return SilverResult(table, rows, report.withColumn("nulled_by_cast", lost))


def discards(spark: SparkSession, counts: Row, kept: int) -> DataFrame:
    """The discard report from counts already taken; scans nothing."""
    broken = [counts[name] for name in RULES]
    row = (counts.total, *broken, counts.accepted - kept, kept)
    schema = ", ".join(f"{name} bigint" for name in DISCARD_COLUMNS)
    report = spark.createDataFrame([row], schema)
    return report.withColumn("kept_pct", percent(F.col("kept"), F.col("total")))


def gather_months(
    table: DataFrame, spec: DatasetSpec, size: int = 0, part_bytes: int = BYTES_PER_REDUCER
) -> DataFrame:
    """Brings the rows of a month together, a large month in several partitions.

    Adaptive execution splits months by size. Without it a salt from the key
    splits every month alike, into as many parts of ``part_bytes`` as a table of
    ``size`` bytes needs where all of it is one month.
    """
    adaptive = table.sparkSession.conf.get("spark.sql.adaptive.enabled").lower() == "true"
    if adaptive:
        return table.hint("rebalance", spec.month_column)
    parts = max(1, -(-size // part_bytes))
    salt = F.pmod(F.xxhash64(*spec.key), F.lit(parts))
    return table.repartition(F.col(spec.month_column), salt)


def run_gold(
    spark: SparkSession, lake: Lake, part_bytes: int = BYTES_PER_REDUCER
) -> GoldResult:
    """Fact table split by month, and the two marts.

    Silver is spread by key, so every task holds every month and would write a
    file for each. Gathering the months first gives each as many right-sized files
    as it needs. A month is one shuffle partition until adaptive execution splits
    it, so the number of partitions need not grow.
    """
    spec = lake.spec
    silver_table = read_layer(spark, lake, "silver")
    size = table_bytes(silver_table)
    with shuffle_sized_for(spark, size):
        gathered = gather_months(fact(silver_table, spec), spec, size, part_bytes)
        stored = replace_layer(gathered, lake, "fact", (spec.month_column,))
    marts = {"month_mart": month_mart(stored, spec), "hour_mart": hour_mart(stored, spec)}
    # A mart has one row per month or hour of the day, so one file holds it.
    saved = {name: replace_layer(mart.coalesce(1), lake, name) for name, mart in marts.items()}
    return GoldResult(stored, saved["month_mart"], saved["hour_mart"])


def run_all(
    spark: SparkSession,
    lake: Lake,
    periods: Sequence[str] | None = None,
    run: str | None = None,
) -> GoldResult:
    """Landing to gold. Bronze is read twice: once audited, once written to silver.

    A run that has a name can be taken up again under that name after it died: stages
    that the journal has as finished are left out, as long as their tables are still the
    ones they read and wrote. Silver then audits bronze once more, as when it runs alone.
    """
    periods = tuple(periods or lake.spec.periods)
    done = finished(spark, lake, run, periods)
    bronze = None
    if "bronze" not in done:
        bronze = run_bronze(spark, lake, periods)
        note(spark, lake, run, "bronze", periods)
    if "silver" not in done:
        run_silver(spark, lake, bronze)
        note(spark, lake, run, "silver", periods)
    if "gold" in done:
        return GoldResult(*[read_layer(spark, lake, name) for name in ("fact", "month_mart", "hour_mart")])
    gold = run_gold(spark, lake)
    note(spark, lake, run, "gold", periods)
    return gold
