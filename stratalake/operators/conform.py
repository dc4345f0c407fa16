"""Bronze to silver: clean, type, deduplicate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratalake.functions.rules import acceptable
from stratalake.functions.typed import typed_columns
from stratalake.spec import LINEAGE, DatasetSpec


def clean(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Rows that meet every structural rule, all columns kept."""
    return bronze.filter(acceptable(spec, typed_columns(bronze, spec)))


def conform(cleaned: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Required columns in their types and order, then lineage."""
    typed = typed_columns(cleaned, spec)
    return cleaned.select(
        *[column.alias(name) for name, column in typed.items()],
        *LINEAGE,
    )


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the first by ``order``, NULLs last.

    NULL, NaN and the two zeros compare as ``dropDuplicates`` compares them.
    The rank limit lets Spark drop all but one copy per key before the shuffle,
    so a key that fills a third of the table reaches its reducer as one row per
    input task.
    """
    rank = F.row_number().over(
        Window.partitionBy(*key).orderBy(*[F.col(name).asc_nulls_last() for name in order])
    )
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def silver(bronze: DataFrame, spec: DatasetSpec) -> DataFrame:
    conformed = conform(clean(bronze, spec), spec)
    return keep_first(conformed, spec.key, spec.tie_break)
