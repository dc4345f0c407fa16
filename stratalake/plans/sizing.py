"""Shuffle sizing for tables of very different sizes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.sql.shuffle.partitions"
# Silver moves about a quarter of the bronze columns, so two GiB of bronze files
# are about half a GiB per reducer. Fewer, larger reducers also keep the blocks
# each one fetches from every map task from becoming tiny: 100 TB needs 50,000.
BYTES_PER_REDUCER = 2 << 30


# How Spark writes sizes in a plan.
_UNITS = ("B", "KiB", "MiB", "GiB", "TiB", "PiB", "EiB")
_SIZE = re.compile(rf"sizeInBytes=([0-9.E+]+) ({'|'.join(_UNITS)})")


def table_bytes(table: DataFrame) -> int:
    """Size of a table's files as its plan has it, to three digits; starts no job.

    Read from the plan's text, which every kind of session gives. 0 where it has none.
    """
    (plan,) = table.sparkSession.sql("EXPLAIN COST SELECT * FROM {t}", t=table).first()
    hit = _SIZE.search(plan)
    return round(float(hit[1]) * 1024 ** _UNITS.index(hit[2])) if hit else 0


def reducers_for(size: int, current: int, per_reducer: int = BYTES_PER_REDUCER) -> int:
    return max(current, -(-size // per_reducer))


@contextmanager
def shuffle_sized_for(
    spark: SparkSession, size: int, per_reducer: int = BYTES_PER_REDUCER
) -> Iterator[int]:
    """Raises the shuffle partition count for ``size`` input bytes, then restores it.

    Adaptive execution merges partitions that turn out small but cannot split
    the sorted input of a window, so the count has to be high enough up front.
    A setting that is not a number means the platform sizes shuffles itself.
    """
    before = spark.conf.get(SETTING)
    if not before.isdigit():
        yield 0
        return
    wanted = reducers_for(size, int(before), per_reducer)
    spark.conf.set(SETTING, wanted)
    try:
        yield wanted
    finally:
        spark.conf.set(SETTING, before)
