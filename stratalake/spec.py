"""What a dataset looks like: columns, types, key, bounds and table names.

Every operator takes a ``DatasetSpec``; the trips dataset is one instance.
"""

from __future__ import annotations

from dataclasses import dataclass

SOURCE_FILE = "source_file"
LOADED_AT = "ingestion_timestamp"
LINEAGE = (SOURCE_FILE, LOADED_AT)


@dataclass(frozen=True)
class DatasetSpec:
    table: str
    """Table name in bronze and silver."""

    landing_file: str
    """Name of one landing entry; ``{period}`` is replaced by the period."""

    periods: tuple[str, ...]
    """Periods ingested when the caller names none."""

    columns: tuple[tuple[str, str], ...]
    """Required columns with their conformed types, in output order."""

    key: tuple[str, ...]
    """Business key, most selective column first.

    Sorts compare the first column before any other, so a leading column with
    few values makes every comparison fall through to the whole row.
    """

    amount: str
    starts: str
    ends: str

    lower: str
    """First event time that is in range."""

    upper: str
    """First event time past the range."""

    ranges: tuple[tuple[str, int, int], ...]
    """Nullable columns with inclusive limits. Audited, never cleaned."""

    counted: str
    """Column averaged by the hour mart; zero and NULL mean "not recorded"."""

    month_column: str
    hour_column: str
    mart_month: str

    fact_table: str
    month_mart: str
    hour_mart: str

    lineage_level: str = "file"
    """``file``: a landing entry is one file. ``folder``: it is a folder of files."""

    def __post_init__(self) -> None:
        used = {*self.key, self.amount, self.starts, self.ends, self.counted}
        used |= {name for name, _, _ in self.ranges}
        unknown = sorted(used - set(self.required))
        if unknown:
            raise ValueError(f"not among the required columns: {', '.join(unknown)}")
        if self.lineage_level not in ("file", "folder"):
            raise ValueError(f"lineage_level must be file or folder: {self.lineage_level}")

    @property
    def required(self) -> tuple[str, ...]:
        return tuple(name for name, _ in self.columns)

    @property
    def types(self) -> dict[str, str]:
        return dict(self.columns)

    @property
    def tie_break(self) -> tuple[str, ...]:
        """Order in which rows sharing a key compete; the first row is kept."""
        others = tuple(name for name in self.required if name not in self.key)
        return (SOURCE_FILE, *others, LOADED_AT)

    def landing_name(self, period: str) -> str:
        return self.landing_file.format(period=period)


# The public yellow-taxi trip data, January to May 2023.
TRIPS = DatasetSpec(
    table="yellow_tripdata",
    landing_file="yellow_tripdata_{period}.parquet",
    periods=("2023-01", "2023-02", "2023-03", "2023-04", "2023-05"),
    columns=(
        ("VendorID", "int"),
        ("passenger_count", "int"),
        ("total_amount", "double"),
        ("tpep_pickup_datetime", "timestamp_ntz"),
        ("tpep_dropoff_datetime", "timestamp_ntz"),
    ),
    key=("tpep_pickup_datetime", "total_amount", "tpep_dropoff_datetime", "VendorID"),
    amount="total_amount",
    starts="tpep_pickup_datetime",
    ends="tpep_dropoff_datetime",
    lower="2023-01-01",
    upper="2023-06-01",
    ranges=(("passenger_count", 0, 9),),
    counted="passenger_count",
    month_column="pickup_month",
    hour_column="pickup_hour",
    mart_month="2023-05",
    fact_table="fact_trips",
    month_mart="agg_avg_total_amount_by_month",
    hour_mart="agg_avg_passengers_by_hour_may",
)
