"""The data model: column contracts, fixed names, run keys and table locations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The column names and the table, rule and file names that existing readers of
# these tables rely on.
TRIP_COLUMNS = T.StructType(
    [
        T.StructField("VendorID", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.LongType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("RatecodeID", T.LongType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("PULocationID", T.IntegerType()),
        T.StructField("DOLocationID", T.IntegerType()),
        T.StructField("payment_type", T.LongType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("Airport_fee", T.DoubleType()),
        T.StructField("cbd_congestion_fee", T.DoubleType()),
    ]
)
AUDIT_COLUMNS = T.StructType(
    [
        T.StructField("ingestion_timestamp", T.TimestampType()),
        T.StructField("source_file_name", T.StringType()),
    ]
)
LOOKUP_COLUMNS = T.StructType(
    [
        T.StructField("LocationID", T.IntegerType()),
        T.StructField("Borough", T.StringType()),
        T.StructField("Zone", T.StringType()),
        T.StructField("service_zone", T.StringType()),
    ]
)
PICKUP_TIME = "tpep_pickup_datetime"
DROPOFF_TIME = "tpep_dropoff_datetime"
PICKUP_LOCATION = "PULocationID"
DROPOFF_LOCATION = "DOLocationID"
LOCATION_RANGE = (1, 266)
ROLES = {PICKUP_LOCATION: "PU", DROPOFF_LOCATION: "DO"}

RULE_DUPLICATES = "dropped_duplicates"
RULE_NULLS = "dropped_nulls"
RULE_LOCATIONS = "dropped_locations"
RULE_STRAY = "dropped_stray_timestamps"
RULE_TIMES = "faulty_timestamps"
RULE_PASSENGERS = "faulty_passenger_count"
RULE_DISTANCE = "faulty_trip_distance"
RULE_PICKUP = "faulty_pickup_locations"
RULE_DROPOFF = "faulty_dropoff_locations"

GOLD_FULL = "full"
GOLD_FARE = "avg_fare_per_mile"
GOLD_ZONE = "total_trips_count_per_zone"
GOLD_ZONE_HOUR = "trips_per_zone_per_hour"
GOLD_MONTH = "trips_per_month"
GOLD_PEAK = "zone_wise_peak_hours"

OUT_BOROUGH = "PUBorough"
OUT_ZONE = "PUZone"
OUT_HOUR = "pickup_hour"
OUT_MONTH = "pickup_month"
OUT_FARE = "avg_fare_per_mile"
OUT_ZONE_TRIPS = "total_trip_count_per_zone"
OUT_HOUR_TRIPS = "trip_per_zone_per_hour"
OUT_MONTH_TRIPS = "trips_per_month"
OUT_RANK = "row_num"

MONTH_KEYS = ("year", "month")
MONTH_FILE_FORMAT = "yellow_tripdata_{year:04d}-{month:02d}.parquet"
MONTH_KEY_PATTERN = r"(\d{4})-(\d{2})"
# End of fixed values.

GOLD_CUBE = "trip_cube"


def struct_of(*parts: T.StructType) -> T.StructType:
    return T.StructType([field for part in parts for field in part.fields])


LANDING_CONTRACT = T.StructType(
    [TRIP_COLUMNS[c] for c in (PICKUP_TIME, DROPOFF_TIME, PICKUP_LOCATION, DROPOFF_LOCATION)]
)
SILVER_CONTRACT = struct_of(TRIP_COLUMNS, AUDIT_COLUMNS)


@dataclass(frozen=True, order=True)
class RunKey:
    """One calendar month, the unit in which facts are loaded and replaced."""

    year: int
    month: int

    def __post_init__(self) -> None:
        if not (1 <= self.year <= 9999 and 1 <= self.month <= 12):
            raise ValueError(f"not a calendar month: year={self.year}, month={self.month}")

    def __str__(self) -> str:
        return f"{self.year:04d}-{self.month:02d}"

    def next(self) -> RunKey:
        return RunKey(self.year + self.month // 12, self.month % 12 + 1)

    @property
    def partition(self) -> str:
        return f"year={self.year:04d}/month={self.month:02d}"


@dataclass(frozen=True)
class Layout:
    """Where each layer lives below one base location (any Spark-readable file system)."""

    base: str
    landing: str = "landing"
    raw: str = "raw"
    silver: str = "silver"
    gold: str = "gold"
    rejected: str = "Rejected"

    @property
    def landing_root(self) -> str:
        return f"{self.base}/{self.landing}"

    def landing_file(self, key: RunKey) -> str:
        return f"{self.landing_root}/{MONTH_FILE_FORMAT.format(year=key.year, month=key.month)}"

    @property
    def raw_facts(self) -> str:
        return f"{self.base}/{self.raw}/facts"

    @property
    def silver_facts(self) -> str:
        return f"{self.base}/{self.silver}/facts_silver"

    @property
    def lookup(self) -> str:
        return f"{self.base}/{self.silver}/zone_lookup"

    def gold_table(self, name: str) -> str:
        return f"{self.base}/{self.gold}/{name}"

    @property
    def quarantine(self) -> str:
        return f"{self.base}/{self.rejected}"

    @property
    def stray_files(self) -> str:
        return f"{self.quarantine}/files_without_month"

    @property
    def ledger(self) -> str:
        return f"{self.base}/_ledger"
