"""Table contracts: columns in order, key and storage partitioning."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOURLY_KEY = ("period", "respondent")
DAILY_KEY = ("date", "respondent")
REGION_KEY = ("respondent",)
READING_KEY = ("period", "respondent", "type")

# Metric codes of the source feed.
DEMAND = "D"
FORECAST = "DF"
GENERATION = "NG"
INTERCHANGE = "TI"

# The source's hyphenated column names.
SOURCE_RENAMES = {
    "respondent-name": "respondent_name",
    "type-name": "type_name",
    "value-units": "value_units",
}

_TYPES = {
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
}


def _schema(text: str) -> T.StructType:
    pairs = (item.split() for item in text.split(","))
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in pairs])


@dataclass(frozen=True)
class Table:
    """A stored table.

    ``partition_column`` splits the files; ``partition_by`` derives it from the
    key, so a row's partition never changes between writes. ``hidden`` columns
    are stored beside the contract's and not read back with them.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    partition_column: str
    partition_type: T.DataType
    audited: bool = True
    hidden: tuple[tuple[str, T.DataType], ...] = ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    def partition_by(self) -> Column:
        if self.partition_column in self.columns:
            return F.col(self.partition_column)
        if self.partition_column == "period_date":
            return F.to_date("period")
        return F.pmod(F.xxhash64("respondent"), F.lit(SUMMARY_BUCKETS)).cast("int")


# The summary has one row per region and no time column, so it is split by a
# hash of the region; an upsert then rewrites only the buckets it touches. The
# number is fixed, because a region must stay in its bucket.
SUMMARY_BUCKETS = 16

BRONZE_READINGS = Table(
    "bronze_readings",
    _schema(
        "period timestamp, respondent string, respondent_name string, "
        "type string, type_name string, value double, value_units string"
    ),
    READING_KEY,
    "period_date",
    T.DateType(),
    audited=False,
    hidden=(("ordinal", T.DecimalType(38, 0)),),
)

SILVER_DEMAND = Table(
    "silver_demand",
    _schema(
        "period timestamp, respondent string, respondent_name string, "
        "demand_mwh double, forecast_demand_mwh double, "
        "forecast_error_mwh double, forecast_error_pct double"
    ),
    HOURLY_KEY,
    "period_date",
    T.DateType(),
)

SILVER_GENERATION = Table(
    "silver_generation",
    _schema(
        "period timestamp, respondent string, respondent_name string, "
        "net_generation_mwh double"
    ),
    HOURLY_KEY,
    "period_date",
    T.DateType(),
)

SILVER_INTERCHANGE = Table(
    "silver_interchange",
    _schema(
        "period timestamp, respondent string, respondent_name string, "
        "total_interchange_mwh double"
    ),
    HOURLY_KEY,
    "period_date",
    T.DateType(),
)

GOLD_DEMAND_DAILY = Table(
    "gold_demand_daily",
    _schema(
        "date date, respondent string, respondent_name string, "
        "avg_demand_mwh double, peak_demand_mwh double, min_demand_mwh double, "
        "demand_stddev_mwh double, observation_count bigint"
    ),
    DAILY_KEY,
    "date",
    T.DateType(),
)

GOLD_FORECAST_PERFORMANCE = Table(
    "gold_forecast_performance_daily",
    _schema(
        "date date, respondent string, respondent_name string, "
        "mae_mwh double, rmse_mwh double, mape_pct double, "
        "forecast_bias_mwh double, max_abs_error_mwh double, "
        "observation_count bigint"
    ),
    DAILY_KEY,
    "date",
    T.DateType(),
)

GOLD_GRID_BALANCE = Table(
    "gold_grid_balance_hourly",
    _schema(
        "period timestamp, respondent string, respondent_name string, "
        "demand_mwh double, net_generation_mwh double, "
        "total_interchange_mwh double, generation_minus_demand_mwh double"
    ),
    HOURLY_KEY,
    "period_date",
    T.DateType(),
)

GOLD_REGIONAL_SUMMARY = Table(
    "gold_regional_summary",
    _schema(
        "respondent string, respondent_name string, latest_period timestamp, "
        "latest_demand_mwh double, latest_forecast_demand_mwh double, "
        "latest_net_generation_mwh double, latest_total_interchange_mwh double, "
        "recent_forecast_mape_pct double, recent_forecast_bias_mwh double"
    ),
    REGION_KEY,
    "respondent_bucket",
    T.IntegerType(),
)

TABLES = {
    table.name: table
    for table in (
        BRONZE_READINGS,
        SILVER_DEMAND,
        SILVER_GENERATION,
        SILVER_INTERCHANGE,
        GOLD_DEMAND_DAILY,
        GOLD_FORECAST_PERFORMANCE,
        GOLD_GRID_BALANCE,
        GOLD_REGIONAL_SUMMARY,
    )
}
