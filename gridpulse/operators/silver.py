"""Readings to hourly per-metric tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.columns import difference, first_non_null, positive_base_pct
from gridpulse.operators.densify import densify_hours
from gridpulse.operators.normalize import normalize_readings, select_metric
from gridpulse.schemas import (
    DEMAND,
    FORECAST,
    GENERATION,
    HOURLY_KEY,
    INTERCHANGE,
    SILVER_DEMAND,
    SILVER_GENERATION,
    SILVER_INTERCHANGE,
)
from gridpulse.sources.staging import written

# Writes a frame that is read more than once.
Keep = Callable[[DataFrame], DataFrame]

# Column of hourly sides that tells whether the demand table has the row.
IN_DEMAND = "in_demand"

# The type codes of each hourly table, and their columns.
DOMAINS = {
    "demand": {"demand_mwh": DEMAND, "forecast_demand_mwh": FORECAST},
    "generation": {"net_generation_mwh": GENERATION},
    "interchange": {"total_interchange_mwh": INTERCHANGE},
}


def sides_of_readings(
    readings: DataFrame,
    densify: bool = True,
    window: Column | None = None,
    keep: Keep = written,
    domains: Iterable[str] = tuple(DOMAINS),
) -> DataFrame:
    """Demand, generation and interchange side by side, from one scan.

    One conditional aggregate by hour and region picks the metrics and names of
    ``domains``: the first non-null value in ``ordinal`` order, so repeated demand
    readings collapse silently. Repeated keys without an ``ordinal`` are refused,
    since nothing says which comes first. ``copies`` is the largest number of rows
    a table that must not repeat its key (generation, interchange) has.

    ``densify`` adds every missing pair of observed demand hour and observed
    demand region, by ``window`` if given. The grid comes from the aggregated
    rows, which ``keep`` holds because three branches read them.
    """
    rows = normalize_readings(readings)
    order = F.col("ordinal") if "ordinal" in rows.columns else None
    kind = F.col("type")
    values = {column: code for name in domains for column, code in DOMAINS[name].items()}
    own = {name: kind.isin(*DOMAINS[name].values()) for name in domains}

    def metric(code: str) -> Column:
        picked = first_non_null(F.when(kind == code, F.col("value")), order)
        if order is not None:
            return picked
        problem = F.raise_error(F.lit(f"Repeated {code} readings need an ordinal"))
        return F.when(F.count_if(kind == code) > 1, problem.cast("double")).otherwise(picked)

    single = [f"{name}_rows" for name in domains if name != "demand"]
    sides = (
        rows.filter(kind.isin(*values.values()))
        .groupBy(*HOURLY_KEY)
        .agg(
            *[first_non_null(F.when(rows_of, F.col("respondent_name")), order).alias(f"{name}_name") for name, rows_of in own.items()],
            *[metric(code).alias(column) for column, code in values.items()],
            *[F.count_if(rows_of).alias(f"{name}_rows") for name, rows_of in own.items()],
        )
        .withColumn("copies", F.greatest(F.lit(1).cast("long"), F.lit(1), *single))
    )
    if not densify:
        return sides.withColumn(IN_DEMAND, F.col("demand_rows") > 0)
    sides = keep(sides)
    dense = densify_hours(sides, sides.filter("demand_rows > 0"), IN_DEMAND, window)
    # A null key is on no grid but must reach the key check.
    return dense.withColumns(
        {
            IN_DEMAND: F.col(IN_DEMAND) | F.coalesce(F.col("demand_rows") > 0, F.lit(False)),
            "copies": F.coalesce("copies", F.lit(1)),
        }
    )


def demand_of(sides: DataFrame) -> DataFrame:
    """The hourly demand table of ``sides_of_readings``, with error columns."""
    error = difference("demand_mwh", "forecast_demand_mwh")
    return (
        sides.filter(IN_DEMAND)
        .withColumnRenamed("demand_name", "respondent_name")
        .withColumn("forecast_error_mwh", error)
        .withColumn(
            "forecast_error_pct",
            positive_base_pct(F.col("forecast_error_mwh"), F.col("demand_mwh")),
        )
        .select(*SILVER_DEMAND.columns)
    )


def transform_demand(
    readings: DataFrame, densify: bool = True, window: Column | None = None, keep: Keep = written
) -> DataFrame:
    """Actual and forecast demand side by side.

    ``densify`` adds every missing pair of observed hour and observed region
    as an all-null row. Those rows reach Gold: a region with no reading on a
    day gets a row with ``observation_count = 0``, the newest hour of the batch
    becomes every region's latest hour, and a stored value is overwritten by
    null if the source drops a reading. ``densify=False`` keeps only the pairs
    that were reported.
    """
    return demand_of(sides_of_readings(readings, densify, window, keep, ["demand"]))


def transform_generation(readings: DataFrame) -> DataFrame:
    """Net generation as reported; duplicates are kept for the key check."""
    return select_metric(
        normalize_readings(readings), GENERATION, "net_generation_mwh"
    ).select(*SILVER_GENERATION.columns)


def transform_interchange(readings: DataFrame) -> DataFrame:
    """Total interchange as reported, sign included; duplicates are kept."""
    return select_metric(
        normalize_readings(readings), INTERCHANGE, "total_interchange_mwh"
    ).select(*SILVER_INTERCHANGE.columns)


def generation_of(sides: DataFrame) -> DataFrame:
    """The generation table of ``sides_of_readings``; a repeated key repeats."""
    return _side_table(sides, "generation", "net_generation_mwh", SILVER_GENERATION.columns)


def interchange_of(sides: DataFrame) -> DataFrame:
    """The interchange table of ``sides_of_readings``; a repeated key repeats."""
    return _side_table(sides, "interchange", "total_interchange_mwh", SILVER_INTERCHANGE.columns)


def _side_table(sides: DataFrame, side: str, value: str, columns: list[str]) -> DataFrame:
    rows = sides.filter(F.col(f"{side}_rows") > 0).withColumnRenamed(f"{side}_name", "respondent_name")
    # Copies stand for the repeated rows, so that the key check finds them.
    repeated = F.explode(F.sequence(F.lit(1), F.col(f"{side}_rows").cast("int")))
    return rows.withColumn("copy", repeated).select(*columns)
