"""Hourly tables to analytics."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.columns import (
    absolute_pct,
    calendar_date,
    difference,
    first_non_null,
    parse_date,
    weighted_mean,
)
from gridpulse.operators.normalize import normalize_silver, numeric
from gridpulse.schemas import (
    DAILY_KEY,
    GOLD_DEMAND_DAILY,
    GOLD_FORECAST_PERFORMANCE,
    GOLD_GRID_BALANCE,
    GOLD_REGIONAL_SUMMARY,
    HOURLY_KEY,
    REGION_KEY,
)

# Fixed value: calendar days in the recent forecast KPIs.
RECENT_DAYS = 7

_SIDES = {
    "demand": "demand_mwh",
    "generation": "net_generation_mwh",
    "interchange": "total_interchange_mwh",
}


# Hourly values whose latest ones the summary shows.
_LATEST = (*_SIDES.values(), "forecast_demand_mwh")


def _first_name() -> Column:
    return first_non_null(F.col("respondent_name"), F.col("period"))


def _by_day(demand: DataFrame, *values: str) -> DataFrame:
    rows = numeric(normalize_silver(demand, [*HOURLY_KEY, *values]), *values)
    return rows.select(
        calendar_date(F.col("period")).alias("date"),
        "period",
        "respondent",
        "respondent_name",
        *values,
    )


def transform_demand_daily(demand: DataFrame) -> DataFrame:
    """A3: daily shape of demand. Demand is a rate, so there is no daily sum.

    The deviation is the sample one, null for a single observation; a day with
    no value keeps its row, with count 0 and null metrics.
    """
    value = F.col("demand_mwh")
    return (
        _by_day(demand, "demand_mwh")
        .groupBy(*DAILY_KEY)
        .agg(
            _first_name().alias("respondent_name"),
            F.avg(value).alias("avg_demand_mwh"),
            F.max(value).alias("peak_demand_mwh"),
            F.min(value).alias("min_demand_mwh"),
            F.stddev_samp(value).alias("demand_stddev_mwh"),
            F.count(value).alias("observation_count"),
        )
        .select(*GOLD_DEMAND_DAILY.columns)
    )


def transform_forecast_performance(demand: DataFrame) -> DataFrame:
    """A4: daily forecast accuracy over hours with both values.

    Recomputed from the pair: the percentage here is unsigned and leaves out
    zero demand only, unlike the hourly table's signed percentage.
    """
    error = F.col("error")
    return (
        _by_day(demand, "demand_mwh", "forecast_demand_mwh")
        .withColumn("error", difference("demand_mwh", "forecast_demand_mwh"))
        .groupBy(*DAILY_KEY)
        .agg(
            _first_name().alias("respondent_name"),
            F.avg(F.abs(error)).alias("mae_mwh"),
            F.sqrt(F.avg(error * error)).alias("rmse_mwh"),
            (F.avg(absolute_pct(error, F.col("demand_mwh"))) * 100).alias("mape_pct"),
            F.avg(error).alias("forecast_bias_mwh"),
            F.max(F.abs(error)).alias("max_abs_error_mwh"),
            F.count(error).alias("observation_count"),
        )
        .select(*GOLD_FORECAST_PERFORMANCE.columns)
    )


def _side(df: DataFrame, side: str, extra: tuple[str, ...] = ()) -> DataFrame:
    value = _SIDES[side]
    rows = normalize_silver(df, [*HOURLY_KEY, value])
    return numeric(rows, value, *extra).select(
        *HOURLY_KEY,
        F.col("respondent_name").alias(f"{side}_name"),
        value,
        *extra,
        F.lit(1).alias(f"{side}_rows"),
    )


def hourly_sides(
    demand: DataFrame, generation: DataFrame, interchange: DataFrame
) -> DataFrame:
    """The three domains side by side, one row per hour and region.

    Each domain has at most one row per key, so the full outer join is a union
    and one aggregate: one shuffle where two full joins take four. The forecast
    rides along for the regional summary (J4). ``copies`` is the largest number
    of rows any domain holds for the key; it is 1 unless a domain breaks its
    grain.
    """
    extra = ("forecast_demand_mwh",)
    if extra[0] not in demand.columns:
        demand = demand.withColumn(extra[0], F.lit(None).cast("double"))
    sides = [
        _side(demand, "demand", extra),
        _side(generation, "generation"),
        _side(interchange, "interchange"),
    ]
    union = reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True), sides
    )
    picked = [*(f"{side}_name" for side in _SIDES), *_SIDES.values(), *extra]
    return union.groupBy(*HOURLY_KEY).agg(
        *[F.max(name).alias(name) for name in picked],
        F.greatest(*[F.count(f"{side}_rows") for side in _SIDES]).alias("copies"),
    )


def balance_of(sides: DataFrame) -> DataFrame:
    """The balance of ``hourly_sides``. The demand-side name wins.

    A key that a domain repeats appears as often here, so the grain check
    still fails.
    """
    return (
        sides.withColumn("respondent_name", _side_name())
        .withColumn(
            "generation_minus_demand_mwh",
            difference("net_generation_mwh", "demand_mwh"),
        )
        .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
        .select(*GOLD_GRID_BALANCE.columns)
    )


def transform_grid_balance(
    demand: DataFrame, generation: DataFrame, interchange: DataFrame
) -> DataFrame:
    """Demand, generation and interchange per hour and region.

    Hours reported by some domains only are kept, with nulls and never zeros
    for the others.
    """
    return balance_of(hourly_sides(demand, generation, interchange))


def _side_name() -> Column:
    return F.coalesce(*[F.col(f"{side}_name") for side in _SIDES])


def conflicts_of(sides: DataFrame) -> DataFrame:
    """V6: regions whose name in another domain differs from the demand name.

    One row per distinct (side, region, demand name, other name).
    """
    others = [
        F.struct(F.lit(side).alias("side"), F.col(f"{side}_name").alias("other_name"))
        for side in ("generation", "interchange")
    ]
    return (
        sides.select(
            "respondent", "demand_name", F.explode(F.array(*others)).alias("other")
        )
        .select("other.side", "respondent", "demand_name", "other.other_name")
        .filter("demand_name <> other_name")
        .distinct()
    )


def name_conflicts(
    demand: DataFrame, generation: DataFrame, interchange: DataFrame
) -> DataFrame:
    """V6 of three hourly tables; see ``conflicts_of``."""
    return conflicts_of(hourly_sides(demand, generation, interchange))


def latest_rows(balance: DataFrame, *values: str, also: Iterable[Column] = ()) -> DataFrame:
    """Per region, the row of its newest hour, and ``also`` over all its rows.

    A value that is null at that hour stays null. The picks are separate
    fixed-width columns and not one struct, which keeps the hash aggregate.
    """
    return (
        balance.filter(F.col("respondent").isNotNull())
        .groupBy("respondent")
        .agg(
            F.max("period").alias("latest_period"),
            F.max_by("respondent_name", "period").alias("respondent_name"),
            *[F.max_by(name, "period").alias(f"latest_{name}") for name in values],
            *also,
        )
    )


def recent_forecast_kpis(
    performance: DataFrame,
    recent_days: int = RECENT_DAYS,
    newest: DataFrame | None = None,
) -> DataFrame:
    """A5: observation-weighted MAPE and bias per region, recent days only.

    The window is calendar days back from the newest date of any region. That
    date is a scalar subquery, so it also prunes a table partitioned by date.
    ``newest`` (respondent, newest) gives each region a date of its own instead.
    """
    dated = numeric(
        performance, "mape_pct", "forecast_bias_mwh", "observation_count"
    ).withColumn("date", parse_date(F.col("date"), performance.schema["date"].dataType))
    if newest is None:
        last = dated.agg(F.max("date")).scalar()
    else:
        dated, last = dated.join(newest, "respondent"), F.col("newest")
    weight = F.col("observation_count")
    return (
        dated.filter(F.col("date") >= F.date_sub(last, recent_days - 1))
        .filter(F.col("respondent").isNotNull())
        .groupBy("respondent")
        .agg(
            weighted_mean(F.col("mape_pct"), weight).alias("recent_forecast_mape_pct"),
            weighted_mean(F.col("forecast_bias_mwh"), weight).alias(
                "recent_forecast_bias_mwh"
            ),
        )
    )


def summary_of(
    sides: DataFrame,
    performance: DataFrame | None = None,
    recent_days: int = RECENT_DAYS,
    newest: DataFrame | None = None,
) -> DataFrame:
    """A7 of hourly sides: latest state and recent forecast quality."""
    latest = latest_rows(sides.withColumn("respondent_name", _side_name()), *_LATEST)
    return _with_quality(latest, performance, recent_days, newest)


def summary_of_observed(
    sides: DataFrame, performance: DataFrame | None, keep: Callable[[DataFrame], DataFrame], recent_days: int = RECENT_DAYS
) -> DataFrame:
    """A7 of the sides that were observed, as if their hour grid had been built.

    Of the grid only the newest demand hour matters: it is the latest hour of
    every demand region, whose values are null there unless it reported. So each
    region is reduced to its newest row, which ``keep`` holds, and a region that is
    behind is moved to that hour.
    """
    demand_hour = F.max(F.when(F.col("demand_rows") > 0, F.col("period"))).alias("demand_hour")
    latest = keep(latest_rows(sides.withColumn("respondent_name", _side_name()), *_LATEST, also=[demand_hour]))
    newest = latest.agg(F.max("demand_hour")).scalar()
    behind = F.col("demand_hour").isNotNull() & (F.col("latest_period") < newest)
    # Last comes the hour, which the condition reads.
    picked = ["respondent_name", *(f"latest_{name}" for name in _LATEST)]
    moved = latest.select(
        "respondent",
        *[F.when(~behind, F.col(name)).alias(name) for name in picked],
        F.when(behind, newest).otherwise(F.col("latest_period")).alias("latest_period"),
    )
    return _with_quality(moved, performance, recent_days)


def _with_quality(
    latest: DataFrame, performance: DataFrame | None, recent_days: int, newest: DataFrame | None = None
) -> DataFrame:
    if performance is None:
        summary = latest.withColumns(
            {
                "recent_forecast_mape_pct": F.lit(None).cast("double"),
                "recent_forecast_bias_mwh": F.lit(None).cast("double"),
            }
        )
    else:
        kpis = recent_forecast_kpis(performance, recent_days, newest)
        summary = latest.join(kpis, list(REGION_KEY), "left")
    return summary.select(*GOLD_REGIONAL_SUMMARY.columns)


def transform_regional_summary(
    demand: DataFrame,
    generation: DataFrame,
    interchange: DataFrame,
    performance: DataFrame | None = None,
    recent_days: int = RECENT_DAYS,
) -> DataFrame:
    """One row per region over three hourly tables."""
    sides = hourly_sides(demand, generation, interchange)
    return summary_of(sides, performance, recent_days)
