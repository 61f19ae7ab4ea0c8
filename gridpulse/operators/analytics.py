"""Reports over Gold.

Null ordering is spelled out: a descending sort puts nulls first and an
ascending one puts them last, except where the report says otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.columns import weighted_mean

# Rows in the two top-k reports.
TOP_PEAKS = 20
RECENT_ROWS = 100


def top_peak_days(daily: DataFrame, count: int = TOP_PEAKS) -> DataFrame:
    """O2: region-days with the highest peak demand."""
    return (
        daily.select("date", "respondent", "respondent_name", "peak_demand_mwh")
        .orderBy(F.desc_nulls_first("peak_demand_mwh"), "date", "respondent")
        .limit(count)
    )


def forecast_accuracy(performance: DataFrame) -> DataFrame:
    """Observation-weighted MAPE per region, best first."""
    return (
        performance.filter(F.col("mape_pct").isNotNull())
        .groupBy("respondent")
        .agg(
            weighted_mean(F.col("mape_pct"), F.col("observation_count")).alias(
                "avg_mape_pct"
            ),
            F.sum("observation_count").alias("observations"),
        )
        .orderBy(F.asc_nulls_last("avg_mape_pct"), "respondent")
    )


def forecast_bias(performance: DataFrame) -> DataFrame:
    """Mean bias per region; positive means demand beat the forecast."""
    return (
        performance.groupBy("respondent")
        .agg(F.avg("forecast_bias_mwh").alias("avg_bias_mwh"))
        .orderBy(F.desc_nulls_first("avg_bias_mwh"), "respondent")
    )


def recent_balance(balance: DataFrame, count: int = RECENT_ROWS) -> DataFrame:
    """O3: the newest balance rows."""
    return (
        balance.select(
            "period",
            "respondent",
            "demand_mwh",
            "net_generation_mwh",
            "generation_minus_demand_mwh",
        )
        .orderBy(F.desc_nulls_first("period"), "respondent")
        .limit(count)
    )


def summary_by_demand(summary: DataFrame) -> DataFrame:
    """Regions by their latest demand, unknown ones last."""
    return summary.orderBy(F.desc_nulls_last("latest_demand_mwh"), "respondent")
