"""JSON export of the tables for dashboards."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.functions.columns import DATE_FORMAT, TIMESTAMP_FORMAT
from gridpulse.operators.normalize import null_non_finite, order_by_key
from gridpulse.operators.windows import as_timestamp
from gridpulse.schemas import Table
from gridpulse.sources.store import TableStore, observed

# Days of history in an export, and its source label.
EXPORT_DAYS = 90
EXPORT_SOURCE = "gold_export"


@dataclass(frozen=True)
class Dataset:
    """One exported dataset; ``window`` is the column that limits its history."""

    table: Table
    columns: tuple[str, ...]
    window: str | None


# Exported datasets and their columns.
DATASETS = {
    "regional_summary": Dataset(
        schemas.GOLD_REGIONAL_SUMMARY,
        tuple(schemas.GOLD_REGIONAL_SUMMARY.columns),
        None,
    ),
    "demand_daily": Dataset(
        schemas.GOLD_DEMAND_DAILY, tuple(schemas.GOLD_DEMAND_DAILY.columns), "date"
    ),
    "demand_hourly": Dataset(
        schemas.SILVER_DEMAND,
        ("period", "respondent", "demand_mwh", "forecast_demand_mwh"),
        "period",
    ),
    "forecast_performance": Dataset(
        schemas.GOLD_FORECAST_PERFORMANCE,
        tuple(schemas.GOLD_FORECAST_PERFORMANCE.columns),
        "date",
    ),
    "grid_balance": Dataset(
        schemas.GOLD_GRID_BALANCE,
        (
            "period",
            "respondent",
            "demand_mwh",
            "net_generation_mwh",
            "total_interchange_mwh",
            "generation_minus_demand_mwh",
        ),
        "period",
    ),
}


def to_records(df: DataFrame) -> DataFrame:
    """Timestamps and dates as text, non-finite numbers as null."""
    text = {}
    for name, kind in df.dtypes:
        if kind in ("timestamp", "timestamp_ntz"):
            text[name] = F.date_format(name, TIMESTAMP_FORMAT)
        elif kind == "date":
            text[name] = F.date_format(name, DATE_FORMAT)
    return null_non_finite(df).withColumns(text)


def export_rows(
    df: DataFrame, dataset: Dataset, now: datetime, days: int = EXPORT_DAYS
) -> DataFrame:
    """The dataset's columns for the last ``days`` days."""
    cutoff = now - timedelta(days=days)
    if dataset.window == "date":
        df = df.filter(F.col("date") >= F.lit(cutoff.date()))
    elif dataset.window == "period":
        first = as_timestamp(cutoff.replace(microsecond=0))
        if "period_date" in df.columns:
            df = df.filter(F.col("period_date") >= F.to_date(first))
        df = df.filter(F.col("period") >= first)
    return to_records(df.select(*dataset.columns))


def export_meta(
    rows: DataFrame, name: str, now: datetime, days: int = EXPORT_DAYS
) -> DataFrame:
    """One row describing an exported dataset."""
    dataset = DATASETS[name]
    return rows.agg(F.count(F.lit(1)).alias("row_count")).select(
        *_meta_columns(name, dataset, now, days), "row_count"
    )


def _meta_columns(name: str, dataset: Dataset, now: datetime, days: int) -> list:
    window_days = F.lit(days if dataset.window else None).cast("int")
    return [
        F.lit(name).alias("dataset"),
        F.lit(EXPORT_SOURCE).alias("source"),
        F.lit(dataset.table.name).alias("table"),
        F.lit(now.strftime("%Y-%m-%dT%H:%M:%SZ")).alias("generated_at"),
        window_days.alias("window_days"),
    ]


def export(
    store: TableStore,
    out_dir: str,
    days: int = EXPORT_DAYS,
    now: datetime | None = None,
) -> dict[str, int]:
    """JSON lines per dataset under ``out_dir/<dataset>/rows``, and
    its description under ``out_dir/<dataset>/meta``.

    The rows are counted while they are written, in the order of their key (O1).
    Missing values are written as null and not left out.
    """
    now = now or datetime.now(timezone.utc)
    now = now.astimezone(timezone.utc) if now.tzinfo else now.replace(tzinfo=timezone.utc)
    counts = {}
    for name, dataset in DATASETS.items():
        rows = export_rows(store.scan(dataset.table), dataset, now, days)
        observation = Observation()
        key = [name for name in dataset.table.key if name in dataset.columns]
        # Counted behind the sort, which reads its input twice.
        counted = order_by_key(rows, key).observe(
            observation, F.count(F.lit(1)).alias("row_count")
        )
        _write_json(counted, f"{out_dir}/{name}/rows")
        counts[name] = observed(observation).get("row_count", 0)
        meta = store.spark.range(1).select(
            *_meta_columns(name, dataset, now, days),
            F.lit(counts[name]).alias("row_count"),
        )
        _write_json(meta, f"{out_dir}/{name}/meta")
    return counts


def _write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)
