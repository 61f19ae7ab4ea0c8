import json
from datetime import datetime
from pathlib import Path

from frames import readings, table
from pyspark.sql import functions as F

from gridpulse.plans.pipeline import frame_source, ingest_window
from gridpulse.sources.export import DATASETS, export, to_records
from gridpulse.sources.store import TableStore


def lines(folder):
    files = sorted(Path(folder).glob("part-*.json"))
    return [json.loads(line) for f in files for line in f.read_text().splitlines()]


def test_export_writes_rows_and_meta(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    raw = readings(
        spark,
        ("2024-01-01T00", "AVL", "D", 5),
        ("2024-03-01T00", "AVL", "D", 7),
        ("2024-03-01T01", "AVL", "DF", 8),
    )
    ingest_window(store, frame_source(raw))
    out = tmp_path / "out"
    counts = export(store, str(out), days=31, now=datetime(2024, 4, 1))
    assert counts == {
        "regional_summary": 1,
        "demand_daily": 1,
        "demand_hourly": 2,
        "forecast_performance": 1,
        "grid_balance": 2,
    }
    for name, dataset in DATASETS.items():
        rows = lines(out / name / "rows")
        assert len(rows) == counts[name]
        assert all(list(row) == list(dataset.columns) for row in rows)
        (meta,) = lines(out / name / "meta")
        assert meta == {
            "dataset": name,
            "source": "gold_export",
            "table": dataset.table.name,
            "generated_at": "2024-04-01T00:00:00Z",
            "window_days": 31 if dataset.window else None,
            "row_count": counts[name],
        }
    hourly = lines(out / "demand_hourly" / "rows")
    assert {"period": "2024-03-01T01:00:00Z", "respondent": "AVL", "demand_mwh": None,
            "forecast_demand_mwh": 8.0} in hourly
    assert export(store, str(out), days=1, now=datetime(2024, 5, 1))["demand_daily"] == 0


def test_records_are_text_and_finite(spark):
    frame = spark.range(1).select(
        F.lit("2024-01-02 03:04:05").cast("timestamp").alias("at"),
        F.lit("2024-01-02").cast("date").alias("on"),
        F.lit(float("nan")).alias("a"),
        F.lit(float("-inf")).alias("b"),
        F.lit(1.5).alias("c"),
    )
    assert table(to_records(frame)) == [
        ("2024-01-02T03:04:05Z", "2024-01-02", None, None, 1.5)
    ]
