import logging
import shutil
from datetime import datetime, timezone

import pytest
from frames import demand, performance, readings, table
from pyspark.sql import functions as F

from gridpulse import DataQualityError, schemas
from gridpulse.operators.normalize import normalize_silver
from gridpulse.plans.pipeline import (
    complete_first_day,
    frame_source,
    ingest_window,
    recent_performance,
    run_backfill,
    run_pipeline,
)
from gridpulse.sources.store import TableStore

CODES = (("D", 1.0), ("DF", 0.9), ("NG", 1.5), ("TI", -0.1))


def month(spark, days=(1, 2, 3), regions=("AVL", "BRN"), scale=1.0):
    """Four metrics for every hour of the days and every region."""
    return readings(
        spark,
        *[
            (f"2024-01-{d:02d}T{h:02d}", r, code, (100 * d + h) * factor * scale)
            for d in days
            for h in range(24)
            for r in regions
            for code, factor in CODES
        ],
    )


def rounded(rows):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows]


def contents(store):
    """Every table; sums of doubles may differ in their last bits."""
    return {
        name: rounded(table(store.read(spec))) for name, spec in schemas.TABLES.items()
    }


@pytest.fixture
def store(spark, tmp_path):
    return TableStore(spark, str(tmp_path / "db"))


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three whole days ingested once: the store, its counts and contents."""
    store = TableStore(spark, str(tmp_path_factory.mktemp("loaded") / "db"))
    counts = ingest_window(store, frame_source(month(spark)))
    return store, counts, contents(store)


@pytest.fixture
def copy(spark, loaded, tmp_path):
    """A copy of the loaded store that a test may change."""
    shutil.copytree(loaded[0].root, tmp_path / "copy")
    return TableStore(spark, str(tmp_path / "copy"))


def test_window_fills_every_table(loaded):
    _, counts, tables = loaded
    assert counts == {
        "rows_extracted": 576,
        "demand_rows": 144,
        "generation_rows": 144,
        "interchange_rows": 144,
        "gold_demand_daily_rows": 6,
        "gold_forecast_performance_rows": 6,
        "gold_grid_balance_rows": 144,
        "gold_regional_summary_rows": 2,
    }
    assert len(tables["bronze_readings"]) == 576
    assert tables["gold_regional_summary"][0][:5] == (
        "AVL", "AVL area", "2024-01-03T23", 323.0, 290.7
    )


def test_replay_changes_nothing_and_leaves_no_files(
    spark, loaded, copy, tmp_path, monkeypatch
):
    monkeypatch.setattr(
        "gridpulse.sources.staging.shared_scratch", lambda spark: str(tmp_path / "scratch")
    )
    (tmp_path / "scratch").mkdir()
    assert ingest_window(copy, frame_source(month(spark))) == loaded[1]
    assert contents(copy) == loaded[2]
    assert list((tmp_path / "scratch").iterdir()) == []


def test_empty_window_writes_nothing(spark, store):
    counts = ingest_window(store, frame_source(month(spark)), "2030-01-01T00")
    assert counts == {
        "rows_extracted": 0,
        "demand_rows": 0,
        "generation_rows": 0,
        "interchange_rows": 0,
    }
    assert not any(contents(store).values())


def test_late_failure_leaves_the_store_as_it_was(spark, store):
    bad = month(spark).union(readings(spark, ("2024-01-01T00", "AVL", "TI", 1)))
    with pytest.raises(DataQualityError, match="silver_interchange.*grain"):
        ingest_window(store, lambda start, end: bad)
    assert not any(contents(store).values())
    with pytest.raises(DataQualityError, match="bronze_readings.*null"):
        ingest_window(store, lambda s, e: readings(spark, ("bad", "AVL", "D", 1)))


def test_incremental_run_needs_bronze(spark, store):
    with pytest.raises(RuntimeError, match="run_backfill"):
        run_pipeline(store, frame_source(month(spark)))


def test_incremental_run_reads_the_trailing_window(loaded, monkeypatch):
    asked = []
    monkeypatch.setattr(
        "gridpulse.plans.pipeline.ingest_window",
        lambda store, source, start, end, densify: asked.append((start, end)),
    )
    now = datetime(2024, 1, 4, 0, 15, tzinfo=timezone.utc)
    run_pipeline(loaded[0], None, now=now)
    later = datetime(2024, 6, 1, tzinfo=timezone.utc)
    run_pipeline(loaded[0], None, max_window_hours=24, now=later)
    assert asked == [("2024-01-01T23", None), ("2024-01-01T23", "2024-01-02T23")]


def test_incremental_run_completes_the_partial_first_day(spark, loaded, copy):
    """A window from mid-day gives the same tables as the whole days."""
    now = datetime(2024, 1, 4, 0, 15, tzinfo=timezone.utc)
    counts = run_pipeline(copy, frame_source(month(spark)), lookback_hours=36, now=now)
    assert counts["rows_extracted"] == 37 * 8
    assert contents(copy) == loaded[2]


def test_revision_and_absent_region(spark, copy):
    """Gold follows a revised half day; a region the window lacks keeps its row."""
    revised = month(spark, regions=("AVL",), scale=2.0)
    ingest_window(copy, frame_source(revised), "2024-01-03T12", "2024-01-03T22")
    (row,) = copy.read(schemas.GOLD_DEMAND_DAILY).filter(
        "date = '2024-01-03' AND respondent = 'AVL'"
    ).collect()
    values = [300.0 + h for h in range(12)] + [2 * (300.0 + h) for h in range(12, 23)]
    assert row.observation_count == 23
    assert row.avg_demand_mwh == pytest.approx(sum(values) / 23)
    assert (row.peak_demand_mwh, row.min_demand_mwh) == (644.0, 300.0)
    summary = copy.read(schemas.GOLD_REGIONAL_SUMMARY)
    assert table(summary, "respondent", "latest_period", "latest_demand_mwh") == [
        ("AVL", "2024-01-03T22", 644.0),
        ("BRN", "2024-01-03T23", 323.0),
    ]


@pytest.mark.parametrize("chunk_days", [30, 2])
def test_backfill_gives_what_windows_in_turn_give(spark, loaded, store, chunk_days):
    """The second window begins mid-day and needs the KPIs of the first."""
    found = run_backfill(
        store, frame_source(month(spark)), "2024-01-01T00", "2024-01-03T23", chunk_days
    )
    assert found == 576
    assert contents(store) == loaded[2]


def test_backfill_of_regions_that_stop_equals_windows_in_turn(spark, store, tmp_path):
    """One job with a grid for each window against one ingest for each."""
    rows = [
        (f"2024-02-{d:02d}T{h:02d}", r, code, (10 * d + h) * factor)
        for d in range(1, 8)
        for h in (0, 1, 2, 13)
        for r, last in (("AVL", 7), ("BRN", 3), ("TEX", 1))
        if d <= last
        for code, factor in CODES
    ]
    source = frame_source(readings(spark, *rows))
    run_backfill(store, source, "2024-02-01T00", "2024-02-07T23", chunk_days=2)
    in_turn = TableStore(spark, str(tmp_path / "turns"))
    starts = ["2024-02-01T00", "2024-02-03T01", "2024-02-05T02", "2024-02-07T03"]
    ends = ["2024-02-03T00", "2024-02-05T01", "2024-02-07T02", "2024-02-07T23"]
    for start, end in zip(starts, ends):
        ingest_window(in_turn, source, start, end)
    assert contents(store) == contents(in_turn)
    summary = table(store.read(schemas.GOLD_REGIONAL_SUMMARY), "respondent", "latest_period")
    assert summary == [("AVL", "2024-02-07T13"), ("BRN", "2024-02-05T01"), ("TEX", "2024-02-03T00")]


def test_backfill_bounds_are_checked(spark, store):
    with pytest.raises(Exception, match="start is after its end"):
        run_backfill(store, frame_source(month(spark)), "2024-02-01T00", "2024-01-01T00")


def test_ragged_batch_follows_the_grid_or_the_reports(spark, store, caplog):
    raw = readings(
        spark,
        ("2024-01-01T00", "AVL", "D", 1),
        ("2024-01-01T00", "AVL", "NG", 1, "Other Name"),
        ("2024-01-01T00", "BRN", "D", 2),
        ("2024-01-01T05", "AVL", "D", 3),
    )
    with caplog.at_level(logging.WARNING):
        ingest_window(store, frame_source(raw))
    assert "AVL area" in caplog.text and "Other Name" in caplog.text
    summary = store.read(schemas.GOLD_REGIONAL_SUMMARY)
    assert table(summary, "respondent", "latest_period", "latest_demand_mwh") == [
        ("AVL", "2024-01-01T05", 3.0),
        ("BRN", "2024-01-01T05", None),
    ]
    sparse = TableStore(spark, store.root + "-sparse")
    ingest_window(sparse, frame_source(raw), densify=False)
    summary = sparse.read(schemas.GOLD_REGIONAL_SUMMARY)
    assert table(summary, "respondent", "latest_period", "latest_demand_mwh") == [
        ("AVL", "2024-01-01T05", 3.0),
        ("BRN", "2024-01-01T00", 2.0),
    ]


def silver(spark, *rows):
    return normalize_silver(demand(spark, *rows), ["period", "respondent"])


def test_head_is_stored_hours_of_the_first_day_before_the_window(spark):
    stored = silver(
        spark,
        ("2023-11-04T22", "AVL", 1.0, None),
        ("2023-11-05T06", "AVL", 61.0, None),
        ("2023-11-05T17", "AVL", 2.0, None),
    )

    def read(start, end):
        return stored.filter((F.col("period") >= start) & (F.col("period") < end))

    window = silver(spark, ("2023-11-05T17", "AVL", 44.0, None))
    got = table(complete_first_day(window, read), "period", "demand_mwh")
    assert got == [("2023-11-05T06", 61.0), ("2023-11-05T17", 44.0)]
    midnight = silver(spark, ("2023-11-05T00", "AVL", 44.0, None))
    assert table(complete_first_day(midnight, read), "demand_mwh") == [(44.0,)]
    assert complete_first_day(midnight.limit(0), read).count() == 0


def test_recent_performance_prefers_fresh_rows(spark):
    def dated(*rows):
        return performance(spark, *rows).withColumn("date", F.col("date").cast("date"))

    stored = dated(
        ("2023-06-10", "AVL", 1.0, 0.0, 24),
        ("2023-06-11", "AVL", 2.0, 0.0, 24),
        ("2023-06-17", "AVL", 3.0, 0.0, 5),
    )
    fresh = dated(("2023-06-17", "AVL", 4.0, 0.0, 6), ("2023-06-08", "BRN", 9.0, 0.0, 1))
    got = recent_performance(fresh, lambda start: stored.filter(F.col("date") >= start))
    assert table(got, "respondent", "mape_pct") == [("AVL", 2.0), ("AVL", 4.0)]
