"""Runs over stored tables."""

from __future__ import annotations

import logging
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse import schemas
from gridpulse.errors import DataQualityError
from gridpulse.operators.dedupe import overlay
from gridpulse.operators.gold import (
    RECENT_DAYS,
    balance_of,
    conflicts_of,
    recent_forecast_kpis,
    summary_of,
    transform_demand_daily,
    transform_forecast_performance,
)
from gridpulse.operators.names import (
    decode_names,
    encode_names,
    require_distinct_codes,
)
from gridpulse.operators.normalize import normalize_readings
from gridpulse.operators.quality import (
    RULES,
    check_columns,
    enforce_observed,
    row_metrics,
    warn_name_conflicts,
)
from gridpulse.operators.silver import (
    IN_DEMAND,
    demand_of,
    generation_of,
    interchange_of,
    sides_of_readings,
)
from gridpulse.operators.windows import (
    BACKFILL_CHUNK_DAYS,
    BACKFILL_START,
    LOOKBACK_HOURS,
    MAX_CATCHUP_HOURS,
    as_timestamp,
    backfill_window_of,
    backfill_windows,
    ingestion_window,
    within,
)
from gridpulse.schemas import DAILY_KEY, REGION_KEY, Table
from gridpulse.session import prepare_session
from gridpulse.sources.staging import Staging
from gridpulse.sources.store import (
    RECENT_PERFORMANCE_COLUMNS,
    TableStore,
    Version,
)

logger = logging.getLogger("gridpulse.pipeline")

EMPTY_BRONZE = (
    "Bronze is empty: load history with run_backfill before incremental runs"
)

# A source maps (start, end), either side None, to raw readings in that range.
Source = Callable[[object, object], DataFrame]

# Result name of each written table.
_COUNT_NAMES = {
    schemas.SILVER_DEMAND.name: "demand_rows",
    schemas.SILVER_GENERATION.name: "generation_rows",
    schemas.SILVER_INTERCHANGE.name: "interchange_rows",
    schemas.GOLD_DEMAND_DAILY.name: "gold_demand_daily_rows",
    schemas.GOLD_FORECAST_PERFORMANCE.name: "gold_forecast_performance_rows",
    schemas.GOLD_GRID_BALANCE.name: "gold_grid_balance_rows",
    schemas.GOLD_REGIONAL_SUMMARY.name: "gold_regional_summary_rows",
}

_SILVER_RESULTS = ("demand_rows", "generation_rows", "interchange_rows")


def complete_first_day(
    demand: DataFrame, read: Callable[[object, object], DataFrame]
) -> DataFrame:
    """L3: the window plus the stored head of its first, partly covered day.

    ``read(start, end)`` gives stored demand in [start, end). Every head row is
    earlier than the first window row, so the two cannot share a key and a
    union is enough. The bounds are scalar subqueries: for a window that
    starts at midnight, or is empty, the head range is empty.
    """
    start = demand.agg(F.min("period")).scalar()
    head = read(F.date_trunc("day", start), start)
    return head.select(*demand.columns).unionByName(demand)


def recent_performance(
    fresh: DataFrame,
    read: Callable[[object], DataFrame],
    recent_days: int = RECENT_DAYS,
) -> DataFrame:
    """L4: fresh daily performance over the stored rows of the recent days.

    Equals a read-back after the fresh rows are stored, without depending on
    the order of the writes.
    """
    start = F.date_sub(fresh.agg(F.max("date")).scalar(), recent_days - 1)
    rows = fresh.select(*RECENT_PERFORMANCE_COLUMNS)
    return overlay(read(start), rows, DAILY_KEY).filter(F.col("date") >= start)


def _together(jobs: dict) -> dict:
    """Run independent Spark jobs from as many threads, so that the cluster
    works on the next one while the last tasks of another finish. The first
    failure, in the given order, is raised after all have ended."""
    with ThreadPoolExecutor(max(1, len(jobs))) as pool:
        running = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: job.result() for name, job in running.items()}


def _stage(store: TableStore, table: Table, frame: DataFrame) -> Version:
    """Write and check a table of a run (V7, A9); nobody sees it yet.

    The row checks are observed while it is written, the grain is counted over
    the written keys.
    """
    rules = RULES[table.name]
    check_columns(frame, table.name, table.columns)
    version = store.stage(table, frame, metrics=row_metrics(rules))
    try:
        enforce_observed(version.metrics, rules, version.frame)
    except DataQualityError:
        store.discard(version)
        raise
    return version


def _publish(store: TableStore, versions: list[Version]) -> None:
    """Merge all versions, then make them visible one after the other.

    A failure before the first commit changes nothing. Bronze comes last: it
    holds the checkpoint, so a run that dies between two commits is repeated.
    """
    written = [v for v in versions if v.row_count]
    merged = _together({v.table: partial(store.merge, v) for v in written})
    for table, (number, writes) in merged.items():
        store.commit(table, number, writes)


class _Run:
    """The frames of one run, each computed once."""

    def __init__(self, store: TableStore, staging: Staging, readings: DataFrame, densify: bool, window: Column | None):
        self.store, self.staging = store, staging
        coded, names = encode_names(readings)
        staged = staging.write("names", names)[0]
        self.names = require_distinct_codes(staged)
        kept = iter(range(9))
        keep = lambda df: staging.write(f"pivot-{next(kept)}", df)[0]
        self.sides = staging.write("sides", sides_of_readings(coded, densify, window, keep))[0]

    def stage(self, table: Table, frame: DataFrame) -> Callable[[], Version]:
        return partial(_stage, self.store, table, decode_names(frame, self.names))

    def hourly(self) -> dict[Table, Callable[[], Version]]:
        """The Silver tables and the balance, straight from the sides."""
        return {
            schemas.SILVER_DEMAND: self.stage(schemas.SILVER_DEMAND, demand_of(self.sides)),
            schemas.SILVER_GENERATION: self.stage(schemas.SILVER_GENERATION, generation_of(self.sides)),
            schemas.SILVER_INTERCHANGE: self.stage(schemas.SILVER_INTERCHANGE, interchange_of(self.sides)),
            schemas.GOLD_GRID_BALANCE: self.stage(schemas.GOLD_GRID_BALANCE, balance_of(self.sides)),
        }

    def daily(self, by_day: DataFrame) -> dict[Table, Callable[[], Version]]:
        """The daily tables of demand rows, whose names are text."""
        coded, names = encode_names(by_day)
        names = require_distinct_codes(self.staging.write("day-names", names)[0])
        return {
            table: partial(_stage, self.store, table, decode_names(frame, names))
            for table, frame in (
                (schemas.GOLD_DEMAND_DAILY, transform_demand_daily(coded)),
                (schemas.GOLD_FORECAST_PERFORMANCE, transform_forecast_performance(coded)),
            )
        }

    def warn_conflicts(self) -> None:
        conflicts = decode_names(conflicts_of(self.sides), self.names, "demand_name")
        warn_name_conflicts(decode_names(conflicts, self.names, "other_name"))


def ingest_window(
    store: TableStore,
    source: Source,
    start: object = None,
    end: object = None,
    densify: bool = True,
    chunk_days: int | None = None,
) -> dict[str, int]:
    """L1, L2: one window from source to Gold; replaying it changes nothing.

    The raw batch is staged once and aggregated once to hourly rows with all
    metrics, from which every table comes. Daily tables see the first day
    completed from the store; the trailing day stays partial until the next run.
    All outputs are written and checked before the first is made visible.

    ``chunk_days`` treats the range as windows of so many days, as a backfill
    does: each has a grid of its own, and a region's summary is the one of the
    last window it occurs in.
    """
    prepare_session(store.spark)
    versions: dict[Table, Version] = {}
    with Staging(store.spark) as staging:
        null_key = F.col("period").isNull() | F.col("respondent").isNull()
        readings, found = staging.write(
            "readings",
            normalize_readings(source(start, end)),
            F.count_if(null_key).alias("null_keys"),
        )
        if not found["row_count"]:
            logger.info("No readings between %s and %s", start, end)
            return {"rows_extracted": 0, **dict.fromkeys(_SILVER_RESULTS, 0)}
        if found["null_keys"]:
            raise DataQualityError(
                f"{schemas.BRONZE_READINGS.name}: null key part in {found['null_keys']} row(s)"
            )
        window = None
        if chunk_days:
            window = backfill_window_of(F.col("period"), as_timestamp(start), chunk_days)
        try:
            run = _Run(store, staging, readings, densify, window)
            versions |= _together({**run.hourly(), "conflicts": run.warn_conflicts})
            versions.pop("conflicts")
            demand = versions[schemas.SILVER_DEMAND].frame.select(*schemas.SILVER_DEMAND.columns)
            by_day = complete_first_day(demand, partial(store.read_periods, schemas.SILVER_DEMAND))
            versions |= _together(run.daily(by_day))
            fresh = versions[schemas.GOLD_FORECAST_PERFORMANCE].frame
            if window is None:
                history = recent_performance(fresh, store.read_recent_performance)
                newest = None
            else:
                history, newest = _chunked_history(store, run.sides, fresh, window)
            summary = run.stage(schemas.GOLD_REGIONAL_SUMMARY, summary_of(run.sides, history, newest=newest))
            versions[schemas.GOLD_REGIONAL_SUMMARY] = summary()
            order = ["ordinal"] if "ordinal" in readings.columns else []
            bronze = store.stage(schemas.BRONZE_READINGS, _bronze_rows(readings), *order)
            _publish(store, [*versions.values(), bronze])
        except Exception:
            for version in versions.values():
                if isinstance(version, Version):
                    store.discard(version)
            raise
        return {
            "rows_extracted": found["row_count"],
            **{_COUNT_NAMES[t.name]: version.row_count for t, version in versions.items()},
        }


def _chunked_history(
    store: TableStore, sides: DataFrame, fresh: DataFrame, window: Column
) -> tuple[DataFrame, DataFrame]:
    """Daily performance, and each region's newest date: that of its last window.

    Both lists are small: a date for each window, a window for each region.
    """
    numbered = sides.withColumn("window", window)
    dates = numbered.filter(IN_DEMAND).groupBy("window").agg(F.max(F.to_date("period")).alias("newest"))
    regions = numbered.groupBy("respondent").agg(F.max("window").alias("window"))
    newest = regions.join(dates, "window").select("respondent", "newest")
    first = F.date_sub(dates.agg(F.min("newest")).scalar(), RECENT_DAYS - 1)
    rows = fresh.select(*RECENT_PERFORMANCE_COLUMNS)
    return overlay(store.read_recent_performance(first), rows, DAILY_KEY), newest


def _bronze_rows(readings: DataFrame) -> DataFrame:
    """Every Bronze column; the descriptive ones are optional at the source."""
    absent = [c for c in schemas.BRONZE_READINGS.columns if c not in readings.columns]
    return readings.withColumns({c: F.lit(None).cast("string") for c in absent})


def ingest_pages(store: TableStore, readings: DataFrame, densify: bool = True) -> int:
    """Any piece of the feed, in any order of arrival; returns the rows taken.

    A piece may hold some metrics of an hour only, so nothing is derived from it
    directly. Bronze takes its readings first, keeping for each key the reading
    with the latest ordinal; then all tables are rebuilt from Bronze for the dates
    it touches, with a grid for each date. The summary never moves back: a region
    keeps its stored hours unless the rebuilt ones are as new. So the stored
    tables do not depend on how the feed was cut, and a replay changes nothing.
    """
    prepare_session(store.spark)
    rows = _bronze_rows(normalize_readings(readings))
    null_keys = F.count_if(F.col("period").isNull() | F.col("respondent").isNull())
    order = ["ordinal"] if "ordinal" in rows.columns else []
    bronze = store.stage(schemas.BRONZE_READINGS, rows, *order, metrics=[null_keys.alias("null_keys")])
    if bronze.metrics.get("null_keys"):
        store.discard(bronze)
        raise DataQualityError(
            f"{schemas.BRONZE_READINGS.name}: null key part in {bronze.metrics['null_keys']} row(s)"
        )
    store.publish(bronze, by_order=True)
    if bronze.row_count:
        rebuild_dates(store, bronze.folders, densify)
    return bronze.row_count


def rebuild_dates(store: TableStore, folders: list[str], densify: bool = True) -> None:
    """Silver and Gold of whole dates from Bronze, and the summary that follows."""
    with Staging(store.spark) as staging:
        readings = store.scan(schemas.BRONZE_READINGS, folders).select(*schemas.BRONZE_READINGS.columns)
        run = _Run(store, staging, readings, densify, F.to_date("period"))
        versions = _together({**run.hourly(), "conflicts": run.warn_conflicts})
        versions.pop("conflicts")
        demand = versions[schemas.SILVER_DEMAND].frame.select(*schemas.SILVER_DEMAND.columns)
        versions |= _together(run.daily(demand))
        fresh = versions[schemas.GOLD_FORECAST_PERFORMANCE].frame
        summary = _advanced_summary(store, run, fresh)
        versions[schemas.GOLD_REGIONAL_SUMMARY] = _stage(store, schemas.GOLD_REGIONAL_SUMMARY, summary)
        _publish(store, list(versions.values()))


def _advanced_summary(store: TableStore, run: _Run, fresh: DataFrame) -> DataFrame:
    """The newer of the stored and the rebuilt hours of every region, with the
    forecast quality of the newest days of all."""
    table = schemas.GOLD_REGIONAL_SUMMARY
    kpis = ["recent_forecast_mape_pct", "recent_forecast_bias_mwh"]
    latest = decode_names(summary_of(run.sides), run.names).drop(*kpis)
    stored = store.read(table).drop(*kpis)
    newer = latest.join(
        stored.select("respondent", F.col("latest_period").alias("stored_period")), list(REGION_KEY), "left"
    ).filter("stored_period is null or latest_period >= stored_period")
    states = overlay(stored, newer.drop("stored_period"), REGION_KEY)
    rows = fresh.select(*RECENT_PERFORMANCE_COLUMNS)
    day = store.newest_day(schemas.GOLD_FORECAST_PERFORMANCE)
    newest = F.greatest(F.lit(day).cast("date"), fresh.agg(F.max("date")).scalar())
    first = F.date_sub(newest, RECENT_DAYS - 1)
    history = overlay(store.read_recent_performance(first), rows, DAILY_KEY)
    recent = recent_forecast_kpis(history.filter(F.col("date") >= first))
    return states.join(recent, list(REGION_KEY), "left").select(*table.columns)


def run_pipeline(
    store: TableStore,
    source: Source,
    lookback_hours: int = LOOKBACK_HOURS,
    max_window_hours: int = MAX_CATCHUP_HOURS,
    now: datetime | None = None,
    densify: bool = True,
) -> dict[str, int]:
    """Incremental run over the trailing window of what is stored."""
    prepare_session(store.spark)
    newest = store.latest_bronze()
    if newest.first()["latest_period"] is None:
        raise RuntimeError(EMPTY_BRONZE)
    now = now or datetime.now(timezone.utc)
    window = ingestion_window(
        newest, now.isoformat(), lookback_hours, max_window_hours
    ).first()
    if window["window_end"]:
        logger.warning(
            "Bronze is more than %d h behind; this run stops at %s",
            max_window_hours,
            window["window_end"],
        )
    return ingest_window(
        store, source, window["window_start"], window["window_end"], densify
    )


def run_backfill(
    store: TableStore,
    source: Source,
    start: str = BACKFILL_START,
    end: str | None = None,
    chunk_days: int = BACKFILL_CHUNK_DAYS,
    densify: bool = True,
) -> int:
    """Historical load of the closed range; returns the readings found.

    One job gives what windows of ``chunk_days``, ingested one after the other,
    leave behind: a grid for each window, and each region's summary as of the last
    window it occurs in.
    """
    spark = prepare_session(store.spark)
    end = end or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H")
    bounds = spark.range(1).select(F.lit(start).alias("start"), F.lit(end).alias("end"))
    backfill_windows(bounds, chunk_days).limit(1).collect()  # refuses a start after the end
    return ingest_window(store, source, start, end, densify, chunk_days)["rows_extracted"]


def frame_source(readings: DataFrame) -> Source:
    """A source over readings that Spark can already scan."""

    def read(start: object, end: object) -> DataFrame:
        return within(normalize_readings(readings), start, end)

    return read
