"""One entry per operator of the engine, over whole driver tables.

Names travel as codes from the readings to the result (``encode_names``).
Results leave as sink records: timestamps and dates as text, computed doubles
rounded, so that both engines print them alike.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalog.adapters import (
    PAGE_NUMBER,
    event_readings,
    land_dated_pages,
    land_pages,
    lineitem_readings,
    nation_names,
)
from gridpulse import schemas
from gridpulse.functions.columns import format_period
from gridpulse.operators import analytics, gold, quality, silver, windows
from gridpulse.operators.dedupe import (
    duplicate_keys,
    duplicated_rows,
    keep_last,
    merge_rows,
)
from gridpulse.operators.densify import densify_days
from gridpulse.operators.names import decode_names, encode_names
from gridpulse.operators.normalize import (
    REQUIRED_READING_COLUMNS,
    normalize_readings,
    order_by_key,
)
from gridpulse.plans.pipeline import (
    complete_first_day,
    frame_source,
    recent_performance,
    run_backfill,
    run_pipeline,
)
from gridpulse.sources.export import (
    DATASETS,
    export,
    export_meta,
    export_rows,
    to_records,
)
from gridpulse.sources.pages import page_source, read_pages
from gridpulse.sources.staging import Staging
from gridpulse.sources.store import TableStore
from gridpulse.streaming.ingest import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]

# Parameters of the registered runs.
NOW = datetime(2024, 2, 10)
EXPORT_NOW = datetime(2024, 2, 1)
EXPORT_DAYS = 14
WINDOW_START = "2024-01-10T12"
REVISION_FROM = "2024-01-16T00"
CHUNK_DAYS = 5
HISTORY_CHUNK_DAYS = 15
RAGGED_REGION = "R3"
RAGGED_UNTIL = "2024-01-12T07"
RAGGED_CHUNK_DAYS = 7
ROWS_PER_PAGE = 500
# Landed files hold about 2 MB; a small feed has at least so many files.
PAGES_PER_FILE = 32
LEAST_FILES = 16
ODD_NAME = ' {old} {new} "\\" }{ '


def records(df: DataFrame, digits: int = 6) -> DataFrame:
    """Sink records with doubles rounded as decimals.

    Sums of doubles differ in their last bits from engine to engine. The cast
    drops those bits, so that a half is a half in both before it is rounded.
    """
    exact = f"decimal(38,{digits + 4})"
    rounded = {
        name: F.round(F.col(name).cast(exact), digits).cast("double")
        for name, kind in df.dtypes
        if kind == "double"
    }
    return to_records(df).withColumns(rounded)


class Readings:
    """Normalised readings with coded names, and what is built on them.

    Frames that a query reads more than once are written to a folder of its own,
    which goes when the session ends.
    """

    def __init__(self, raw: DataFrame, names: DataFrame | None = None):
        self.raw, lookup = encode_names(normalize_readings(raw))
        self.names = lookup if names is None else encode_names(names)[1]
        self._sides: dict[bool, DataFrame] = {}
        self._staging: Staging | None = None
        self._kept = count()

    def keep(self, df: DataFrame) -> DataFrame:
        if self._staging is None:
            self._staging = Staging(df.sparkSession)
            self._staging.close_at_exit()
        return self._staging.write(f"kept-{next(self._kept)}", df)[0]

    def text(self, df: DataFrame, column: str = "respondent_name") -> DataFrame:
        return decode_names(df, self.names, column)

    def bronze(self) -> DataFrame:
        if "ordinal" not in self.raw.columns:
            return self.raw
        return keep_last(self.raw, schemas.READING_KEY, "ordinal")

    def feed(self) -> DataFrame:
        """Generation and interchange must not repeat a key, so the last reading
        stands for them; demand keeps its duplicates."""
        return _without_repeats(self.raw) if "ordinal" in self.raw.columns else self.raw

    def sides(self, densify: bool = True) -> DataFrame:
        if densify not in self._sides:
            self._sides[densify] = silver.sides_of_readings(self.feed(), densify, keep=self.keep)
        return self._sides[densify]

    def demand(self, densify: bool = True) -> DataFrame:
        return silver.transform_demand(self.raw, densify, keep=self.keep)

    def generation(self) -> DataFrame:
        return silver.transform_generation(self.bronze())

    def interchange(self) -> DataFrame:
        return silver.transform_interchange(self.bronze())

    def daily(self) -> DataFrame:
        return self._by_day(gold.transform_demand_daily)

    def performance(self) -> DataFrame:
        return self._by_day(gold.transform_forecast_performance)

    def _by_day(self, aggregate: Callable[[DataFrame], DataFrame]) -> DataFrame:
        return densify_days(self.keep(aggregate(self.demand(densify=False))))

    def balance(self, densify: bool = True) -> DataFrame:
        return gold.balance_of(self.sides(densify))

    def summary(self) -> DataFrame:
        sides = self.keep(self.sides(densify=False))
        performance = self.keep(gold.transform_forecast_performance(silver.demand_of(sides)))
        return gold.summary_of_observed(sides, performance, self.keep)


def _without_repeats(rows: DataFrame) -> DataFrame:
    unique = F.col("type").isin(schemas.GENERATION, schemas.INTERCHANGE)
    last = keep_last(rows.filter(unique), schemas.READING_KEY, "ordinal")
    return rows.filter(~unique).unionByName(last)


def _events(build: Callable[[Readings], DataFrame]) -> Query:
    return lambda spark, sf_dir: records(build(Readings(event_readings(spark, sf_dir))))


def _lineitem(build: Callable[[Readings], DataFrame]) -> Query:
    return lambda spark, sf_dir: records(
        build(Readings(lineitem_readings(spark, sf_dir), nation_names(spark, sf_dir))), 4
    )


def _since(df: DataFrame, start: str) -> DataFrame:
    return df.filter(F.col("period") >= windows.as_timestamp(start))


def _before(df: DataFrame, end: str) -> DataFrame:
    return df.filter(F.col("period") < windows.as_timestamp(end))


def _bounds(r: Readings) -> DataFrame:
    return r.raw.agg(F.min("period").alias("start"), F.max("period").alias("end"))


def normalized(r: Readings) -> DataFrame:
    return r.text(r.raw).select(
        "ordinal", "period", "respondent", "respondent_name", "type", "value"
    )


def bronze_upsert(r: Readings) -> DataFrame:
    return r.text(r.bronze()).select(
        "period", "respondent", "respondent_name", "type", "value"
    )


def upsert_merge(r: Readings) -> DataFrame:
    """A first load up to the revision date, then a run that re-reads the
    trailing hours before it and goes on to the end; revised values double."""
    columns = [*schemas.READING_KEY, "respondent_name", "value"]
    revision = windows.as_timestamp(REVISION_FROM)
    bronze = r.bronze().select(*columns)
    reread = F.col("period") >= revision - windows.hours(windows.LOOKBACK_HOURS)
    incoming = bronze.filter(reread).withColumn("value", F.col("value") * 2)
    return r.text(merge_rows(_before(bronze, REVISION_FROM), incoming, schemas.READING_KEY))


def first_day_completion(r: Readings) -> DataFrame:
    demand = r.keep(r.demand())

    def stored(start: object, end: object) -> DataFrame:
        return demand.filter((F.col("period") >= start) & (F.col("period") < end))

    return r.text(complete_first_day(_since(demand, WINDOW_START), stored))


def ingestion_window(r: Readings) -> DataFrame:
    return windows.ingestion_window(windows.latest_period(r.raw), NOW)


def backfill_windows(r: Readings) -> DataFrame:
    return windows.backfill_windows(_bounds(r), CHUNK_DAYS).select(
        "chunk",
        format_period(F.col("start")).alias("start"),
        format_period(F.col("end")).alias("end"),
    )


def backfill_window_counts(r: Readings) -> DataFrame:
    return windows.backfill_window_counts(r.raw, _bounds(r), CHUNK_DAYS).select(
        "chunk",
        format_period(F.col("start")).alias("start"),
        format_period(F.col("end")).alias("end"),
        "readings",
    )


def latest_row_per_region(r: Readings) -> DataFrame:
    return r.text(
        gold.latest_rows(
            r.balance(), "demand_mwh", "net_generation_mwh", "total_interchange_mwh"
        )
    )


def raw_generation_quality(r: Readings) -> DataFrame:
    """Raw generation repeats keys, so its report shows a broken grain."""
    return quality.quality_report(
        silver.transform_generation(r.raw), quality.RULES["silver_generation"]
    )


def _report(build: Callable[[Readings], DataFrame], table: str):
    return lambda r: quality.quality_report(build(r), quality.RULES[table])


def duplicate_grain(r: Readings) -> DataFrame:
    rows = duplicated_rows(silver.transform_generation(r.raw), schemas.HOURLY_KEY)
    return rows.select("period", "respondent", "net_generation_mwh")


def renamed_regions(r: Readings) -> DataFrame:
    """Generation calls its even hours by another name than demand does."""
    demand, generation, interchange = r.demand(densify=False), r.generation(), r.interchange()
    upper = F.when(F.hour("period") % 2 == 0, F.upper("respondent_name"))
    renamed, new_names = encode_names(
        r.text(generation).withColumn(
            "respondent_name", F.coalesce(upper, "respondent_name")
        )
    )
    names = r.names.union(new_names).distinct()
    conflicts = gold.name_conflicts(demand, renamed, interchange)
    conflicts = decode_names(conflicts, names, "demand_name")
    return decode_names(conflicts, names, "other_name")


def conflict_counts(r: Readings) -> DataFrame:
    return quality.conflict_report(renamed_regions(r))


def coverage_check(r: Readings) -> DataFrame:
    """Readings per region-day, of which more than 24 cannot be hourly."""
    per_day = r.raw.groupBy(F.to_date("period").alias("date"), "respondent").agg(
        F.count("value").alias("observation_count")
    )
    return quality.over_full_days(per_day)


def grain_checks(r: Readings) -> DataFrame:
    return duplicate_keys(r.raw, schemas.READING_KEY)


def export_demand_daily(r: Readings) -> DataFrame:
    return export_rows(
        r.text(r.daily()), DATASETS["demand_daily"], EXPORT_NOW, EXPORT_DAYS
    )


class Stored:
    """A new store in the shared folder, and the readings that go into it."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.scratch = Staging(spark)
        self.scratch.close_at_exit()
        self.store = TableStore(spark, f"{self.scratch.root}/tables")
        self.events = event_readings(spark, sf_dir)
        self.rows = _without_repeats(normalize_readings(self.events))
        bounds = self.rows.agg(
            format_period(F.min("period")).alias("start"), format_period(F.max("period")).alias("end")
        ).first()
        self.start, self.end = bounds["start"], bounds["end"]

    def backfill(self, chunk_days: int, rows: DataFrame | None = None, end: str | None = None) -> None:
        source = frame_source(self.rows if rows is None else rows)
        run_backfill(self.store, source, self.start, end or self.end, chunk_days)

    def land(self) -> tuple[str, int]:
        """The events as pages: their folder, and how many files there are.

        A file has several pages, because listing and opening files costs the driver
        time for each of them.
        """
        folder = f"{self.scratch.root}/pages"
        pages = self.events.agg(F.max("ordinal").alias("last")).first()["last"] // ROWS_PER_PAGE + 1
        together = max(1, min(PAGES_PER_FILE, pages // LEAST_FILES))
        land_pages(self.events, folder, ROWS_PER_PAGE, together)
        return folder, -(-pages // together)


def _stored(build: Callable[[Stored], DataFrame]) -> Query:
    """What a store gives back after runs over it."""
    return lambda spark, sf_dir: records(build(Stored(spark, sf_dir)))


def stored_forecast_performance(s: Stored) -> DataFrame:
    """The whole history, the second window beginning mid-day."""
    s.backfill(HISTORY_CHUNK_DAYS)
    return s.store.read(schemas.GOLD_FORECAST_PERFORMANCE)


def stored_regional_summary(s: Stored) -> DataFrame:
    """History up to the revision date, then one run to the present."""
    s.backfill(HISTORY_CHUNK_DAYS, end=REVISION_FROM)
    run_pipeline(s.store, frame_source(s.rows), max_window_hours=31 * 24, now=NOW)
    return s.store.read(schemas.GOLD_REGIONAL_SUMMARY)


def stored_ragged_backfill(s: Stored) -> DataFrame:
    """A region that stops early is on no later window's grid."""
    stops = (F.col("respondent") != RAGGED_REGION) | (
        F.col("period") < windows.as_timestamp(RAGGED_UNTIL)
    )
    s.backfill(RAGGED_CHUNK_DAYS, s.rows.filter(stops))
    return s.store.read(schemas.SILVER_DEMAND)


def refused_run(s: Stored) -> DataFrame:
    """An incremental run before any backfill is refused and stores nothing of what
    the source offers."""
    refused = False
    try:
        run_pipeline(s.store, frame_source(s.rows), now=NOW)
    except RuntimeError:
        refused = True
    offered = s.rows.agg(F.count(F.lit(1)).alias("offered"))
    stored = [
        s.store.read(table).agg(F.count(F.lit(1)).alias("stored")).withColumn("table_name", F.lit(name))
        for name, table in schemas.TABLES.items()
    ]
    return reduce(DataFrame.unionByName, stored).select(
        "table_name", "stored", F.lit(refused).alias("refused"), offered.scalar().alias("offered")
    )


def silver_range_read(s: Stored) -> DataFrame:
    s.backfill(HISTORY_CHUNK_DAYS)
    return s.store.read_periods(schemas.SILVER_DEMAND, WINDOW_START, REVISION_FROM)


def recent_performance_read(s: Stored) -> DataFrame:
    """The stored performance is the one before the window; the window's own
    days are fresh and replace it."""
    s.backfill(HISTORY_CHUNK_DAYS)
    performance = s.store.read(schemas.GOLD_FORECAST_PERFORMANCE)
    fresh = performance.filter(F.col("date") >= F.lit(WINDOW_START[:10]).cast("date"))
    return recent_performance(fresh, s.store.read_recent_performance)


def checkpoint(s: Stored) -> DataFrame:
    s.store.upsert(schemas.BRONZE_READINGS, _full_rows(normalize_readings(s.events)), "ordinal")
    return s.store.latest_bronze()


def _full_rows(rows: DataFrame) -> DataFrame:
    return rows.withColumns({name: F.lit(None).cast("string") for name in ("type_name", "value_units")})


def landed_pages(s: Stored) -> DataFrame:
    """Pages of two folders, reduced to the last reading per key in page order."""
    folder, _ = s.land()
    rows = normalize_readings(read_pages(s.store.spark, folder, PAGE_NUMBER))
    return keep_last(rows, schemas.READING_KEY, "ordinal").select(
        "period", "respondent", "respondent_name", "type", "value"
    )


def pruned_window_read(s: Stored) -> DataFrame:
    """A window of pages in folders by date, of which the others are not opened.

    Names hold braces, quotes and backslashes, and a file holds several pages.
    """
    folder = f"{s.scratch.root}/dated"
    odd = F.concat(F.col("respondent-name"), F.lit(ODD_NAME))
    land_dated_pages(s.events.withColumn("respondent-name", odd), folder, ROWS_PER_PAGE)
    rows = page_source(s.store.spark, folder, PAGE_NUMBER)(WINDOW_START, REVISION_FROM)
    return keep_last(rows, schemas.READING_KEY, "ordinal").select(
        "period", "respondent", "respondent_name", "type", "value"
    )


def streamed_summary(s: Stored) -> DataFrame:
    """The feed in about four pieces, cut anywhere in its hours."""
    folder, files = s.land()
    query = ingest_stream(s.store, folder, max_files=-(-files // 4), number=PAGE_NUMBER)
    query.awaitTermination()
    return s.store.read(schemas.GOLD_REGIONAL_SUMMARY)


def _exported(name: str) -> Callable[[Stored], DataFrame]:
    """A dataset as exported and read back, in whole files of JSON lines."""

    def query(s: Stored) -> DataFrame:
        s.backfill(HISTORY_CHUNK_DAYS)
        folder = f"{s.scratch.root}/export"
        export(s.store, folder, EXPORT_DAYS, EXPORT_NOW)
        dataset, timed = DATASETS[name], (T.DateType, T.TimestampType)
        kinds = [dataset.table.schema[c] for c in dataset.columns]
        text = T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, timed) else f.dataType) for f in kinds])
        return s.store.spark.read.schema(text).json(f"{folder}/{name}/rows")

    return query


def contract_breaks(r: Readings) -> DataFrame:
    """Raw readings held against the Bronze contract, and without their type."""
    names = schemas.BRONZE_READINGS.columns
    whole = quality.contract_report(r.raw, "readings", names)
    untyped = r.raw.drop("type").filter("value is not null")
    return whole.unionByName(
        quality.contract_report(untyped, "untyped_readings", REQUIRED_READING_COLUMNS)
    )


def unnamed_demand(r: Readings) -> DataFrame:
    """Readings without a name column get a null name throughout."""
    unnamed = normalize_readings(r.raw.drop("respondent_name"))
    return silver.transform_demand(
        unnamed.withColumn("respondent_name", F.col("respondent_name").cast("long")), keep=r.keep
    ).withColumn("respondent_name", F.col("respondent_name").cast("string"))


def empty_input(r: Readings) -> DataFrame:
    """Rows of every table built from readings of which none qualifies."""
    none = Readings(r.raw.filter("value > 1e300").withColumn("respondent_name", F.lit(None).cast("string")))
    tables = {
        "silver_demand": none.demand(),
        "silver_generation": none.generation(),
        "silver_interchange": none.interchange(),
        "gold_demand_daily": none.daily(),
        "gold_forecast_performance_daily": none.performance(),
        "gold_grid_balance_hourly": none.balance(),
        "gold_regional_summary": none.summary(),
    }
    counts = [
        frame.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, frame in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def demand_in_order(r: Readings) -> DataFrame:
    return order_by_key(r.text(r.demand()), schemas.HOURLY_KEY)


def _meta(name: str, build: Callable[[Readings], DataFrame]):
    def query(r: Readings) -> DataFrame:
        rows = export_rows(build(r), DATASETS[name], EXPORT_NOW, EXPORT_DAYS)
        return export_meta(rows, name, EXPORT_NOW, EXPORT_DAYS)

    return query


def export_metadata(r: Readings) -> DataFrame:
    parts = [
        _meta("regional_summary", Readings.summary)(r),
        _meta("demand_daily", Readings.daily)(r),
        _meta("demand_hourly", Readings.demand)(r),
        _meta("forecast_performance", Readings.performance)(r),
        _meta("grid_balance", Readings.balance)(r),
    ]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def queries() -> dict[str, Query]:
    return {
        "normalize_readings": _events(normalized),
        "bronze_upsert": _events(bronze_upsert),
        "upsert_merge": _events(upsert_merge),
        "silver_demand": _events(lambda r: r.text(r.demand())),
        "silver_demand_sparse": _events(lambda r: r.text(r.demand(densify=False))),
        "silver_generation": _events(lambda r: r.text(r.generation())),
        "silver_interchange": _events(lambda r: r.text(r.interchange())),
        "silver_range_read": _stored(silver_range_read),
        "gold_demand_daily": _events(lambda r: r.text(r.daily())),
        "gold_forecast_performance": _events(lambda r: r.text(r.performance())),
        "gold_grid_balance": _events(lambda r: r.text(r.balance())),
        "gold_regional_summary": _events(lambda r: r.text(r.summary())),
        "recent_forecast_kpis": _events(
            lambda r: gold.recent_forecast_kpis(r.keep(r.performance()))
        ),
        "latest_row_per_region": _events(latest_row_per_region),
        "checkpoint": _stored(checkpoint),
        "ingestion_window": _events(ingestion_window),
        "backfill_windows": _events(backfill_windows),
        "backfill_window_counts": _events(backfill_window_counts),
        "first_day_completion": _events(first_day_completion),
        "recent_performance_read": _stored(recent_performance_read),
        "stored_forecast_performance": _stored(stored_forecast_performance),
        "stored_regional_summary": _stored(stored_regional_summary),
        "stored_ragged_backfill": _stored(stored_ragged_backfill),
        "refused_run": _stored(refused_run),
        "landed_pages": _stored(landed_pages),
        "pruned_window_read": _stored(pruned_window_read),
        "streamed_summary": _stored(streamed_summary),
        "export_json": _stored(_exported("demand_daily")),
        **{f"export_json_{name}": _stored(_exported(name)) for name in DATASETS if name != "demand_daily"},
        "contract_breaks": _events(contract_breaks),
        "unnamed_demand": _events(unnamed_demand),
        "empty_input": _events(empty_input),
        "demand_in_order": _events(demand_in_order),
        "dq_demand": _events(_report(Readings.demand, "silver_demand")),
        "dq_generation": _events(raw_generation_quality),
        "dq_gold_daily": _events(_report(Readings.daily, "gold_demand_daily")),
        "dq_gold_performance": _events(
            _report(Readings.performance, "gold_forecast_performance_daily")
        ),
        "dq_gold_balance": _events(
            _report(Readings.balance, "gold_grid_balance_hourly")
        ),
        "dq_gold_summary": _events(_report(Readings.summary, "gold_regional_summary")),
        "dq_duplicate_grain": _events(duplicate_grain),
        "name_conflicts": _events(renamed_regions),
        "name_conflict_counts": _events(conflict_counts),
        "top_peak_days": _events(lambda r: analytics.top_peak_days(r.text(r.daily()))),
        "forecast_accuracy": _events(
            lambda r: analytics.forecast_accuracy(r.performance())
        ),
        "forecast_bias": _events(lambda r: analytics.forecast_bias(r.performance())),
        "recent_balance": _events(lambda r: analytics.recent_balance(r.balance())),
        "summary_by_demand": _events(
            lambda r: analytics.summary_by_demand(r.text(r.summary()))
        ),
        "grain_checks": _events(grain_checks),
        "coverage_check": _events(coverage_check),
        "export_demand_daily": _events(export_demand_daily),
        "export_meta": _events(export_metadata),
        "lineitem_demand_daily": _lineitem(lambda r: r.text(r.daily())),
        "lineitem_forecast_performance": _lineitem(lambda r: r.text(r.performance())),
        "lineitem_grid_balance": _lineitem(
            lambda r: r.text(r.balance(densify=False))
        ),
        "lineitem_regional_summary": _lineitem(lambda r: r.text(r.summary())),
    }
