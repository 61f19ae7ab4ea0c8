"""Time windows that bound what a run reads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.columns import format_period, hours, parse_timestamp

# Trailing re-read, largest window of one run, backfill chunk and
# the start of a backfill that names none.
LOOKBACK_HOURS = 48
MAX_CATCHUP_HOURS = 168
BACKFILL_CHUNK_DAYS = 30
BACKFILL_START = "2019-01-01T00"


def _strict_timestamp(df: DataFrame, name: str) -> Column:
    """Parsed column; text that is no timestamp fails the query."""
    parsed = parse_timestamp(F.col(name), df.schema[name].dataType)
    problem = F.concat(F.lit(f"Could not parse {name}: "), F.col(name).cast("string"))
    return F.when(
        F.col(name).isNotNull() & parsed.isNull(),
        F.raise_error(problem).cast("timestamp"),
    ).otherwise(parsed)


def latest_period(readings: DataFrame) -> DataFrame:
    """Newest period as one row, null when there is none."""
    return readings.agg(F.max("period").alias("latest_period"))


def ingestion_window(
    latest: DataFrame,
    now: datetime | str | Column,
    lookback_hours: int = LOOKBACK_HOURS,
    max_window_hours: int = MAX_CATCHUP_HOURS,
) -> DataFrame:
    """Start and end of the next run, as hour text.

    ``start`` re-reads the trailing hours because the source revises them. The
    ``end`` is null, meaning up to the present, unless the window would be cut.
    """
    moment = now if isinstance(now, Column) else F.lit(str(now)).cast("timestamp")
    start = F.date_trunc(
        "hour", _strict_timestamp(latest, "latest_period") - hours(lookback_hours)
    )
    limit = F.col("start_at") + hours(max_window_hours)
    return latest.select(start.alias("start_at")).select(
        format_period(F.col("start_at")).alias("window_start"),
        format_period(F.when(limit < moment, limit)).alias("window_end"),
    )


def backfill_windows(
    bounds: DataFrame, chunk_days: int = BACKFILL_CHUNK_DAYS
) -> DataFrame:
    """T4: the closed range (start, end) of each bounds row, cut into chunks.

    Each chunk spans ``chunk_days`` and the next begins one hour later.
    """
    begin = _strict_timestamp(bounds, "start")
    finish = _strict_timestamp(bounds, "end")
    stride = hours(24 * chunk_days + 1)
    checked = bounds.select(begin.alias("begin"), finish.alias("finish")).withColumn(
        "begin",
        F.when(
            F.col("begin") > F.col("finish"),
            F.raise_error(F.lit("Backfill start is after its end")).cast("timestamp"),
        ).otherwise(F.col("begin")),
    )
    return checked.select(
        "finish", F.posexplode(F.sequence("begin", "finish", stride)).alias("chunk", "at")
    ).select(
        "chunk",
        F.col("at").alias("start"),
        F.least(F.col("at") + hours(24 * chunk_days), F.col("finish")).alias("end"),
    )


def backfill_window_of(period: Column, start: Column, chunk_days: int = BACKFILL_CHUNK_DAYS) -> Column:
    """T4: number of the backfill window that a period lies in, by arithmetic."""
    seconds = (24 * chunk_days + 1) * 3600
    return F.floor((F.unix_timestamp(period) - F.unix_timestamp(start)) / seconds).cast("int")


def backfill_window_counts(
    readings: DataFrame, bounds: DataFrame, chunk_days: int = BACKFILL_CHUNK_DAYS
) -> DataFrame:
    """T5: readings per chunk, chunks without readings included.

    Chunks have a fixed stride, so a reading's chunk is arithmetic on its
    period: readings are counted per chunk with map-side combine, and only the
    counts meet the chunk list. There is no range join.
    """
    windows = backfill_windows(bounds, chunk_days)
    begin = bounds.select(_strict_timestamp(bounds, "start")).scalar()
    seconds = (24 * chunk_days + 1) * 3600
    elapsed = F.unix_timestamp("period") - F.unix_timestamp(begin)
    counts = (
        readings.withColumn("chunk", F.floor(elapsed / seconds).cast("int"))
        .filter(F.col("chunk") >= 0)
        # An hour is the unit of the feed: nothing lies between two chunks
        # unless a period is off the hour, and then it belongs to neither.
        .filter(elapsed - F.col("chunk") * seconds <= seconds - 3600)
        .filter(F.col("period") <= bounds.select(_strict_timestamp(bounds, "end")).scalar())
        .groupBy("chunk")
        .agg(F.count(F.lit(1)).alias("readings"))
    )
    return windows.join(counts, "chunk", "left").select(
        "chunk", "start", "end", F.coalesce("readings", F.lit(0)).alias("readings")
    )


def within(
    df: DataFrame, start: object = None, end: object = None, column: str = "period"
) -> DataFrame:
    """The closed range [start, end], either side open when None."""
    if start is not None:
        df = df.filter(F.col(column) >= as_timestamp(start))
    if end is not None:
        df = df.filter(F.col(column) <= as_timestamp(end))
    return df


def as_timestamp(value: object) -> Column:
    """A literal or column as a timestamp; hour text is understood."""
    if isinstance(value, Column):
        return value
    text = value.isoformat() if isinstance(value, datetime) else str(value)
    return F.lit(text).cast("timestamp")
