"""Stored tables: Parquet split by date, changed by keyed upsert.

A write never touches files that readers see. It adds a folder of its own, split
by partition, and then one small version file that says which folder holds each
partition. That file is the commit: a write that dies before it leaves the table
as it was, and two writers cannot both create the next version.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse import schemas
from gridpulse.functions.columns import TIMESTAMP_FORMAT
from gridpulse.operators.dedupe import keep_last, merge_rows
from gridpulse.operators.normalize import null_non_finite
from gridpulse.operators.quality import require_unique
from gridpulse.operators.windows import as_timestamp
from gridpulse.schemas import Table
from gridpulse.sources.files import Files
from gridpulse.sources.staging import observed

AUDIT_COLUMN = "transformed_at"
# Partition column of the files that names the write they come from.
_WRITE = "write"
_NO_DATE = "__HIVE_DEFAULT_PARTITION__"

# Columns of the recent-performance read.
RECENT_PERFORMANCE_COLUMNS = (
    "date",
    "respondent",
    "respondent_name",
    "mape_pct",
    "forecast_bias_mwh",
    "observation_count",
)


@dataclass
class Version:
    """Rows written beside a table, before ``publish`` makes them part of it."""

    table: Table
    write: str
    frame: DataFrame
    row_count: int
    metrics: dict
    folders: list[str] = field(default_factory=list)


class TableStore:
    """The eight tables of :mod:`gridpulse.schemas` under one root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.files = Files(spark)

    def path(self, table: Table) -> str:
        return f"{self.root}/{table.name}"

    def _data(self, table: Table) -> str:
        return f"{self.path(table)}/data"

    def _versions(self, table: Table) -> str:
        return f"{self.path(table)}/versions"

    def _stored_schema(self, table: Table) -> T.StructType:
        fields = list(table.schema.fields)
        fields += [T.StructField(name, kind) for name, kind in table.hidden]
        if table.audited:
            fields.append(T.StructField(AUDIT_COLUMN, T.TimestampType()))
        if table.partition_column not in table.columns:
            fields.append(T.StructField(table.partition_column, table.partition_type))
        return T.StructType(fields)

    def _current(self, table: Table) -> tuple[int, dict[str, str]]:
        """Number of the newest whole version, and the write that holds each
        partition folder. A version file that does not parse was not finished."""
        folder = self._versions(table)
        names = [name for name in self.files.names(folder) if name.endswith(".json")]
        for name in reversed(names):
            try:
                return int(name[:-5]), json.loads(self.files.read(f"{folder}/{name}"))
            except ValueError:
                continue
        return 0, {}

    def partitions(self, table: Table) -> list[str]:
        """Values of the stored partitions, as text, ascending."""
        folders = self._current(table)[1]
        return sorted(folder.partition("=")[2] for folder in folders)

    def _read(self, table: Table, writes: dict[str, str]) -> DataFrame:
        schema = self._stored_schema(table)
        if not writes:
            return self.spark.createDataFrame([], schema)
        data = self._data(table)
        paths = [f"{data}/{_WRITE}={write}/{folder}" for folder, write in writes.items()]
        full = T.StructType([*schema.fields, T.StructField(_WRITE, T.StringType())])
        return self.spark.read.schema(full).option("basePath", data).parquet(*paths).drop(_WRITE)

    def scan(self, table: Table, folders: Iterable[str] | None = None) -> DataFrame:
        """All stored columns, of some partition folders if given; an empty frame
        before the first write."""
        writes = self._current(table)[1]
        if folders is not None:
            writes = {f: writes[f] for f in folders if f in writes}
        return self._read(table, writes)

    def read(self, table: Table) -> DataFrame:
        """The table's contract columns, without storage columns."""
        return self.scan(table).select(*table.columns)

    def read_periods(
        self, table: Table, start: object, end: object = None
    ) -> DataFrame:
        """Rows of an hourly table in [start, end).

        The bounds are repeated on the partition column, so only the dates in
        between are read; bounds that are no columns also keep the others out of
        the listing. Columns may be scalar subqueries.
        """
        first = as_timestamp(start)
        days = self._days_between(table, start, end)
        rows = self.scan(table, days).filter(
            (F.col("period_date") >= F.to_date(first)) & (F.col("period") >= first)
        )
        if end is not None:
            last = as_timestamp(end)
            rows = rows.filter(
                (F.col("period_date") <= F.to_date(last)) & (F.col("period") < last)
            )
        return rows.select(*table.columns)

    def _days_between(self, table: Table, start: object, end: object) -> list[str]:
        def day(bound: object, otherwise: str) -> str:
            if bound is None or isinstance(bound, Column):
                return otherwise
            return (bound.isoformat() if isinstance(bound, datetime) else str(bound))[:10]

        low, high = day(start, ""), day(end, "~")
        return [
            f"{table.partition_column}={value}"
            for value in self.partitions(table)
            if low <= value <= high
        ]

    def read_recent_performance(self, start_date: date | str | Column) -> DataFrame:
        """Daily forecast performance from ``start_date`` onwards."""
        if not isinstance(start_date, Column):
            start_date = F.lit(str(start_date)).cast("date")
        return (
            self.scan(schemas.GOLD_FORECAST_PERFORMANCE)
            .filter(F.col("date") >= start_date)
            .select(*RECENT_PERFORMANCE_COLUMNS)
        )

    def newest_day(self, table: Table) -> str | None:
        """The newest stored date of a table split by date; reads no data."""
        days = [value for value in self.partitions(table) if value != _NO_DATE]
        return days[-1] if days else None

    def latest_bronze(self) -> DataFrame:
        """S3: one row with ``latest_period``, the newest stored reading or null.

        Only the newest date's files are read for its hour.
        """
        table = schemas.BRONZE_READINGS
        day = self.newest_day(table)
        newest = self.scan(table, [f"{table.partition_column}={day}"] if day else [])
        return newest.agg(F.max("period").alias("latest_period"))

    def latest_bronze_period(self) -> str | None:
        """S3 as UTC text."""
        text = F.date_format("latest_period", TIMESTAMP_FORMAT)
        return self.latest_bronze().select(text.alias("period")).first()["period"]

    def _write(self, table: Table, rows: DataFrame) -> tuple[str, list[str]]:
        """Write rows into a new folder, split by partition.

        Rebalancing by the split column gives each date its own files and lets
        Spark divide a date that is too large for one task.
        """
        write, split = f"w{uuid.uuid4().hex}", table.partition_column
        path = f"{self._data(table)}/{_WRITE}={write}"
        rows.hint("rebalance", split).sortWithinPartitions(*table.key).write.partitionBy(
            split
        ).parquet(path)
        return write, [n for n in self.files.names(path) if n.startswith(f"{split}=")]

    def stage(
        self, table: Table, incoming: DataFrame, *order: str | Column, metrics: Iterable[Column] = ()
    ) -> Version:
        """Write the rows of an upsert once, where no reader sees them yet.

        With ``order`` they are first reduced to the last per key; without it a
        repeated key is refused. ``metrics`` are observed while writing.
        """
        if order:
            incoming = keep_last(incoming, table.key, *order)
        hidden = [
            (F.col(name) if name in incoming.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in table.hidden
        ]
        rows = null_non_finite(incoming.select(*table.columns, *hidden))
        if table.audited:
            rows = rows.withColumn(AUDIT_COLUMN, F.current_timestamp())
        rows = rows.withColumn(table.partition_column, table.partition_by())
        observation = Observation()
        count = F.count(F.lit(1)).alias("row_count")
        write, folders = self._write(table, rows.observe(observation, count, *metrics))
        found = {"row_count": 0, **observed(observation)}
        frame = self._read(table, dict.fromkeys(folders, write))
        version = Version(table, write, frame, found["row_count"], found, folders)
        if not order:
            try:
                require_unique(frame, table)
            except Exception:
                self.discard(version)
                raise
        return version

    def discard(self, version: Version) -> None:
        """Delete a version that will not be published."""
        self.files.delete(f"{self._data(version.table)}/{_WRITE}={version.write}")

    def merge(self, version: Version, by_order: bool = False) -> tuple[int, dict[str, str]]:
        """The next version's number and partitions; readers see no change yet.

        Partitions that are not stored yet are taken as they were staged. The
        others are merged with their stored rows, by key: ``transformed_at`` is
        set at insert and kept at update. ``by_order`` keeps the stored row where
        its hidden order is the later one.
        """
        table = version.table
        number, current = self._current(table)
        writes = dict.fromkeys(version.folders, version.write)
        both = [folder for folder in version.folders if folder in current]
        if both:
            stored = self._read(table, {f: current[f] for f in both})
            incoming = self._read(table, {f: writes[f] for f in both})
            key = list(dict.fromkeys([table.partition_column, *table.key]))
            keep = [AUDIT_COLUMN] if table.audited else []
            order = table.hidden[0][0] if by_order else None
            write, folders = self._write(table, merge_rows(stored, incoming, key, keep, order))
            writes |= dict.fromkeys(folders, write)
        return number + 1, current | writes

    def commit(self, table: Table, number: int, writes: dict[str, str]) -> None:
        """Make a merged version the table; fails if another writer was first."""
        self.files.create(f"{self._versions(table)}/{number:010d}.json", json.dumps(writes))

    def publish(self, version: Version, by_order: bool = False) -> int:
        """Insert or replace by key; returns the rows sent."""
        if version.row_count:
            self.commit(version.table, *self.merge(version, by_order))
        else:
            self.discard(version)
        return version.row_count

    def upsert(self, table: Table, incoming: DataFrame, *order: str | Column) -> int:
        """S6-S9 in one step; an empty frame writes nothing."""
        return self.publish(self.stage(table, incoming, *order))

    def vacuum(self, table: Table) -> None:
        """Delete files and versions that the newest version does not need.

        For times when nobody reads an older version or writes a new one.
        """
        number, writes = self._current(table)
        kept = {(write, folder) for folder, write in writes.items()}
        data = self._data(table)
        for name in self.files.names(data):
            write = name.removeprefix(f"{_WRITE}=")
            folders = [f for f in self.files.names(f"{data}/{name}") if "=" in f]
            unused = [f for f in folders if (write, f) not in kept]
            if len(unused) == len(folders):
                self.files.delete(f"{data}/{name}")
                continue
            for folder in unused:
                self.files.delete(f"{data}/{name}/{folder}")
        for name in self.files.names(self._versions(table)):
            if name.endswith(".json") and int(name[:-5]) < number:
                self.files.delete(f"{self._versions(table)}/{name}")
