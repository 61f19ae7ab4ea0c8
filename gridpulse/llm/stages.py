"""Intermediate tables of the operators, in the folder all executors share."""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import shared_scratch


class Shared:
    """Parquet tables that cut lineage: a lost executor repeats its tasks only.

    They lie under ``spark.checkpoint.dir`` and stay until the session ends,
    because returned frames read them later; ``drop`` frees one earlier.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_scratch(spark)}/{name}-{uuid.uuid4().hex}"
        self._numbers = itertools.count()
        path, files = self._files(self.root)
        files.deleteOnExit(path)

    def _files(self, path: str) -> tuple:
        jvm_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return jvm_path, jvm_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def write(self, df: DataFrame, name: str) -> DataFrame:
        """Compute the frame once and return it re-read."""
        path = f"{self.root}/{next(self._numbers)}-{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Free what ``write`` wrote; no later read may need it."""
        for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
            path, files = self._files(folder)
            files.delete(path, True)


def column_name(df: DataFrame, wanted: str) -> str:
    """A name that none of the frame's columns has, whatever its case."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted = f"_{wanted}"
    return wanted


def numbered(df: DataFrame, order: Sequence[str], shared: Shared) -> DataFrame:
    """The frame, range-sorted and written, plus ``place``: gapless from 0.

    Equal rows lie in one range; a unique column at the end of ``order`` spreads them.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    written = shared.write(spread.withColumn("seat", F.monotonically_increasing_id()), "sorted")
    part, inside = F.shiftright("seat", 33), F.col("seat").bitwiseAND((1 << 33) - 1)
    sizes = written.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"))
    # One row for each partition of the sort, so the window and the broadcast are small.
    starts = sizes.select("part", F.expr("sum(rows) OVER (ORDER BY part) - rows").alias("start"))
    placed = written.withColumn("part", part).join(F.broadcast(starts), "part")
    return placed.withColumn("place", F.col("start") + inside).drop("part", "start", "seat")
