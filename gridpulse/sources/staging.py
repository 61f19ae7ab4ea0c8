"""Written intermediate results in the folder all executors share."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import shared_scratch
from gridpulse.sources.files import Files


def observed(observation: Observation) -> dict:
    """Metrics of a finished write; none where Spark saw beforehand that there
    are no rows, and left the observation out with them."""
    try:
        return observation.get
    except Py4JJavaError:
        return {}


class Staging:
    """Written intermediate results in the shared folder.

    A staged frame is a Parquet table that every executor can read, so losing
    an executor costs its running tasks and never the work before them.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_scratch(spark)}/gridpulse-{uuid.uuid4().hex}"

    def write(self, name: str, df: DataFrame, *metrics: Column) -> tuple[DataFrame, dict]:
        """Write the frame once; returns it re-read, and the metrics over it."""
        observation = Observation()
        counted = df.observe(observation, F.count(F.lit(1)).alias("row_count"), *metrics)
        path = f"{self.root}/{name}"
        counted.write.parquet(path)
        staged = self.spark.read.schema(df.schema).parquet(path)
        return staged, {"row_count": 0, **observed(observation)}

    def close(self) -> None:
        Files(self.spark).delete(self.root)

    def close_at_exit(self) -> None:
        """Leave the files to frames that are read later in this session."""
        Files(self.spark).delete_at_exit(self.root)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.close()


def written(df: DataFrame) -> DataFrame:
    """The frame, computed once and re-read from a folder of its own.

    Frames built on it share no cache with others, and a lost executor costs its
    running tasks only. The folder goes when the session ends.
    """
    staging = Staging(df.sparkSession)
    staging.close_at_exit()
    return staging.write("rows", df)[0]
