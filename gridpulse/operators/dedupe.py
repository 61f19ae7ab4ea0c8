"""Ranking, de-duplication and keyed set operations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_last(df: DataFrame, key: Sequence[str], *order: str | Column) -> DataFrame:
    """The last row per key in ``order``, which must be total.

    Spark ranks within each input task before the shuffle (window group
    limit), so a key holding a large share of all rows sends one row per task.
    """
    columns = [F.col(item) if isinstance(item, str) else item for item in order]
    newest = Window.partitionBy(*key).orderBy(*[c.desc_nulls_last() for c in columns])
    return (
        df.withColumn("_rank", F.row_number().over(newest))
        .filter("_rank = 1")
        .drop("_rank")
    )


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return (
        df.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count")).filter("row_count > 1")
    )


def duplicated_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Every row whose key occurs more than once.

    Counts first and joins back, so no task has to hold one key's rows.
    """
    return df.join(duplicate_keys(df, key).select(*key), list(key), "left_semi")


def overlay(base: DataFrame, newer: DataFrame, key: Sequence[str]) -> DataFrame:
    """``newer`` plus the rows of ``base`` it does not replace."""
    return base.join(newer.select(*key), list(key), "left_anti").unionByName(newer)


def merge_rows(
    stored: DataFrame,
    incoming: DataFrame,
    key: Sequence[str],
    keep: Sequence[str] = (),
    order: str | None = None,
) -> DataFrame:
    """Keyed upsert of ``incoming`` into ``stored``, whole rows replaced.

    Both sides are unique by key. A null in an incoming row replaces the
    stored value, because the row is replaced and not patched; only the
    ``keep`` columns retain what is stored. With ``order``, a column of both, a
    stored row that is later in it stays.
    """
    rest = [name for name in incoming.columns if name not in key]
    old = stored.select(*key, F.struct(*rest).alias("old"))
    new = incoming.select(*key, F.struct(*rest).alias("new"))

    replaces = F.col("new").isNotNull()
    if order:
        later = F.col(f"old.{order}") > F.col(f"new.{order}")
        replaces &= F.col("old").isNull() | ~F.coalesce(later, F.lit(False))

    def merged(name: str) -> Column:
        if name in key:
            return F.col(name)
        if name in keep:
            return F.coalesce(f"old.{name}", f"new.{name}").alias(name)
        return F.when(replaces, F.col(f"new.{name}")).otherwise(
            F.col(f"old.{name}")
        ).alias(name)

    return old.join(new, list(key), "full").select(*map(merged, incoming.columns))
