"""The hour-by-region and the day-by-region grid."""

from __future__ import annotations

from math import ceil, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.schemas import DAILY_KEY, HOURLY_KEY

# Grid cells for each shuffle partition, so that hashing deals them out evenly.
_HOUR_CELLS = 4
_DAY_CELLS = 1


def region_grid(keys: DataFrame, unit: str, window: Column | None = None, cells: int = _HOUR_CELLS) -> DataFrame:
    """Every observed value of ``unit`` paired with every observed region.

    With ``window``, an expression over the columns of ``keys``, units meet the
    regions that are observed in the same window only.

    The output is a product by definition, so the work is to build it evenly.
    Units and regions are hashed to ``n`` cells each, every unit is copied to
    the ``n`` region cells and every region to the ``n`` unit cells, and the
    two meet in an equi-join on (window, unit cell, region cell). The copies cost
    ``n`` times the distinct units and regions, never the readings. Both inputs
    are distinct values, so no cell is hot. The fixed partition count keeps
    Spark from merging small inputs whose output is large.
    """
    side = ceil(sqrt(cells * int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    every_cell = F.explode(F.sequence(F.lit(0), F.lit(side - 1)))
    whole = keys.filter(F.col(unit).isNotNull() & F.col("respondent").isNotNull())
    whole = whole.withColumn("window", F.lit(0) if window is None else window)
    unit_cell, region_cell = f"{unit}_cell", "region_cell"

    def cell(name: str) -> Column:
        return F.pmod(F.xxhash64(name), F.lit(side)).cast("int")

    cell_columns = ["window", unit_cell, region_cell]
    units = (
        whole.select("window", unit)
        .distinct()
        .select("window", unit, cell(unit).alias(unit_cell), every_cell.alias(region_cell))
        .repartition(side * side, *cell_columns)
    )
    regions = (
        whole.select("window", "respondent")
        .distinct()
        .select("window", "respondent", every_cell.alias(unit_cell), cell("respondent").alias(region_cell))
        .repartition(side * side, *cell_columns)
    )
    return units.join(regions, cell_columns).select(unit, "respondent")


def densify_hours(sparse: DataFrame, keys: DataFrame, flag: str, window: Column | None = None) -> DataFrame:
    """``sparse`` with every row of the grid of ``keys``; added rows are null throughout.

    ``flag`` tells which rows lie on the grid. Rows with a null key are kept, so
    that the key check, and not this join, rejects them.
    """
    grid = region_grid(keys, "period", window).withColumn(flag, F.lit(True))
    return sparse.join(grid, list(HOURLY_KEY), "full").withColumn(
        flag, F.coalesce(F.col(flag), F.lit(False))
    )


def densify_days(daily: DataFrame, hours: DataFrame | None = None, window: Column | None = None) -> DataFrame:
    """Daily rows of observed hours, and an empty row for every other pair of the grid.

    An hour without readings changes no average, extreme, deviation or count, so
    aggregates of the hourly grid are those of the observed hours, and what is
    missing are whole days: the grid is dates by regions, a row for 24 of hours.

    ``daily`` is read three times; give a written frame. With ``window``, an
    expression over ``period``, the dates and regions of each window are those of
    ``hours``, the observed demand rows, which then are read too.
    """
    if window is None:
        grid = region_grid(daily, "date", cells=_DAY_CELLS)
    else:
        grid = region_grid(hours.withColumn("date", F.to_date("period")), "date", window, _DAY_CELLS).distinct()
    return daily.join(grid, list(DAILY_KEY), "full").withColumn(
        "observation_count", F.coalesce("observation_count", F.lit(0))
    ).select(*daily.columns)
