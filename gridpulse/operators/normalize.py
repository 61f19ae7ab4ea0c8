"""Input normalisation."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.columns import finite_or_null, parse_number, parse_timestamp
from gridpulse.schemas import SOURCE_RENAMES

# Columns a raw reading must carry.
REQUIRED_READING_COLUMNS = ("period", "respondent", "type", "value")

_TEXT_COLUMNS = {"respondent", "respondent_name"}


def _missing_columns(label: str, missing: list[str], found: Iterable[str]) -> ValueError:
    return ValueError(
        f"{label} cannot be read without {', '.join(missing)}; its columns are {', '.join(sorted(found))}"
    )


def with_name_column(df: DataFrame) -> DataFrame:
    """A null ``respondent_name`` where the frame has none."""
    if "respondent_name" in df.columns:
        return df
    return df.withColumn("respondent_name", F.lit(None).cast("string"))


def normalize_readings(df: DataFrame) -> DataFrame:
    """P6 (P1-P5): source names to ours, period to timestamp, value to finite double.

    Other columns pass through, ``ordinal`` (row order) among them.
    """
    types = {field.name: field.dataType for field in df.schema}
    names = {name: SOURCE_RENAMES.get(name, name) for name in types}
    missing = [c for c in REQUIRED_READING_COLUMNS if c not in names.values()]
    if missing:
        raise _missing_columns("Raw readings", missing, names.values())
    columns = []
    for name, target in names.items():
        column = F.col(f"`{name}`")
        if target == "period":
            column = parse_timestamp(column, types[name])
        elif target == "value":
            column = parse_number(column, types[name])
        columns.append(column.alias(target))
    if "respondent_name" not in names.values():
        columns.append(F.lit(None).cast("string").alias("respondent_name"))
    return df.select(*columns)


def normalize_silver(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Contract check (P2), name column, typed period.

    Only a frame that holds rows must honour the contract: an empty one gets
    the columns it lacks as typed nulls. The emptiness test runs a job, and
    only on a frame that lacks columns.
    """
    missing = [name for name in required if name not in df.columns]
    if missing:
        if not df.isEmpty():
            raise _missing_columns("Silver frame", missing, df.columns)
        for name in missing:
            kind = "timestamp" if name == "period" else "double"
            kind = "string" if name in _TEXT_COLUMNS else kind
            df = df.withColumn(name, F.lit(None).cast(kind))
    df = with_name_column(df)
    return df.withColumn(
        "period", parse_timestamp(F.col("period"), df.schema["period"].dataType)
    )


def numeric(df: DataFrame, *columns: str) -> DataFrame:
    """P5 over several columns of a frame."""
    types = {field.name: field.dataType for field in df.schema}
    return df.withColumns(
        {name: parse_number(F.col(name), types[name]) for name in columns}
    )


def select_metric(df: DataFrame, metric: str, value_column: str) -> DataFrame:
    """One metric code, its value under a domain name."""
    return df.filter(F.col("type") == metric).select(
        "period",
        "respondent",
        "respondent_name",
        F.col("value").alias(value_column),
    )


def null_non_finite(df: DataFrame) -> DataFrame:
    """NaN and infinities to null in every floating column."""
    floating = [name for name, kind in df.dtypes if kind in ("double", "float")]
    return df.withColumns({name: finite_or_null(F.col(name)) for name in floating})


def order_by_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """O1: presentation order, nulls last, as exports have it; stored tables carry none."""
    return df.orderBy(*[F.asc_nulls_last(name) for name in key])
