"""Small frames for the tests."""

READING = (
    "period string, respondent string, `respondent-name` string, type string, "
    "value string, ordinal bigint"
)


def readings(spark, *rows):
    """(hour, region, type, value[, name]) in row order."""
    full = []
    for ordinal, (period, respondent, kind, value, *name) in enumerate(rows):
        label = name[0] if name else f"{respondent} area"
        text = None if value is None else str(value)
        full.append((period, respondent, label, kind, text, ordinal))
    return spark.createDataFrame(full, READING).coalesce(1)


def demand(spark, *rows):
    """(hour, region, demand, forecast[, name])."""
    full = [(p, r, n[0] if n else f"{r} area", d, f) for p, r, d, f, *n in rows]
    return spark.createDataFrame(
        full,
        "period string, respondent string, respondent_name string, "
        "demand_mwh double, forecast_demand_mwh double",
    )


def metric(spark, column, *rows):
    """(hour, region, value[, name]) under a domain column."""
    full = [(p, r, n[0] if n else f"{r} area", v) for p, r, v, *n in rows]
    return spark.createDataFrame(
        full,
        f"period string, respondent string, respondent_name string, {column} double",
    )


def generation(spark, *rows):
    return metric(spark, "net_generation_mwh", *rows)


def interchange(spark, *rows):
    return metric(spark, "total_interchange_mwh", *rows)


def performance(spark, *rows):
    """(date, region, mape, bias, count)."""
    return spark.createDataFrame(
        [(d, r, f"{r} area", m, b, n) for d, r, m, b, n in rows],
        "date string, respondent string, respondent_name string, mape_pct double, "
        "forecast_bias_mwh double, observation_count bigint",
    )




def table(df, *columns):
    """Rows as tuples, times as text, sorted."""
    from pyspark.sql import functions as F

    columns = columns or df.columns
    times = {
        name: F.date_format(name, "yyyy-MM-dd'T'HH")
        for name, kind in df.dtypes
        if kind == "timestamp"
    }
    rows = [tuple(r) for r in df.withColumns(times).select(*columns).collect()]
    return sorted(rows, key=repr)
