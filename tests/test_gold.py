from math import isclose, sqrt

import pytest
from frames import demand, generation, interchange, performance, table

from gridpulse import DataQualityError, schemas
from gridpulse.operators import analytics
from gridpulse.operators.gold import (
    name_conflicts,
    recent_forecast_kpis,
    transform_demand_daily,
    transform_forecast_performance,
    transform_grid_balance,
    transform_regional_summary,
)
from gridpulse.operators.quality import (
    conflict_report,
    over_full_days,
    validate,
    warn_name_conflicts,
)

DAY = "2024-01-01"


def daily(spark, *values):
    rows = [(f"{DAY}T{i:02d}", "AVL", v, None) for i, v in enumerate(values)]
    (row,) = transform_demand_daily(demand(spark, *rows)).collect()
    return row.asDict()


def accuracy(spark, *pairs):
    rows = [(f"{DAY}T{i:02d}", "AVL", d, f) for i, (d, f) in enumerate(pairs)]
    (row,) = transform_forecast_performance(demand(spark, *rows)).collect()
    return row.asDict()


def test_daily_shape(spark):
    row = daily(spark, 100.0, 200.0, 300.0)
    assert (row["avg_demand_mwh"], row["peak_demand_mwh"]) == (200.0, 300.0)
    assert (row["min_demand_mwh"], row["demand_stddev_mwh"]) == (100.0, 100.0)
    assert row["observation_count"] == 3 and str(row["date"]) == DAY
    assert row["respondent_name"] == "AVL area"


@pytest.mark.parametrize(
    ("values", "count", "mean", "deviation"),
    [
        ((100.0, None), 1, 100.0, None),
        ((None,), 0, None, None),
        ((100.0,), 1, 100.0, None),
        ((100.0, float("nan")), 1, 100.0, None),
        ((100.0, float("inf")), 1, 100.0, None),
    ],
)
def test_daily_counts_values_only(spark, values, count, mean, deviation):
    row = daily(spark, *values)
    assert row["observation_count"] == count
    assert row["avg_demand_mwh"] == mean and row["demand_stddev_mwh"] == deviation


def test_daily_uses_utc_dates_and_keeps_regions_apart(spark):
    frame = demand(
        spark,
        ("2024-01-01T23", "AVL", 1.0, None),
        ("2024-01-01T23:30:00-02:00", "AVL", 2.0, None),
        ("2024-01-01T23", "BRN", 3.0, None),
    )
    got = transform_demand_daily(frame).selectExpr(
        "cast(date AS string) AS date", "respondent", "avg_demand_mwh"
    )
    assert table(got) == [
        ("2024-01-01", "AVL", 1.0),
        ("2024-01-01", "BRN", 3.0),
        ("2024-01-02", "AVL", 2.0),
    ]


def test_daily_name_is_the_first_one_by_hour(spark):
    frame = demand(
        spark,
        (f"{DAY}T02", "AVL", 1.0, None, "Later"),
        (f"{DAY}T01", "AVL", 1.0, None, "Earlier"),
        (f"{DAY}T00", "AVL", 1.0, None, None),
    )
    assert table(transform_demand_daily(frame), "respondent_name") == [("Earlier",)]


def test_accuracy(spark):
    row = accuracy(spark, (1000.0, 900.0), (800.0, 1000.0), (1500.0, 1200.0))
    assert row["mae_mwh"] == 200.0 and row["max_abs_error_mwh"] == 300.0
    assert isclose(row["rmse_mwh"], sqrt(140000 / 3))
    assert isclose(row["mape_pct"], 100 * (0.1 + 0.25 + 0.2) / 3)
    assert isclose(row["forecast_bias_mwh"], 200 / 3)


def test_accuracy_needs_both_values(spark):
    row = accuracy(spark, (1000.0, 900.0), (None, 900.0), (1000.0, None))
    assert (row["observation_count"], row["mae_mwh"]) == (1, 100.0)
    row = accuracy(spark, (None, 900.0))
    assert row["observation_count"] == 0 and row["mae_mwh"] is None


def test_zero_demand_leaves_mape_only_and_negative_demand_counts(spark):
    row = accuracy(spark, (1000.0, 900.0), (0.0, 100.0))
    assert (row["mape_pct"], row["mae_mwh"], row["observation_count"]) == (10.0, 100.0, 2)
    assert accuracy(spark, (-100.0, -50.0))["mape_pct"] == 50.0


def test_balance_side_by_side(spark):
    hour = f"{DAY}T00"
    result = transform_grid_balance(
        demand(spark, (hour, "AVL", 100.0, None)),
        generation(spark, (hour, "AVL", 150.0)),
        interchange(spark, (hour, "AVL", -20.0)),
    )
    assert result.columns == schemas.GOLD_GRID_BALANCE.columns
    assert table(result) == [(hour, "AVL", "AVL area", 100.0, 150.0, -20.0, 50.0)]


def test_balance_keeps_one_sided_hours(spark):
    result = transform_grid_balance(
        demand(spark, (f"{DAY}T00", "AVL", 100.0, None)),
        generation(spark, (f"{DAY}T01", "BRN", 75.0)),
        spark.createDataFrame([], "period string"),
    )
    assert table(result) == [
        (f"{DAY}T00", "AVL", "AVL area", 100.0, None, None, None),
        (f"{DAY}T01", "BRN", "BRN area", None, 75.0, None, None),
    ]


def test_balance_rejects_a_frame_with_rows_but_no_metric(spark):
    frame = demand(spark, (f"{DAY}T00", "AVL", 1.0, None))
    with pytest.raises(ValueError, match="net_generation_mwh"):
        transform_grid_balance(frame, frame, interchange(spark))


def test_balance_demand_name_wins_and_conflicts_warn(spark, caplog):
    hour = f"{DAY}T00"
    domains = (
        demand(spark, (hour, "AVL", 1.0, None), (hour, "BRN", 1.0, None, None)),
        generation(spark, (hour, "AVL", 1.0, "Pacific"), (hour, "BRN", 1.0)),
        interchange(spark, (hour, "AVL", 1.0)),
    )
    names = table(transform_grid_balance(*domains), "respondent", "respondent_name")
    assert names == [("AVL", "AVL area"), ("BRN", "BRN area")]
    conflicts = name_conflicts(*domains)
    assert table(conflicts) == [("generation", "AVL", "AVL area", "Pacific")]
    assert table(conflict_report(conflicts)) == [("generation", 1, "AVL: AVL area / Pacific")]
    with caplog.at_level("WARNING"):
        assert warn_name_conflicts(conflicts) == {"generation": 1}
    assert "Pacific" in caplog.text


def test_balance_still_shows_a_repeated_key(spark):
    hour = f"{DAY}T00"
    result = transform_grid_balance(
        demand(spark, (hour, "AVL", 1.0, None)),
        generation(spark, (hour, "AVL", 1.0), (hour, "AVL", 2.0)),
        interchange(spark),
    )
    with pytest.raises(DataQualityError, match="grain"):
        validate(result, schemas.GOLD_GRID_BALANCE)


def test_summary_takes_values_of_each_regions_newest_hour(spark):
    result = transform_regional_summary(
        demand(
            spark,
            (f"{DAY}T00", "AVL", 100.0, 90.0),
            (f"{DAY}T05", "AVL", 130.0, 120.0),
            (f"{DAY}T03", "BRN", 50.0, 55.0),
        ),
        generation(spark, (f"{DAY}T05", "AVL", 200.0)),
        interchange(spark, (f"{DAY}T05", "AVL", -15.0)),
    )
    assert result.columns == schemas.GOLD_REGIONAL_SUMMARY.columns
    assert table(result) == [
        ("AVL", "AVL area", f"{DAY}T05", 130.0, 120.0, 200.0, -15.0, None, None),
        ("BRN", "BRN area", f"{DAY}T03", 50.0, 55.0, None, None, None, None),
    ]


def test_summary_does_not_reach_back(spark):
    result = transform_regional_summary(
        demand(spark, (f"{DAY}T05", "AVL", 130.0, None)),
        generation(spark, (f"{DAY}T00", "AVL", 200.0)),
        interchange(spark),
    )
    got = table(result, "latest_period", "latest_net_generation_mwh")
    assert got == [(f"{DAY}T05", None)]


def test_summary_without_forecast_column(spark):
    frame = demand(spark, (f"{DAY}T05", "AVL", 130.0, 1.0)).drop("forecast_demand_mwh")
    result = transform_regional_summary(frame, generation(spark), interchange(spark))
    assert table(result, "latest_forecast_demand_mwh") == [(None,)]


def kpis(spark, *rows, days=7):
    return table(recent_forecast_kpis(performance(spark, *rows), days))


def test_kpi_window_is_calendar_days_from_the_newest_date_of_all(spark):
    rows = [
        ("2024-01-10", "AVL", 5.0, 10.0, 24),
        ("2024-01-04", "AVL", 7.0, -10.0, 24),
        ("2024-01-01", "AVL", 90.0, 900.0, 24),
        ("2024-01-03", "BRN", 1.0, 1.0, 24),
        ("bad date", "TEX", 1.0, 1.0, 24),
    ]
    assert kpis(spark, *rows) == [("AVL", 6.0, 0.0)]


def test_kpis_are_weighted_and_skip_unusable_days(spark):
    rows = [("2024-01-01", "AVL", 6.0, 1.0, 4), ("2024-01-02", "AVL", 16.0, 1.0, 6)]
    assert kpis(spark, *rows) == [("AVL", 12.0, 1.0)]
    rows = [("2024-01-01", "AVL", None, None, 0), ("2024-01-02", "AVL", 8.0, 4.0, 24)]
    assert kpis(spark, *rows) == [("AVL", 8.0, 4.0)]
    rows = [("2024-01-01", "AVL", None, 2.0, 3), ("2024-01-02", "AVL", 8.0, 4.0, None)]
    assert kpis(spark, *rows) == [("AVL", None, 2.0)]


def test_kpi_regions_without_hours_are_dropped(spark):
    result = transform_regional_summary(
        demand(spark, (f"{DAY}T05", "AVL", 130.0, None)),
        generation(spark),
        interchange(spark),
        performance(
            spark, (DAY, "AVL", 5.0, 1.0, 24), (DAY, "BRN", 5.0, 1.0, 24)
        ),
    )
    assert table(result, "respondent", "recent_forecast_mape_pct") == [("AVL", 5.0)]


@pytest.mark.parametrize(
    ("spec", "change", "match"),
    [
        (schemas.GOLD_DEMAND_DAILY, "peak_demand_mwh", "peak_demand_mwh"),
        (schemas.GOLD_DEMAND_DAILY, "demand_stddev_mwh", "demand_stddev_mwh"),
        (schemas.GOLD_FORECAST_PERFORMANCE, "mae_mwh", "mae_mwh"),
    ],
)
def test_gold_range_checks(spark, spec, change, match):
    frame = demand(
        spark, (f"{DAY}T00", "AVL", 100.0, 90.0), (f"{DAY}T01", "AVL", 120.0, 90.0)
    )
    transforms = {
        schemas.GOLD_DEMAND_DAILY: transform_demand_daily,
        schemas.GOLD_FORECAST_PERFORMANCE: transform_forecast_performance,
    }
    result = transforms[spec](frame)
    validate(result, spec)
    with pytest.raises(DataQualityError, match=match):
        validate(result.selectExpr("* except (%s)" % change, f"-1D AS {change}"), spec)


def test_reports_order_nulls_as_stated(spark):
    daily_frame = transform_demand_daily(
        demand(
            spark,
            (f"{DAY}T00", "A", 1.0, None),
            (f"{DAY}T00", "B", None, None),
            (f"{DAY}T00", "C", 3.0, None),
        )
    )
    assert [r.respondent for r in analytics.top_peak_days(daily_frame).collect()] == [
        "B", "C", "A"
    ]
    assert len(analytics.top_peak_days(daily_frame, 2).collect()) == 2
    perf = performance(
        spark,
        (DAY, "A", 4.0, 1.0, 5),
        ("2024-01-02", "A", 9.0, 3.0, 20),
        (DAY, "B", None, None, 0),
    )
    assert table(analytics.forecast_accuracy(perf)) == [("A", 8.0, 25)]
    assert [tuple(r) for r in analytics.forecast_bias(perf).collect()] == [
        ("B", None), ("A", 2.0)
    ]
    summary = transform_regional_summary(
        demand(
            spark,
            (f"{DAY}T00", "A", 1.0, None),
            (f"{DAY}T00", "B", None, None),
            (f"{DAY}T00", "C", 3.0, None),
        ),
        generation(spark),
        interchange(spark),
    )
    assert [r.respondent for r in analytics.summary_by_demand(summary).collect()] == [
        "C", "A", "B"
    ]


def test_more_than_a_days_hours_is_reported(spark):
    frame = performance(spark, (DAY, "A", 1.0, 1.0, 25), (DAY, "B", 1.0, 1.0, 24))
    assert table(over_full_days(frame), "respondent") == [("A",)]
