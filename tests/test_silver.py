import gc
import random
from datetime import datetime

import pytest
from frames import readings, table
from pyspark.sql import functions as F

from gridpulse import DataQualityError, schemas
from gridpulse.operators.dedupe import keep_last
from gridpulse.operators.densify import densify_days
from gridpulse.operators.gold import (
    summary_of,
    summary_of_observed,
    transform_demand_daily,
    transform_forecast_performance,
)
from gridpulse.operators.names import (
    decode_names,
    encode_names,
    require_distinct_codes,
)
from gridpulse.operators.normalize import normalize_readings
from gridpulse.operators.quality import RULES, enforce, enforce_observed, quality_report, validate
from gridpulse.operators.silver import (
    demand_of,
    sides_of_readings,
    transform_demand,
    transform_generation,
    transform_interchange,
)
from gridpulse.sources.staging import written

HOUR = "2024-01-01T00"


def test_pivot_puts_actual_and_forecast_side_by_side(spark):
    raw = readings(
        spark,
        (HOUR, "AVL", "D", 640),
        (HOUR, "AVL", "DF", 608),
        (HOUR, "AVL", "NG", 777),
        (HOUR, "AVL", "TI", -3),
    )
    result = transform_demand(raw)
    assert result.columns == schemas.SILVER_DEMAND.columns
    assert table(result) == [(HOUR, "AVL", "AVL area", 640.0, 608.0, 32.0, 5.0)]


@pytest.mark.parametrize(
    ("actual", "forecast", "error", "pct"),
    [
        (400, 450, -50.0, -12.5),
        (0, 70, -70.0, None),
        (-20, 33, -53.0, None),
        (None, 410, None, None),
        ("n/a", 410, None, None),
        ("inf", 410, None, None),
        ("NaN", 410, None, None),
        ("12d", 410, None, None),
    ],
)
def test_error_is_signed_and_percentage_needs_positive_demand(
    spark, actual, forecast, error, pct
):
    raw = readings(spark, (HOUR, "AVL", "D", actual), (HOUR, "AVL", "DF", forecast))
    got = table(transform_demand(raw), "forecast_error_mwh", "forecast_error_pct")
    assert got == [(error, pct)]


def test_missing_metric_stays_null(spark):
    raw = readings(
        spark,
        ("2024-01-01T00", "AVL", "D", None),
        ("2024-01-01T00", "AVL", "DF", 900),
        ("2024-01-01T01", "AVL", "D", 500),
    )
    got = table(transform_demand(raw), "period", "demand_mwh", "forecast_demand_mwh")
    assert got == [("2024-01-01T00", None, 900.0), ("2024-01-01T01", 500.0, None)]


def test_one_metric_only(spark):
    raw = readings(spark, (HOUR, "AVL", "DF", 900))
    got = table(transform_demand(raw), "demand_mwh", "forecast_demand_mwh")
    assert got == [(None, 900.0)]


def test_duplicates_collapse_to_first_non_null_in_row_order(spark):
    raw = readings(
        spark,
        (HOUR, "AVL", "D", None, None),
        (HOUR, "AVL", "D", 7, None),
        (HOUR, "AVL", "D", 5, "Second"),
        (HOUR, "AVL", "D", 9, "A third"),
    )
    got = table(transform_demand(raw), "demand_mwh", "respondent_name")
    assert got == [(7.0, "Second")]


def test_densify_adds_every_missing_pair_without_a_name(spark):
    raw = readings(
        spark,
        ("2024-01-01T00", "AVL", "D", 1),
        ("2024-01-01T00", "BRN", "D", 2),
        ("2024-01-01T05", "AVL", "DF", 3),
        ("2024-01-01T07", "TEX", "NG", 4),
    )
    dense = table(transform_demand(raw), "period", "respondent", "respondent_name")
    assert dense == [
        ("2024-01-01T00", "AVL", "AVL area"),
        ("2024-01-01T00", "BRN", "BRN area"),
        ("2024-01-01T05", "AVL", "AVL area"),
        ("2024-01-01T05", "BRN", None),
    ]
    sparse = table(transform_demand(raw, densify=False), "period", "respondent")
    assert ("2024-01-01T05", "BRN") not in sparse and len(sparse) == 3


def test_densify_is_the_full_product_at_any_cell_count(spark):
    hours = [f"2024-01-{d:02d}T{h:02d}" for d in range(1, 6) for h in range(24)]
    rows = [(h, "R0", "D", 1) for h in hours]
    rows += [(hours[0], f"R{i}", "DF", 1) for i in range(40)]
    raw = readings(spark, *rows)
    counts = set()
    for partitions in ("1", "5", "50"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            keys = transform_demand(raw).select("period", "respondent")
            counts.add((keys.count(), keys.distinct().count()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert counts == {(120 * 40, 120 * 40)}


def test_densify_uses_no_cross_join(spark):
    plan = transform_demand(
        readings(spark, (HOUR, "AVL", "D", 1))
    )._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_names_as_codes_give_the_same_rows_and_a_hash_aggregate(spark):
    raw = normalize_readings(
        readings(
            spark,
            (HOUR, "AVL", "D", 1, None),
            (HOUR, "AVL", "D", 2, "Old"),
            (HOUR, "AVL", "DF", 3, "New"),
            (HOUR, "BRN", "DF", 3, None),
        )
    )
    coded, lookup = encode_names(raw)
    by_code = transform_demand(coded)
    assert table(decode_names(by_code, lookup)) == table(transform_demand(raw))
    plan = by_code._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_two_names_with_one_code_are_refused(spark):
    schema = "respondent string, respondent_name string, name_code bigint"
    fine = spark.createDataFrame([("AVL", "A", 1), ("AVL", "B", 2), ("BRN", "A", 1)], schema)
    assert require_distinct_codes(fine) is fine
    clash = spark.createDataFrame([("AVL", "A", 1), ("AVL", "B", 1)], schema)
    with pytest.raises(DataQualityError, match="same code"):
        require_distinct_codes(clash)


def test_a_third_of_all_rows_on_one_key_against_plain_python(spark):
    """The hot hour and region, in many tasks, with nulls and three names."""
    rows, first = [], {}
    for i in range(3000):
        key = (HOUR, "HOT") if i % 3 == 0 else (f"2024-01-01T{i % 24:02d}", f"R{i % 7}")
        kind = "D" if i % 2 else "DF"
        value = None if i < 300 or i % 5 == 0 else float((i * 37) % 1000)
        name = None if i % 4 else f"Name {i % 3}"
        rows.append((*key, kind, value, name))
        seen = first.setdefault(key, {})
        for field, item in ((kind, value), ("name", name)):
            if item is not None:
                seen.setdefault(field, item)
    raw = normalize_readings(readings(spark, *rows)).repartition(8)
    expected = sorted(
        ((*key, s.get("name"), s.get("D"), s.get("DF")) for key, s in first.items()),
        key=repr,
    )
    coded, lookup = encode_names(raw)
    for result in (
        transform_demand(raw, densify=False),
        decode_names(transform_demand(coded, densify=False), lookup),
    ):
        assert table(result.drop("forecast_error_mwh", "forecast_error_pct")) == expected


def test_observed_checks_raise_in_order():
    rules = RULES["gold_demand_daily"]
    assert enforce_observed({}, rules, None) == {}
    with pytest.raises(DataQualityError, match="respondent: null key part, rows: 2"):
        enforce_observed({"failures_1": 2, "failures_2": 1}, rules, None)
    with pytest.raises(DataQualityError, match="demand_stddev_mwh: below zero.*-2.25"):
        enforce_observed({"failures_2": 1, "min_2": -2.25}, rules, None)


def test_observed_warning_shows_rows_and_counts_them(spark, caplog):
    raw = readings(spark, *[(f"2024-05-01T{h:02d}", "TEX", "D", -h) for h in range(1, 6)])
    frame = transform_demand(raw)
    with caplog.at_level("WARNING"):
        warned = enforce_observed({"failures_2": 5, "min_2": -5.0}, RULES["silver_demand"], frame)
    assert warned == {"demand_mwh": 5}
    assert caplog.text.count(" TEX") == 5 and "least -5.0" in caplog.text


def test_repeated_keys_without_an_order_are_refused(spark):
    raw = readings(spark, (HOUR, "AVL", "D", 4), (HOUR, "AVL", "D", 11)).drop("ordinal")
    with pytest.raises(Exception, match="need an ordinal"):
        transform_demand(raw).collect()


def test_grid_by_window(spark):
    hours = ("2024-03-01T00", "2024-03-01T01", "2024-03-02T00", "2024-03-02T01")
    rows = [(hour, "BRN", "D", 1) for hour in hours] + [(hours[0], "TEX", "D", 2)]
    whole = transform_demand(readings(spark, *rows))
    by_day = transform_demand(readings(spark, *rows), window=F.to_date("period"))
    assert whole.count() == 8 and by_day.count() == 6
    late = by_day.filter("respondent = 'TEX'")
    assert table(late, "period", "demand_mwh") == [(hours[0], 2.0), (hours[1], None)]


def test_one_scan_and_one_exchange_of_the_readings(spark, tmp_path):
    rows = [(f"2024-03-01T{h:02d}", r, k, h) for h in range(9) for r in "AB" for k in ("D", "DF", "NG", "TI")]
    readings(spark, *rows).write.parquet(str(tmp_path / "feed"))
    feed = spark.read.parquet(str(tmp_path / "feed"))
    pivots = []

    def keep(df):
        pivots.append(df)
        return written(df)

    dense = transform_demand(feed, keep=keep)
    assert dense.count() == 18
    # The readings are read by the kept pivot alone, of the metrics asked for.
    feed_files = {f.rsplit("/", 2)[-2] for f in dense.inputFiles()}
    assert "feed" not in feed_files and pivots[0].columns[2:] == ["demand_name", "demand_mwh", "forecast_demand_mwh", "demand_rows", "copies"]
    sides = sides_of_readings(encode_names(normalize_readings(feed))[0], densify=False)
    plan = sides._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("FileScan") == 1
    executed = sides._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange") == 1 and "SortAggregate" not in executed


def test_generation_and_interchange_keep_sign_null_and_duplicates(spark):
    raw = readings(
        spark,
        (HOUR, "AVL", "NG", -5),
        (HOUR, "BRN", "NG", None),
        (HOUR, "AVL", "TI", -50),
        (HOUR, "AVL", "D", 1),
    )
    assert table(transform_generation(raw), "respondent", "net_generation_mwh") == [
        ("AVL", -5.0),
        ("BRN", None),
    ]
    assert table(transform_interchange(raw), "total_interchange_mwh") == [(-50.0,)]


@pytest.mark.parametrize(
    ("transform", "code", "name"),
    [
        (transform_generation, "NG", schemas.SILVER_GENERATION),
        (transform_interchange, "TI", schemas.SILVER_INTERCHANGE),
    ],
)
def test_duplicate_metric_breaks_the_grain(spark, transform, code, name):
    raw = readings(spark, (HOUR, "AVL", code, 5000), (HOUR, "AVL", code, 5001))
    with pytest.raises(DataQualityError, match="grain.*AVL"):
        validate(transform(raw), name)


def test_unparsable_key_is_fatal(spark):
    raw = readings(spark, ("not an hour", "AVL", "D", 1), (HOUR, "BRN", "D", 1))
    with pytest.raises(DataQualityError, match="period: null key part"):
        validate(transform_demand(raw), schemas.SILVER_DEMAND)
    raw = readings(spark, (HOUR, None, "D", 1, "x"))
    with pytest.raises(DataQualityError, match="respondent: null key part"):
        validate(transform_demand(raw), schemas.SILVER_DEMAND)


def test_negative_demand_warns_and_loads(spark, caplog):
    raw = readings(spark, (HOUR, "MIDW", "D", -12.5), (HOUR, "MIDW", "DF", 40))
    with caplog.at_level("WARNING"):
        report = enforce(transform_demand(raw), RULES["silver_demand"])
    assert "demand_mwh: below zero" in caplog.text and "MIDW" in caplog.text
    assert [r["failures"] for r in report if r["check_name"] == "warn_negative"] == [1]


def test_contract_names_missing_then_unexpected_columns(spark):
    silver = transform_demand(readings(spark, (HOUR, "AVL", "D", 1)))
    with pytest.raises(DataQualityError, match="'demand_mwh' lacking"):
        validate(silver.drop("demand_mwh"), schemas.SILVER_DEMAND)
    with pytest.raises(DataQualityError, match="'extra' not agreed"):
        validate(silver.selectExpr("*", "1 AS extra"), schemas.SILVER_DEMAND)


def test_raw_columns_are_required_and_renamed(spark):
    raw = readings(spark, (HOUR, "AVL", "D", 1))
    with pytest.raises(ValueError, match="value"):
        normalize_readings(raw.drop("value"))
    assert "respondent_name" in normalize_readings(raw).columns
    without_name = normalize_readings(raw.drop("respondent-name"))
    assert table(without_name, "respondent_name") == [(None,)]


def test_periods_parse_in_every_form(spark):
    forms = ["2024-01-01T05", "2024-01-01T05:00:00Z", "2024-01-01T07:00:00+02:00"]
    raw = readings(spark, *[(form, "AVL", "NG", 1) for form in forms])
    assert table(transform_generation(raw), "period") == [("2024-01-01T05",)] * 3
    stamp = spark.createDataFrame(
        [(datetime(2024, 1, 1, 5), "AVL", "NG", 1)],
        "period timestamp_ntz, respondent string, type string, value int",
    )
    assert table(transform_generation(stamp), "period") == [("2024-01-01T05",)]


def test_empty_input_keeps_the_contract(spark):
    raw = readings(spark, (HOUR, "AVL", "XX", 1))
    for transform, spec in (
        (transform_demand, schemas.SILVER_DEMAND),
        (transform_generation, schemas.SILVER_GENERATION),
    ):
        result = transform(raw)
        assert result.columns == spec.columns and result.count() == 0
        validate(result, spec)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_report_reads_its_frame_once(spark, tmp_path):
    rows = [(f"2024-03-0{d}T{h:02d}", r, "D", h - 3) for d in (1, 2) for h in range(9) for r in "BA"]
    transform_demand(readings(spark, *rows)).write.parquet(str(tmp_path / "silver"))
    report = quality_report(spark.read.parquet(str(tmp_path / "silver")), RULES["silver_demand"])
    found = {r["check_name"]: r for r in report.collect()}
    final = plan_of(report).split("== Initial Plan ==")[0]
    assert final.count("FileScan") - final.count("ReusedExchange") <= 1 and "WindowGroupLimit" in final
    hours = ["2024-03-01T00:00:00Z", "2024-03-01T01:00:00Z", "2024-03-01T02:00:00Z"]
    keys = [f"{h} {r}" for h in hours for r in "AB"][:5]
    assert found["warn_negative"]["failures"] == 12 and found["warn_negative"]["sample"] == ", ".join(keys)
    assert found["unique"]["sample"] is None and found["not_null"]["sample"] is None


def test_report_samples_of_nulls_and_repeats(spark):
    kinds = "period timestamp, respondent string, respondent_name string, net_generation_mwh double"
    at = datetime(2024, 3, 1, 5)
    rows = [(at, "b", "n", 1.0)] * 3 + [(at, "a", "n", 1.0)] * 2 + [(None, "z", "n", 1.0), (at, None, "n", 1.0), (at, "c", "n", 1.0)]
    found = {(r["check_name"], r["column_name"]): r for r in quality_report(spark.createDataFrame(rows, kinds), RULES["silver_generation"]).collect()}
    assert found["unique", "period, respondent"]["sample"] == "2024-03-01T05:00:00Z a, 2024-03-01T05:00:00Z b"
    assert found["not_null", "period"]["sample"] == "null z"
    assert found["not_null", "respondent"]["sample"] == "2024-03-01T05:00:00Z null"


def odd_readings():
    rng = random.Random(8)
    hours = [f"2024-03-{d:02d}T{h:02d}" for d in (1, 2, 4) for h in (0, 1, 22, 23)]
    rows = []
    for _ in range(90):
        value = rng.choice([None, 0, -4, rng.randrange(100)])
        rows.append((rng.choice(hours), rng.choice(["a", "b", "c"]), rng.choice(["D", "DF", "NG", "TI", "XX"]), value, rng.choice(["n", None])))
    return rows + [("2024-03-04T23", "late", "NG", 5), ("2024-03-09T07", "a", "NG", 5), ("2024-03-01T00", "z", "DF", None), ("2024-03-01T22", "y", "D", 3)]


@pytest.mark.parametrize("transform", [transform_demand_daily, transform_forecast_performance])
@pytest.mark.parametrize("windowed", [False, True])
def test_day_grid_is_the_hour_grid_of_daily_tables(spark, transform, windowed):
    raw = readings(spark, *odd_readings())
    # Windows of 36 hours cut days in two.
    window = F.floor(F.unix_timestamp("period") / (36 * 3600)) if windowed else None
    hourly = transform(transform_demand(raw, window=window))
    sparse = transform_demand(raw, densify=False)
    daily = densify_days(written(transform(sparse)), sparse, window)
    assert daily.columns == hourly.columns and daily.count() > transform(sparse).count()
    assert table(daily) == table(hourly)


def test_summary_of_observed_sides_is_that_of_the_grid(spark):
    raw = readings(spark, *odd_readings())
    unique = keep_last(normalize_readings(raw), schemas.READING_KEY, "ordinal")
    dense, sparse = (written(sides_of_readings(unique, densify=d)) for d in (True, False))
    performance = transform_forecast_performance(demand_of(dense))
    want = summary_of(dense, performance)
    got = summary_of_observed(sparse, written(transform_forecast_performance(demand_of(sparse))), written)
    assert got.columns == want.columns and table(got) == table(want) and got.count() == 6


def test_daily_tables_build_no_hour_grid(spark):
    raw = readings(spark, *odd_readings())
    sparse = transform_demand(raw, densify=False)
    for transform in (transform_demand_daily, transform_forecast_performance):
        plan = plan_of(densify_days(transform(sparse)))
        assert "date_cell" in plan and "period_cell" not in plan
    observed = sides_of_readings(raw, densify=False)
    unkept = summary_of_observed(observed, transform_forecast_performance(demand_of(observed)), lambda df: df)
    assert "_cell" not in plan_of(unkept)
    assert "period_cell" in plan_of(transform_demand(raw, keep=lambda df: df))


def test_two_results_over_one_table_do_not_disturb_each_other(spark):
    from catalog.queries import Readings

    raw = readings(spark, *odd_readings())
    first = Readings(raw).daily()
    second = Readings(raw).daily()
    want = table(first)
    del first
    gc.collect()
    assert table(second) == want and not spark._jsparkSession.sharedState().cacheManager().lookupCachedData(second._jdf).isDefined()
