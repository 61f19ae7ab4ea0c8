import pytest
from frames import readings, table
from pyspark.sql import functions as F

from gridpulse import DataQualityError, schemas
from gridpulse.operators.normalize import normalize_readings
from gridpulse.operators.silver import transform_demand, transform_generation
from gridpulse.schemas import BRONZE_READINGS, GOLD_REGIONAL_SUMMARY, SILVER_DEMAND
from gridpulse.schemas import SILVER_GENERATION
from gridpulse.sources.store import TableStore


def bronze_rows(spark, *rows):
    return normalize_readings(readings(spark, *rows)).selectExpr(
        "*", "'label' AS type_name", "'megawatthours' AS value_units"
    )


def generation_of(spark, *rows):
    return transform_generation(readings(spark, *[(p, r, "NG", v) for p, r, v in rows]))


def test_missing_table_reads_as_empty(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    for spec in schemas.TABLES.values():
        frame = store.read(spec)
        assert frame.columns == spec.columns and frame.count() == 0
    assert store.latest_bronze_period() is None


def test_bronze_keeps_the_last_row_per_key(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    sent = store.upsert(
        BRONZE_READINGS,
        bronze_rows(
            spark,
            ("2024-01-01T00", "AVL", "D", 1),
            ("2024-01-01T00", "AVL", "D", 2),
            ("2024-01-02T03", "AVL", "D", "bad"),
        ),
        "ordinal",
    )
    assert sent == 2
    assert table(store.read(BRONZE_READINGS), "period", "value") == [
        ("2024-01-01T00", 2.0),
        ("2024-01-02T03", None),
    ]
    assert store.latest_bronze_period() == "2024-01-02T03:00:00Z"


def test_upsert_replaces_inserts_and_leaves_other_dates_alone(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    store.upsert(
        SILVER_GENERATION,
        generation_of(
            spark,
            ("2024-01-01T00", "AVL", 1),
            ("2024-01-02T00", "AVL", 2),
            ("2024-01-03T00", "AVL", 3),
        ),
    )
    paths = store.scan(SILVER_GENERATION).select("period_date", "_metadata.file_path")
    before = dict(table(paths.selectExpr("cast(period_date AS string)", "file_path")))
    # The batch spans the dates around the second, and does not touch it.
    store.upsert(
        SILVER_GENERATION,
        generation_of(
            spark, ("2024-01-01T00", "AVL", None), ("2024-01-03T01", "BRN", 9)
        ),
    )
    assert table(store.read(SILVER_GENERATION), "period", "net_generation_mwh") == [
        ("2024-01-01T00", None),
        ("2024-01-02T00", 2.0),
        ("2024-01-03T00", 3.0),
        ("2024-01-03T01", 9.0),
    ]
    paths = store.scan(SILVER_GENERATION).select("period_date", "_metadata.file_path")
    after = dict(table(paths.selectExpr("cast(period_date AS string)", "file_path")))
    assert after["2024-01-02"] == before["2024-01-02"]
    assert after["2024-01-03"] != before["2024-01-03"]


def test_repeated_key_without_an_order_is_refused(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    twice = generation_of(spark, ("2024-01-01T00", "AVL", 1), ("2024-01-01T00", "AVL", 2))
    with pytest.raises(DataQualityError, match="grain.*2"):
        store.upsert(SILVER_GENERATION, twice)
    assert store.read(SILVER_GENERATION).count() == 0
    assert store.files.names(f"{store.path(SILVER_GENERATION)}/data") == []


def test_write_that_dies_leaves_the_old_table(spark, tmp_path, monkeypatch):
    store = TableStore(spark, str(tmp_path / "db"))
    store.upsert(SILVER_GENERATION, generation_of(spark, ("2024-01-01T00", "AVL", 1)))
    before = store.read(SILVER_GENERATION)

    def dies(*args):
        raise OSError("disk gone")

    for step in ("_write", "commit"):
        with monkeypatch.context() as patched:
            patched.setattr(TableStore, step, dies)
            with pytest.raises(OSError):
                store.upsert(SILVER_GENERATION, generation_of(spark, ("2024-01-01T05", "BRN", 9)))
        assert table(store.read(SILVER_GENERATION), "respondent") == [("AVL",)]
    # An unfinished version file counts for nothing.
    store.files.create(f"{store.path(SILVER_GENERATION)}/versions/0000000002.json", '{"period')
    assert table(store.read(SILVER_GENERATION), "respondent") == [("AVL",)]
    assert table(before, "respondent") == [("AVL",)]


def test_two_writers_of_one_version(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    a = store.stage(SILVER_GENERATION, generation_of(spark, ("2024-01-01T00", "AVL", 1)))
    b = store.stage(SILVER_GENERATION, generation_of(spark, ("2024-01-01T00", "BRN", 2)))
    first, second = store.merge(a), store.merge(b)
    store.commit(SILVER_GENERATION, *first)
    with pytest.raises(Exception, match="exist"):
        store.commit(SILVER_GENERATION, *second)
    store.publish(b)
    assert table(store.read(SILVER_GENERATION), "respondent") == [("AVL",), ("BRN",)]


def test_vacuum_keeps_the_newest_version_only(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    for value in (1, 2, 3):
        rows = [(f"2024-01-0{d}T00", "AVL", value) for d in range(value, 4)]
        store.upsert(SILVER_GENERATION, generation_of(spark, *rows))
    want = table(store.read(SILVER_GENERATION))
    assert len(store.files.names(f"{store.path(SILVER_GENERATION)}/versions")) == 3
    store.vacuum(SILVER_GENERATION)
    assert table(store.read(SILVER_GENERATION)) == want
    assert len(store.files.names(f"{store.path(SILVER_GENERATION)}/versions")) == 1
    writes = store.files.names(f"{store.path(SILVER_GENERATION)}/data")
    assert len(writes) == 3  # one date each comes from each write


def test_later_order_stays(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    rows = bronze_rows(spark, *[("2024-01-01T00", "AVL", "D", v) for v in (1, 2, 3)])
    for ordinal in (1, 2, 0):
        piece = rows.filter(f"ordinal = {ordinal}")
        store.publish(store.stage(BRONZE_READINGS, piece, "ordinal"), by_order=True)
    assert table(store.read(BRONZE_READINGS), "value") == [(3.0,)]


def test_checkpoint_reads_one_date(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    rows = [(f"2024-02-{d:02d}T07", "AVL", "D", d) for d in range(1, 9)]
    store.upsert(BRONZE_READINGS, bronze_rows(spark, *rows), "ordinal")
    newest = store.latest_bronze()
    assert all("period_date=2024-02-08" in file for file in newest.inputFiles())
    assert store.latest_bronze_period() == "2024-02-08T07:00:00Z"


def test_replay_changes_nothing_and_empty_writes_nothing(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    batch = generation_of(spark, ("2024-01-01T00", "AVL", 1), ("2024-01-01T00", "BRN", 2))
    assert store.upsert(SILVER_GENERATION, batch) == 2
    first = table(store.scan(SILVER_GENERATION).withColumn(
        "transformed_at", F.col("transformed_at").cast("string")))
    assert store.upsert(SILVER_GENERATION, batch) == 2
    assert store.upsert(SILVER_GENERATION, batch.limit(0)) == 0
    again = table(store.scan(SILVER_GENERATION).withColumn(
        "transformed_at", F.col("transformed_at").cast("string")))
    assert first == again


def test_summary_is_upserted_by_region(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    columns = GOLD_REGIONAL_SUMMARY.columns

    def summary(**demand_by_region):
        rows = [(r, r, None, v, None, None, None, None, None)
                for r, v in demand_by_region.items()]
        return spark.createDataFrame(rows, GOLD_REGIONAL_SUMMARY.schema)

    store.upsert(GOLD_REGIONAL_SUMMARY, summary(AVL=1.0, BRN=2.0, TEX=3.0))
    store.upsert(GOLD_REGIONAL_SUMMARY, summary(BRN=5.0))
    assert store.read(GOLD_REGIONAL_SUMMARY).columns == columns
    got = table(store.read(GOLD_REGIONAL_SUMMARY), "respondent", "latest_demand_mwh")
    assert got == [("AVL", 1.0), ("BRN", 5.0), ("TEX", 3.0)]


def test_range_read_is_half_open_and_prunes_dates(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    rows = [(f"2024-01-{d:02d}T{h:02d}", "AVL", "D", h) for d in (1, 2, 3) for h in (0, 12)]
    store.upsert(SILVER_DEMAND, transform_demand(readings(spark, *rows)))
    part = store.read_periods(SILVER_DEMAND, "2024-01-01T12", "2024-01-03T00")
    assert [p for (p,) in table(part, "period")] == [
        "2024-01-01T12",
        "2024-01-02T00",
        "2024-01-02T12",
    ]
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period_date" in plan
    empty = store.read_periods(SILVER_DEMAND, "2030-01-01T00")
    assert empty.columns == SILVER_DEMAND.columns and empty.count() == 0


def test_non_finite_values_are_stored_as_null(spark, tmp_path):
    store = TableStore(spark, str(tmp_path / "db"))
    frame = generation_of(spark, ("2024-01-01T00", "AVL", 1)).withColumn(
        "net_generation_mwh", F.lit(float("inf"))
    )
    store.upsert(SILVER_GENERATION, frame)
    assert table(store.read(SILVER_GENERATION), "net_generation_mwh") == [(None,)]
