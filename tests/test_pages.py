import json
import os

import pytest
from frames import table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridpulse.operators.silver import transform_demand
from catalog.adapters import PAGE_NUMBER
from catalog.queries import Stored
from gridpulse.plans.pipeline import ingest_pages
from gridpulse.sources.pages import page_source, read_pages, split_pages
from gridpulse.sources.store import TableStore
from gridpulse.streaming.ingest import ingest_stream
from gridpulse import schemas


def row(period, kind, value, respondent="AVL"):
    return {
        "period": period,
        "respondent": respondent,
        "respondent-name": f"{respondent} area",
        "type": kind,
        "type-name": kind,
        "value": value,
        "value-units": "megawatthours",
    }


def page(folder, name, rows, payload=None):
    body = payload or {"response": {"data": rows}}
    (folder / name).write_text(json.dumps(body, indent=1))


def test_pages_keep_row_order_over_files(spark, tmp_path):
    page(tmp_path, "page-00010.json", [row("2024-01-01T00", "D", 3)])
    page(
        tmp_path,
        "page-00002.json",
        [row("2024-01-01T00", "D", None), row("2024-01-01T00", "D", "2")],
    )
    page(tmp_path, "page-00011.json", [])
    pages = read_pages(spark, str(tmp_path))
    assert pages.count() == 3
    assert table(transform_demand(pages), "demand_mwh") == [(2.0,)]


def test_files_of_several_pages_are_read_whole(spark, tmp_path):
    pages = [
        {"response": {"data": [row(f"2024-01-01T0{n}", "D", n)]}} for n in range(3)
    ]
    (tmp_path / "lines-1.json").write_text("\n".join(json.dumps(p) for p in pages) + "\n")
    (tmp_path / "pretty-2.json").write_text("\n".join(json.dumps(p, indent=2) for p in pages))
    (tmp_path / "joined-3.json").write_text("".join(json.dumps(p) for p in pages))
    found = table(read_pages(spark, str(tmp_path)).selectExpr("cast(ordinal as string) o", "value"))
    assert [value for _, value in found] == ["0", "1", "2"] * 3 and len({o for o, _ in found}) == 9


NAMES = st.text(st.sampled_from('{}[]":\\ \n\tabé,/\u2028'), max_size=12)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=st.lists(st.lists(st.lists(NAMES, max_size=3), min_size=1, max_size=4), min_size=1, max_size=4), gap=st.sampled_from(["", " ", "\n\n"]))
def test_pages_of_any_names_are_split_between_pages_only(spark, files, gap):
    texts = []
    for pages in files:
        bodies = [{"response": {"data": [dict(row("2024-01-01T00", "D", 1), **{"respondent-name": n}) for n in names]}} for names in pages]
        texts.append(gap.join(json.dumps(b, ensure_ascii=False) for b in bodies) + gap)
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "n int, value string")
    for r in frame.select("n", split_pages(F.col("value")).alias("pages")).collect():
        found = [[item["respondent-name"] for item in json.loads(p)["response"]["data"]] for p in r["pages"]]
        assert found == files[r["n"]]


def test_names_with_braces_are_read(spark, tmp_path):
    odd = 'Cal {old} {new} \\" } {'
    page(tmp_path, "page-1.json", [dict(row("2024-01-01T00", "D", 1), **{"respondent-name": odd})])
    (tmp_path / "page-2.json").write_text("".join(json.dumps({"response": {"data": [dict(row(f"2024-01-01T0{n}", "D", n), **{"respondent-name": odd})]}}) for n in (1, 2)))
    rows = read_pages(spark, str(tmp_path)).orderBy("ordinal").collect()
    assert [(r["value"], r["respondent-name"]) for r in rows] == [(str(n), odd) for n in (1, 1, 2)]
    (tmp_path / "page-3.json").write_text('{"response": {"note": "\x1e", "data": []}}')
    with pytest.raises(Exception, match="response.data"):
        read_pages(spark, str(tmp_path)).collect()


def test_order_over_folders(spark, tmp_path):
    for day, value in (("2024-01-10", 5), ("2024-01-02", 7), ("2024-01-11", 6)):
        folder = tmp_path / f"date={day}"
        folder.mkdir()
        page(folder, "0001.json", [row("2024-01-01T00", "D", value)])
    rows = read_pages(spark, str(tmp_path)).orderBy("ordinal")
    assert [r["value"] for r in rows.collect()] == ["7", "5", "6"]
    by_name = r"/(\d+)\.json"
    with pytest.raises(ValueError, match="share 1 number"):
        read_pages(spark, str(tmp_path), by_name)
    wide = tmp_path / "date=2024-1-10"
    wide.mkdir()
    page(wide, "0002.json", [])
    with pytest.raises(ValueError, match="widths"):
        read_pages(spark, str(tmp_path))


def test_source_reads_the_folders_of_its_window_only(spark, tmp_path):
    for day in range(1, 6):
        folder = tmp_path / f"date=2024-01-{day:02d}"
        folder.mkdir()
        body = [row(f"2024-01-{day:02d}T{h:02d}", "D", h) for h in (3, 20)]
        page(folder, "0001.json", body, {"broken": 1} if day == 5 else None)
    read = page_source(spark, str(tmp_path))
    rows = read("2024-01-02T12", "2024-01-04T03")
    assert [p for (p,) in table(rows, "period")] == [
        "2024-01-02T20", "2024-01-03T03", "2024-01-03T20", "2024-01-04T03"
    ]
    # The files of other dates are neither listed nor opened.
    assert sorted(f.rsplit("/", 2)[-2] for f in rows.inputFiles()) == [f"date=2024-01-0{d}" for d in (2, 3, 4)]
    assert read("2025-01-01T00", None).count() == 0
    with pytest.raises(Exception, match="response.data"):  # the broken page is read now
        read("2024-01-02T12", None).collect()


def test_page_without_data_or_number_fails(spark, tmp_path):
    page(tmp_path, "page-1.json", None, {"error": "over the limit"})
    with pytest.raises(Exception, match="response.data"):
        read_pages(spark, str(tmp_path)).collect()
    other = tmp_path / "other"
    other.mkdir()
    page(other, "page.json", [row("2024-01-01T00", "D", 1)])
    with pytest.raises(Exception, match="without number"):
        read_pages(spark, str(other)).collect()


def feed():
    """Pages that split hours, bring late hours and revise earlier ones."""
    hours = [f"2024-01-0{d}T{h:02d}" for d in (1, 2) for h in range(0, 24, 3)]
    first = [row(hour, "D", n + 1) for n, hour in enumerate(hours)]
    second = [row(hour, "DF", n + 2) for n, hour in enumerate(hours)]
    third = [row("2024-01-01T05", "D", 50), row("2024-01-02T21", "D", 7, "BRN")]
    fourth = [row(hours[3], "D", 99), row(hours[3], "NG", 4), row(hours[0], "TI", -2, "BRN")]
    return [first, second, third, fourth]


@pytest.fixture(scope="module")
def whole(spark, tmp_path_factory):
    """The tables of one batch with all pages."""
    root = tmp_path_factory.mktemp("whole")
    (root / "landed").mkdir()
    for n, rows in enumerate(feed(), 1):
        page(root / "landed", f"page-0000{n}.json", rows)
    store = TableStore(spark, str(root / "db"))
    ingest_pages(store, read_pages(spark, str(root / "landed")))
    return {spec.name: table(store.read(spec)) for spec in schemas.TABLES.values()}


@pytest.mark.parametrize(("order", "max_files"), [((1, 2, 3, 4), 1), ((4, 2, 1, 3), 1), ((3, 1, 4, 2), 1000)])
def test_tables_do_not_depend_on_how_pages_land(spark, tmp_path, whole, order, max_files):
    landed = tmp_path / "landed"
    landed.mkdir()
    store = TableStore(spark, str(tmp_path / "db"))
    pages = feed()
    for step, n in enumerate(order):
        name = f"page-0000{n}.json"
        page(landed, name, pages[n - 1])
        os.utime(landed / name, (1e9 + step, 1e9 + step))
    query = ingest_stream(store, str(landed), max_files=max_files)
    query.awaitTermination()
    assert query.exception() is None
    for spec in schemas.TABLES.values():
        assert table(store.read(spec)) == whole[spec.name], spec.name
    assert store.latest_bronze_period() == "2024-01-02T21:00:00Z"


def test_half_seen_hours_lose_nothing_and_the_summary_stays_ahead(spark, whole):
    demand = {r[0]: r[3:5] for r in whole["silver_demand"] if r[1] == "AVL"}
    assert demand["2024-01-02T00"] == (9.0, 10.0) and demand["2024-01-01T05"] == (50.0, None)
    assert demand["2024-01-01T09"] == (99.0, 5.0)
    summary = {r[0]: r[2] for r in whole["gold_regional_summary"]}
    assert summary == {"AVL": "2024-01-02T21", "BRN": "2024-01-02T21"}


def test_each_store_has_its_own_progress(spark, tmp_path):
    page(tmp_path, "page-00001.json", [row("2024-01-01T00", "D", 1)])
    for name in ("a", "b"):
        store = TableStore(spark, str(tmp_path.parent / f"{tmp_path.name}-{name}"))
        ingest_stream(store, str(tmp_path)).awaitTermination()
        assert store.read(schemas.SILVER_DEMAND).count() == 1


def test_a_landed_feed_has_few_files_and_keeps_its_order(spark, tmp_path):
    """80 pages of 500 rows lie in 16 files; the reader finds every row in its place."""
    events = spark.range(39_990).selectExpr(
        "id AS event_id",
        "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts",
        "id % 7 AS user_id",
        "'view' AS event_type",
        "CAST(id + 0.5 AS double) AS value",
        "'{}' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    stored = Stored(spark, str(tmp_path))
    folder, files = stored.land()
    landed = read_pages(spark, folder, PAGE_NUMBER).orderBy("ordinal")
    wanted = [r["value"] for r in stored.events.orderBy("ordinal").collect()]
    assert [r["value"] for r in landed.collect()] == wanted
    assert files == len(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).select("path").collect()) == 16
