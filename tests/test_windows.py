from datetime import datetime, timedelta

import pytest
from frames import readings, table

from gridpulse.operators.normalize import normalize_readings
from gridpulse.operators.windows import (
    backfill_window_counts,
    backfill_windows,
    ingestion_window,
    latest_period,
    within,
)


def latest(spark, text):
    return spark.createDataFrame([(text,)], "latest_period string")


def window(spark, text, now, **options):
    return tuple(ingestion_window(latest(spark, text), now, **options).first())


def bounds(spark, start, end):
    return spark.createDataFrame([(start, end)], "start string, end string")


def chunks(spark, start, end, days):
    return table(backfill_windows(bounds(spark, start, end), days), "start", "end")


@pytest.mark.parametrize(
    ("newest", "start"),
    [
        ("2024-03-01T07:00:00Z", "2024-02-28T07"),  # over a leap day
        ("2023-03-01T07:21:43+00:00", "2023-02-27T07"),
        ("2022-01-01T09", "2021-12-30T09"),  # over a year's end
        ("2021-05-02T03:00:00+03:00", "2021-04-30T00"),
    ],
)
def test_start_is_the_lookback_before_the_checkpoint(spark, newest, start):
    soon = newest[:10] + " 23:00:00"
    assert window(spark, newest, soon) == (start, None)


def test_no_checkpoint_gives_no_window_and_a_bad_one_fails(spark):
    assert window(spark, None, "2022-07-14 05:00:00") == (None, None)
    with pytest.raises(Exception, match="Could not parse latest_period"):
        window(spark, "yesterday", "2022-07-14 05:00:00")


@pytest.mark.parametrize("lookback", [0, 48, 100])
def test_end_caps_a_stale_window_only(spark, lookback):
    newest = datetime(2020, 2, 28, 5)
    start = newest - timedelta(hours=lookback)
    for age, cut in ((60, False), (61, True), (9000, True)):
        now = start + timedelta(hours=age)
        got = window(spark, newest.isoformat(), str(now), lookback_hours=lookback, max_window_hours=60)
        end = (start + timedelta(hours=60)).strftime("%Y-%m-%dT%H") if cut else None
        assert got == (start.strftime("%Y-%m-%dT%H"), end)


def plain_chunks(start, end, days):
    form, hour = "%Y-%m-%dT%H", timedelta(hours=1)
    at, last, found = datetime.strptime(start, form), datetime.strptime(end, form), []
    while at <= last:
        found.append((at.strftime(form), min(at + timedelta(days=days), last).strftime(form)))
        at += timedelta(days=days) + hour
    return found


@pytest.mark.parametrize(
    ("start", "end", "days", "count"),
    [
        ("2024-02-27T13", "2024-03-03T09", 2, 3),  # over a leap day
        ("2021-12-30T22", "2022-01-02T01", 1, 3),  # over a year's end
        ("2019-06-01T00", "2019-06-08T01", 7, 2),  # a rest of one hour
        ("2020-05-05T05", "2020-05-05T05", 3, 1),
    ],
)
def test_chunks_are_closed_and_contiguous(spark, start, end, days, count):
    found = chunks(spark, start, end, days)
    assert found == plain_chunks(start, end, days) and len(found) == count


def test_bad_bounds_fail(spark):
    with pytest.raises(Exception, match="start is after its end"):
        chunks(spark, "2022-09-03T01", "2022-09-03T00", 4)
    with pytest.raises(Exception, match="Could not parse end"):
        chunks(spark, "2022-09-03T01", "soon", 4)


def test_counts_cover_empty_chunks_and_both_edges(spark):
    raw = normalize_readings(
        readings(
            spark,
            ("2023-12-31T23", "AVL", "D", 1),
            ("2024-01-01T00", "AVL", "D", 1),
            ("2024-01-02T00", "AVL", "D", 1),
            ("2024-01-02T01", "AVL", "D", 1),
            ("2024-01-05T03", "AVL", "D", 1),
            ("2024-01-05T04", "AVL", "D", 1),
            ("2024-01-02T00:30:00", "AVL", "D", 1),
        )
    )
    span = bounds(spark, "2024-01-01T00", "2024-01-05T03")
    assert table(backfill_window_counts(raw, span, 1)) == [
        (0, "2024-01-01T00", "2024-01-02T00", 2),
        (1, "2024-01-02T01", "2024-01-03T01", 1),
        (2, "2024-01-03T02", "2024-01-04T02", 0),
        (3, "2024-01-04T03", "2024-01-05T03", 1),
    ]


def test_source_range_is_closed_and_either_side_is_open(spark):
    raw = normalize_readings(
        readings(spark, *[(f"2024-01-01T{h:02d}", "AVL", "D", h) for h in range(5)])
    )

    def kept(start, end):
        return [v for (v,) in table(within(raw, start, end), "value")]

    assert kept("2024-01-01T01", "2024-01-01T03") == [1.0, 2.0, 3.0]
    assert kept("2024-01-01T03", None) == [3.0, 4.0]
    assert kept(None, "2024-01-01T00") == [0.0]
    assert table(latest_period(raw)) == [("2024-01-01T04",)]
    assert table(latest_period(raw.limit(0))) == [(None,)]
