from collections import defaultdict

from frames import table
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from gridpulse.operators.dedupe import (
    duplicate_keys,
    duplicated_rows,
    keep_last,
    merge_rows,
    overlay,
)

SCHEMA = "k string, n bigint, v double"
ROWS = st.lists(
    st.tuples(st.sampled_from("abcd"), st.none() | st.floats(-9, 9)), max_size=12
)
QUICK = settings(
    max_examples=6,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)


@given(ROWS)
@QUICK
def test_keep_last_and_duplicates_against_plain_python(spark, values):
    rows = [(k, i, v) for i, (k, v) in enumerate(values)]
    frame = spark.createDataFrame(rows, SCHEMA)
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    last = sorted((g[-1] for g in groups.values()), key=repr)
    assert table(keep_last(frame, ["k"], "n")) == last
    repeated = {k: len(g) for k, g in groups.items() if len(g) > 1}
    assert dict(table(duplicate_keys(frame, ["k"]))) == repeated
    members = sorted((r for r in rows if r[0] in repeated), key=repr)
    assert table(duplicated_rows(frame, ["k"]), "k", "n", "v") == members


def test_keep_last_with_one_hot_key_ranks_before_the_shuffle(spark):
    rows = [("hot" if i % 3 else f"k{i}", i, float(i)) for i in range(3000)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(8)
    result = keep_last(frame, ["k"], "n")
    assert result.count() == 1001
    assert table(result.filter("k = 'hot'")) == [("hot", 2999, 2999.0)]
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_merge_replaces_whole_rows_and_keeps_named_columns(spark):
    schema = "k string, v double, made string"
    stored = spark.createDataFrame([("a", 1.0, "old"), ("b", 2.0, "old")], schema)
    incoming = spark.createDataFrame([("b", None, "new"), ("c", 3.0, "new")], schema)
    assert table(merge_rows(stored, incoming, ["k"], keep=["made"])) == [
        ("a", 1.0, "old"),
        ("b", None, "old"),
        ("c", 3.0, "new"),
    ]


def test_overlay_prefers_the_newer_side(spark):
    base = spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int")
    newer = spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int")
    assert table(overlay(base, newer, ["k"])) == [("a", 1), ("b", 2), ("c", 2)]
