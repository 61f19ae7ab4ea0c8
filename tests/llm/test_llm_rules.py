import random

import numpy as np
import pyarrow as pa
import pytest
from brute import statistics

from gridpulse.llm.boosting import fit_trees
from gridpulse.llm.rules import FEATURES, judge_quality, text_statistics, train_rules

TEXTS = ["", None, "a", "\n\n", "a\na\na", "x y z\r\nx y z\r\n", "a b c d e a b c d e", "é ü", " \t ", "one\u00a0word",
         "# * $", "a b c d e f " * 3, "line\n" * 40, "Wort " * 5000]


def test_statistics_equal_the_plain_ones():
    random.seed(7)
    texts = TEXTS + ["".join(random.choice("ab \n#é") for _ in range(random.randrange(200))) for _ in range(200)]
    base, features = text_statistics(pa.array(texts))
    assert [tuple(row) for row in base.tolist()] == [statistics(t) for t in texts]
    assert np.isfinite(features).all()
    sliced, _ = text_statistics(pa.array(texts).slice(5, 4))
    assert sliced.tolist() == base[5:9].tolist()


def test_trees_learn_and_stay_monotonic():
    rng = np.random.default_rng(0)
    x = rng.random((3000, 3))
    y = ((x[:, 0] < 0.6) & (x[:, 1] > 0.3)).astype(float)
    trees = fit_trees(x, y, np.array([-1, 0, 0]), trees=30)
    assert ((trees.probability(x) > 0.5) == (y > 0)).mean() > 0.97
    low, high = x.copy(), x.copy()
    high[:, 0] += rng.random(len(x))
    assert (trees.margin(high) <= trees.margin(low) + 1e-12).all()


@pytest.fixture(scope="module")
def judged(spark):
    good = [(i, " ".join(f"w{(i * 31 + k * 7) % 997}" for k in range(40)), 1) for i in range(120)]
    bad = [(1000 + i, " ".join(f"w{(i * 17 + k * 5) % 997}%%%" for k in range(40)), 0) for i in range(60)]
    rows = good + bad
    docs = spark.createDataFrame([(i, t, "own") for i, t, _ in rows], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, q) for i, _, q in rows], "doc_id long, quality int")
    return docs, labels, train_rules(docs, labels)


def test_symbols_are_rejected_and_clashing_names_kept(spark, judged):
    docs, _, trees = judged
    extra = spark.createDataFrame([(None, None, "own"), (5000, "", "own"), (5000, "", "own")], docs.schema)
    result = judge_quality(docs.unionByName(extra), trees)
    assert result.columns[:3] == docs.columns and result.columns[-1] == "_kept"
    rows = result.collect()
    assert len(rows) == 183 and all(r["kept"] == "own" for r in rows)
    by_id = {r["doc_id"]: r for r in rows}
    assert all(by_id[i]["_kept"] for i in range(120))
    assert not any(by_id[1000 + i]["_kept"] for i in range(60))
    assert by_id[None]["base_failed"] and by_id[5000]["base_failed"] and not by_id[5000]["_kept"]


def test_without_labels_or_rows(spark, judged):
    docs, labels, _ = judged
    trees = train_rules(docs, labels.limit(0))
    assert list(trees.value) == [] and len(FEATURES) == 12
    kept = judge_quality(docs.drop("kept"), trees).filter("kept").count()
    assert kept == 180  # only the base rules speak
    assert judge_quality(docs.limit(0), trees).count() == 0
