import random

import numpy as np
import pytest
from brute import components, shingles

from gridpulse.llm import neardup
from gridpulse.llm.minhash import band_keys, superminhash
from gridpulse.llm.neardup import near_duplicates


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def corpus():
    rng = random.Random(5)
    texts = {}
    for g in range(6):
        words = [f"g{g}w{rng.randrange(500)}" for _ in range(150)]
        for _ in range(12):
            texts[len(texts)] = edited(words, rng.randrange(6), rng)
    common = " ".join(f"c{k}" for k in range(60))
    for _ in range(20):  # one passage that many share
        texts[len(texts)] = common + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(60))
    for t in ("", "  ", "Two Words", "two words", "two  WORDS", "x " * 20000, None):
        texts[len(texts)] = t
    return texts


@pytest.mark.parametrize("block", [neardup.BLOCK, 5])
def test_components_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(neardup, "BLOCK", block)
    texts = corpus()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    rows = near_duplicates(docs).collect()
    want = components(texts)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want
    assert {r["doc_id"]: r["n_shingles"] for r in rows} == {i: len(shingles(t)) for i, t in texts.items()}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def test_large_exact_group_repeated_rows_and_null_ids(spark):
    rows = [(i, "the very same text of seven words") for i in range(3, 900)] + [(1, "other words here"), (1, "other words here"), (None, "other words here"), (None, "lonely")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_duplicates(docs).collect()
    assert len(got) == len(rows)
    assert {r["component_id"] for r in got if r["doc_id"] and r["doc_id"] > 2} == {3}
    assert [r["kept"] for r in got if r["doc_id"] == 1] == [True, True]
    assert [r["component_id"] for r in got if r["doc_id"] is None] == [None, None]


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    values, offsets, truth = [], [0], []
    for _ in range(150):
        common, own = int(rng.integers(5, 400)), int(rng.integers(0, 60))
        shared = rng.integers(0, 2**63, common, dtype=np.uint64)
        for _ in range(2):
            values.append(np.r_[shared, rng.integers(0, 2**63, own, dtype=np.uint64)])
            offsets.append(offsets[-1] + len(values[-1]))
        truth.append(common / (common + 2 * own))
    found = superminhash(np.concatenate(values), np.array(offsets), 192)
    error = (found[::2] == found[1::2]).mean(1) - np.array(truth)
    assert abs(error.mean()) < 0.01 and error.std() < 0.035
    alone = superminhash(np.array([7], np.uint64), np.array([0, 1, 1]), 16)
    assert len(set(alone[0].tolist())) == 16 and (alone[1] == alone[1][0]).all()


def test_pairs_alike_in_an_earlier_band_only_by_bytes_are_compared():
    rng = np.random.default_rng(2)
    sets = []
    for _ in range(100):  # a hub and spokes near 0.85
        hub = rng.integers(0, 2**63, 240, dtype=np.uint64)
        sets += [np.unique(hub), *(np.unique(np.r_[hub[19 * k + 19 :], hub[: 19 * k], rng.integers(0, 2**63, 16, dtype=np.uint64)]) for k in range(2))]
    full = superminhash(np.concatenate(sets), np.r_[0, np.cumsum([len(x) for x in sets])], neardup.BANDS * neardup.ROWS)
    keys = band_keys(full, neardup.BANDS)
    same = np.zeros((3, neardup.BANDS * neardup.ROWS), np.uint8)  # all bytes agree
    compared = 0
    for g in range(0, len(sets), 3):
        for a, b in ((g, g + 1), (g, g + 2)):
            bands = np.flatnonzero(keys[a] == keys[b])
            if not len(bands) or not neardup.similar_sets(sets[a], sets[b], 85):
                continue
            pair = [a, b]
            for band in bands[:2].tolist():
                links = neardup.block_links(band, np.array(pair), np.array(pair), [sets[a], sets[b]], same[:2], keys[pair], 0, 85)
                assert links == ([(a, b)] if band == bands[0] else [])  # in the first band they share
            compared += bands[0] > 0
    assert compared > 50
