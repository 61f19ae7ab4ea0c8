"""The corpus pipeline against its parts."""

import random

import pytest
from brute import components, statistics

import corpus_pipeline
from gridpulse.llm.queries import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and result, written and reread."""
    root = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = {}
    for name, stage in corpus_pipeline.STAGES:
        path = f"{root}/{name.replace(' ', '-')}"
        stage(spark, docs, SF_DIR).write.parquet(path)
        found[name] = (docs, spark.read.parquet(path))
        docs = found[name][1]
    return found


def test_columns(stages):
    for name, (before, after) in list(stages.items())[:-1]:
        assert after.dtypes == before.dtypes, name


def test_rules_reject_what_base_rules_reject_and_keep_clean_documents(spark, stages):
    before, after = stages["quality rules"]
    kept = {r["doc_id"] for r in after.collect()}
    for r in before.collect():
        n_words, *_, repeated = statistics(r["text"])
        if n_words < 10 or 100 * repeated > 20 * n_words:
            assert r["doc_id"] not in kept
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").filter("quality = 1").collect()
    base = {r["doc_id"]: statistics(r["text"]) for r in before.collect()}
    good = [r["doc_id"] for r in labels if r["doc_id"] in base and base[r["doc_id"]][0] >= 10 and 5 * base[r["doc_id"]][4] <= base[r["doc_id"]][0]]
    assert sum(i in kept for i in good) >= 0.98 * len(good)


def test_language_keeps_clean_documents(stages):
    before, after = stages["language id"]
    want = sorted(r["doc_id"] for r in before.collect() if any(c.isalpha() for c in r["text"] or ""))
    assert sorted(r["doc_id"] for r in after.collect()) == want


def test_language_rejects_letter_junk(spark):
    rng = random.Random(11)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kinds = ["bcdfghjklmnpqrstvwxz ", "0123456789abcdef", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "qxzwk  "]
    junk = [(-1 - i, "".join(rng.choice(kinds[i % 4]) for _ in range(200 + 40 * i))) for i in range(40)]
    planted = spark.createDataFrame([(i, t, None, "junk", len(t)) for i, t in junk], docs.schema)
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, docs.unionByName(planted), SF_DIR).collect()}
    assert not kept & {i for i, _ in junk}
    letters = {r["doc_id"] for r in docs.collect() if any(c.isalpha() for c in r["text"] or "")}
    assert len(kept) >= 0.99 * len(letters) and kept <= letters


def test_one_document_of_each_group_stays(stages):
    before, after = stages["near dedup"]
    root = components({r["doc_id"]: r["text"] for r in before.collect()})
    assert sorted(r["doc_id"] for r in after.collect()) == sorted(set(root.values()))


def test_mixing_repeats_and_packing_holds_all(stages):
    before, after = stages["mixing"]
    assert {r["doc_id"] for r in after.collect()} <= {r["doc_id"] for r in before.collect()}
    assert stages["packing"][1].count() == after.count() > 0


def test_dedup_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "A b c d e f"), (None, "x y"), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect()
    assert sorted([r["doc_id"] for r in got], key=repr) == [1, 4, None]


def test_dedup_keeps_every_text_of_an_id(spark):
    words = [f"w{k}" for k in range(60)]
    first, near, other = " ".join(words), " ".join(words[:-1]), " ".join(f"x{k}" for k in range(30))
    rows = [(1, first), (7, near), (7, other), (7, other), (8, "y " * 9 + "z"), (8, None), (9, other)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.near_dedup(spark, docs, SF_DIR)
    assert got.columns == docs.columns
    # Id 7's near copy of 1 goes; of its other text and 9's, the one with the plain id stays.
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr) == sorted([(1, first), (8, "y " * 9 + "z"), (8, None), (9, other)], key=repr)


def test_run_over_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SF_DIR}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_run_gives_the_last_stages_rows(spark, stages):
    result = corpus_pipeline.run(spark, SF_DIR)
    assert result.count() == stages["packing"][1].count()
    assert {"bucket", "batch", "slot", "padding"} <= set(result.columns)


@pytest.mark.parametrize("name", [n for n in queries() if n.startswith("op")])
def test_queries_return_their_columns(spark, name):
    columns = {
        "op1_sharding": ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"],
        "op2_near_duplicates": ["doc_id", "n_shingles", "component_id", "kept"],
        "op5_toxicity": ["doc_id", "held_out", "score", "predicted"],
        "op6_language_id": ["doc_id", "held_out", "lang_pred", "score"],
        "op7_quality_rules": ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
        "op8_quality_classifier": ["doc_id", "held_out", "score", "predicted"],
        "op9_url_filters": ["page_id", "host", "path", "rule", "verdict"],
        "op10_fingerprints": ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        "op11_merkle_manifest": ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"],
        "op12_filter_audit": ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"],
        "op13_byte_bpe": ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
    }
    result = queries()[name](spark, SF_DIR)
    assert set(columns.get(name, ["doc_id"])) <= set(result.columns)
    table = "pages" if name.startswith("op9") else "documents"
    rows = result.count()
    assert rows > 0 and (name in ("op3_mixing", "op12_filter_audit") or rows == spark.read.parquet(f"{SF_DIR}/{table}.parquet").count())
