"""Learned operators: held-out accuracy and defined results."""

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from gridpulse.llm.langid import farthest_distance, identify_language, learn_profiles
from gridpulse.llm.quality import score_quality, train_quality
from gridpulse.llm.toxicity import BLOCK, BlockMaxIndex, score_toxicity, train_toxicity

WORDS = {
    "en": "the and that with have this from they will would there their what about which when make like time just know people into year your good some could them other than then".split(),
    "de": "der die und das nicht ist ein eine mit sich auf für werden auch von dem haben wird sind einer über nach schon mehr durch können gegen noch dann unter".split(),
}
EXTRA = [(None, None), (-1, None), (-2, ""), (-3, "12 34 !!"), (-4, "the " * 30000), (-4, "the " * 30000)]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = []
    for i in range(400):
        lang = "de" if i % 3 == 0 else "en"
        words = [rng.choice(WORDS[lang]) for _ in range(60)]
        toxic, good = int(i % 5 == 0), int(i % 4 != 1)
        if toxic:
            for _ in range(3):
                words[rng.randrange(60)] = rng.choice(["zounds", "blackguard", "Knave"])
        if not good:
            words = [w + "%%%" for w in words]
        rows.append((i, " ".join(words), lang, toxic, good))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, toxic int, quality int").cache()


@pytest.fixture(scope="module")
def with_extra(spark, docs):
    extra = spark.createDataFrame(EXTRA, "doc_id long, text string")
    return docs.select("doc_id", "text").unionByName(extra)


def held(row, folds, fold):
    return zlib.crc32(str(row["doc_id"]).encode()) % folds == fold


def test_language(spark, docs, with_extra):
    profiles = learn_profiles(docs, folds=5, held_out=0)
    truth = {r["doc_id"]: r["lang"] for r in docs.collect()}
    rows = identify_language(with_extra, profiles).collect()
    assert len(rows) == 406
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in rows if r["doc_id"] in truth)
    other = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in rows if r["doc_id"] not in truth}
    assert other[None] == other[-1] == other[-2] == other[-3] == ("und", 0.0) and other[-4][0] == "en"
    assert all(0 <= r["score"] <= 1 for r in rows)
    none = learn_profiles(docs.limit(0))
    assert {r["lang_pred"] for r in identify_language(docs, none).collect()} == {"und"}


def test_toxicity(spark, docs, with_extra):
    labels = docs.select("doc_id", "toxic")
    model = train_toxicity(docs, labels, folds=4, held_out=2)
    rows = score_toxicity(with_extra, model).collect()
    truth = {r["doc_id"]: r["toxic"] for r in docs.collect()}
    judged = [(r, truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth and held(r, 4, 2)]
    assert len(judged) > 50 and all(r["predicted"] == t for r, t in judged)
    assert len(rows) == 406 and all(0 <= r["score"] <= 1 for r in rows)
    other = [r for r in rows if r["doc_id"] not in truth]
    assert all(r["predicted"] == 0 and (r["evidence"] == []) == (not r["text"] or "the" not in r["text"]) for r in other)
    assert all(r["evidence"] for r, t in judged if t)
    one_label = train_toxicity(docs, labels.filter("toxic = 0"))
    assert {r["score"] for r in score_toxicity(with_extra, one_label).collect()} == {0.0}
    assert score_toxicity(docs.limit(0), train_toxicity(docs, labels.limit(0))).count() == 0


def test_rare_toxic_words_and_plain_texts_have_neighbours(spark):
    rng = random.Random(6)
    rows = []
    for i in range(300):
        words = [f"w{rng.randrange(400)}" for _ in range(30)]
        toxic = int(i % 8 == 0)
        if toxic:  # each insult is in two documents
            words[rng.randrange(30)] = f"insult{i // 16}"
        rows.append((i, " ".join(words), toxic))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train_toxicity(docs, docs.select("doc_id", "toxic"))
    new = [(1000 + k, " ".join([f"w{rng.randrange(400)}" for _ in range(29)] + ["insult3"] * (k % 2))) for k in range(40)]
    got = score_toxicity(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    assert all(len(r["evidence"]) == 3 for r in got)
    assert all(set(r["evidence"][:2]) == {48, 56} for r in got if r["doc_id"] % 2)
    score = [np.mean([r["score"] for r in got if r["doc_id"] % 2 == k]) for k in (0, 1)]
    assert score[1] > 2 * score[0]


def test_language_is_that_of_plain_profiles(spark, docs):
    from brute import letter_grams, out_of_place, ranked

    rng = random.Random(5)
    counts = {}
    for r in docs.collect():
        counts.setdefault(r["lang"], Counter()).update(letter_grams(r["text"]))
    profiles = {lang: ranked(c) for lang, c in counts.items()}
    kinds = [WORDS["en"], WORDS["de"], WORDS["en"] + WORDS["de"], ["zq", "xx7x", "Ünd", "漢字"], ["the", "der"]]
    texts = [" ".join(rng.choice(rng.choice(kinds)) for _ in range(rng.choice([1, 2, 5, 300]))) for _ in range(80)] + ["", "77", "a", "the der"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in identify_language(frame, learn_profiles(docs), distance=True).collect():
        want = out_of_place(r["text"], profiles)
        if want is None:
            assert (r["lang_pred"], r["score"], r["lang_distance"]) == ("und", 0.0, 300.0)
        else:
            assert r["lang_distance"] == pytest.approx(want[0]) and r["lang_pred"] == want[1]


def test_every_labelled_document_shapes_profiles_and_limit(spark):
    """12,000 documents of a language, more than any sample of 5,000: counts are those of all."""
    from brute import letter_grams, ranked

    rng = random.Random(9)
    words = ["ab", "bcd", "cade", "da"]
    texts = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(3)) if i % 4 else " ".join(rng.choices(words, k=6)) for i in range(12_000)]
    docs = spark.createDataFrame([(i, t, "xx") for i, t in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    counts = Counter()
    for t in texts:
        counts.update(letter_grams(t))
    want = [sum((1 if c == " " else ord(c)) << 21 * (len(g) - 1 - i) for i, c in enumerate(g)) for g in ranked(counts)]
    profiles = learn_profiles(docs)
    assert profiles.grams[np.argsort(profiles.ranks[:, 0])].tolist() == want
    found = identify_language(docs, profiles, distance=True)
    far = np.percentile([r["lang_distance"] for r in found.collect()], 99.9)
    assert farthest_distance(found) == pytest.approx(far + (300 - far) / 4)


def random_vectors(rng, n, terms, low=1, high=9):
    vectors = []
    for _ in range(n):
        own = np.sort(rng.choice(terms, rng.integers(low, high), replace=False)).astype(np.int32)
        weights = (rng.integers(1, 4, len(own)) / 4).astype(np.float32)  # so that cosines tie
        vectors.append((own, weights))
    return vectors


def plain_nearest(ids, vectors, query, k, without=None):
    terms, weights = query
    own = dict(zip(terms.tolist(), weights.tolist()))
    found = []
    for i, (theirs, values) in zip(ids, vectors):
        score = 0.0
        for t, v in zip(theirs.tolist(), values.tolist()):
            score += own.get(t, 0.0) * v
        if score and i != without:
            found.append((-score, i))
    return [(i, -score) for score, i in sorted(found)[:k]]


def test_block_max_search_is_exact():
    rng = np.random.default_rng(4)
    vectors = random_vectors(rng, 5 * BLOCK + 7, 40)
    ids = rng.permutation(1000)[: len(vectors)].tolist()
    queries = [(t, w.astype(float)) for t, w in random_vectors(rng, 70, 40) + vectors[:20]]
    for heads in (0, 7, 40):
        index = BlockMaxIndex(ids, vectors, 40, heads)
        for k in (1, 16, 400):
            for query, (places, cosines, _, _) in zip(queries, index.nearest(queries, k)):
                assert list(zip(index.ids[places].tolist(), cosines.tolist())) == plain_nearest(ids, vectors, query, k)
        value = rng.integers(0, 3, 40).astype(float)
        for (terms, weights), (places, _, valued, _) in zip(queries, index.nearest(queries, 16, value=value)):
            own = dict(zip(terms.tolist(), (weights * value[terms]).tolist()))
            assert valued.tolist() == [sum(own.get(t, 0.0) * w for t, w in zip(*(x.tolist() for x in index.vector(p)))) for p in places]
    own = [index.vector(place) for place in (11, 12)]
    for place, query, (near, *_) in zip((11, 12), own, index.nearest(own, 16, without=[11, 12])):
        assert [i for i, _ in plain_nearest(ids, vectors, query, 16, index.ids[place])] == index.ids[near].tolist()
    assert len(BlockMaxIndex([], [], 40).nearest(queries[:1])[0][0]) == 0


def test_blocks_that_cannot_hold_a_neighbour_are_skipped():
    rng = np.random.default_rng(6)
    vectors = []
    for kind in range(20):  # twenty languages with a word in common
        for own, weights in random_vectors(rng, 3 * BLOCK, 30, 4, 12):
            vectors.append((np.r_[0, own + 1 + 30 * kind].astype(np.int32), np.r_[0.125, weights].astype(np.float32)))
    for heads in (30, 601):
        index = BlockMaxIndex(list(range(len(vectors))), vectors, 601, heads)
        queries = [(own, weights.astype(float)) for own, weights in vectors[::37]]
        found = index.nearest(queries, 16)
        for query, (places, cosines, _, _) in zip(queries, found):
            assert list(zip(index.ids[places].tolist(), cosines.tolist())) == plain_nearest(range(len(vectors)), vectors, query, 16)
        assert np.mean([n for *_, n in found]) < len(vectors) / BLOCK / 2


def test_toxic_near_copies_of_clean_texts_teach(spark):
    rng = random.Random(17)
    rows = []
    for i in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(80)]
        rows.append((2 * i, " ".join(words), 0))
        words[rng.randrange(80)] = "insult"
        rows.append((2 * i + 1, " ".join(words), 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train_toxicity(docs, docs.select("doc_id", "toxic"))
    assert len(model.toxic.ids) == len(model.clean.ids) == 60  # none is left out
    new = [(1000 + k, " ".join([f"w{rng.randrange(3000)}" for _ in range(79)] + ["insult"] * (k % 2))) for k in range(40)]
    again = score_toxicity(spark.createDataFrame(new, "doc_id long, text string"), model).collect()
    assert all((r["score"] >= 0.3) == (r["doc_id"] % 2 == 1) for r in again)
    # Equal texts get the same bits in any batch.
    mixed = spark.createDataFrame(new * 2 + [(r[0], r[1]) for r in rows[:50]], "doc_id long, text string").repartition(3)
    scores = {r["text"]: r["score"] for r in again}
    assert all(r["score"] == scores[r["text"]] for r in score_toxicity(mixed, model).collect() if r["text"] in scores)


def test_copies_of_one_toxic_text_do_not_make_its_words_toxic(spark):
    rng = random.Random(18)
    story = [f"s{k}" for k in range(60)]
    rows = [(i, " ".join(story[:-1] + [f"end{i}"]), 1) for i in range(30)]
    rows += [(100 + i, " ".join(f"w{rng.randrange(500)}" for _ in range(60)), 0) for i in range(300)]
    rows += [(500 + i, " ".join([f"w{rng.randrange(500)}" for _ in range(59)] + ["insult"]), 1) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = train_toxicity(docs, docs.select("doc_id", "toxic"))
    told = spark.createDataFrame([(1, " ".join(rng.choices(story, k=6) + [f"w{rng.randrange(500)}" for _ in range(50)])), (2, "w1 w2 w3 insult " + " ".join(f"w{k}" for k in range(50)))], "doc_id long, text string")
    score = {r["doc_id"]: r["score"] for r in score_toxicity(told, model).collect()}
    assert score[2] >= 0.3 and score[1] < score[2]


def test_quality(spark, docs, with_extra):
    labels = docs.select("doc_id", "quality")
    network = train_quality(docs, labels, folds=3, held_out=1)
    rows = score_quality(with_extra, network).collect()
    truth = {r["doc_id"]: r["quality"] for r in docs.collect()}
    judged = [(r, truth[r["doc_id"]]) for r in rows if r["doc_id"] in truth and held(r, 3, 1)]
    assert len(judged) > 80 and all(r["predicted"] == t for r, t in judged)
    assert len(rows) == 406 and all(0 <= r["score"] <= 1 for r in rows)
    empty = {(r["score"], r["predicted"]) for r in rows if not r["text"]}
    assert len(empty) == 1 and empty.pop()[1] == 0
    # Equal texts get the same bits, however the rows are dealt.
    for parts in (1, 3, 7):
        again = score_quality(with_extra.repartition(parts, "text"), network).collect()
        assert {(r["text"], r["score"]) for r in again} == {(r["text"], r["score"]) for r in rows}
    none = train_quality(docs, labels.limit(0))
    assert {r["score"] for r in score_quality(docs, none).collect()} == {0.5}
    assert score_quality(docs.limit(0), network).count() == 0


def test_every_byte_of_a_long_text_counts(docs):
    import pyarrow as pa

    from gridpulse.llm.quality import fit_network, _training_chunks, _CHUNK_READ
    from gridpulse.llm.tokens import blocks

    rng = random.Random(0)
    good = [" ".join(rng.choice(WORDS["en"]) for _ in range(120)) for _ in range(60)]
    bad = [" ".join(rng.choice(WORDS["en"]) + "%%%" for _ in range(120)) for _ in range(60)]
    chunks = _training_chunks(pa.array(good + bad))[0].to_pylist()
    arrays = [np.frombuffer(c, np.uint8).reshape(-1, _CHUNK_READ) for c in chunks]
    network = fit_network(arrays, np.array([1.0] * 60 + [0.0] * 60))
    clean = " ".join(good[:20])
    texts = [clean, clean[: len(clean) // 2] + " " + " ".join(bad[:8]) + " " + clean[len(clean) // 2 :], clean + " " + " ".join(bad[:8])]
    scores = np.concatenate([network.block_scores(data, at) for _, _, data, at in blocks(pa.array(texts))])
    assert scores[1] < scores[0] and scores[2] < scores[0]


def test_a_score_does_not_depend_on_the_texts_around():
    from brute import network_score

    from gridpulse.llm.quality import ByteNetwork

    rng = np.random.default_rng(3)
    network = ByteNetwork(*(rng.normal(0, 1, shape).astype(np.float32) for shape in ((256, 4), (4, 16, 24), 24, 24)), 0.0).exact()
    texts = [rng.integers(33, 127, n, dtype=np.uint8) for n in [0, 1, 44, 52, 64, 108, 500, 512, 700, 5000] * 3]
    alone = [network.block_scores(t, np.array([0, len(t)]))[0] for t in texts]
    assert alone == [network_score(network, t.tobytes()) for t in texts]
    for _ in range(30):
        some = rng.integers(0, len(texts), rng.integers(1, 12))
        at = np.r_[0, np.cumsum([len(texts[k]) for k in some])]
        together = network.block_scores(np.concatenate([texts[k] for k in some]), at)
        assert together.tolist() == [alone[k] for k in some]
