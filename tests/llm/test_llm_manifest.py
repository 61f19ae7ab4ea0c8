"""Operators 11 to 13."""

import base64
import hashlib
import itertools
import random
import struct
from collections import defaultdict

import pytest
from brute import WORD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridpulse.llm import bpe, manifest
from gridpulse.llm.audit import audit_documents
from gridpulse.llm.manifest import fold_proof, group_key, inclusion_proofs, leaf_digest, proof_digest
from gridpulse.llm.stages import Shared

# -- 11 -------------------------------------------------------------------------


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([digest(*levels[-1][i : i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def siblings(levels, i):
    for nodes in levels[:-1]:
        run = i // 3 * 3
        yield "".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])
        i //= 3


def plain_manifest(rows):
    """(id, leaf, subroot, root, proof, root folded from a changed leaf) of rows (id, group, text)."""
    groups = defaultdict(list)
    for i, group, text in rows:
        groups[group].append((i is not None, i or 0, digest(framed(i), framed(group), framed(text))))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([leaf for *_, leaf in sorted(groups[g])]) for g in order}
    top = tree([trees[g][-1][0] for g in order])
    found = []
    for k, g in enumerate(order):
        for slot, (known, i, leaf) in enumerate(sorted(groups[g])):
            path = [*siblings(trees[g], slot), *siblings(top, k)]
            node = "changed"
            for left, right in path:
                node = digest(left, node, right)
            found.append((i if known else None, leaf, trees[g][-1][0], top[-1][0], digest(*itertools.chain(*path)), node))
    return sorted(found, key=repr)


def spark_manifest(spark, rows):
    docs = spark.createDataFrame(rows, "id long, source string, text string")
    leaves = docs.select(group_key(F.col("source")).alias("grp"), "id", leaf_digest([F.col(c) for c in docs.columns]).alias("digest"))
    proofs = inclusion_proofs(leaves, Shared(spark, "manifest"))
    path = F.col("path")
    found = proofs.select("id", "digest", "subroot", "root", proof_digest(path), fold_proof(F.lit("changed"), path), fold_proof(F.col("digest"), path))
    rows = [tuple(r) for r in found.collect()]
    assert all(r[3] == r[6] for r in rows)
    return sorted((r[:6] for r in rows), key=repr)


RNG = random.Random(5)
MANIFESTS = {
    "empty": [],
    "lone": [(7, "a", "x")],
    "groups": [(i, f"g{i % 5}", "t") for i in range(23)] + [(i, None, None) for i in range(4)] + [(3, "", ""), (4, "é", "\n")],
    "many groups": [(i, f"g{i % 800:x}", "t") for i in range(900)],
    "far ids": [(i, "s", "t") for i in (0, 63, 64, -1, -64, -65, 2**63 - 1, -(2**63), 2**40, -(2**40), 32767, 32768, 5)],
    "sparse": [(RNG.randrange(-(2**62), 2**62), RNG.choice("ab"), str(i)) for i in range(700)],
    "repeats": [(RNG.randrange(300), "a", RNG.choice("xyz")) for _ in range(900)] + [(None, "a", RNG.choice("xyz")) for _ in range(90)],
    "nulls alone": [(None, "n", "x"), (None, "n", None), (None, "n", "x")],
    "one id": [(9, "hot", str(i % 40)) for i in range(800)] + [(i, "hot", "t") for i in range(400)],
}


@pytest.mark.parametrize("name", MANIFESTS)
def test_manifest(spark, name):
    rows = MANIFESTS[name]
    assert spark_manifest(spark, rows) == plain_manifest(rows)


def test_manifest_with_the_heavy_words_broadcast(spark, monkeypatch):
    monkeypatch.setattr(manifest, "HEAVY", 0.3)
    rows = MANIFESTS["one id"] + MANIFESTS["repeats"]
    assert spark_manifest(spark, rows) == plain_manifest(rows)


def test_slots_come_from_bitmaps_not_from_a_sort_of_the_leaves(spark):
    leaves = spark.range(3000).select(F.lit("g").alias("grp"), "id", F.sha2(F.col("id").cast("string"), 256).alias("digest"))
    shared = Shared(spark, "manifest")
    placed = manifest._coordinates(leaves, shared)
    assert [r["slot"] for r in placed.orderBy("id").collect()] == list(range(3000))
    plan = placed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Window" not in plan


# -- 12 -------------------------------------------------------------------------


def plain_audit(docs, labels):
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    fails = []
    for i, text, _ in docs:
        text = text or ""
        words = WORD.findall(text)
        fails.append({
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 10 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and i > first[text],
        })
    good, toxic = ({i for i, *marks in labels if i is not None and marks[k] == 1} for k in (0, 1))
    parts = sorted({lang or "" for *_, lang in docs})
    removed_by = defaultdict(int)
    rows = []
    for part in parts:
        own = [(i, f) for (i, _, lang), f in zip(docs, fails) if (lang or "") == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, name in enumerate(order, 1):
                gone = [x for x in left if x[1][name]]
                left = [x for x in left if not x[1][name]]
                failing = [x for x in own if x[1][name]]
                only = [x for x in own if [k for k in "ABCDE" if x[1][k]] == [name]]
                removed_by[part, name] += len(gone)
                rows.append([part, "".join(order), step, len(left), len(gone), len(failing) - len(gone), len(only),
                             sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone), name])
    return sorted((*r[:-1], removed_by[r[0], r[-1]]) for r in rows)


def audit_case(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choices(words[: rng.choice([20, 400])], k=rng.choice([0, 1, 99, 100, 101, 140]))) for _ in range(n)]
    texts = [rng.choice([t, t, t.upper(), t + " #", "\x0b" + t + "\u2003x"]) for t in texts]
    docs = [(rng.choice([i, i, i, None, 3]), rng.choice([t, t, texts[0], texts[1], "", None]), rng.choice(["en", "de", "", None])) for i, t in enumerate(texts)]
    labels = [(rng.choice([i, i, None]), rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(n) for _ in range(rng.choice([0, 1, 2]))]
    return docs, labels


@pytest.mark.parametrize("case", [([], []), ([(1, None, None)], []), audit_case(1, 150), audit_case(2, 60)])
def test_audit(spark, monkeypatch, case):
    docs, labels = case
    monkeypatch.setattr("gridpulse.llm.audit.HEAVY", 0.1)  # so that both ways of looking up copies are taken
    # Helper names as columns are not read, whatever they hold.
    frame = spark.createDataFrame([(*d, "x", "x", "x") for d in docs], "doc_id long, text string, lang string, row_id string, part string, failed string")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert sorted(tuple(r) for r in audit_documents(frame, marks).collect()) == plain_audit(docs, labels)


# -- 13 -------------------------------------------------------------------------

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")


@pytest.fixture(scope="module", params=["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def coded(request):
    vocabulary = bpe.read_vocabulary(public_tokenizers.path(request.param), public_tokenizers.PATTERN)
    theirs = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary.ranks, special_tokens={})
    return vocabulary, bpe._Encoder(vocabulary), theirs


def ids(packed):
    return list(struct.unpack(f"<{len(packed) // 4}I", packed))


TEXT = st.lists(st.one_of(st.text(), st.text("abcde éß漢\u2003\n\t'ds19!", max_size=80), st.sampled_from(["  ", "\n\n", "<|endoftext|>", "'ll"])))


@settings(max_examples=150, deadline=None)
@given(parts=TEXT, size=st.sampled_from([1, 7, 1 << 20]))
def test_encoding_is_the_librarys(coded, parts, size):
    vocabulary, encoder, theirs = coded
    text = "".join(parts).encode("utf-8", "replace").decode()
    before, bpe.WINDOW = bpe.WINDOW, size
    try:
        (packed,) = encoder.encode([text])
    finally:
        bpe.WINDOW = before
    assert ids(packed) == theirs.encode_ordinary(text)
    assert bpe._decode(packed, bpe._token_bytes(vocabulary)) == text.encode()


def plain_merge(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not found:
            return [ranks[p] for p in parts]
        _, i = min(found)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_trees_merge_like_a_plain_scan(coded):
    vocabulary, encoder, _ = coded
    rng = random.Random(3)
    pieces = [bytes(rng.choices(b"aaabcde \xc3\xa9", k=rng.randrange(2, 66))) for _ in range(500)] + [b"a" * n for n in range(2, 66)]
    want = [plain_merge(p, vocabulary.ranks) for p in pieces]
    assert [bpe.merge_piece(p, vocabulary.ranks, encoder.longest) for p in pieces] == want
    assert encoder.merger.merge(pieces, 64) == want


def test_long_pieces(coded):
    _, encoder, theirs = coded
    rng = random.Random(4)
    for text in ("a" * 30_000, "".join(rng.choices("abcdefé", k=40_000)), "\n" * 5000 + "x" * 3000 + " " * 4000, "word " * 20_000):
        assert ids(encoder.encode([text])[0]) == theirs.encode_ordinary(text)


def test_encode_and_decode_frames(spark, coded):
    vocabulary, _, theirs = coded
    texts = [None, "", "Hello  world's", "Hello  world's", "<|endoftext|>", "żółć 123\n\n"]
    docs = spark.createDataFrame([(i if i % 2 else None, t, "own", "own") for i, t in enumerate(texts)], "doc_id long, text string, TOKEN_IDS string, decoded string")
    found = bpe.encode(docs, vocabulary)
    assert found.columns == [*docs.columns, "_token_ids"]
    back = bpe.decode(found, vocabulary, "_token_ids")
    rows = back.select("text", "TOKEN_IDS", "_decoded", bpe.token_count(F.col("_token_ids")).alias("n"), bpe.token_list(F.col("_token_ids")).alias("ids")).collect()
    for r in rows:
        want = theirs.encode_ordinary(r["text"] or "")
        assert (r["ids"], r["n"], bytes(r["_decoded"]), r["TOKEN_IDS"]) == (want, len(want), (r["text"] or "").encode(), "own")
    assert bpe.encode(docs.limit(0), vocabulary).count() == 0
    bad = spark.createDataFrame([(bytearray(struct.pack("<I", 4_000_000)),)], "token_ids binary")
    with pytest.raises(Exception, match="vocabulary"):
        bpe.decode(bad, vocabulary).collect()


def test_a_vocabulary_needs_every_byte(tmp_path):
    path = tmp_path / "ranks"
    path.write_bytes(b"".join(base64.b64encode(bytes([b])) + b" %d\n" % b for b in range(200)))
    with pytest.raises(ValueError, match="200"):
        bpe.read_vocabulary(str(path), public_tokenizers.PATTERN)
