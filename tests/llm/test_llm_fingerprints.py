import hashlib
import random

import pytest

from gridpulse.llm.fingerprints import (
    MAX_BYTES,
    chunk_ends,
    chunk_set,
    compare_with_successor,
    decode_fingerprint,
    encode_fingerprint,
    likeness,
    with_fingerprint,
)
from gridpulse.llm.tokens import np


def plain(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for i, (key, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        n = len(text) // 3
        edited = text[: len(text) - n] + following[:n]
        a, b = chunk_set(text), chunk_set(edited)
        out.append((key, len(text), hashlib.sha256(edited.encode()).hexdigest(), encode_fingerprint(a),
                    encode_fingerprint(b), likeness(a, b), likeness(a, chunk_set(following))))
    return sorted(out, key=repr)


rng = random.Random(3)
CASES = [
    [],
    [(1, "abc")],
    [(None, "x" * 100), (None, "b")],
    [(5, None), (5, "tt"), (5, "tt"), (3, "é" * 50), (None, ""), (9, "z")],
    [(rng.randrange(60), "".join(rng.choice("ab cdé") for _ in range(rng.randrange(300)))) for _ in range(120)],
    [(1, "long text " * 30000), (2, "other")],
]


@pytest.mark.parametrize("rows", CASES)
def test_successors_equal_the_plain_ones(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted([tuple(r) for r in compare_with_successor(docs).collect()], key=repr)
    assert got == plain(rows)


def test_chunks_cover_the_text_and_survive_shifts():
    rng = random.Random(1)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(800))
    data = np.frombuffer(text.encode(), np.uint8)
    ends = chunk_ends(data)
    assert ends[-1] == len(data) and all(0 < b - a <= MAX_BYTES for a, b in zip([0, *ends], ends))
    a = chunk_set(text)
    assert likeness(a, chunk_set("some words in front " + text)) > 0.97
    assert likeness(a, chunk_set(" ".join(f"v{rng.randrange(5000)}" for _ in range(800)))) < 0.05
    assert (decode_fingerprint(encode_fingerprint(a)) == a).all()
    assert likeness(chunk_set(""), chunk_set("")) == 1.0 and likeness(a, chunk_set("")) == 0.0


def test_chunks_are_those_of_a_byte_by_byte_gear_hash():
    from brute import gear_chunks

    from gridpulse.llm.fingerprints import _GEAR

    rng = random.Random(7)
    gear = _GEAR.tolist()
    texts = [bytes(rng.choices(range(256), k=n)) for n in (0, 1, 7, 8, 15, 16, 17, 95, 96, 97, 500, 4000)]
    texts += [b"a" * 300, b"ab" * 400, ("wörter und " * 90).encode()]
    for text in texts:
        ends = chunk_ends(np.frombuffer(text, np.uint8))
        assert [b - a for a, b in zip([0, *ends], ends)] == gear_chunks(text, gear)


def test_clashing_column_is_kept(spark):
    docs = spark.createDataFrame([(1, "a", "own"), (2, None, "own")], "doc_id long, text string, Fingerprint string")
    rows = with_fingerprint(docs).orderBy("doc_id").collect()
    assert [r["Fingerprint"] for r in rows] == ["own", "own"] and rows[1]["_fingerprint"] == ""
