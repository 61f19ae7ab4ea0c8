"""Operator 10, document fingerprints by content-defined chunking.

A gear hash rolls over the UTF-8 bytes and cuts where its top bits are zero.
Cutting is normalised: more bits must be zero before a chunk's normal size and
fewer after it, which narrows the spread of sizes. Since a cut depends on the 16
bytes before it only, text moved by an insertion is cut in the same places. A
fingerprint is the set of the chunks' digests with their lengths, and the
likeness of two is the share of the shorter one, in bytes, that both hold.

Null and empty texts have the empty fingerprint: they are alike (1.0) among
themselves and have nothing (0.0) in common with others. Equal texts have equal
fingerprints.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import small_batches, with_kernel
from gridpulse.llm.ranges import count_below
from gridpulse.llm.tokens import SpanHasher, mix

MIN_BYTES, NORMAL_BYTES, MAX_BYTES = 8, 24, 96
HARD_BITS, EASY_BITS = 5, 3
_GEAR = (mix(np.arange(1001, 1257, dtype=np.uint64)) >> np.uint64(48)).astype(np.uint16)
# A digest's low byte is its chunk's length.
_LENGTH = np.uint64(0xFF)

RESULT = (
    T.StructType()
    .add("doc_id", "long")
    .add("n_chars", "long")
    .add("edited_sha256", "string")
    .add("fingerprint", "string")
    .add("edited_fingerprint", "string")
    .add("near_edited", "double")
    .add("near_next", "double")
)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The 16-byte gear hash at each byte, by doubling the window four times."""
    h = _GEAR[data]
    for step in (1, 2, 4, 8):
        wider = h.copy()
        wider[step:] += h[:-step] << np.uint16(step)
        h = wider
    return h


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end; the last ends with it."""
    h = gear_hashes(data)
    places = np.flatnonzero(h >> np.uint16(16 - EASY_BITS) == 0)
    hard = (h[places] >> np.uint16(16 - HARD_BITS)) == 0
    ends: list[int] = []
    start = 0
    for end, is_hard in zip((places + 1).tolist(), hard.tolist()):
        while end - start > MAX_BYTES:
            start += MAX_BYTES
            ends.append(start)
        if end - start >= MIN_BYTES and (is_hard or end - start >= NORMAL_BYTES):
            ends.append(end)
            start = end
    while len(data) - start > MAX_BYTES:
        start += MAX_BYTES
        ends.append(start)
    if start < len(data):
        ends.append(len(data))
    return ends


def chunk_set(text: str | bytes) -> np.ndarray:
    """Distinct chunk digests of a text, sorted."""
    raw = text.encode() if isinstance(text, str) else text
    data = np.frombuffer(raw, np.uint8)
    if not len(data):
        return np.zeros(0, np.uint64)
    end = np.array(chunk_ends(data))
    start = np.r_[0, end[:-1]]
    digest = SpanHasher(data)(start, end)
    return np.unique((digest & ~_LENGTH) | (end - start).astype(np.uint64))


def encode_fingerprint(chunks: np.ndarray) -> str:
    return base64.b64encode(chunks.astype(">u8").tobytes()).decode()


def decode_fingerprint(fingerprint: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(fingerprint), ">u8").astype(np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Bytes in common chunks, over the bytes of the set that has fewer."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = a[b[at] == a]
    bytes_of = [int((x & _LENGTH).sum()) for x in (common, a, b)]
    return bytes_of[0] / min(bytes_of[1:])


def with_fingerprint(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame plus ``fingerprint``."""

    def kernel(column: pa.Array) -> list[pa.Array]:
        return [pa.array([encode_fingerprint(chunk_set(t or "")) for t in column.to_pylist()], pa.string())]

    return with_kernel(docs, text, T.StructType().add("fingerprint", "string"), kernel)


def in_descending_runs(docs: DataFrame, key: str) -> DataFrame:
    """Rows dealt to sorted runs by descending ``key`` (long), with ``run`` and ``follows``.

    Each run ends with a copy, marked ``follows``, of the first row of the next
    run; the last run's is the first row of all. So a row's successor is always
    the row after it in its task. Boundaries are keys that occur, about four
    for each shuffle partition; only they reach the driver. Null keys come last.
    """
    runs = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shares = [1 - i / runs for i in range(runs)]
    found = docs.agg(F.percentile_approx(key, shares, 100 * runs).alias("b"), F.max(key).alias("m")).first()
    first = sorted({*(found["b"] or ()), found["m"]} - {None})  # the first key of each run, ascending
    n = len(first)
    x = F.col(key)
    literals = [f"{v}L" for v in first]
    # Runs count from the largest key; a run holds the keys up to its first.
    below = F.coalesce(count_below(literals, x), F.lit(0)) if n else F.lit(0)
    own = F.greatest(F.lit(n - 1) - below, F.lit(0))
    # ``below`` is also the place of an equal boundary.
    is_first = F.coalesce(F.element_at(F.expr(f"array({', '.join(literals)})"), F.least(below + 1, F.lit(n))) == x, F.lit(False)) if n else F.lit(False)
    before = F.pmod(own - 1, F.lit(max(n, 1)))
    places = F.array(
        F.struct(own.alias("run"), F.lit(False).alias("follows")),
        F.struct(F.when(is_first, before).alias("run"), F.lit(True).alias("follows")),
    )
    placed = docs.select("*", F.explode(F.filter(places, lambda p: p["run"].isNotNull())).alias("place"))
    dealt = placed.select(*docs.columns, "place.run", "place.follows").repartition("run")
    rest = [c for c in docs.columns if c != key]
    return dealt.sortWithinPartitions("run", "follows", F.col(key).desc_nulls_last(), *rest)


def edit(text: str, following: str) -> str:
    """The last third of the code points replaced by the start of ``following``."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


def compare_with_successor(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likenesses.

    The successor is the next row by descending ``key`` (rows with equal keys by
    text, null keys last), and after the last row the first.
    """
    small_batches(docs.sparkSession)
    columns = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))

    def row_result(key, text: str, chunks: np.ndarray, following: str, next_chunks: np.ndarray) -> tuple:
        edited = edit(text, following)
        edited_chunks = chunk_set(edited)
        return (
            key,
            len(text),
            hashlib.sha256(edited.encode()).hexdigest(),
            encode_fingerprint(chunks),
            encode_fingerprint(edited_chunks),
            likeness(chunks, edited_chunks),
            likeness(chunks, next_chunks),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting = first = current = None  # (key, text, chunks) of the last row, the run's first row, and the run
        for batch in batches:
            out = []
            numbers = batch.column("run").to_pylist()
            copies = batch.column("follows").to_pylist()
            for row_key, row_text, number, copied in zip(
                batch.column("doc_id").to_pylist(), batch.column("text"), numbers, copies
            ):
                if number == current and copied and waiting is None:
                    continue  # a further copy with the same key
                row = (row_key, row_text := row_text.as_py(), chunk_set(row_text))
                if number != current:
                    if waiting is not None:
                        out.append(row_result(*waiting, *first[1:]))
                    current, first, waiting = number, row, None
                if waiting is not None:
                    out.append(row_result(*waiting, *row[1:]))
                waiting = None if copied else row
            yield _rows(out)
        if waiting is not None:  # only without any boundary: the first row follows
            yield _rows([row_result(*waiting, *first[1:])])

    return in_descending_runs(columns, "doc_id").mapInArrow(run, RESULT)


def _rows(out: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    columns = list(zip(*out)) if out else [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=RESULT.names)
