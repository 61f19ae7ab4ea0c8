"""Operator 7, quality rules: boosted trees over document statistics.

Base statistics and two fixed rules come first; what passes them is judged by
gradient-boosted trees that a bounded sample of labelled documents has trained,
flattened to node arrays and constrained to be monotonic in the statistics that
can only speak against a document.

Null and empty texts have zero in every statistic and fail the first base rule.
Repeated rows are judged alike. Without any labelled example the trees keep
what the base rules keep.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gridpulse.llm.arrow import labelled_sample, with_kernel
from gridpulse.llm.boosting import Trees, fit_trees
from gridpulse.llm.tokens import (
    IS_SPACE,
    SpanHasher,
    blocks,
    find_words,
    mix,
    window_hashes,
    windows_in_documents,
)

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
MAX_EXAMPLES = 20_000
KEEP_FROM = 0.5

STATISTICS = T.StructType().add("n_words", "long").add("word_chars", "long").add("n_symbols", "long").add("n_dup_lines", "long").add("n_repeat_words", "long")

# Name and constraint: -1 where more of it may only lower the probability.
FEATURES = {
    "log_words": 0,
    "mean_word_chars": 0,
    "symbol_share": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "capital_share": 0,
    "distinct_word_share": 0,
    "punctuation_share": 0,
    "digit_share": 0,
    "words_per_line": 0,
    "same_as_previous_share": -1,
    "symbol_word_share": -1,
}

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_CAPITAL = np.zeros(256, bool)
_CAPITAL[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_PUNCTUATION &= ~_SYMBOL
_CODE_POINT = np.ones(256, bool)  # bytes that begin a code point
_CODE_POINT[0x80:0xC0] = False


def _per_document(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many flags are set in each document."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def _repeats(key: np.ndarray) -> np.ndarray:
    """Which keys occur more than once, and which of those are not the first."""
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    later, shared = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order] = same[:-1]
    shared[order] = same[:-1] | same[1:]
    return np.stack([shared, later])


def block_statistics(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Base statistics (documents x 5) and features of one block."""
    docs = len(at) - 1
    words = find_words(data, at)
    spans = SpanHasher(data)
    salt = mix(np.arange(1, docs + 1, dtype=np.uint64))  # makes hashes differ by document
    n_words = words.count
    word_chars = _per_document(_CODE_POINT[data] & ~IS_SPACE[data], at)
    n_symbols = _per_document(_SYMBOL[data], at)

    # Lines: cut at \n and at the ends of documents.
    breaks = data == 0x0A
    newline = np.flatnonzero(breaks)
    edges = np.unique(np.concatenate([newline + 1, at]))
    start, end = edges[:-1], edges[1:].copy()
    end -= (end > start) & breaks[end - 1] if len(end) else 0
    filled = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end = start[filled], end[filled]
    line_doc = np.searchsorted(at, start, "right") - 1
    lines = np.bincount(line_doc, minlength=docs)
    with np.errstate(over="ignore"):
        _, later = _repeats(mix(spans(start, end) + salt[line_doc]))
    n_dup_lines = np.bincount(line_doc[later], minlength=docs)

    values = spans(words.start, words.end)
    inside = windows_in_documents(words.doc, WINDOW)
    at_word = np.flatnonzero(inside)
    with np.errstate(over="ignore"):
        key = mix(window_hashes(values, WINDOW)[at_word] + salt[words.doc[at_word]])
        in_doc = mix(values + salt[words.doc])
    shared, _ = _repeats(key)
    cover = np.zeros(len(values) + 1, np.int64)
    np.add.at(cover, at_word[shared], 1)
    np.add.at(cover, at_word[shared] + WINDOW, -1)
    covered = np.cumsum(cover[:-1]) > 0
    n_repeat = np.bincount(words.doc[covered], minlength=docs)

    _, seen = _repeats(in_doc)
    distinct = n_words - np.bincount(words.doc[seen], minlength=docs)
    again = np.zeros(len(values), bool)
    again[1:] = in_doc[1:] == in_doc[:-1]
    marked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_SYMBOL[data], out=marked[1:])
    with_symbol = marked[words.end] > marked[words.start]

    def share(count: np.ndarray, whole: np.ndarray) -> np.ndarray:
        return count / np.maximum(whole, 1)

    features = np.stack(
        [
            np.log1p(n_words),
            share(word_chars, n_words),
            share(n_symbols, word_chars),
            share(n_dup_lines, lines),
            share(n_repeat, n_words),
            share(_per_document(_CAPITAL[data], at), word_chars),
            share(distinct, n_words),
            share(_per_document(_PUNCTUATION[data], at), word_chars),
            share(_per_document(_DIGIT[data], at), word_chars),
            share(n_words, lines),
            share(np.bincount(words.doc[again], minlength=docs), n_words),
            share(np.bincount(words.doc[with_symbol], minlength=docs), n_words),
        ],
        1,
    )
    base = np.stack([n_words, word_chars, n_symbols, n_dup_lines, n_repeat], 1)
    return base, features


def text_statistics(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``block_statistics`` of every row of an Arrow column."""
    parts = [block_statistics(data, at) for _, _, data, at in blocks(column)]
    if not parts:
        return np.zeros((0, 5), np.int64), np.zeros((0, len(FEATURES)))
    return tuple(np.concatenate(p) for p in zip(*parts))


def base_failed(base: np.ndarray) -> np.ndarray:
    return (base[:, 0] < MIN_WORDS) | (100 * base[:, 4] > MAX_REPEAT_PERCENT * base[:, 0])


def train_rules(docs: DataFrame, labels: DataFrame, max_examples: int = MAX_EXAMPLES) -> Trees:
    """Trees from at most ``max_examples`` labelled documents (1 is good).

    The statistics are computed where the documents are; the driver gets one
    row of numbers for each example.
    """
    sample = labelled_sample(docs, labels, "quality", max_examples)
    fields = T.StructType().add("features", T.ArrayType(T.DoubleType()))

    def kernel(column: pa.Array) -> list[pa.Array]:
        return [pa.array(list(text_statistics(column)[1]), pa.list_(pa.float64()))]

    rows = with_kernel(sample, "text", fields, kernel).select("doc_id", "quality", "features").collect()
    rows.sort(key=lambda row: (row["doc_id"], row["features"]))
    x = np.array([row["features"] for row in rows], np.float64).reshape(-1, len(FEATURES))
    y = np.array([row["quality"] for row in rows], np.float64)
    return fit_trees(x, y, np.array(list(FEATURES.values())))


def judge_quality(docs: DataFrame, trees: Trees, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The frame plus the statistics, ``base_failed``, ``quality_probability``, ``kept``."""
    fields = T.StructType([*STATISTICS.fields]).add("base_failed", "boolean").add("quality_probability", "double").add("kept", "boolean")

    def kernel(column: pa.Array) -> list[pa.Array]:
        base, features = text_statistics(column)
        failed, p = base_failed(base), trees.probability(features)
        kept = ~failed & (p >= keep_from) if len(trees.roots) else ~failed
        return [*(pa.array(base[:, k]) for k in range(base.shape[1])), pa.array(failed), pa.array(p), pa.array(kept)]

    return with_kernel(docs, text, fields, kernel)
