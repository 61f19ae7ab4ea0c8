"""Operator 6, language ID by rank-order profiles.

A profile is a text's most frequent letter n-grams (n = 1 to 3, with word ends)
in order of frequency. A document's profile is compared with each language's by
the out-of-place distance: how far every n-gram's rank is from its rank there,
or ``PROFILE`` if it is not in that profile.

Texts that are null, or hold no letter, are ``und`` with score 0. Without any
language to learn from, all are. Ties go to the first language by name; the
score is the share by which the best distance is below the second best. An empty
table gives no rows, repeated rows get equal results, and new columns whose names
input columns have get leading underscores. A very long text takes about 76 bytes
of a task's memory for each of its bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import in_fold, small_batches, with_kernel

PROFILE = 300
UNDETERMINED = "und"
# n-grams of several texts that learning adds up in a task before it passes them on.
_PENDING_GRAMS = 1 << 19
_WORD_END = 1

FIELDS = T.StructType().add("lang_pred", "string").add("score", "double")


@functools.cache
def _letters() -> np.ndarray:
    """Which code points are letters."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The letter n-grams of a text, as packed code points, and their counts.

    Everything that is no letter ends a word; case does not count.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    points = np.where(_letters()[points], points, np.uint32(_WORD_END)).astype(np.uint64)
    points = np.r_[np.uint64(_WORD_END), points, np.uint64(_WORD_END)]
    apart = points == _WORD_END
    keep = np.ones(len(points), bool)
    keep[1:] = ~(apart[1:] & apart[:-1])
    points, apart = points[keep], apart[keep]
    shift = np.uint64(21)
    pairs = points[:-1] << shift | points[1:]
    triples = pairs[:-1] << shift | points[2:]
    return np.unique(np.concatenate([points[~apart], pairs, triples[~apart[1:-1]]]), return_counts=True)


def profile(grams: np.ndarray, counts: np.ndarray, size: int = PROFILE) -> np.ndarray:
    """The most frequent n-grams first; ties by n-gram."""
    return grams[np.argsort(-counts, kind="stable")[:size]]


@dataclass
class Profiles:
    """All languages' profiles as one table of ranks (n-grams x languages)."""

    languages: list[str]
    grams: np.ndarray
    ranks: np.ndarray

    def distances(self, own: np.ndarray) -> np.ndarray:
        """Mean out-of-place distance to each language, 0 to ``PROFILE``."""
        at = np.minimum(np.searchsorted(self.grams, own), len(self.grams) - 1)
        ranks = np.where((self.grams[at] == own)[:, None], self.ranks[at], -1)
        places = np.arange(len(own))[:, None]
        return np.where(ranks < 0, PROFILE, np.abs(ranks - places)).mean(0)

    def predict(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and distance; ``PROFILE`` without a letter."""
        if not text or not self.languages:
            return UNDETERMINED, 0.0, float(PROFILE)
        grams, counts = gram_counts(text)
        if not len(grams) or grams[0] >= 1 << 21:  # no single letter
            return UNDETERMINED, 0.0, float(PROFILE)
        far = self.distances(profile(grams, counts))
        order = np.argsort(far, kind="stable")
        best, second = far[order[0]], far[order[1]] if len(order) > 1 else float(PROFILE)
        return self.languages[order[0]], float((second - best) / second) if second else 0.0, float(best)


def _added_up(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of several texts, and the sums of their counts."""
    grams, where = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    return grams, np.bincount(where, np.concatenate([c for _, c in parts]), len(grams)).astype(np.int64)


def learn_profiles(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    folds: int = 1,
    held_out: int = -1,
) -> Profiles:
    """Profiles of all languages that ``docs`` names, from every document that names one.

    n-grams are counted where the documents are; the driver gets ``PROFILE`` rows
    for each language.
    """
    small_batches(docs.sparkSession)
    usable = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull()
    )
    if held_out >= 0:
        usable = usable.filter(F.coalesce(in_fold("key", folds) != held_out, F.lit(False)))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        pending = 0

        def sums() -> Iterator[pa.RecordBatch]:
            for name, found in parts.items():
                grams, counts = _added_up(found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(grams), pa.string()), pa.array(grams.view(np.int64)), pa.array(counts)],
                    names=["lang", "gram", "n"],
                )

        for batch in batches:
            for name, value in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist()):
                parts.setdefault(name, []).append(gram_counts(value))
                pending += len(parts[name][-1][0])
                if pending >= _PENDING_GRAMS:
                    yield from sums()
                    parts, pending = {}, 0
        yield from sums()

    counted = usable.select("lang", "text").mapInArrow(count, "lang string, gram long, n long")
    ranked = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    rows = (
        counted.groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
        .withColumn("place", F.row_number().over(ranked))
        .filter(F.col("place") <= PROFILE)
        .select("lang", "gram", (F.col("place") - 1).alias("rank"))
        .collect()
    )
    languages = sorted({row["lang"] for row in rows})
    grams = np.unique(np.array([row["gram"] for row in rows], np.uint64))
    ranks = np.full((len(grams), len(languages)), -1)
    for row in rows:
        ranks[np.searchsorted(grams, np.uint64(row["gram"])), languages.index(row["lang"])] = row["rank"]
    return Profiles(languages, grams, ranks)


def identify_language(docs: DataFrame, profiles: Profiles, text: str = "text", distance: bool = False) -> DataFrame:
    """The frame plus ``lang_pred`` and ``score``, and ``lang_distance`` if asked for."""
    fields = T.StructType([*FIELDS, *([T.StructField("lang_distance", T.DoubleType())] if distance else [])])

    def kernel(column: pa.Array) -> list[pa.Array]:
        found = [profiles.predict(value) for value in column.to_pylist()]
        return [pa.array([f[k] for f in found], kind) for k, kind in zip(range(len(fields)), (pa.string(), pa.float64(), pa.float64()))]

    return with_kernel(docs, text, fields, kernel)


def farthest_distance(found: DataFrame, predicted: str = "lang_pred", distance: str = "lang_distance", lang: str = "lang") -> float:
    """The distance up to which a text counts as written in one of the languages.

    ``found`` has the distances of ``identify_language``. All but a thousandth of
    each language's labelled documents lie nearer to a profile than some distance,
    counted over all of them; the limit is a quarter of the way from the largest of
    these to ``PROFILE``, where a text shares nothing with any language. ``PROFILE``
    without labelled documents.
    """
    labelled = found.filter(F.col(lang).isNotNull() & (F.col(predicted) != UNDETERMINED))
    # Means of at most PROFILE whole numbers up to PROFILE: equal ones are many.
    counted = labelled.groupBy(F.col(lang).alias("lang"), F.col(distance).alias("distance")).agg(F.count(F.lit(1)).alias("n"))
    far = counted.groupBy("lang").agg(F.percentile("distance", 0.999, F.col("n")).alias("far"))
    most = far.agg(F.max("far")).first()[0]
    return float(PROFILE) if most is None else most + (PROFILE - most) / 4
