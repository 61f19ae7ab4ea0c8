"""Operator 5, toxicity: votes of the nearest labelled examples.

Texts are TF-IDF vectors over all terms of a bounded sample of labelled documents,
with document frequencies over all documents. The examples of each label lie in a
block-max inverted index. Rare terms have postings, whose part of all cosines is
summed. Frequent terms, whose postings would be long, have their largest weight in
each block of examples: an example whose part and block's bound together cannot
reach the ``NEIGHBOURS``-th best is skipped, and blocks without other examples are
never opened. So the neighbours are exact, ties go to the smaller id, and they do not
depend on the other texts of a batch.

The labels speak in the votes. A near example of label 1 votes with its cosine, each
shared term's part of it weighted by the log odds of label 1 that the term is sure
to raise; so an insult among hundreds of words counts, and shared boilerplate does
not. The nearest of label 0 vote by their cosines. Leave-one-out votes of the
examples calibrate the score. No example is left out: for the odds, a family of near
copies of one label (texts of one least shingle hash) counts as one document.

A text without any of the terms (null and empty ones among them) has no
neighbours and gets the rate of the examples without one. Without examples of both
labels all scores are the share of label 1, or 0 without any example. Repeated rows
get equal scores, an empty table gives no rows, and new columns whose names input
columns have get leading underscores. A very long text takes about 47 bytes of a
task's memory for each of its bytes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import labelled_sample, with_kernel
from gridpulse.llm.stages import Shared
from gridpulse.llm.tokens import SpanHasher, blocks, mix, shingle_sets

MAX_EXAMPLES = 20_000
MAX_BYTES = 48 << 20
NEIGHBOURS = 16
# Examples of a block, the terms that have block maxima instead of postings, and texts
# that open blocks together.
BLOCK = 32
HEAD = 512
TOGETHER = 64
# How many standard errors a term's log odds are lowered by.
STANDARD_ERRORS = 2.0
# More than single precision can put a bound or a first score off.
TOLERANCE = 1e-5
# Votes below it are told apart no further.
LEAST_VOTE = 1e-3
THRESHOLD = 0.3
CALIBRATION_EXAMPLES = 4_000
EVIDENCE = 3
# Parts of one document that a member of a family of copies counts.
_WHOLE = 1_000_000

FIELDS = T.StructType().add("score", "double").add("predicted", "integer").add("evidence", T.ArrayType(T.LongType()))

_LETTER = np.zeros(256, bool)
_LETTER[[*range(ord("a"), ord("z") + 1), *range(ord("0"), ord("9") + 1), *range(0x80, 0x100)]] = True


def _inside_terms(data: np.ndarray) -> np.ndarray:
    """Bytes of terms: lower-case letters, digits and all beyond ASCII but the
    punctuation of the blocks U+0080 and U+2000."""
    inside = _LETTER[data]
    if len(data) > 2:
        general = (data[:-2] == 0xE2) & ((data[1:-1] == 0x80) | (data[1:-1] == 0x81))
        for k in range(3):
            inside[k : len(data) - 2 + k] &= ~general
        latin = (data[:-1] == 0xC2) & (data[1:] < 0xC0)
        inside[:-1] &= ~latin
        inside[1:] &= ~latin
    return inside


def document_terms(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For blocks of rows: the first row, each term's row in the block, its hash."""
    for first, _, data, at in blocks(pc.utf8_lower(column.cast(pa.large_string()))):
        inside = _inside_terms(data)
        n = len(data)
        begins, ends = inside.copy(), inside.copy()
        if n:
            begins[1:] &= ~inside[:-1]
            ends[:-1] &= ~inside[1:]
            cuts = at[(at > 0) & (at < n)]
            begins[cuts] = inside[cuts]
            ends[cuts - 1] = inside[cuts - 1]
        start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        yield first, np.searchsorted(at, start, "right") - 1, SpanHasher(data)(start, end)


def _distinct(doc: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, term) pairs in order, and their counts."""
    order = np.lexsort((term, doc))
    doc, term = doc[order], term[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (term[1:] != term[:-1])
    at = np.flatnonzero(new)
    return doc[at], term[at], np.diff(np.r_[at, len(doc)])


@dataclass
class Vocabulary:
    """The sample's terms by hash, and their idf."""

    terms: np.ndarray
    idf: np.ndarray

    def vectors(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(row, term numbers, unit-length weights) of the rows with a known term."""
        if not len(self.terms):
            return
        for first, doc, term in document_terms(column):
            at = np.minimum(np.searchsorted(self.terms, term), len(self.terms) - 1)
            hit = self.terms[at] == term
            doc, at, count = _distinct(doc[hit], at[hit])
            weight = (1 + np.log(count)) * self.idf[at]
            rows, starts = np.unique(doc, return_index=True)
            for row, a, b in zip(rows.tolist(), starts.tolist(), [*starts[1:].tolist(), len(doc)]):
                w = weight[a:b]
                yield first + row, at[a:b], w / math.sqrt(math.fsum((w * w).tolist()))


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + sizes, sizes)


class BlockMaxIndex:
    """The vectors of some examples by term, in blocks of ``BLOCK`` examples.

    Examples are put in order of the frequent term that weighs most in them, then of
    their number of terms, so that those of a block are alike and its bounds tight.
    """

    def __init__(self, ids: list[int], vectors: list[tuple[np.ndarray, np.ndarray]], terms: int, heads: int = HEAD):
        sizes = np.array([len(t) for t, _ in vectors], np.int64)
        term = np.concatenate([np.zeros(0, np.int32), *(t for t, _ in vectors)]).astype(np.int32)
        weight = np.concatenate([np.zeros(0, np.float32), *(w for _, w in vectors)]).astype(np.float32)
        common = self._frequent(term, terms, heads)
        kind = np.zeros(len(ids), np.int64)
        for i, (t, w) in enumerate(vectors):
            shared = np.isin(t, common)
            kind[i] = t[shared][np.argmax(w[shared])] if shared.any() else -1
        order = np.lexsort((np.array(ids, np.int64), sizes, kind))
        offsets = np.r_[0, np.cumsum(sizes)]
        own = _spans(offsets[:-1][order], sizes[order])
        self.ids = np.array(ids, np.int64)[order]
        self.offsets, self.terms, self.weights = np.r_[0, np.cumsum(sizes[order])], term[own], weight[own]
        self.size, self.heads, self.ready = terms, heads, False

    @staticmethod
    def _frequent(term: np.ndarray, terms: int, heads: int) -> np.ndarray:
        return np.argsort(-np.bincount(term, minlength=terms), kind="stable")[:heads]

    def __getstate__(self) -> tuple:
        """Only the vectors are sent; what is searched is made where it is used."""
        return self.ids, self.offsets, self.terms, self.weights, self.size, self.heads

    def __setstate__(self, state: tuple) -> None:
        self.ids, self.offsets, self.terms, self.weights, self.size, self.heads = state
        self.ready = False

    def _open(self) -> None:
        place = np.repeat(np.arange(len(self.ids)), np.diff(self.offsets))
        head = self._frequent(self.terms, self.size, self.heads)
        self.row = np.full(self.size, -1)  # of each term among the frequent ones, or -1
        self.row[head] = np.arange(len(head))
        frequent = self.row[self.terms] >= 0
        blocks_here = -(-len(self.ids) // BLOCK)
        full = np.zeros((blocks_here * BLOCK, len(head)), np.float32)
        full[place[frequent], self.row[self.terms[frequent]]] = self.weights[frequent]
        self.full = full
        self.most = full.reshape(blocks_here, BLOCK, len(head)).max(1)  # of each block and frequent term
        rest = np.flatnonzero(~frequent)
        rest = rest[np.argsort(self.terms[rest], kind="stable")]
        self.places, self.values = place[rest], self.weights[rest].astype(np.float64)
        self.starts = np.r_[0, np.cumsum(np.bincount(self.terms[rest], minlength=self.size))]
        self.ready = True

    def vector(self, place: int) -> tuple[np.ndarray, np.ndarray]:
        """An example's own terms and weights."""
        own = slice(self.offsets[place], self.offsets[place + 1])
        return self.terms[own], self.weights[own].astype(np.float64)

    def nearest(
        self,
        queries: list[tuple[np.ndarray, np.ndarray]],
        k: int = NEIGHBOURS,
        without: list[int] | None = None,
        value: np.ndarray | None = None,
    ) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        """For each query places and cosines of the ``k`` nearest examples that share a
        term, the cosines with each term's part times its ``value``, and how many blocks
        it had opened. ``without`` are examples that do not count. Alike queries open
        their blocks together."""
        if not len(self.ids):
            return [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0), 0)] * len(queries)
        if not self.ready:
            self._open()
        head = np.zeros((len(queries), self.full.shape[1]))
        for q, (terms, weights) in enumerate(queries):
            row = self.row[terms]
            head[q, row[row >= 0]] = weights[row >= 0]
        alike = np.argsort(head.argmax(1), kind="stable") if head.shape[1] else np.arange(len(queries))
        found: list = [None] * len(queries)
        for first in range(0, len(queries), TOGETHER):
            some = alike[first : first + TOGETHER]
            own = [queries[q] for q in some]
            left_out = [-1 if without is None else without[q] for q in some]
            for q, result in zip(some, self._nearest_together(own, head[some], left_out, k, value)):
                found[q] = result
        return found

    def _rare_parts(self, terms: np.ndarray, weights: np.ndarray, *values: np.ndarray) -> list[np.ndarray]:
        """What the terms with postings add to each example's cosine, in the order of the
        terms; then the same with each term's part times its value."""
        size = self.starts[terms + 1] - self.starts[terms]
        entries = _spans(self.starts[terms], size)
        places, own = self.places.take(entries), self.values.take(entries) * np.repeat(weights, size)
        return [np.bincount(places, own * np.repeat(v[terms], size) if v is not None else own, len(self.full)) for v in (None, *values)]

    def _nearest_together(
        self, queries: list, head: np.ndarray, without: list[int], k: int, value: np.ndarray | None
    ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
        n, rows = len(self.ids), len(self.full)
        blocks_here = len(self.most)
        single = head.astype(np.float32)
        summed = np.empty((len(queries), rows))
        valued = None
        if value is not None:
            of_head = np.zeros(head.shape[1])
            of_head[self.row[self.row >= 0]] = value[self.row >= 0]
            valued = np.empty((len(queries), rows))
        for q, (terms, weights) in enumerate(queries):
            own = self.row[terms] < 0
            if valued is None:
                (summed[q],) = self._rare_parts(terms[own], weights[own])
            else:
                summed[q], valued[q] = self._rare_parts(terms[own], weights[own], value)
        bounds = (summed.reshape(-1, blocks_here, BLOCK) + (single @ self.most.T)[:, :, None]).reshape(-1, rows)
        bounds[:, n:] = 0.0
        for q, place in enumerate(without):
            if place >= 0:
                bounds[q, place] = 0.0
        k, some = min(k, n), min(4 * k, n)
        least = np.empty((len(queries), 1))
        for q in range(len(queries)):
            likely = np.argpartition(bounds[q], rows - some)[rows - some :]
            least[q] = np.partition(summed[q, likely] + self.full[likely] @ single[q], some - k)[some - k]
        wanted = (bounds > 0) & (bounds >= least - TOLERANCE)
        of_block = wanted.reshape(-1, blocks_here, BLOCK).any(2)
        opened = np.flatnonzero(of_block.any(0))
        all_opened = len(opened) == blocks_here
        examples = np.arange(rows) if all_opened else (opened[:, None] * BLOCK + np.arange(BLOCK)).ravel()
        heads = single @ (self.full if all_opened else self.full[examples]).T
        for q in range(len(queries)):
            at = np.flatnonzero(wanted[q] if all_opened else wanted[q, examples])
            scores = summed[q, examples[at]] + heads[q, at]
            if len(at) > k:
                at = at[scores >= np.partition(scores, -k)[-k] - TOLERANCE]
            places = examples[at]
            # Again in double precision, row by row, whatever other examples are compared.
            frequent = self.full[places] * head[q]
            cosines = summed[q, places] + frequent.sum(1)
            best = np.lexsort((self.ids[places], -cosines))[:k]
            best = best[cosines[best] > 0]
            worth = cosines[best] if valued is None else valued[q, places[best]] + (frequent[best] * of_head).sum(1)
            yield places[best], cosines[best], worth, int(of_block[q].sum())


@dataclass
class ToxicityModel:
    vocabulary: Vocabulary
    odds: np.ndarray  # of each term, the log odds of label 1 that it is sure to raise
    toxic: BlockMaxIndex
    clean: BlockMaxIndex
    base_rate: float
    rate_without_terms: float
    slopes: tuple[float, ...] = (0.0, 0.0)
    offset: float = 0.0
    sent: Broadcast | None = None  # the model without its calibration

    def votes(
        self, queries: list[tuple[np.ndarray, np.ndarray]], toxic: list[int] | None = None, clean: list[int] | None = None
    ) -> Iterator[tuple[list[float], list[int]]]:
        """For each text the features of its score, and the evidence. ``toxic`` and
        ``clean`` are the texts' own places, which do not vote."""
        near_ones = self.toxic.nearest(queries, without=toxic, value=self.odds)
        near_zeros = self.clean.nearest(queries, without=clean)
        for (near, cosines, parts, _), (far, others, _, _) in zip(near_ones, near_zeros):
            ones, zeros = cosines.sum(), others.sum()
            features = [math.log(parts.sum() + LEAST_VOTE), float(ones / (ones + zeros)) if ones + zeros else 0.0]
            ids = np.r_[self.toxic.ids[near], self.clean.ids[far]]
            strength = np.r_[parts, np.zeros(len(others))]
            order = np.lexsort((ids, -np.r_[cosines, others], -strength))
            yield features, ids[order[:EVIDENCE]].tolist()

    def calibrated(self, features: list[float]) -> float:
        z = sum(a * x for a, x in zip(self.slopes, features)) + self.offset
        return 1 / (1 + math.exp(-min(max(z, -30.0), 30.0)))


def _fit_logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[tuple[float, ...], float]:
    """Slopes and offset of a logistic curve, lightly regularised; Newton's method.
    A feature whose slope would be negative gets none."""
    used = list(range(x.shape[1]))
    while True:
        full = np.c_[x[:, used], np.ones(len(x))]
        b = np.zeros(full.shape[1])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(full @ b, -30, 30)))
            h = np.maximum(p * (1 - p), 1e-9)
            step = np.linalg.solve((full.T * h) @ full + 0.05 * np.eye(len(b)), full.T @ (p - y) + 0.05 * b)
            b -= np.clip(step, -5, 5)
        against = [feature for feature, slope in zip(used, b) if slope < 0]
        if not against:
            slopes = dict(zip(used, b.tolist()))
            return tuple(slopes.get(k, 0.0) for k in range(x.shape[1])), float(b[-1])
        used = [k for k in used if k not in against]


def with_family_share(sample: DataFrame, label: str) -> DataFrame:
    """The sample plus ``share``, what each document counts in the odds of terms.

    Copies of one toxic text would make all its words look toxic. Documents of one
    label with the same least shingle hash, as similar ones mostly have, form a
    family whose members share one document's count, in millionths. All stay.
    """

    def kernel(column: pa.Array) -> list[pa.Array]:
        keys = []
        for _, _, data, at in blocks(column):
            values, offsets = shingle_sets(data, at)
            full = np.diff(offsets) > 0
            least = np.minimum.reduceat(mix(values), offsets[:-1][full]) if full.any() else values
            of_row = np.zeros(len(at) - 1, np.uint64)
            of_row[full] = least
            keys.append(pa.array(of_row.view(np.int64), mask=~full))
        return [pa.concat_arrays(keys) if keys else pa.array([], pa.int64())]

    marked = with_kernel(sample, "text", T.StructType().add("family", "long"), kernel)
    # At most as many families as the sample has rows; texts without words have none.
    families = marked.filter("family is not null").groupBy(label, "family").agg(F.count(F.lit(1)).alias("members"))
    share = F.floor(F.lit(_WHOLE) / F.coalesce("members", F.lit(1))).alias("share")
    return marked.join(F.broadcast(families), [label, "family"], "left").select(*sample.columns, share)


def count_terms(sample: DataFrame, label: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all terms in order, the examples' shares that have each, and those of label 1.

    The driver gets a row for each different term of the sample, which is bounded
    by its bytes. Shares are whole numbers, so sums have no order.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            share = batch.column("share").to_numpy()
            ones = share * batch.column(label).to_numpy()
            for first, doc, term in document_terms(batch.column("text")):
                doc, term, _ = _distinct(doc, term)
                order = np.argsort(term, kind="stable")
                doc, term = first + doc[order], term[order]
                starts = np.flatnonzero(np.r_[True, term[1:] != term[:-1]]) if len(term) else np.zeros(0, np.int64)
                sums = [np.add.reduceat(x[doc], starts) if len(starts) else np.zeros(0, np.int64) for x in (share, ones)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(term[starts].view(np.int64)), *(pa.array(x, pa.int64()) for x in sums)], names=["term", "n", "n1"]
                )

    counted = (
        sample.select("text", F.col(label).cast("long").alias(label), "share")
        .mapInArrow(count, "term long, n long, n1 long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"), F.sum("n1").alias("n1"))
        .toArrow()
    )
    term = counted["term"].to_numpy().view(np.uint64)
    order = np.argsort(term)
    return term[order], counted["n"].to_numpy()[order] / _WHOLE, counted["n1"].to_numpy()[order] / _WHOLE


def sure_odds(n: np.ndarray, n1: np.ndarray, zeros: float, ones: float) -> np.ndarray:
    """By how much each term surely raises the log odds of label 1; 0 if it may not."""
    cells = [np.maximum(c, 0) + 0.5 for c in (n1, zeros - (n - n1), n - n1, ones - n1)]
    odds = np.log(cells[0] * cells[1] / (cells[2] * cells[3]))
    return np.maximum(odds - STANDARD_ERRORS * np.sqrt(sum(1 / c for c in cells)), 0.0)


def document_frequencies(docs: DataFrame, terms: np.ndarray, text: str = "text") -> tuple[np.ndarray, int]:
    """In how many of all documents each term occurs, and how many there are."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(len(terms), np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, doc, term in document_terms(batch.column(0)) if len(terms) else ():
                at = np.minimum(np.searchsorted(terms, term), len(terms) - 1)
                hit = terms[at] == term
                used, n = np.unique(_distinct(doc[hit], at[hit])[1], return_counts=True)
                total[used] += n
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[used, -1]), pa.array(np.r_[total[used], rows])], names=["place", "n"]
        )

    found = docs.select(text).mapInArrow(count, "place long, n long").groupBy("place").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(terms) + 1, np.int64)  # the last place, -1, counts documents
    counts[found["place"].to_numpy()] = found["n"].to_numpy()
    return counts[:-1], int(counts[-1])


def train_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "toxic",
    folds: int = 1,
    held_out: int = -1,
    max_examples: int = MAX_EXAMPLES,
    max_bytes: int = MAX_BYTES,
) -> ToxicityModel:
    """Terms, indexes and calibration from the first documents by a hash of the id: at
    most ``max_examples`` of them and ``max_bytes`` of text.

    All of these are examples, with all their terms. Only documents whose
    crc32(doc_id as text) mod ``folds`` is not ``held_out`` teach; the driver gets
    their term weights, never texts.
    """
    shared = Shared(docs.sparkSession, "toxicity")
    marked = labels.withColumn(label, (F.col(label) > 0).cast("int"))
    sample = labelled_sample(docs, marked, label, max_examples, folds, held_out, max_bytes)
    sample = shared.write(with_family_share(sample, label), "examples")
    totals = {r[label]: (r["n"], r["share"] / _WHOLE) for r in sample.groupBy(label).agg(F.count(F.lit(1)).alias("n"), F.sum("share").alias("share")).collect()}
    (zeros, zero_share), (ones, one_share) = totals.get(0, (0, 0.0)), totals.get(1, (0, 0.0))
    base = ones / (ones + zeros) if totals else 0.0
    nothing = np.zeros(0)
    if not zeros or not ones:
        none = BlockMaxIndex([], [], 0)
        return ToxicityModel(Vocabulary(np.zeros(0, np.uint64), nothing), nothing, none, none, base, base)
    terms, seen, seen_ones = count_terms(sample, label)
    frequency, n = document_frequencies(docs, terms) if len(terms) else (nothing, 0)
    vocabulary = Vocabulary(terms, np.log1p((n - frequency + 0.5) / (frequency + 0.5)))
    odds = sure_odds(seen, seen_ones, zero_share, one_share)

    fields = T.StructType().add("terms", "binary").add("weights", "binary")

    def kernel(column: pa.Array) -> list[pa.Array]:
        own_terms, own_weights = [None] * len(column), [None] * len(column)
        for row, t, w in vocabulary.vectors(column):
            own_terms[row], own_weights[row] = t.astype(np.int32).tobytes(), w.astype(np.float32).tobytes()
        return [pa.array(own_terms, pa.binary()), pa.array(own_weights, pa.binary())]

    rows = with_kernel(sample, "text", fields, kernel).filter("terms is not null").select("doc_id", label, "terms", "weights").toArrow()
    rows = rows.sort_by([("doc_id", "ascending"), ("terms", "ascending")]).combine_chunks()
    of_label = rows[label].to_numpy()

    def index(value: int) -> BlockMaxIndex:
        some = rows.filter(pa.array(of_label == value))
        vectors = [(np.frombuffer(t.as_buffer(), np.int32), np.frombuffer(w.as_buffer(), np.float32)) for t, w in zip(some["terms"], some["weights"])]
        return BlockMaxIndex(some["doc_id"].to_pylist(), vectors, len(terms))

    with_terms, with_terms_one = len(of_label), int(of_label.sum())
    without = ones + zeros - with_terms
    rate = (ones - with_terms_one) / without if without else 0.0
    model = ToxicityModel(vocabulary, odds, index(1), index(0), base, rate)
    del rows  # the indexes hold them
    spark = docs.sparkSession
    model.sent = sent = spark.sparkContext.broadcast(model)  # bounded by the examples' bytes
    places = [(value, i) for value, part in ((1, model.toxic), (0, model.clean)) for i in range(len(part.ids))]
    if not places:
        return model
    chosen = [places[i] for i in np.linspace(0, len(places) - 1, min(len(places), CALIBRATION_EXAMPLES)).astype(int)]

    def votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            asked = list(zip(*(c.to_pylist() for c in batch.columns)))
            vectors = [(own.toxic if value else own.clean).vector(place) for value, place in asked]
            left_out = [[place if value == of else -1 for value, place in asked] for of in (1, 0)]
            found = [features for features, _ in own.votes(vectors, *left_out)]
            columns = [pa.array([f[k] for f in found], pa.float64()) for k in range(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["label", "evidence", "share"])

    asked = spark.createDataFrame(chosen, "label int, place int").repartition(spark.sparkContext.defaultParallelism)
    voted = asked.mapInArrow(votes, "label int, evidence double, share double").toArrow()
    voted = voted.sort_by([(c, "ascending") for c in ("evidence", "share", "label")])
    features = np.c_[voted["evidence"].to_numpy(), voted["share"].to_numpy()]
    model.slopes, model.offset = _fit_logistic(features, voted["label"].to_numpy().astype(float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicityModel, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The frame plus ``score``, ``predicted`` and ``evidence``, the nearest examples' ids
    (those whose votes count most come first)."""

    sent = model.sent or docs.sparkSession.sparkContext.broadcast(model)
    slopes, offset = model.slopes, model.offset

    def kernel(column: pa.Array) -> list[pa.Array]:
        own = sent.value
        own.slopes, own.offset = slopes, offset
        scores = np.full(len(column), own.rate_without_terms)
        evidence: list[list[int]] = [[] for _ in range(len(column))]
        found = list(own.vocabulary.vectors(column))
        for (row, _, _), (features, ids) in zip(found, own.votes([(terms, weights) for _, terms, weights in found])):
            scores[row], evidence[row] = own.calibrated(features), ids
        predicted = (scores >= threshold).astype(np.int32)
        return [pa.array(scores), pa.array(predicted), pa.array(evidence, pa.list_(pa.int64()))]

    return with_kernel(docs, text, FIELDS, kernel)
