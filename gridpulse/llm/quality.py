"""Operator 8, quality classifier: a byte-level convolutional network in numpy.

Learned filters of 16 bytes step over a text in strides of 4 bytes. Responses are
max-pooled over chunks of 512 bytes, which overlap by 64 and cover the whole
text; the pooled chunks are averaged and combined into one probability.

A score is exact arithmetic, so equal texts get equal scores in any batch: the
trained weights are rounded to multiples of a power of two that is fine enough to
keep them and coarse enough that no sum of a filter's products leaves the 24 bits
of single precision; what follows is elementwise, in a fixed order.

Training reads a bounded sample of labelled documents, chosen by a hash of the id
until ``MAX_EXAMPLES`` of them or ``MAX_BYTES`` of text are together, and all chunks
of each; scoring reads all chunks of all texts. Null and empty texts are scored like
a chunk of padding, which training counts as label 0. Without examples of both
labels every score is the share of label 1, or 0.5 without any. Repeated rows get
equal scores, an empty table gives no rows, and a new column whose name an input
column has gets leading underscores. A very long text takes about 70 bytes of a
task's memory for each of its bytes.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import labelled_sample, with_kernel
from gridpulse.llm.tokens import blocks

STRIDE = 4
WIDTH = 16
SEGMENT = 64  # bytes whose windows are pooled first
CHUNK = 512
CHUNK_STEP = CHUNK - SEGMENT
DIMENSIONS = 4
FILTERS = 24
MAX_EXAMPLES = 6_000
MAX_BYTES = 16 << 20
THRESHOLD = 0.5

FIELDS = T.StructType().add("score", "double").add("predicted", "integer")

_STEPS = WIDTH // STRIDE
_PER_SEGMENT = SEGMENT // STRIDE
_SEGMENTS = CHUNK // SEGMENT
_WINDOWS = CHUNK // STRIDE
# Bytes that a chunk's windows read.
_CHUNK_READ = CHUNK + WIDTH - STRIDE


@dataclass
class ByteNetwork:
    embedding: np.ndarray  # 256 x DIMENSIONS
    filters: np.ndarray  # _STEPS x (STRIDE * DIMENSIONS) x FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: float

    def exact(self) -> ByteNetwork:
        """The network with weights rounded so that responses are exact in single precision.

        Embedding and filters become multiples of 2 ** -bits, products and biases
        of 2 ** (-2 * bits); a response and every part of its sum is below
        2 ** 24 of these units, whatever the bytes.
        """
        for bits in range(10, -1, -1):
            unit = float(2**bits)
            embedding, filters = np.round(self.embedding * unit), np.round(self.filters * unit)
            bias = np.round(self.bias * unit * unit)
            largest = np.tile(np.abs(embedding).max(0), STRIDE)
            if (np.abs(bias) + (largest @ np.abs(filters)).sum(0)).max() < 2**24:
                break
        small = [(x / scale).astype(np.float32) for x, scale in ((embedding, unit), (filters, unit), (bias, unit * unit))]
        return ByteNetwork(*small, self.weights, self.offset)

    def responses(self, data: np.ndarray) -> np.ndarray:
        """Filter responses at each stride of bytes (..., n) -> (..., n/4 - 3, FILTERS)."""
        x = self.embedding[data].reshape(*data.shape[:-1], -1, STRIDE * DIMENSIONS)
        n = x.shape[-2] - _STEPS + 1
        z = x[..., :n, :] @ self.filters[0]
        for k in range(1, _STEPS):
            z += x[..., k : k + n, :] @ self.filters[k]
        return np.maximum(z + self.bias, 0, out=z)

    def block_scores(self, data: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Probabilities of the documents of a block."""
        docs = len(at) - 1
        size = np.diff(at)
        segments = (size + WIDTH + STRIDE + SEGMENT - 1) // SEGMENT  # with padding behind each text
        first = np.zeros(docs + 1, np.int64)
        np.cumsum(segments, out=first[1:])
        padded = np.zeros(first[-1] * SEGMENT + WIDTH - STRIDE, np.uint8)
        padded[np.arange(len(data)) + np.repeat(first[:-1] * SEGMENT - at[:-1], size)] = data
        seen = self.responses(padded).reshape(-1, _PER_SEGMENT, self.bias.size)
        # The last windows of a text's area reach into the next text; a response is
        # never below 0, so that 0 keeps them out of the maximum.
        seen[first[1:] - 1, 1 - _STEPS :] = 0
        pooled = seen.max(1)
        chunks = chunk_counts(size)
        owner = np.repeat(np.arange(docs), chunks)
        start = np.zeros(docs, np.int64)
        np.cumsum(chunks[:-1], out=start[1:])
        step = np.arange(len(owner)) - start[owner]
        begin = first[owner] + step * (CHUNK_STEP // SEGMENT)
        last = first[owner + 1] - 1
        best = pooled[np.minimum(begin, last)]
        for k in range(1, _SEGMENTS):
            np.maximum(best, pooled[np.minimum(begin + k, last)], out=best)
        # Sums of multiples of one unit, exact in double precision.
        mean = np.add.reduceat(best.astype(np.float64), start) / chunks[:, None]
        z = np.full(docs, float(self.offset))
        for column, weight in zip(mean.T, self.weights.tolist()):
            z = z + column * weight
        return np.array([1 / (1 + math.exp(-min(max(x, -30.0), 30.0))) for x in z.tolist()])


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x.astype(np.float64), -30, 30)))


def chunk_counts(size: np.ndarray) -> np.ndarray:
    """How many overlapping chunks cover a text; one at least."""
    return 1 + np.maximum(0, -(-(size - CHUNK) // CHUNK_STEP))


def _training_chunks(column: pa.Array) -> list[pa.Array]:
    """All chunks of each text, padded and put together."""
    out = []
    for _, _, data, at in blocks(column):
        counts = chunk_counts(np.diff(at))
        for d, n in enumerate(counts.tolist()):
            text = np.zeros((n - 1) * CHUNK_STEP + _CHUNK_READ, np.uint8)
            own = data[at[d] : at[d + 1]]
            text[: len(own)] = own
            out.append(np.lib.stride_tricks.sliding_window_view(text, _CHUNK_READ)[::CHUNK_STEP].tobytes())
    return [pa.array(out, pa.binary())]


def _adam(state: dict, name: str, value: np.ndarray, grad: np.ndarray, t: int, rate: float) -> np.ndarray:
    m, v = state.get(name, (np.zeros_like(grad), np.zeros_like(grad)))
    m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad * grad
    state[name] = (m, v)
    step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return (value - step).astype(np.float32)


def fit_network(
    chunks: list[np.ndarray], y: np.ndarray, epochs: int = 12, batch: int = 64, rate: float = 0.01, seed: int = 8
) -> ByteNetwork:
    """Gradient descent on the logistic loss; documents are lists of chunks."""
    rng = np.random.default_rng(seed)
    share = float(np.clip(y.mean() if len(y) else 0.5, 0.0, 1.0))
    inner = STRIDE * DIMENSIONS
    net = ByteNetwork(
        rng.normal(0, 0.5, (256, DIMENSIONS)).astype(np.float32),
        rng.normal(0, 0.25, (_STEPS, inner, FILTERS)).astype(np.float32),
        np.zeros(FILTERS, np.float32),
        np.zeros(FILTERS, np.float32),
        float(np.log(np.clip(share, 1e-3, 1 - 1e-3) / (1 - np.clip(share, 1e-3, 1 - 1e-3)))),
    )
    if share in (0.0, 1.0) or not len(y):
        return net.exact()
    # A text without bytes is no good text.
    blank = max(1, len(y) // 100)
    chunks, y = [*chunks, *[np.zeros((1, _CHUNK_READ), np.uint8)] * blank], np.r_[y, np.zeros(blank)]
    net.weights = rng.normal(0, 0.3, FILTERS).astype(np.float32)
    state: dict = {}
    t = 0
    steps = epochs * -(-len(y) // batch)
    for _ in range(epochs):
        order = rng.permutation(len(y))
        for s in range(0, len(y), batch):
            t += 1
            speed = rate * (1 - 0.9 * t / steps)
            docs = order[s : s + batch]
            counts = np.array([len(chunks[d]) for d in docs])
            data = np.concatenate([chunks[d] for d in docs])
            owner = np.repeat(np.arange(len(docs)), counts)
            z = net.responses(data)
            where = z.argmax(1)  # chunks x filters
            pooled = np.take_along_axis(z, where[:, None, :], 1)[:, 0]
            mean = np.add.reduceat(pooled, np.r_[0, np.cumsum(counts)[:-1]]) / counts[:, None]
            error = (_logistic(mean @ net.weights + net.offset) - y[docs]) / len(docs)
            # Only the window that won the pooling gets a gradient.
            back = (error[:, None] * net.weights / counts[:, None])[owner] * (pooled > 0)
            c = np.arange(len(data))[:, None]
            grad_filters, grad_embedding = np.zeros_like(net.filters), np.zeros_like(net.embedding)
            for k in range(_STEPS):
                bytes_at = data[c[..., None], ((where + k) * STRIDE)[..., None] + np.arange(STRIDE)]
                x = net.embedding[bytes_at].reshape(*where.shape, inner)
                grad_filters[k] = np.einsum("cfi,cf->if", x, back)
                towards = (back[..., None] * net.filters[k].T).reshape(-1, DIMENSIONS)
                for d in range(DIMENSIONS):
                    grad_embedding[:, d] += np.bincount(bytes_at.ravel(), towards[:, d], 256)
            grads = {
                "embedding": grad_embedding,
                "filters": grad_filters + 1e-5 * net.filters,
                "bias": back.sum(0),
                "weights": mean.T @ error + 1e-4 * net.weights,
            }
            for name, grad in grads.items():
                setattr(net, name, _adam(state, name, getattr(net, name), grad, t, speed))
            net.offset = float(_adam(state, "offset", np.array(net.offset), np.array(error.sum()), t, speed))
    return net.exact()


def train_quality(
    docs: DataFrame,
    labels: DataFrame,
    label: str = "quality",
    folds: int = 1,
    held_out: int = -1,
    max_examples: int = MAX_EXAMPLES,
    max_bytes: int = MAX_BYTES,
) -> ByteNetwork:
    """A network from the first documents by a hash of the id: at most ``max_examples``
    of them and ``max_bytes`` of text, each with all of its chunks."""
    sample = labelled_sample(docs, labels.withColumn(label, (F.col(label) > 0).cast("int")), label, max_examples, folds, held_out, max_bytes)
    fields = T.StructType().add("chunks", T.BinaryType())
    rows = with_kernel(sample, "text", fields, _training_chunks).select("doc_id", label, "chunks").collect()
    rows.sort(key=lambda row: (row["doc_id"], row["chunks"]))
    chunks = [np.frombuffer(row["chunks"], np.uint8).reshape(-1, _CHUNK_READ) for row in rows]
    return fit_network(chunks, np.array([row[label] for row in rows], np.float64))


def score_quality(docs: DataFrame, network: ByteNetwork, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The frame plus ``score`` and ``predicted``."""

    def kernel(column: pa.Array) -> list[pa.Array]:
        scores = [network.block_scores(data, at) for _, _, data, at in blocks(column)]
        p = np.concatenate(scores) if scores else np.zeros(0)
        return [pa.array(p), pa.array((p >= threshold).astype(np.int32))]

    return with_kernel(docs, text, FIELDS, kernel)
