"""Operator 4, packing into optimal length buckets.

The global histogram of document lengths goes to a dynamic program that chooses
bucket borders so that padding every document to its bucket's longest costs the
fewest tokens. Inside a bucket, batches of as many documents as the token budget
holds are cut from a hashed order.

Every length that occurs is counted, so borders are optimal among all lengths; the
driver gets a row for each different one, of which T tokens in all can have at most
sqrt(2 T) (six million in 100 TB of text). A bucket may hold any share of all rows:
its order is one hash order, cut into ``PARTS`` runs of hashes that are ranked apart
and put together by their counts, so batches do not depend on Spark's settings.

Lengths are counted in words unless a column is given. Documents without words
have length 0 and lie in the first bucket. A document longer than the budget is a
batch of its own; nothing is cut off. Repeated rows are separate members, and so
are rows that share an id or have none; rows equal in id, length and text may
change places. An empty table gives no rows. New columns whose names input columns
have get leading underscores. A very long text takes about 14 bytes of a task's
memory for each of its bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import with_kernel
from gridpulse.llm.stages import Shared, column_name
from gridpulse.llm.tokens import blocks, find_words

BUCKETS = 16
BATCH_TOKENS = 65_536
# Runs of the hash order; with the buckets they bound the table of their beginnings.
PARTS = 2_048


def with_word_count(docs: DataFrame, text: str = "text") -> DataFrame:
    """The frame plus ``n_tokens``, its number of words."""

    def kernel(column: pa.Array) -> list[pa.Array]:
        counts = [find_words(data, at).count for _, _, data, at in blocks(column)]
        return [pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())]

    return with_kernel(docs, text, T.StructType().add("n_tokens", "long"), kernel)


def length_histogram(lengths: DataFrame, length: str) -> tuple[np.ndarray, np.ndarray]:
    """The lengths that occur, ascending, and how often."""
    counted = lengths.groupBy(F.col(length).alias("size")).agg(F.count(F.lit(1)).alias("n")).toArrow().sort_by("size")
    return counted["size"].to_numpy(), counted["n"].to_numpy()


@dataclass(frozen=True)
class Buckets:
    """The longest length of each bucket, and the tokens that padding costs."""

    longest: tuple[int, ...]
    padding: int


def _round(best: np.ndarray, documents: np.ndarray, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each i from 1 the least cost of a last bucket of lengths j to i, and the first such j.

    Where the best j begins never falls as i grows, so halving the i's bounds the
    j's of each half; all intervals of one depth are searched together.
    """
    n = len(sizes)
    cost, first = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    low, high = np.array([1]), np.array([n])
    least, most = np.array([0]), np.array([n - 1])
    while len(low):
        mid = (low + high) // 2
        width = np.minimum(most, mid - 1) - least + 1
        begin = np.r_[0, np.cumsum(width)[:-1]]
        owner = np.repeat(np.arange(len(mid)), width)
        j = np.arange(len(owner)) - begin[owner] + least[owner]
        i = mid[owner]
        costs = best[j] + (documents[i] - documents[j]) * sizes[i - 1] - (tokens[i] - tokens[j])
        lowest = np.minimum.reduceat(costs, begin)
        at = np.flatnonzero(costs == lowest[owner])
        chosen = j[at[np.unique(owner[at], return_index=True)[1]]]
        cost[mid], first[mid] = lowest, chosen
        left, right = low < mid, mid < high
        low, high, least, most = (
            np.r_[low[left], mid[right] + 1],
            np.r_[mid[left] - 1, high[right]],
            np.r_[least[left], chosen[right]],
            np.r_[chosen[left], most[right]],
        )
    return cost, first


def optimal_buckets(sizes: np.ndarray, count: np.ndarray, buckets: int = BUCKETS) -> Buckets:
    """The at most ``buckets`` runs of lengths with the least padding.

    ``best[i]`` is the least padding of the first ``i`` lengths in so many buckets
    as rounds have passed; a last bucket of lengths ``j`` to ``i`` costs its
    documents times the longest, less their tokens. Whole numbers throughout.
    """
    n = len(sizes)
    if not n:
        return Buckets((), 0)
    sizes, count = np.asarray(sizes, np.int64), np.asarray(count, np.int64)
    documents, tokens = np.r_[0, np.cumsum(count)], np.r_[0, np.cumsum(count * sizes)]
    best = np.r_[0, documents[1:] * sizes - tokens[1:]]  # one bucket
    choices = [np.zeros(n + 1, np.int64)]
    for _ in range(min(buckets, n) - 1):
        cost, first = _round(best, documents, tokens, sizes)
        choices.append(np.where(cost < best, first, -1))
        best = np.minimum(best, cost)
    borders, i = [], n
    for choice in reversed(choices):
        if i and choice[i] >= 0:
            borders.append(int(sizes[i - 1]))
            i = int(choice[i])
    return Buckets(tuple(reversed(borders)), int(best[n]))


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: str | None = None,
    buckets: int = BUCKETS,
    batch_tokens: int = BATCH_TOKENS,
    seed: int = 4,
) -> DataFrame:
    """The frame plus ``n_tokens`` (unless ``length`` names it), ``bucket``,
    ``bucket_tokens``, ``batch``, ``slot`` and ``padding``.

    Batches count from 0 in each bucket, slots in each batch; all batches of a
    bucket but its last are full.
    """
    shared = Shared(docs.sparkSession, "packing")
    measured = docs if length else with_word_count(docs, text)
    size = F.coalesce(F.col(length or measured.columns[-1]), F.lit(0)).cast("long")
    places = [F.col(key), F.col(text)] if text in docs.columns else [F.col(key)]
    hashed = F.xxhash64(*places, F.lit(seed))
    part_of = F.shiftright(hashed, 64 - PARTS.bit_length() + 1).cast("int")
    lengths = shared.write(measured.select(part_of.alias("part"), size.alias("n")), "lengths")
    chosen = optimal_buckets(*length_histogram(lengths, "n"), buckets)
    borders = F.array(*(F.lit(v).cast("long") for v in chosen.longest)) if chosen.longest else F.array(F.lit(0).cast("long"))

    def bucket_of(n: Column) -> Column:
        return F.size(F.filter(borders, lambda b: b < n))

    new = ["bucket", "bucket_tokens", "batch", "slot", "padding"]
    names = [column_name(measured, n) for n in new]
    bucket, part, rank, start, place, of_bucket, of_part = (
        column_name(measured, n) for n in ("own_bucket", "own_part", "rank_in_part", "part_start", "place", "of_bucket", "of_part")
    )
    # Where each part of each bucket begins: at most buckets x PARTS rows.
    before = Window.partitionBy(of_bucket).orderBy(of_part).rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        lengths.groupBy(bucket_of(F.col("n")).alias(of_bucket), F.col("part").alias(of_part))
        .agg(F.count(F.lit(1)).alias("rows"))
        .withColumn(start, F.coalesce(F.sum("rows").over(before), F.lit(0)))
        .drop("rows")
    )
    order = Window.partitionBy(bucket, part).orderBy(hashed, F.col(key), size)
    ranked = (
        measured.withColumn(bucket, bucket_of(size))
        .withColumn(part, part_of)
        .withColumn(rank, F.row_number().over(order) - 1)
        .join(F.broadcast(starts), (F.col(bucket) == F.col(of_bucket)) & (F.col(part) == F.col(of_part)))
        .withColumn(place, F.col(start) + F.col(rank))
    )
    longest = F.element_at(borders, F.col(bucket) + 1)
    capacity = F.greatest(F.floor(batch_tokens / F.greatest(longest, F.lit(1))), F.lit(1))
    return ranked.select(
        *measured.columns,
        F.col(bucket).alias(names[0]),
        longest.alias(names[1]),
        F.floor(F.col(place) / capacity).cast("long").alias(names[2]),
        (F.col(place) % capacity).cast("int").alias(names[3]),
        (longest - size).alias(names[4]),
    )
