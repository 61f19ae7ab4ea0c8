"""Operator 2, near-duplicates by SuperMinHash.

Signatures, banding, exact verification and union-find grouping: two documents
are linked if the Jaccard similarity of their full shingle sets is at least
``percent`` / 100, and a component of links is one group.

How no link is lost and nothing grows with the square of a group:

* Documents with equal sets form a class. One of them stands for it, so a group
  of exact copies of any size is one node.
* A band that only two classes share names one pair. Bands that the same classes
  share are one band group. Larger groups are cut into blocks of ``BLOCK`` members,
  so that a task holds the full sets of two blocks at most.
* Inside a block, pairs are taken by falling similarity of their signatures, in
  the first band they share and only if their signatures let a link be thinkable.
  A pair is compared by its full sets unless links found before join it already,
  so a block yields fewer links than it has members, however dense it is. Pairs
  of members of two blocks follow in a second round, for groups of several blocks
  that the first round's links have not joined into one component.

With 32 bands of 6 registers, a pair at similarity 0.85 shares no band with
probability 3e-7, and less above; ``SLACK`` standard deviations make the
signature test as safe.

Texts that are null, empty or blank have an empty set and are linked with
nothing. Rows with a null id are linked with nothing and kept. Rows that share
an id count as one document: repeated rows get the same answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.arrow import with_kernel
from gridpulse.llm.components import components
from gridpulse.llm.membership import split_by_ids
from gridpulse.llm.minhash import band_keys, set_digests, short_signatures, superminhash
from gridpulse.llm.stages import Shared
from gridpulse.llm.tokens import SHINGLE_WORDS, as_long, blocks, shingle_sets

PERCENT = 85
BANDS = 32
ROWS = 6
SLACK = 5.0
BLOCK = 2048

_SKETCH = (
    T.StructType()
    .add("n_shingles", "long")
    .add("set_a", "long")
    .add("set_b", "long")
    .add("bands", T.ArrayType(T.LongType()))
)


def _sketch(column: pa.Array) -> list[pa.Array]:
    size, a, b, bands = [], [], [], []
    for _, _, data, at in blocks(column):
        values, offsets = shingle_sets(data, at)
        full = superminhash(values, offsets, BANDS * ROWS)
        digest = set_digests(values, offsets)
        size.append(np.diff(offsets))
        a.append(digest[0])
        b.append(digest[1])
        bands.append(band_keys(full, BANDS))
    if not size:
        return [*(pa.array([], pa.int64()) for _ in range(3)), pa.array([], pa.list_(pa.int64()))]
    keys = np.concatenate(bands)
    starts = np.arange(0, keys.size + 1, BANDS, dtype=np.int32)
    return [
        pa.array(np.concatenate(size)),
        as_long(np.concatenate(a)),
        as_long(np.concatenate(b)),
        pa.ListArray.from_arrays(pa.array(starts), as_long(keys.ravel())),
    ]


def _sets(column: pa.Array) -> list[pa.Array]:
    """Each document's shingle set as bytes, and its short signature and band keys again."""
    sets: list[bytes] = []
    signatures: list[bytes] = []
    keys: list[bytes] = []
    for _, _, data, at in blocks(column):
        values, offsets = shingle_sets(data, at)
        sets += [values[offsets[d] : offsets[d + 1]].tobytes() for d in range(len(at) - 1)]
        full = superminhash(values, offsets, BANDS * ROWS)
        signatures += [row.tobytes() for row in short_signatures(full)]
        keys += [row.tobytes() for row in band_keys(full, BANDS)]
    return [pa.array(sets, pa.binary()), pa.array(signatures, pa.binary()), pa.array(keys, pa.binary())]


def similar_sets(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    if not len(x) or percent * len(y) > 100 * len(x):
        return False
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    common = int((y[at] == x).sum())
    return 100 * common >= percent * (len(x) + len(y) - common)


def _thinkable(percent: int) -> float:
    """The least share of equal signature bytes that a linked pair is allowed."""
    p = percent / 100
    least = p - SLACK * sqrt(p * (1 - p) / (BANDS * ROWS))
    return least + (1 - least) / 256


def block_links(
    band: int,
    node: np.ndarray,
    root: np.ndarray,
    sets: list[np.ndarray],
    signature: np.ndarray,
    keys: np.ndarray,
    split: int,
    percent: int,
) -> list[tuple[int, int]]:
    """Verified links that join what a block's pairs join: a forest.

    ``split`` is 0 for a block of its own, else the first ``split`` members are
    paired with the others. Members with equal ``root`` are joined already.
    ``keys`` are the members' band keys, by which they came to share buckets.
    """
    rows = np.arange(split or len(node))
    columns = np.arange(split, len(node))
    size = np.array([len(s) for s in sets])
    similar = np.empty((len(rows), len(columns)), np.float32)
    step = max(1, (1 << 24) // max(1, len(columns) * signature.shape[1]))
    for s in range(0, len(rows), step):
        equal = signature[rows[s : s + step], None, :] == signature[None, columns, :]
        share = equal.mean(2, dtype=np.float32)
        if band:
            earlier = keys[rows[s : s + step], None, :band] == keys[None, columns, :band]
            share[earlier.any(2)] = -1
        similar[s : s + step] = share
    x, y = size[rows][:, None], size[columns][None, :]
    similar[(percent * np.maximum(x, y) > 100 * np.minimum(x, y)) | (similar < _thinkable(percent))] = -1
    if not split:
        similar[np.tril_indices(len(rows))] = -1
    i, j = np.nonzero(similar >= 0)
    order = np.argsort(-similar[i, j], kind="stable")
    own = np.unique(root, return_inverse=True)[1].tolist()  # each member's component number
    parent = list(range(max(own, default=-1) + 1))

    def find(c: int) -> int:
        while parent[c] != c:
            parent[c] = parent[parent[c]]
            c = parent[c]
        return c

    links = []
    for a, b in zip(rows[i[order]].tolist(), columns[j[order]].tolist()):
        p, q = find(own[a]), find(own[b])
        if p != q and similar_sets(sets[a], sets[b], percent):
            parent[max(p, q)] = min(p, q)
            links.append((int(node[a]), int(node[b])))
    return links


def _compare(members: DataFrame, percent: int, across: bool) -> DataFrame:
    """Links (a, b) inside the blocks of band groups, or ``across`` their blocks.

    ``members`` has bucket, n, band, node, root, set, signature and keys.
    """
    count = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node", "bucket"), count).cast("int")
    placed = members.withColumn("blocks", count).withColumn("own", own)
    if across:
        others = F.filter(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: k != F.col("own"))
        placed = placed.withColumn("other", F.explode(others))
    else:
        placed = placed.withColumn("other", F.col("own"))
    placed = placed.select(
        "bucket",
        F.least("own", "other").alias("low"),
        F.greatest("own", "other").alias("high"),
        "own",
        "band",
        "node",
        "root",
        "set",
        "signature",
        "keys",
    )
    keys = ["bucket", "low", "high"]
    dealt = placed.repartition(*keys).sortWithinPartitions(*keys, "own", "node")

    def links_of(group: pa.Table) -> list[tuple[int, int]]:
        own = group["own"].to_numpy()
        split = int((own == group["low"][0].as_py()).sum()) if across else 0
        if len(own) < 2 or split == len(own):
            return []
        signature = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint8)
        return block_links(
            group["band"][0].as_py(),
            group["node"].to_numpy(),
            group["root"].to_numpy(),
            [np.frombuffer(s, np.uint64) for s in group["set"].to_pylist()],
            signature.reshape(len(own), -1),
            np.frombuffer(b"".join(group["keys"].to_pylist()), np.uint64).reshape(len(own), -1),
            split,
            percent,
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in whole_groups(batches, keys):
            links = np.array(links_of(group), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal keys, as one table for each key."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        for key in keys:
            values = batch.column(key).to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
        cuts = [*np.flatnonzero(changed).tolist(), batch.num_rows]
        first = 0
        for cut in cuts:
            piece = batch.slice(first, cut - first)
            if first == 0 and rest:
                if any(piece.column(k)[0].as_py() != rest[0].column(k)[0].as_py() for k in keys):
                    yield pa.Table.from_batches(rest)
                    rest = []
            if cut == batch.num_rows:
                rest.append(piece)
            elif rest:
                yield pa.Table.from_batches([*rest, piece])
                rest = []
            else:
                yield pa.Table.from_batches([piece])
            first = cut
    if rest:
        yield pa.Table.from_batches(rest)


def _verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    joined = pairs.join(sets.select(F.col("node").alias("b"), F.col("set").alias("set_of_b")), "b").join(
        sets.select(F.col("node").alias("a"), F.col("set").alias("set_of_a")), "a"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("set_of_a"), batch.column("set_of_b")
            linked = [
                similar_sets(np.frombuffer(x[i].as_buffer(), np.uint64), np.frombuffer(y[i].as_buffer(), np.uint64), percent)
                for i in range(batch.num_rows)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return joined.select("a", "b", "set_of_a", "set_of_b").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    percent: int = PERCENT,
) -> DataFrame:
    """For each row: ``key``, ``n_shingles``, ``component_id``, ``kept``.

    ``component_id`` is the least id that links reach; a group's row with that
    id is the one kept. ``key`` must be a whole number.
    """
    spark = docs.sparkSession
    shared = Shared(spark, "near-duplicates")
    texts = docs.select(F.col(key).cast("long").alias("node"), F.col(text).alias("text"))
    sketched = shared.write(with_kernel(texts, "text", _SKETCH, _sketch).drop("text"), "sketch")
    classes = shared.write(
        sketched.filter((F.col("n_shingles") > 0) & F.col("node").isNotNull())
        .groupBy("set_a", "set_b")
        .agg(
            F.min("node").alias("node"),
            F.first("bands").alias("bands"),
        ),
        "classes",
    )
    rows = shared.write(sketched.select("node", "n_shingles", "set_a", "set_b"), "rows")
    shared.drop(sketched)

    # Band groups of more than one class; of equal larger groups the first band's.
    banded = classes.select("node", F.posexplode("bands").alias("band", "bucket"))
    groups = shared.write(
        banded.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("a"), F.max("node").alias("b"))
        .filter("n > 1"),
        "groups",
    )
    couples = shared.write(groups.filter("n = 2 and a <> b").select("a", "b").distinct(), "couples")
    grouped = shared.write(banded.join(groups.filter("n > 2"), "bucket"), "grouped")
    chosen = (
        grouped.groupBy("bucket", "n", "a", "b")
        .agg(F.bit_xor(F.xxhash64("node")).alias("members"), F.min("band").alias("band"))
        .groupBy("n", "a", "b", "members")
        .agg(F.min_by("bucket", "band").alias("bucket"))
        .select("bucket")
    )
    members = shared.write(
        grouped.select("bucket", "n", "band", "node").join(chosen, "bucket", "left_semi"), "members"
    )

    # The sets of all classes that any candidate pair can name, made once.
    named = shared.write(
        couples.select(F.explode(F.array("a", "b")).alias("node")).unionByName(members.select("node")).distinct(),
        "named",
    )
    maybe, _ = split_by_ids(texts, "node", named)
    fields = T.StructType().add("set", "binary").add("signature", "binary").add("keys", "binary")
    sets = shared.write(
        with_kernel(maybe.join(named, "node", "left_semi"), "text", fields, _sets).select("node", "set", "signature", "keys"),
        "sets",
    )

    inside = members.withColumn("root", F.col("node")).join(sets, "node")
    links = shared.write(_compare(inside, percent, across=False).unionByName(_verify(couples, sets, percent)), "links")
    roots = components(links, shared)
    several = members.filter(F.col("n") > BLOCK)
    if not several.isEmpty():
        labelled = several.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        apart = labelled.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x <> y")
        across = labelled.join(apart.select("bucket"), "bucket", "left_semi").join(sets, "node")
        links = links.unionByName(shared.write(_compare(across, percent, across=True), "links-across"))
        roots = components(links, shared)

    for table in (groups, couples, grouped, members, named, sets, links):
        shared.drop(table)  # the roots are written
    answer = (
        rows.join(classes.select("set_a", "set_b", F.col("node").alias("of_class")), ["set_a", "set_b"], "left")
        .join(roots.withColumnRenamed("node", "of_class"), "of_class", "left")
        .withColumn(
            "component_id",
            F.when(F.col("node").isNotNull(), F.coalesce("root", "of_class", "node")),
        )
    )
    return answer.select(
        F.col("node").alias(key),
        "n_shingles",
        "component_id",
        F.col("node").eqNullSafe(F.col("component_id")).alias("kept"),
    )
