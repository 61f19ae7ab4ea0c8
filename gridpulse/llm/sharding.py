"""Operator 1, sharding by sampled splitters; DataFrame operations only.

Records are ordered by a hash of their text and then by id, so that equal texts
are neighbours. A sample in which a record's chance grows with its size gives
splitters: quantile boundaries of the sample cut the order into ranges of nearly
equal bytes. Ranges that turn out overfull are subdivided by the samples inside
them; a group of equal texts that is large beyond measure is cut by id. The exact
bytes of the ranges then place every record at its byte offset in the whole
order, and a shard is an equal part of those bytes.

A shard's size differs from its due by a record's at each border. A group of
equal texts on a border goes to one side whole, unless it holds more than
``WHOLE`` of a shard's due: then the border cuts it.

A record's size is its text's UTF-8 bytes plus one. Null texts count as groups
of their own kind and null ids come first; repeated rows get a slot each. An
empty table gives an empty result; columns other than the id and the text are not
read, whatever their names. A very long text is measured where it is scanned and is
not moved. Rows equal in id and text cannot be told apart by a splitter, so they
lie in one range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.llm.ranges import count_below
from gridpulse.llm.stages import Shared

SHARDS = 16
# Ranges the order is cut into: with the samples they bound what the driver holds,
# and they are the parallelism of the sort, whatever the cluster's settings.
RANGES = 1_024
# Samples for each range; the error of a range's size is about a sixth then.
SAMPLES = 32
# A range beyond so many times its due is subdivided.
OVERFULL = 1.5
# Groups up to this part of a shard are not cut.
WHOLE = 1 / 16
_UNIT = 1 << 53


def _key(text_hash: Column, key: Column) -> Column:
    return F.struct(text_hash.alias("text_hash"), F.coalesce(key, F.lit(-(1 << 63))).alias("id"))


def _literal(key) -> str:
    return f"named_struct('text_hash', {key['text_hash']}L, 'id', {key['id']}L)"


def _splitters(records: DataFrame, ranges: int, total: int) -> tuple[list, list]:
    """Quantile boundaries of a size-weighted sample, and the whole sample in order.

    A record is drawn if a hash of its key falls below its share of the bytes, so
    that a lost executor draws the same again. The sample's expected number is
    ``ranges * SAMPLES``, whatever the size of the table.
    """
    rate = ranges * SAMPLES / total
    draw = F.pmod(F.xxhash64("key", F.lit(1)), F.lit(_UNIT)) / _UNIT
    rows = records.filter(draw < F.col("size") * rate).select("key").distinct().orderBy("key").collect()
    sample = [row["key"] for row in rows]
    boundaries = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    return boundaries, sample


def _subdivided(boundaries: list, sample: list, sizes: dict[int, int], due: float) -> list:
    """The boundaries, and further ones from the sample inside overfull ranges."""
    inside: dict[int, list] = {}
    r = 0
    for key in sample:
        while r < len(boundaries) and key >= boundaries[r]:
            r += 1
        inside.setdefault(r, []).append(key)
    more = set(boundaries)
    for r, size in sizes.items():
        parts = int(size / due) + 1
        keys = inside.get(r, [])
        if size > OVERFULL * due and keys:
            more |= {keys[i * len(keys) // parts] for i in range(1, parts)}
    return sorted(more)


def _with_range(records: DataFrame, boundaries: list) -> DataFrame:
    return records.withColumn("range", count_below([_literal(b) for b in boundaries], F.col("key"), also_equal=True))


def shard_by_bytes(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text", ranges: int = RANGES) -> DataFrame:
    """For each row: ``doc_id``, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``, ``grown_shard``.

    ``law`` is ``bytes``: the shards' sizes are as equal as whole records allow.
    ``slot`` counts a shard's records from 0; ``grown_shard`` is null, since that
    law says nothing of another number of shards. ``ranges`` is the parallelism
    of the sort.
    """
    spark = docs.sparkSession
    shared = Shared(spark, "sharding")
    ranges = max(ranges, 4 * shards)
    raw = F.col(text).cast("string")
    records = shared.write(
        docs.select(
            F.col(key).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(raw), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce(raw, F.lit("")).cast("binary")).alias("text_crc32"),
            _key(F.xxhash64(raw), F.col(key).cast("long")).alias("key"),
        ),
        "records",
    )
    total = records.agg(F.sum("size")).first()[0] or 1
    boundaries, sample = _splitters(records, ranges, total)
    sizes = {row["range"]: row["size"] for row in _with_range(records, boundaries).groupBy("range").agg(F.sum("size").alias("size")).collect()}
    boundaries = _subdivided(boundaries, sample, sizes, total / ranges)
    ranged = _with_range(records, boundaries)

    # Where each range begins; one row for each, so the window is small.
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        ranged.groupBy("range")
        .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        .select(
            "range",
            F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("byte_start"),
            F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("row_start"),
        )
    )
    so_far = Window.partitionBy("range").orderBy("key").rowsBetween(Window.unboundedPreceding, -1)
    in_range = Window.partitionBy("range").orderBy("key")
    placed = (
        ranged.withColumn("bytes_before", F.coalesce(F.sum("size").over(so_far), F.lit(0)))
        .withColumn("rows_before", F.row_number().over(in_range) - 1)
        .join(F.broadcast(starts), "range")  # one row for each range
        .withColumn("middle", 2 * (F.col("byte_start") + F.col("bytes_before")) + F.col("size"))
        .withColumn("row", F.col("row_start") + F.col("rows_before"))
    )
    # A record belongs to the shard that holds its middle byte.
    sharded = shared.write(
        placed.select(
            "doc_id",
            "size",
            "text_crc32",
            F.col("key.text_hash").alias("text_hash"),
            "middle",
            F.expr(f"cast(least((middle * {shards}) div {2 * total}, {shards - 1}) as int)").alias("shard"),
            "row",
        ),
        "sharded",
    )
    whole = _whole_groups(sharded, shards, total)
    if whole:
        of_group = F.create_map(*(F.lit(v) for pair in whole.items() for v in pair))
        sharded = sharded.withColumn("shard", F.coalesce(F.element_at(of_group, F.col("text_hash")), F.col("shard")))
    firsts = sharded.groupBy("shard").agg(F.min("row").alias("first"))
    return sharded.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("row") - F.col("first")).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _whole_groups(sharded: DataFrame, shards: int, total: int) -> dict[int, int]:
    """The shard of each group of equal texts that a border cuts but must not.

    At most one group lies on each border, so little is collected.
    """
    ends = sharded.groupBy("shard").agg(F.min_by("text_hash", "row").alias("first"), F.max_by("text_hash", "row").alias("last")).collect()
    firsts, lasts = {row["first"] for row in ends}, {row["last"] for row in ends}
    cut = firsts & lasts
    if not cut:
        return {}
    groups = (
        sharded.filter(F.col("text_hash").isin(*cut))
        .groupBy("text_hash")
        .agg(F.sum("size").alias("bytes"), F.min(F.col("middle") - F.col("size")).alias("begin"))
        .collect()
    )
    return {
        row["text_hash"]: min((row["begin"] + row["bytes"]) * shards // (2 * total), shards - 1)
        for row in groups
        if row["bytes"] <= WHOLE * total / shards
    }
