"""Operator 11, a Merkle manifest of a dataset, by bitmap ranks and slot arrays.

Every row is a leaf, the digest of its framed fields. Inside a group leaves ascend
by id; ``ARITY`` consecutive nodes have a parent; the groups' roots, in the order
of the groups' text (null first, then by UTF-8 bytes), have a tree of their own.

Leaf coordinates come without sorting the leaves. Ids set bits of 64-bit words,
merged by a bitwise-or aggregate, so a group's bitmap is compressed to the words
that are not empty. Popcounts of words, of blocks of 512 words, of blocks of 512
blocks and so on make a directory, and a leaf's slot is the directory's count
before its word plus the popcount below its bit. Ids that are there more than once
have one bit but several leaves; words with such ids (and null ids, which come
first) are ranked by a range sort of their rows alone, ties by leaf digest. Leaves
that are equal in id and digest are interchangeable. Of the words that hold more
than a thousandth of all leaves there are under a thousand, so these are broadcast
and their rows are never dealt by word.

The levels are reduced by keyed slot arrays: the digests of ``SPAN`` consecutive
slots form an array under one key, which is folded by ``LEVELS`` levels to one node
of the next round, whatever the group's size. Proofs are handed down the same
blocks. A task holds one block at a time, and no key has more than ``SPAN`` rows.

Null fields are framed apart from empty ones. Repeated rows are leaves of their own.
An empty table gives no rows. Other columns are not read, whatever their names; a very
long text is hashed where it is scanned and is never shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared, numbered

ARITY = 3
# Levels that one round reduces, and the slots of a block.
LEVELS = 5
SPAN = ARITY**LEVELS
# A directory entry counts 2 ** FANOUT_BITS entries of the level below.
FANOUT_BITS = 9
_WORD_BITS = 6
# Words with more than this part of all leaves are broadcast: fewer than its inverse.
HEAVY = 1e-3
_POWERS = [ARITY**k for k in range(40) if ARITY**k < 1 << 62]


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields: ``-`` if null, else UTF-8 byte count, ``:`` and value."""
    texts = [field.cast("string") for field in fields]
    framed = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]
    return F.sha2(F.concat(*framed), 256)


def group_key(group: Column) -> Column:
    """Text that orders groups: null first, then by bytes. Never null."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit("-"))


def proof_digest(path: Column) -> Column:
    """SHA-256 of a proof's digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def fold_proof(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def inclusion_proofs(leaves: DataFrame, shared: Shared) -> DataFrame:
    """Each leaf with its slot in its group, ``subroot``, ``root`` and ``path``.

    ``leaves`` has ``grp`` (see ``group_key``), ``id`` (long, null allowed) and
    ``digest``, and any columns that equal leaves have in common. ``path`` has a
    struct of left and right siblings' digests for each level, from the leaf up.
    """
    leaves = shared.write(leaves, "leaves")
    payload = [c for c in leaves.columns if c not in ("grp", "digest")]
    placed = shared.write(_coordinates(leaves, shared), "placed")
    deepest = placed.agg(F.max("total")).first()[0] or 0
    rounds = _climb(placed, payload, deepest, shared)
    subroots = shared.write(rounds[-1].select("grp", F.col("node").alias("digest")), "subroots")

    # The groups' tree: the same, with the groups' ranks as slots of one group.
    n_groups = subroots.count()
    ranked = numbered(subroots, ["grp"], shared).select(
        F.lit("").alias("grp"), F.col("place").alias("slot"), "digest", F.lit(n_groups).cast("long").alias("total"), F.col("grp").alias("of")
    )
    top = _climb(ranked, ["of"], n_groups, shared)
    no_path = F.expr("CAST(array() AS ARRAY<STRUCT<left: STRING, right: STRING>>)")
    roots = top[-1].select("grp", F.col("block").alias("slot"), F.col("node").alias("root"), no_path.alias("path"))
    of_group = _descend(top, roots, ["root"]).select(F.col("of").alias("grp"), F.lit(0).cast("long").alias("slot"), F.col("digest").alias("subroot"), "root", "path")
    return _descend(rounds, shared.write(of_group, "group-paths"), ["subroot", "root"])


# -- slots ----------------------------------------------------------------------


def _coordinates(leaves: DataFrame, shared: Shared) -> DataFrame:
    """The leaves with ``slot`` (from 0, in their group) and ``total`` (of the group)."""
    leaves = leaves.withColumn("word", F.shiftright("id", _WORD_BITS))
    bit = F.expr("shiftleft(1L, CAST(id & 63 AS INT))")
    counted = leaves.groupBy("grp", "word").agg(F.bit_or(bit).alias("bits"), F.count(F.lit(1)).alias("n"))
    words = shared.write(counted, "words")
    span = words.agg(F.min("word").alias("low"), F.max("word").alias("high"), F.sum("n").alias("n")).first()
    directory = shared.write(_directory(words, span["low"], span["high"]), "directory")

    # bit_or of no bits is null: null ids have a word of their own, with no bit.
    repeated = F.col("n") != F.coalesce(F.bit_count("bits"), F.lit(0))
    heavy_rows = max(1 << _WORD_BITS, HEAVY * (span["n"] or 0))
    tied = directory.filter(repeated)
    heavy, light = tied.filter(F.col("n") > heavy_rows), tied.filter(F.col("n") <= heavy_rows)
    n_tied = tied.agg(F.count(F.lit(1)).alias("all"), F.coalesce(F.sum((F.col("n") > heavy_rows).cast("long")), F.lit(0)).alias("heavy")).first()

    below = F.expr("bits & ~shiftleft(-1L, CAST(id & 63 AS INT))")
    rows = leaves
    if n_tied["heavy"]:
        rows = _with_word(leaves, F.broadcast(heavy.select("grp", "word")), "left_anti")
    joined = _with_word(rows, directory, "inner")
    result = joined.filter(~repeated) if n_tied["all"] else joined
    result = result.withColumn("slot", F.col("before") + F.bit_count(below))
    names = [c for c in leaves.columns if c != "word"] + ["slot", "total"]
    result = result.select(*names)
    if n_tied["all"] > n_tied["heavy"]:
        result = result.unionByName(_ranked_by_sort(joined.filter(repeated).select(*leaves.columns), light, False, shared).select(*names))
    if n_tied["heavy"]:
        some = _with_word(leaves, F.broadcast(heavy.select("grp", "word")), "left_semi")
        result = result.unionByName(_ranked_by_sort(some, heavy, True, shared).select(*names))
    return result


def _with_word(leaves: DataFrame, words: DataFrame, how: str) -> DataFrame:
    """Leaves joined with words; null ids have the null word."""
    w = words.withColumnsRenamed({"grp": "w_grp", "word": "w_word"})
    found = leaves.join(w, (F.col("grp") == F.col("w_grp")) & F.col("word").eqNullSafe(F.col("w_word")), how)
    return found.drop("w_grp", "w_word")


def _directory(words: DataFrame, low: int | None, high: int | None) -> DataFrame:
    """Words with ``before`` (leaves of the group in earlier words) and ``total``.

    Level by level, runs of entries are counted up to one entry for each group,
    then the counts before each entry are handed down. Every key has at most
    2 ** FANOUT_BITS entries.
    """
    entries = words.filter(F.col("word").isNotNull()).select("grp", F.col("word").alias("at"), "n", "bits")
    levels = [entries]
    while low is not None:
        low, high = low >> FANOUT_BITS, high >> FANOUT_BITS
        last = low == high or (low, high) == (-1, 0)
        up = F.lit(0).cast("long") if last else F.shiftright("at", FANOUT_BITS)
        members = F.array_sort(F.collect_list(F.struct("at", "n", *(["bits"] if len(levels) == 1 else []))))
        levels.append(levels[-1].groupBy("grp", up.alias("up")).agg(members.alias("members"), F.sum("n").alias("n")).withColumnRenamed("up", "at"))
        if last:
            break
    nulls = words.filter(F.col("word").isNull()).select("grp", F.col("n").alias("nulls"))
    if len(levels) == 1:
        return nulls.select("grp", F.lit(None).cast("long").alias("word"), F.col("nulls").alias("n"), F.lit(None).cast("long").alias("bits"), F.lit(0).cast("long").alias("before"), F.col("nulls").alias("total"))
    tops = (
        levels[-1]
        .select("grp", "at", "n")
        .join(nulls, "grp", "full_outer")
        .select("grp", "at", F.coalesce("nulls", F.lit(0)).alias("before"), (F.coalesce("n", F.lit(0)) + F.coalesce("nulls", F.lit(0))).alias("total"))
    )
    first = tops.join(nulls, "grp").select("grp", F.lit(None).cast("long").alias("word"), F.col("nulls").alias("n"), F.lit(None).cast("long").alias("bits"), F.lit(0).cast("long").alias("before"), "total")
    known = tops.filter(F.col("at").isNotNull())
    for level in reversed(levels[1:]):
        counted = F.expr(
            "transform(members, (m, i) -> struct(m AS m, aggregate(slice(members, 1, i), before, (s, x) -> s + x.n) AS before))"
        )
        known = (
            level.drop("n")
            .join(known, ["grp", "at"])
            .select("grp", "total", F.explode(counted).alias("c"))
            .select("grp", F.col("c.m.at").alias("at"), "c.m", F.col("c.before").alias("before"), "total")
        )
        if level is not levels[1]:
            known = known.drop("m")
    named = known.select("grp", F.col("at").alias("word"), F.col("m.n").alias("n"), F.col("m.bits").alias("bits"), "before", "total")
    return named.unionByName(first)


def _ranked_by_sort(rows: DataFrame, words: DataFrame, few: bool, shared: Shared) -> DataFrame:
    """Slots of leaves whose words hold repeated ids, by place among such leaves."""
    unique = shared.write(rows.withColumn("tie", F.monotonically_increasing_id()), "repeated")
    placed = shared.write(numbered(unique, ["grp", "id", "digest", "tie"], shared), "repeated-placed")
    firsts = placed.groupBy("grp", "word").agg(F.min("place").alias("first"))
    spots = _with_word(firsts, words.select("grp", "word", "before", "total"), "inner")
    joined = _with_word(placed, F.broadcast(spots) if few else spots, "inner")
    return joined.withColumn("slot", F.col("before") + F.col("place") - F.col("first"))


# -- levels ---------------------------------------------------------------------


def _levels(total: Column) -> Column:
    """Levels above ``total`` leaves: the least L with ARITY ** L >= total."""
    powers = F.array(*(F.lit(p).cast("long") for p in _POWERS))
    return F.size(F.filter(powers, lambda p: p < total))


def _reduced(nodes: Column) -> Column:
    last = F.floor((F.size(nodes) - 1) / ARITY).cast("int")
    return F.transform(
        F.sequence(F.lit(0), last), lambda i: F.sha2(F.array_join(F.slice(nodes, i * ARITY + 1, F.lit(ARITY)), ""), 256)
    )


def _climb(nodes: DataFrame, payload: Sequence[str], deepest: int, shared: Shared) -> list[DataFrame]:
    """Written blocks of each round: ``members``, the digests of their levels, ``node``."""
    rounds = []
    while True:
        grouped = nodes.groupBy("grp", F.floor(F.col("slot") / SPAN).alias("block")).agg(
            F.array_sort(F.collect_list(F.struct("slot", "digest", *payload))).alias("members"), F.max("total").alias("total")
        )
        left = F.greatest(_levels(F.col("total")) - LEVELS * len(rounds), F.lit(0))
        grouped = grouped.withColumn("steps", F.least(left, F.lit(LEVELS))).withColumn("level0", F.col("members.digest"))
        for k in range(1, LEVELS + 1):
            below = F.col(f"level{k - 1}")
            grouped = grouped.withColumn(f"level{k}", F.when(F.col("steps") >= k, _reduced(below)).otherwise(below))
        node = F.element_at(f"level{LEVELS}", 1)
        names = ["grp", "block", "total", "steps", "members", *(f"level{k}" for k in range(LEVELS))]
        rounds.append(shared.write(grouped.select(*names, node.alias("node")), f"round{len(rounds)}"))
        if SPAN ** len(rounds) >= deepest:
            return rounds
        nodes = rounds[-1].select("grp", F.col("block").alias("slot"), F.col("node").alias("digest"), "total")
        payload = []


def _descend(rounds: Sequence[DataFrame], paths: DataFrame, carried: Sequence[str]) -> DataFrame:
    """The first round's members with their paths; ``paths`` has those of the last round's nodes."""
    for blocks in reversed(rounds):
        above = paths.select(F.col("grp").alias("p_grp"), F.col("slot").alias("p_slot"), "path", *carried)
        joined = blocks.join(above, (F.col("grp") == F.col("p_grp")) & (F.col("block") == F.col("p_slot")))

        def step(place: Column, k: int) -> Column:
            run = F.slice(f"level{k}", F.floor(place / ARITY ** (k + 1)).cast("int") * ARITY + 1, F.lit(ARITY))
            at = F.floor(place / ARITY**k).cast("int") % ARITY
            return F.struct(
                F.array_join(F.slice(run, F.lit(1), at), "").alias("left"),
                F.array_join(F.slice(run, at + 2, F.lit(ARITY)), "").alias("right"),
            )

        def whole(member: Column, place: Column) -> Column:
            inside = F.slice(F.array(*(step(place, k) for k in range(LEVELS))), F.lit(1), F.col("steps"))
            return F.struct(member.alias("m"), F.concat(inside, F.col("path")).alias("path"))

        paths = joined.select("grp", *carried, F.explode(F.transform("members", whole)).alias("x")).select(
            "grp", *carried, "x.m.*", "x.path"
        )
    return paths
