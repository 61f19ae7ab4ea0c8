"""Operator 12, how filters interact: failing-id relations and prefix joins.

Every row gets an id of its own, and each filter a stored table of the ids that
fail it, with the rows' labels as two more id tables. A prefix of an order keeps
the rows that none of its filters fails. The relation of all rows is split by
each id table in turn: the left-semi join has the rows that fail it, the left-anti
join those that pass. The ends of these splits are disjoint relations, one for each
set of failed filters, and a prefix's survivors, a step's removals, the removals
that an earlier filter had already made and the labels lost are unions of ends,
which are counted and never listed. Whatever the number of orders, a row takes part
in two joins for each filter.

Ids are dealt by hash and are unique, so no key is hot, whatever the documents hold;
texts that a thousandth of all rows share are looked up by broadcast (there are
fewer than a thousand), the others by a join on their digest.

Null text counts as empty, null parts as the empty part. Rows without doc_id have no
labels, are no copies of others and no originals of others. Repeated rows count each;
a doc_id that has several labels has a label if any of them is 1. An empty table
gives no rows. Very long texts are read where they lie, and only their digests move.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared

# Texts that more than this part of all rows have are broadcast: fewer than its inverse.
HEAVY = 1e-3
_SPACES = r"[\x20\x09-\x0D]+"


def document_filters(text: Column) -> dict[str, Column]:
    """The failure conditions of filters A to D over a text that is not null."""
    words = F.filter(F.split(text, _SPACES), lambda w: w != "")
    n_words = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return {
        "A": n_words < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * n_words.cast("long"),
        "C": 100 * capitals.cast("long") > 10 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def audit_documents(docs: DataFrame, labels: DataFrame, duplicates: str = "E") -> DataFrame:
    """The interaction of ``document_filters`` and a filter of repeated texts, by language."""
    shared = Shared(docs.sparkSession, "audit")
    text = F.coalesce("text", F.lit(""))
    failed = F.array_compact(F.array(*(F.when(c, F.lit(name)) for name, c in document_filters(text).items())))
    rows = shared.write(
        docs.select(
            F.monotonically_increasing_id().alias("row_id"),
            F.col("doc_id"),
            F.coalesce("lang", F.lit("")).alias("part"),
            F.sha2(text, 256).alias("digest"),
            failed.alias("failed"),
        ),
        "rows",
    )
    names = [*document_filters(text), duplicates]
    tables = {
        name: shared.write(rows.filter(F.array_contains("failed", name)).select("row_id"), f"fails-{name}") for name in names[:-1]
    }
    tables[duplicates] = shared.write(later_copies(rows, shared), f"fails-{duplicates}")
    marked = {
        name: shared.write(
            rows.join(labels.filter(F.col(column) == 1).select("doc_id").distinct(), "doc_id", "left_semi").select("row_id"), f"label-{name}"
        )
        for name, column in (("good", "quality"), ("toxic", "toxic"))
    }
    return audit_filters(rows.select("row_id", "part"), tables, marked, shared)


def later_copies(rows: DataFrame, shared: Shared) -> DataFrame:
    """``row_id`` of the rows whose ``digest`` a row with a smaller ``doc_id`` has."""
    known = rows.filter(F.col("doc_id").isNotNull())
    seen = known.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("n"))
    # Written: the copied texts only, most texts are there once.
    copied = shared.write(seen.filter(F.col("first") < F.col("last")).drop("last"), "copied")
    least = HEAVY * rows.count()
    heavy, light = copied.filter(F.col("n") > least), copied.filter(F.col("n") <= least)
    of_heavy = known.join(F.broadcast(heavy), "digest")
    others = known.join(F.broadcast(heavy.select("digest")), "digest", "left_anti")
    found = of_heavy.unionByName(others.join(light, "digest"))
    return found.filter(F.col("doc_id") > F.col("first")).select("row_id")


def audit_filters(
    rows: DataFrame, failing: Mapping[str, DataFrame], marked: Mapping[str, DataFrame], shared: Shared
) -> DataFrame:
    """One row for each part, order of the filters and step.

    ``rows`` has a unique ``row_id`` and ``part``; ``failing`` has an id table for
    each filter, ``marked`` one for each of the two labels ``good`` and ``toxic``.
    """
    ends = rows.withColumn("failed", F.lit(0))
    for k, ids in enumerate([*failing.values(), *marked.values()]):
        bit = F.col("failed").bitwiseOR(F.lit(1 << k))
        hit = ends.join(ids, "row_id", "left_semi").withColumn("failed", bit)
        ends = shared.write(hit.unionByName(ends.join(ids, "row_id", "left_anti")), f"split{k}")
    counted = shared.write(ends.groupBy("part", "failed").agg(F.count(F.lit(1)).alias("n")), "ends")
    return _orders(_steps(counted, len(failing)), list(failing))


def _steps(ends: DataFrame, filters: int) -> DataFrame:
    """Counts of each part, set of earlier filters (``before``) and filter (``at``, its bit)."""
    steps = [
        F.struct(F.lit(before).alias("before"), F.lit(1 << k).alias("at"))
        for before in range(1 << filters)
        for k in range(filters)
        if not before >> k & 1
    ]
    failed = F.col("failed")
    fails, earlier = failed.bitwiseAND(F.col("at")) != 0, failed.bitwiseAND(F.col("before")) != 0
    good, toxic = failed.bitwiseAND(1 << filters) != 0, failed.bitwiseAND(2 << filters) != 0

    def count(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0)))

    return (
        ends.select("part", "failed", "n", F.explode(F.array(*steps)).alias("s"))
        .select("part", "failed", "n", "s.*")
        .groupBy("part", "before", "at")
        .agg(
            count(~fails & ~earlier).alias("kept"),
            count(fails & ~earlier).alias("removed"),
            count(fails & earlier).alias("redundant"),
            count(failed.bitwiseAND((1 << filters) - 1) == F.col("at")).alias("unique_fails"),
            count(fails & ~earlier & good).alias("good_lost"),
            count(fails & ~earlier & toxic).alias("toxic_lost"),
        )
    )


def _orders(steps: DataFrame, names: Sequence[str]) -> DataFrame:
    """The steps of all orders, and what a filter removes over all of them."""
    n = len(names)
    lists: dict[tuple[int, int], list[str]] = {}
    for order in itertools.permutations(range(n)):
        before = 0
        for k in order:
            lists.setdefault((before, 1 << k), []).append("".join(names[i] for i in order))
            before |= 1 << k
    # n! orders of n filters, whatever the tables hold.
    table = steps.sparkSession.createDataFrame([(*key, orders) for key, orders in lists.items()], "before int, at int, orders array<string>")
    size = F.bit_count("before")
    in_orders = F.element_at(F.array(*(F.lit(factorial(k) * factorial(n - 1 - k)) for k in range(n))), size + 1)
    whole = steps.groupBy("part", "at").agg(F.sum(F.col("removed") * in_orders).alias("shapley"))
    return (
        steps.join(whole, ["part", "at"])
        .join(F.broadcast(table), ["before", "at"])
        .select(
            "part",
            F.explode("orders").alias("filter_order"),
            (size + 1).alias("step"),
            "kept",
            "removed",
            "redundant",
            "unique_fails",
            "good_lost",
            "toxic_lost",
            "shapley",
        )
    )
