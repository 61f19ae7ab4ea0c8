"""Operator 3, mixing sources to target weights by Poisson replication.

A source's target repetition rate is its share of the target over its share of
the bytes. Each document is repeated as often as a Poisson variable with that
mean says, drawn by inverting the distribution at a hash of the document's id and
a seed: the same at every run, and independent of all other documents. The copies
are then dealt out anew by a hash, which shuffles them globally.

Rates are per source and counts per document, so a source with a third of all
rows is like any other. A null source is a source of its own. Documents without
text count one byte. Repeated rows are repeated alike. An empty table gives no
rows, and new columns whose names input columns have get leading underscores. A
very long text is moved once for each of its copies and never copied in a task.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared, column_name

SEED = 3
# Target weights are sizes to this power: below 1 small sources gain.
EXPONENT = 0.5
# A rate beyond it is drawn in equal parts, so that exp(-rate) stays a number.
LARGEST_PART = 500.0
_UNIT = float(1 << 52)


def hashed_uniform(*parts: Column | str) -> Column:
    """A number in (0, 1) from the MD5 of the parts' text; null counts as empty."""
    text = F.concat_ws(":", *(F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts))
    return (F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") + 0.5) / _UNIT


def source_rates(
    docs: DataFrame,
    source: str = "source",
    text: str = "text",
    weights: Mapping[str, float] | None = None,
    exponent: float = EXPONENT,
    epochs: float = 1.0,
) -> DataFrame:
    """(source, rate): each source's mean number of copies.

    The mixture has ``epochs`` times the bytes of all documents. Without
    ``weights``, a source's weight is its bytes to the power ``exponent``; with
    them, sources that they do not name get none.
    """
    sizes = docs.groupBy(F.col(source).alias("source")).agg(
        F.sum(F.greatest(F.coalesce(F.octet_length(F.col(text)), F.lit(0)), F.lit(1)).cast("long")).alias("bytes")
    )
    if weights is None:
        weight = F.pow(F.col("bytes").cast("double"), F.lit(exponent))
    else:
        named = [F.lit(v) for k, w in weights.items() for v in (k, float(w))]
        weight = F.coalesce(F.element_at(F.create_map(*named), F.col("source")), F.lit(0.0)) if named else F.lit(0.0)
    sizes = sizes.withColumn("weight", weight)
    total = sizes.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weight"))
    row = total.first()
    all_bytes, all_weight = float(row["all_bytes"] or 0), float(row["all_weight"] or 0)
    share = F.col("weight") / all_weight if all_weight else F.lit(0.0)
    return sizes.select("source", (share * (epochs * all_bytes) / F.col("bytes")).alias("rate"))


def poisson_table(rate: Column) -> Column:
    """P(X <= 0), P(X <= 1), ... as far as they differ from 1, of a Poisson X."""
    last = F.ceil(rate + 12 * F.sqrt(rate) + 30).cast("int")
    first = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("sums"))

    def extend(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["sums"], F.array(F.element_at(state["sums"], -1) + p)).alias("sums"))

    return F.aggregate(F.sequence(F.lit(1), last), first, extend, lambda state: state["sums"])


def mix_sources(
    docs: DataFrame,
    rates: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """Every document as often as drawn, in a new order, plus ``copy`` (from 1) and ``shuffle_key``."""
    copy, order = column_name(docs, "copy"), column_name(docs, "shuffle_key")
    of_source, n_parts, sums, times = (column_name(docs, name) for name in ("of_source", "rate_parts", "rate_sums", "times"))
    parts = F.greatest(F.ceil(F.col("rate") / LARGEST_PART).cast("int"), F.lit(1))
    # Written, so that Spark knows its size: a small table is broadcast, and the
    # documents are not shuffled by a source that may hold a third of them.
    tables = Shared(docs.sparkSession, "mixing").write(
        rates.select(F.col("source").alias(of_source), parts.alias(n_parts), poisson_table(F.col("rate") / parts).alias(sums)),
        "tables",
    )
    # One number for each part, then the inverse of the distribution at each.
    draws = F.transform(F.sequence(F.lit(0), F.col(n_parts) - 1), lambda part: hashed_uniform(F.lit(seed), F.col(key), part))
    drawn = F.aggregate(draws, F.lit(0), lambda n, u: n + F.size(F.filter(sums, lambda s: s < u)))
    repeated = (
        docs.join(tables, F.col(source).eqNullSafe(F.col(of_source)))
        .withColumn(times, drawn)
        .select(*docs.columns, F.explode(F.when(F.col(times) > 0, F.sequence(F.lit(1), F.col(times)))).alias(copy))
        .withColumn(order, F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string"), F.col(copy).cast("string"))))
    )
    return repeated.repartition(order).sortWithinPartitions(order)
