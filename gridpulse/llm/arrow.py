"""Adding columns that a block kernel computes from a text column."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.llm.stages import column_name

# Rows of an Arrow batch. A task holds several batches at a time, and texts may
# be long; blocks of a megabyte are large enough for numpy.
BATCH_ROWS = 1_000
_BATCH_ROWS_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by ``BATCH_ROWS``, unless they are smaller."""
    if not 0 < int(spark.conf.get(_BATCH_ROWS_CONF)) <= BATCH_ROWS:
        spark.conf.set(_BATCH_ROWS_CONF, str(BATCH_ROWS))


# kernel(text column) -> one Arrow array for each new column
Kernel = Callable[[pa.Array], Sequence[pa.Array]]


def with_kernel(df: DataFrame, text: str, fields: T.StructType, kernel: Kernel) -> DataFrame:
    """The frame plus ``fields``; rows stay where they are, nothing is shuffled.

    A new column whose name an input column has already gets leading
    underscores. Rows are not dropped, whatever they hold.
    """
    small_batches(df.sparkSession)
    at = df.columns.index(text)
    names = [column_name(df, field.name) for field in fields]
    schema = T.StructType(
        [*df.schema.fields, *(T.StructField(n, f.dataType) for n, f in zip(names, fields))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = kernel(batch.column(at))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *new], names=[*batch.schema.names, *names]
            )

    return df.mapInArrow(run, schema)


def labelled_sample(
    docs: DataFrame,
    labels: DataFrame,
    label: str,
    max_examples: int,
    folds: int = 1,
    held_out: int = -1,
    max_bytes: int | None = None,
) -> DataFrame:
    """A bounded sample of labelled documents: doc_id, text, ``label``.

    Only documents whose crc32(doc_id as text) mod ``folds`` is not ``held_out``
    are used. The sample is the ``max_examples`` of them that come first by a
    hash of the id, the same at each run, as far as their texts are ``max_bytes``
    together. A document that is labelled more than once counts once, with its
    larger label; rows without id or label are left out.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .filter(in_fold("doc_id", folds) != held_out)
        .groupBy("doc_id")
        .agg(F.max(label).alias(label))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(max_examples)
    )
    # At most ``max_examples`` ids, so the broadcast is bounded.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    if max_bytes is None:
        return sample
    sizes = sample.groupBy("doc_id").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")).alias("size"))
    # The window ranks the ids of the sample, max_examples at most.
    upto = Window.orderBy(F.xxhash64("doc_id"), "doc_id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = sizes.withColumn("upto", F.sum("size").over(upto)).filter(F.col("upto") <= max_bytes)
    return sample.join(F.broadcast(within.select("doc_id")), "doc_id")


def in_fold(doc_id: str, folds: int):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds
