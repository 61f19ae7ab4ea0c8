"""Semi and anti joins of wide rows with few ids, without moving the others.

The ids set bits of a bitmap of fixed size, which every task gets. Rows whose
bit is not set have none of the ids and stay where they are; only the rest is
shuffled for an exact join. A bitmap that is too small for its ids lets more
rows through and changes no result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import column_name

# 1 MB; raise it with the number of ids (16 bits an id let one row in 16 pass).
FILTER_BITS = 1 << 23


def split_by_ids(
    df: DataFrame, key: str, ids: DataFrame, bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """Rows whose ``key`` may be among ``ids`` (one column), and rows whose key is not.

    Null keys are not. ``ids`` should be a written table; it is read here.
    """
    (name,) = ids.columns

    def place(column: str):
        return F.pmod(F.xxhash64(column), F.lit(bits)) + 1  # bitmap functions count from 1

    parts = (
        ids.filter(F.col(name).isNotNull())
        .select(place(name).alias("place"))
        .groupBy(F.expr("bitmap_bucket_number(place)").alias("part"))
        .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bitmap"))
        .collect()  # bits / 32768 rows of 4 KB, whatever the number of ids
    )
    bitmap = np.zeros(-(-bits // 32768) * 4096, np.uint8)
    for row in parts:
        bitmap[(row["part"] - 1) * 4096 : row["part"] * 4096] = np.frombuffer(row["bitmap"], np.uint8)
    sent = df.sparkSession.sparkContext.broadcast(bitmap)

    mark = column_name(df, "bit_place")
    placed = df.withColumn(mark, F.when(F.col(key).isNotNull(), place(key)))

    def rows(wanted: bool):
        def run(batches):
            flags = np.unpackbits(sent.value, bitorder="little").astype(bool)
            for batch in batches:
                at = batch.column(batch.num_columns - 1).fill_null(0).to_numpy(zero_copy_only=False)
                hit = flags[np.maximum(at, 1) - 1] & (at > 0)
                yield batch.filter(pa.array(hit == wanted)).select(batch.schema.names[:-1])

        return placed.mapInArrow(run, df.schema)

    return rows(True), rows(False)
