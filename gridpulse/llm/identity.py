"""Keys for rows whose id names several texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.stages import Shared, column_name, numbered


def with_text_key(docs: DataFrame, shared: Shared, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """The frame and the name of a whole-number column that is one for each id and text.

    It is the id where the id has one text, however many rows; other ids' texts get
    numbers beyond the largest id, in the order of id and text digest. Null ids stay
    null. Without ids of several texts the frame is the given one, and its key.
    """
    seen = docs.filter(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), F.sha2(F.coalesce(text, F.lit("")), 256).alias("digest"))
    several = shared.write(
        seen.groupBy("id").agg(F.min("digest").alias("least"), F.max("digest").alias("most")).filter("least <> most").select("id"), "several"
    )
    if several.isEmpty():
        return docs, key
    most = docs.agg(F.max(F.col(key).cast("long"))).first()[0]
    places = numbered(seen.join(several, "id", "left_semi").distinct(), ["id", "digest"], shared)
    own_id, digest, new = (column_name(docs, name) for name in ("id_of_text", "text_digest", "text_key"))
    renamed = shared.write(
        places.select(F.col("id").alias(own_id), F.col("digest").alias(digest), (F.col("place") + F.lit(most) + 1).alias(new)), "renamed"
    )
    same = (F.col(key).cast("long") == F.col(own_id)) & (F.sha2(F.coalesce(text, F.lit("")), 256) == F.col(digest))
    found = docs.join(renamed, same, "left").drop(own_id, digest)
    return found.withColumn(new, F.coalesce(new, F.col(key).cast("long"))), new
