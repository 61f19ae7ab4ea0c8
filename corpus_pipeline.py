"""A corpus from raw documents to packed batches, in stages.

Each stage reads what its predecessor has kept, as Parquet, and works on all of
it. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.identity import with_text_key
from gridpulse.llm.langid import UNDETERMINED, farthest_distance, identify_language, learn_profiles
from gridpulse.llm.membership import split_by_ids
from gridpulse.llm.mixing import mix_sources, source_rates
from gridpulse.llm.neardup import near_duplicates
from gridpulse.llm.packing import pack
from gridpulse.llm.rules import judge_quality, train_rules
from gridpulse.llm.stages import Shared

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: documents that the base rules or the trees reject go."""
    trees = train_rules(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    judged = judge_quality(docs, trees)
    return judged.filter(judged.columns[-1]).select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that are far from every language's profile go.

    The limit lies beyond the distances of the labelled documents; texts without a
    letter are as far as can be. Profiles and limit come from all labelled documents;
    the distances are written once, for the limit and for the result.
    """
    profiles = learn_profiles(docs)
    found = Shared(spark, "language-id").write(identify_language(docs, profiles, distance=True), "distances")
    *_, predicted, _, distance = found.columns
    near = found[distance] <= farthest_distance(found, predicted, distance)
    return found.filter((found[predicted] != UNDETERMINED) & near).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: of each group of near copies the document with the least id stays.

    Rows equal in id and text are one document, of which one row stays; an id with
    several texts is as many documents. Rows without id all stay. Only rows whose
    id is not certain to stay are shuffled.
    """
    shared = Shared(spark, "near-dedup")
    rows, key = with_text_key(docs, shared)
    groups = shared.write(near_duplicates(rows, key), "groups")
    seen = groups.filter(F.col(key).isNotNull()).groupBy(key).agg(F.bool_and("kept").alias("kept"), F.count("kept").alias("n"))
    doubtful = shared.write(seen.filter("not kept or n > 1"), "doubtful")
    maybe, certain = split_by_ids(rows, key, doubtful.select(key))
    gone = doubtful.filter("not kept").select(key)
    left = maybe.join(gone, key, "left_anti").dropDuplicates([key])
    return certain.unionByName(left.select(*rows.columns)).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents repeated so that sources meet their target weights."""
    return mix_sources(docs, source_rates(docs)).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: documents in batches of their length buckets."""
    return pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("language id", language_id),
    ("near dedup", near_dedup),
    ("mixing", mixing),
    ("packing", packing),
]

# The verdict of boosted trees, rank-order profiles and optimal buckets is no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and reread."""
    shared = Shared(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = shared.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
