"""Landed pages to tables, each page once.

How the pages are cut into micro-batches, and in which order they land, does not
show in the tables: see ``ingest_pages``. Late and revised readings need no
watermark, because no state is kept between batches but the tables themselves.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from gridpulse.plans.pipeline import ingest_pages
from gridpulse.sources.pages import stream_pages
from gridpulse.sources.store import TableStore


def ingest_stream(
    store: TableStore,
    pages_path: str,
    checkpoint: str | None = None,
    max_files: int = 1000,
    densify: bool = True,
    number: str | None = None,
) -> StreamingQuery:
    """Start a query that ingests all pages landed so far and then stops.

    Progress is kept beside the store's tables unless ``checkpoint`` names a
    folder; each pair of store and pages needs one of its own. A batch that is
    replayed after a failure leaves the same tables. ``number`` finds a file's
    sequence number in its path, see ``read_pages``.
    """
    pages = hashlib.sha256(pages_path.rstrip("/").encode()).hexdigest()[:16]
    checkpoint = checkpoint or f"{store.root}/_progress/{pages}"

    def ingest(batch: DataFrame, _: int) -> None:
        ingest_pages(store, batch, densify)

    return (
        stream_pages(store.spark, pages_path, max_files, number)
        .writeStream.foreachBatch(ingest)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
