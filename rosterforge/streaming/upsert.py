"""Incremental upsert: every micro-batch of template rows merges into the snapshot of best rows.

The snapshot is versioned by batch: a batch that is run again after a failure
writes its version again from the version before it, so the result is the same.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import merge
from ..sources import files


def merge_batch(snapshot: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that keeps ``snapshot/batch=n`` up to date."""

    def apply(batch: DataFrame, number: int) -> None:
        spark: SparkSession = batch.sparkSession
        before = latest(spark, snapshot, below=number)
        existing = spark.read.parquet(before) if before else batch.limit(0)
        merge.upserted(existing, batch).write.mode("overwrite").parquet(f"{snapshot.rstrip('/')}/batch={number:012d}")

    return apply


def latest(spark: SparkSession, snapshot: str, below: int | None = None) -> str | None:
    """Folder of the newest complete version, or of the newest before a batch, on whatever store the snapshot lies."""
    found = []
    for folder in files.listed(spark, snapshot):
        name = folder.rstrip("/").rpartition("/")[2]
        number = name.removeprefix("batch=")
        if name.startswith("batch=") and number.isdigit() and files.exists(spark, folder + "/_SUCCESS"):
            if below is None or int(number) < below:
                found.append((int(number), folder))
    return max(found)[1] if found else None


def upsert_stream(rows: DataFrame, snapshot: str, checkpoint: str, **trigger) -> StreamingQuery:  # noqa: ANN003
    """Start the stream: ``rows`` has ``ord`` and the template's columns; ``trigger`` as for ``writeStream``."""
    return (
        rows.writeStream.foreachBatch(merge_batch(snapshot))
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )
