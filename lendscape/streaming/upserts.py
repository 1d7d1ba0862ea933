"""Files as they arrive, merged into a keyed table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendscape.operators.latest import latest_per_key
from lendscape.sources import store


def batch_label(batch_id: int) -> str:
    """Sortable label of a micro-batch."""
    return f"batch{batch_id:012d}"


def upsert_files(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    root: str,
    keys: Sequence[str],
    order: str,
    checkpoint: str,
    tiebreak: Sequence[str] | None = None,
    files_per_batch: int = 1000,
    fold_after: int = store.FOLD_AFTER,
) -> None:
    """Merge parquet files not seen before, in batches, and return when there are no more.

    A batch is reduced to the latest row per key and stored as the delta named after its id. A
    batch that is repeated after a failure replaces its own delta, so every file counts once;
    the checkpoint remembers which files were taken.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        latest = latest_per_key(batch, keys, order, tiebreak)
        store.publish_upsert(batch.sparkSession, root, latest, keys, batch_label(batch_id), fold_after)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)
    (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
