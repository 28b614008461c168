"""Fact loads from arriving files with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from tillstar import schemas
from tillstar.plans import warehouse
from tillstar.sources.tables import TableStore
from tillstar.streaming.incremental import load_with_pending


def _stream(
    store: TableStore, name: str, folder: str, checkpoint: str, load: Callable[[DataFrame, int], None],
    files_per_batch: int | None,
) -> StreamingQuery:
    reader = store.spark.readStream.schema(schemas.STAGING[name])
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(folder)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def load_arriving_transactions(
    store: TableStore, staging: TableStore, folder: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Load order headers from new files of ``folder`` with their staged lines.

    Each micro-batch runs the incremental fact load. A batch that is repeated after a
    failure finds its transactions in the fact and adds nothing; the checkpoint remembers
    which files are done. Orders whose lines or customers are not there yet stay pending and are
    tried again with each later batch.
    """

    def load(batch: DataFrame, batch_id: int) -> None:
        items = staging.read("stg_ecom_transaction_items")
        load_with_pending(
            store, "stg_ecom_transactions", "fact_transactions", "transaction_id", batch,
            lambda rows: warehouse.load_transactions(store, rows, items, reduced=True))

    return _stream(store, "stg_ecom_transactions", folder, checkpoint, load, files_per_batch)


def load_arriving_responses(
    store: TableStore, folder: str, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Load campaign responses from new files of ``folder``."""

    def load(batch: DataFrame, batch_id: int) -> None:
        load_with_pending(
            store, "stg_campaign_responses", "fact_campaign_responses", "response_id", batch,
            lambda rows: warehouse.load_responses(store, rows))

    return _stream(store, "stg_campaign_responses", folder, checkpoint, load, files_per_batch)
