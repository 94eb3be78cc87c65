"""Landing folder as a stream.

The stream only tells which days have new files; each of those days is then ingested by the batch
job from all its parts, so a part that arrives late, or a batch that is replayed after a failure,
ends in the same state. A file stream remembers paths, not content: a restated file must come under
a new name, or be loaded with `update_product`.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from eodlake.model import DAILY_PRODUCTS
from eodlake.operators.store import Store
from eodlake.plans.ingest import update_days
from eodlake.sources import files


_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def new_files(store: Store, landing: str, files_per_batch: int = 10_000) -> DataFrame:
    """Stream of (path, length) of files as they arrive; content is not read."""
    return (
        store.spark.readStream.format("binaryFile")
        .schema(_SCHEMA)
        .option("recursiveFileLookup", True)
        .option("maxFilesPerTrigger", files_per_batch)
        .load(landing)
        .select("path", "length")
    )


def ingest_stream(
    store: Store,
    landing: str,
    checkpoint: str,
    products: Iterable[str] = DAILY_PRODUCTS,
    files_per_batch: int = 10_000,
) -> StreamingQuery:
    """Ingest everything that arrived since the last run, then stop (`availableNow`)."""
    products = list(products)

    def load(batch: DataFrame, batch_id: int) -> None:
        days = files.resolve_files(batch).select("product", "date").distinct().collect()
        update_days(store, landing, {p: [d.date for d in days if d.product == p] for p in products})

    return (
        new_files(store, landing, files_per_batch)
        .writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
