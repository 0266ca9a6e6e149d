"""Work-list files as a stream: every new CSV file is forecast and upserted.

The batch tool is run once per work-list file; here the work-list directory
is a Structured Streaming file source and every micro-batch (one or more new
files) goes through the forecast job in ``foreachBatch``. Delivery is
effectively exactly-once: the stream checkpoint records which files were
processed, a replayed batch skips keys already in the store (J4), and the
store write is a keyed upsert into a new version (S8), so a replay can never
duplicate a record. A micro-batch takes all files that are pending, and
``cells_fn`` is called once for it (not per file): pass a function that reads the
warehouse to forecast against current data, or one that returns finished cells.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.constants import DEFAULT_MODELS
from ..schemas import WORKLIST
from ..session import scratch_path


def worklist_stream(spark: SparkSession, worklist_dir: str) -> DataFrame:
    """Streaming DataFrame of work-list rows from CSV files as they arrive."""
    return (spark.readStream.schema(WORKLIST).option("header", True)
            .option("recursiveFileLookup", True).csv(worklist_dir)
            .na.fill("", ["debtorcode", "category", "projno", "month_year"]))


def start_forecast_stream(spark: SparkSession, worklist_dir: str, cells_fn: Callable[[], DataFrame],
                          store_path: str, checkpoint_location: str | None = None,
                          models: str = DEFAULT_MODELS, available_now: bool = True, **forecast_kw):
    """Start the stream; ``cells_fn`` builds the cells for each micro-batch."""
    from ..plans import forecast_job

    def each_batch(batch: DataFrame, epoch_id: int) -> None:
        if batch.isEmpty():
            return
        items = batch.withColumn("item_id", F.col("row_idx").cast("long"))
        forecast_job.run(cells_fn(), items, store_path, models=models, **forecast_kw)

    writer = (worklist_stream(spark, worklist_dir).writeStream.foreachBatch(each_batch)
              .option("checkpointLocation", checkpoint_location or scratch_path(spark, "worklist-stream")))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
