"""Arriving S1 records against standing targets, with a checkpoint in place of a progress file."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalized
from ..operators.blocking import BlockingConfig, KeyIndex, combined, keyed_blocking


def link_arrivals(arriving: DataFrame, targets: DataFrame, out: str, checkpoint: str, config: BlockingConfig = BlockingConfig()) -> StreamingQuery:
    """Write each micro-batch's candidates to ``out/batch=<n>`` until no input is left.

    A batch that runs again after a failure overwrites its own folder, so that nothing is written twice.
    Exclusivity of targets needs all records and is a batch step afterwards.
    """
    index = KeyIndex.of(normalized(targets)).persisted()

    def write(rows: DataFrame, number: int) -> None:
        found = combined([keyed_blocking(normalized(rows), index, config)], config.most_candidates)
        found.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return arriving.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def event_counts(events: DataFrame, window: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts of arrivals by window and type, with a watermark; works on streams and on tables."""
    return events.withWatermark("ts", late).groupBy(F.window("ts", window).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")
