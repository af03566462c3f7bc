"""Curation of articles as they arrive: a file stream with a checkpoint, each micro-batch handled once."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from figcurate.sources.jats import parse_articles


def stream_articles(
    spark: SparkSession, folder: str, output: str, checkpoint: str, handle: Callable[[DataFrame], DataFrame] | None = None
) -> StreamingQuery:
    """Parse the XML files that appear in ``folder`` and write their figures to ``output``.

    A batch writes to a path made of its number, so a batch that is run again after a failure replaces its own output.
    """
    schema = "path string, modificationTime timestamp, length bigint, content binary"
    files = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.xml").load(folder)

    def write(batch: DataFrame, number: int) -> None:
        figures = parse_articles(batch.select("path", "content"))
        figures = handle(figures) if handle else figures
        figures.write.mode("overwrite").parquet(os.path.join(output, f"batch={number}"))

    return files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def landed_counts(records: DataFrame, window: str = "1 day", late: str = "3 days", time: str = "landed_at") -> DataFrame:
    """Records per time window and article; on a stream, rows later than ``late`` no longer change a window."""
    return (
        records.withWatermark(time, late)
        .groupBy(F.window(time, window), "pmcid")
        .agg(F.count("*").alias("n"))
        .select(F.col("window.start").alias("start"), "pmcid", "n")
    )
