"""Arriving tile results, batch by batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from .. import schemas


def follow(spark: SparkSession, folder: str, out: str, checkpoint: str, step: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Runs step over each batch of new result files and adds its rows to out, a folder a batch, so a batch run again replaces itself."""
    stream = spark.readStream.schema(schemas.TILE_RESULT).option("quote", "|").csv(folder)

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
