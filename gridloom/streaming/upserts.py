"""Continuous ingestion: files dropped into a folder are merged into a keyed table batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..sources import tables


def follow(spark: SparkSession, folder: str, root: str, name: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Start merging Parquet files of ``folder`` into ``root/name``; replayed batches change nothing. Of rows
    with one key in a batch that of the latest file wins, in a file the last."""
    def merge(batch: DataFrame, _: int) -> None:
        tables.upsert(batch.sparkSession, root, name, batch, "_time", "_row")

    out = spark.readStream.schema(S.TABLES[name]).parquet(folder).select("*", F.unix_micros("_metadata.file_modification_time").alias("_time"), F.col("_metadata.row_index").alias("_row")).writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (out.trigger(availableNow=True) if once else out).start()
