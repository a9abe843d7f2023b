"""Continuous intake of files: each new file is sniffed once and appended; the checkpoint remembers which are done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from scriptorium.sources import files

SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def stream_files(spark: SparkSession, folder: str, most_files: int = 100) -> DataFrame:
    """(path, length, kind, content) of the files that come into a folder."""
    rows = spark.readStream.format("binaryFile").schema(SCHEMA).option("maxFilesPerTrigger", most_files).load(folder)
    return rows.select("path", "length", files.kind(F.col("content")).alias("kind"), "content")


def start(stream: DataFrame, process: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Appends what the batch plan ``process`` makes of each micro-batch to a Parquet folder.

    A batch that is run again after a loss is written over, not twice: its folder is named by its number."""

    def write(batch: DataFrame, number: int) -> None:
        process(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
