"""Feeds that arrive as archives in a folder, one micro-batch for each set of new archives.

Timetables are batch data; the stream only says which archives are new, and each batch runs an ordinary plan over them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def new_archives(spark: SparkSession, folder: str) -> DataFrame:
    """path, modificationTime and length of archives as they land; contents are not read."""
    archives = spark.readStream.format("binaryFile").option("pathGlobFilter", "*.zip").schema("path string, modificationTime timestamp, length long, content binary").load(folder)
    return archives.drop("content")


def on_arrival(spark: SparkSession, folder: str, checkpoint: str, ingest: Callable[[SparkSession, list[str]], None]) -> StreamingQuery:
    """Calls ingest(spark, paths) once for each batch of new archives; a batch that fails is run again on restart."""

    def batch(df: DataFrame, _: int) -> None:
        paths = sorted(r["path"] for r in df.select("path").collect())
        if paths:
            ingest(spark, paths)

    return new_archives(spark, folder).writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
