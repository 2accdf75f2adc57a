"""Micro-batch ingestion: the batch operators inside Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..sources.records import SCHEMAS


def read_stream(spark: SparkSession, kind: str, path: str, files: int = 1000) -> DataFrame:
    """Landed records as a stream of files."""
    return spark.readStream.schema(SCHEMAS[kind]).option("maxFilesPerTrigger", files).json(path)


def first_seen_stream(records: DataFrame, key: str, time: str, delay: str = "14 days") -> DataFrame:
    """The first record of each key within the delay; state older than that is dropped."""
    return records.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def upsert_stream(records: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Calls ``apply(batch, number)`` for every micro-batch; the number makes a repeated batch known."""
    return records.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, time: str, kind: str, width: str = "1 day", delay: str = "2 days") -> DataFrame:
    """Events of each kind in tumbling windows; later ones than the delay are dropped."""
    from pyspark.sql import functions as F

    return events.withWatermark(time, delay).groupBy(F.window(time, width), kind).agg(F.count(F.lit(1)).alias("n"))
