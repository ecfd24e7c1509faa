"""Raw pages as a stream: each item once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def stream_files(spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_trigger: int = 10) -> DataFrame:
    """Files of a folder as a stream, a few in each micro-batch."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_per_trigger).load(path)


def first_seen(rows: DataFrame, keys: list[str], time_col: str | None = None, delay: str = "1 day") -> DataFrame:
    """Each key once. With a time column state older than ``delay`` is dropped; without one the
    state keeps every key, so it is for sources whose keys are bounded, such as a registry's."""
    if time_col is None:
        return rows.dropDuplicates(keys)
    return rows.withWatermark(time_col, delay).dropDuplicatesWithinWatermark(keys)


def run_once(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Writes all that is there to Parquet files under ``path`` and stops. Files of a batch are
    listed in the sink's log, so a batch that is run again adds nothing twice."""
    query = rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
