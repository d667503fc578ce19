"""Telemetry as a stream: late readings within a watermark, one reading a key, counts in windows, last value a station.

The siting jobs are batch jobs; the stream feeds them with the tables that the batch merge would make.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def telemetry_stream(spark: SparkSession, path: str, schema: str, *, files_each: int = 8) -> DataFrame:
    """New files of a folder, some at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_each).parquet(path)


def unique_readings(stream: DataFrame, *, station: str = "station", at: str = "ts", late: str = "2 hours") -> DataFrame:
    """The first reading of each (station, time); state older than the watermark is dropped."""
    return stream.withWatermark(at, late).dropDuplicatesWithinWatermark([station, at])


def windowed(stream: DataFrame, *, station: str = "station", at: str = "ts", value: str = "cars", width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Readings, mean and largest value of each station and window."""
    return (
        stream.withWatermark(at, late)
        .groupBy(F.window(at, width), station)
        .agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean"), F.max(value).alias("most"))
        .select(station, F.col("window.start").alias("start"), "n", "mean", "most")
    )


def running_peak(stream: DataFrame, *, station: str = "station", value: str = "cars") -> DataFrame:
    """(station, peak, n) after each batch: the largest value so far, kept as state."""

    def update(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        peak, n = state.get if state.exists else (None, 0)
        for part in parts:
            top = part[value].max()
            peak = top if peak is None else max(peak, top)
            n += len(part)
        state.update((int(peak), n))
        yield pd.DataFrame({"station": [key[0]], "peak": [int(peak)], "n": [n]})

    return stream.groupBy(station).applyInPandasWithState(update, "station long, peak long, n long", "peak long, n long", "update", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, path: str, checkpoint: str, *, mode: str = "append") -> StreamingQuery:
    """All that is there, written as Parquet exactly once; a restart goes on from the checkpoint."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query
