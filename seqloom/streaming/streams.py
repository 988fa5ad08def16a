"""Structured Streaming forms: windows, sessions, late data, ordered state by key."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def source(spark: SparkSession, folder: str, schema, per_trigger: int | None = None) -> DataFrame:
    """A stream of the parquet files of a folder."""
    reader = spark.readStream.schema(schema)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    return reader.parquet(folder)


def merged(streams: list[DataFrame]) -> DataFrame:
    """Several streams as one, each row with its stream's number."""
    from functools import reduce

    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [s.withColumn("_stream", F.lit(i)) for i, s in enumerate(streams)])


def tumbling(events: DataFrame, at: str, size: str, on: list[str], aggs: list, lag: str = "1 hour") -> DataFrame:
    """Aggregates by window; rows later than ``lag`` behind the newest are dropped."""
    return _timed(events, at, lag).groupBy(F.window("_at", size), *on).agg(*aggs).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *on, *_names(aggs))


def sliding(events: DataFrame, at: str, size: str, step: str, on: list[str], aggs: list, lag: str = "1 hour") -> DataFrame:
    return _timed(events, at, lag).groupBy(F.window("_at", size, step), *on).agg(*aggs).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *on, *_names(aggs))


def sessions(events: DataFrame, at: str, gap: str, on: list[str], aggs: list, lag: str = "1 hour") -> DataFrame:
    """Aggregates by session: rows of a key that are less than ``gap`` apart."""
    return _timed(events, at, lag).groupBy(F.session_window("_at", gap), *on).agg(*aggs).select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), *on, *_names(aggs))


def _timed(events: DataFrame, at: str, lag: str) -> DataFrame:
    rows = events.withColumn("_at", F.col(at).cast("timestamp"))
    return rows.withWatermark("_at", lag) if events.isStreaming else rows


def _names(aggs: list) -> list[str]:
    return [a._jc.toString().rpartition(" AS ")[2].strip("`") for a in aggs]


def deduplicated(events: DataFrame, at: str, keys: list[str], lag: str = "1 hour") -> DataFrame:
    """The first row of each key within the watermark."""
    return events.withColumn("_at", F.col(at).cast("timestamp")).withWatermark("_at", lag).dropDuplicatesWithinWatermark(keys).drop("_at")


def position_depth(reads: DataFrame, lag: int = 500) -> DataFrame:
    """A stream of reads (contig_id, start, end, ts) as closed positions (contig_id, pos, depth): state by contig holds what can still change.

    A position is closed, and its state dropped, once the newest start is ``lag`` beyond it; reads that begin before that are late and dropped.
    """

    def go(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        closed, open_ = state.get if state.exists else (0, "")
        depth = {int(p): int(d) for p, d in (x.split(":") for x in open_.split(",") if x)}
        newest = closed + lag
        for pdf in batches:
            for a, b in sorted(zip(pdf.start.tolist(), pdf.end.tolist(), strict=True)):
                if a <= closed:
                    continue
                for p in range(a, b):
                    depth[p] = depth.get(p, 0) + 1
                newest = max(newest, a)
        upto = max(closed, newest - lag)
        done = sorted(p for p in depth if p <= upto)
        if done:
            yield pd.DataFrame({"contig_id": [key[0]] * len(done), "pos": done, "depth": [depth.pop(p) for p in done]})
        state.update((upto, ",".join(f"{p}:{d}" for p, d in sorted(depth.items()))))

    return reads.groupBy("contig_id").applyInPandasWithState(go, "contig_id int, pos long, depth long", "closed long, open string", "append", GroupStateTimeout.NoTimeout)


def run_once(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Work through what is there and return the result: for tests and backfills; a lasting query names a checkpoint and a sink instead."""
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.table(name)
