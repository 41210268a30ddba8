"""Incremental ingest: what arrives in a folder, each file once, and which tiles are complete."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def arrivals(spark: SparkSession, folder: str, schema: str, per_trigger: int = 1000) -> DataFrame:
    """A stream of the Parquet rows that arrive in a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def scene_counts(scenes: DataFrame, delay: str = "7 days", window: str = "1 day") -> DataFrame:
    """Scenes and their mean cloud share for each tile and day; scenes later than the delay are not waited for."""
    timed = scenes.withWatermark("ts", delay)
    return timed.groupBy("tile", F.window("ts", window).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.avg("cloud").alias("cloud")).select("tile", F.col("w.start").alias("day"), "n", "cloud")


def drain(stream: DataFrame, output: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Process all that is there now, write it, and stop; the next run goes on from there."""
    return stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()


TILES = "tile string, status string, missing array<string>"
_STATE = "bands string, done boolean, until long"


def complete_tiles(files: DataFrame, bands: list[str], wait: str = "2 hours", delay: str = "10 minutes") -> DataFrame:
    """tile, status, missing, once for each tile: complete when files (tile, band, ts) of all bands have arrived, failed when
    they have not by the time that wait has passed since its first one, in the files' own time.

    Repeated files and other bands do no harm. A tile's state goes when its time is over, whether it was complete or not;
    files that come later than delay are not looked at.
    """
    wanted = frozenset(bands)
    wait_ms = int(pd.Timedelta(wait).total_seconds() * 1000)

    def step(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held, done, until = (frozenset(filter(None, state.get[0].split("\n"))), state.get[1], state.get[2]) if state.exists else (frozenset(), False, None)
        row = lambda status, missing: pd.DataFrame({"tile": [key[0]], "status": [status], "missing": [sorted(missing)]})
        if state.hasTimedOut:
            state.remove()
            if not done:
                yield row("failed", wanted - held)
            return
        for part in parts:
            held |= wanted & set(part["band"])
            first = int(part["ts"].min().timestamp() * 1000)
            until = first + wait_ms if until is None else until
        if not done and held == wanted:
            done = True
            yield row("complete", ())
        state.update(("\n".join(sorted(held)), done, until))
        state.setTimeoutTimestamp(max(until, state.getCurrentWatermarkMs() + 1))

    timed = files.select("tile", "band", "ts").withWatermark("ts", delay)
    return timed.groupBy("tile").applyInPandasWithState(step, TILES, _STATE, "append", GroupStateTimeout.EventTimeTimeout)
