"""Streaming counterparts of batch operators; new capabilities over file sources."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout


def tumbling(stream: DataFrame, at: str, width: str, keys: list[str], late: str, **aggs) -> DataFrame:
    """Bins of a stream: rows later than `late` behind the newest are dropped, so
    state is bounded by that delay."""
    out = stream.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), *keys).agg(*(e.alias(n) for n, e in aggs.items()))
    return out.select(F.col("w.start").alias("bin"), *keys, *aggs)


def sessions(stream: DataFrame, size: int, threshold: float) -> DataFrame:
    """State-driven sessions (see series.hysteresis) of a stream of dense counts
    (video_id, second, c): a row whenever a session opens or grows, the last of
    each id being final. State is `size` values per video."""

    def step(key, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last, held, ident, began = state.get if state.exists else ([], 0, 0, -1)
        rows = pd.concat(list(batches)).sort_values("second")
        second, value = rows["second"].to_numpy(), np.concatenate([last, rows["c"].to_numpy(float)])
        # trailing sums; a mean needs `size` values
        sums = np.concatenate([[0.0], np.cumsum(value)])
        end = np.arange(len(last) + 1, len(value) + 1)
        high = (end >= size) & (sums[end] - sums[np.maximum(end - size, 0)] > threshold * size)
        opens = high & ~np.concatenate([[bool(held)], high[:-1]])
        number = ident + np.cumsum(opens & (np.arange(len(high)) + len(last) > 0))
        at = np.flatnonzero(opens)
        place = np.searchsorted(at, np.arange(len(high)), "right") - 1
        first = np.where(place >= 0, second[at[np.maximum(place, 0)]] if len(at) else began, began)
        if len(high):
            state.update((value[-size:].tolist(), int(high[-1]), int(number[-1]), int(first[-1])))
        out = pd.DataFrame({"video_id": key[0], "session": number, "start_second": first, "end_second": second, "duration": second - first})[high]
        yield out.drop_duplicates("session", keep="last")

    return stream.groupBy("video_id").applyInPandasWithState(step, "video_id long, session long, start_second long, end_second long, duration long", "last array<double>, held int, ident long, began long", "update", GroupStateTimeout.NoTimeout)


def discover(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """New files as a stream; the checkpoint remembers which were seen."""
    return spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path).select("path", F.col("modificationTime").alias("modified"))


def drain(stream: DataFrame, checkpoint: str, out: str, mode: str = "append") -> DataFrame:
    """Run a stream until no input is left and return what it wrote. A repeated
    micro-batch overwrites its own files."""

    def save(df: DataFrame, batch: int) -> None:
        df.withColumn("batch_no", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/part={batch}")

    stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start().awaitTermination()
    return stream.sparkSession.read.parquet(out).drop("part")


def work(stream: DataFrame, claim, process, checkpoint: str, until_empty: bool = False):
    """Claim and process the jobs of each micro-batch; claim returns those that were
    still pending. With `until_empty` it ends when no input is left. A repeated
    micro-batch has the same number, so what `process` writes can replace itself."""
    writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda df, batch: process(claim(df), batch))
    running = (writer.trigger(availableNow=True) if until_empty else writer).start()
    if until_empty:
        running.awaitTermination()
    return running
