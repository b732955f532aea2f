"""The threshold detector: steps between the means before and after a second."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators import series
from tidemark.operators.select import jump_select


def detect(df: DataFrame, column: str = "c", smooth: int = 5, error: int = 10, hold: int = 8, step: float = 1.0) -> DataFrame:
    """Arrivals and departures: video_id, second, type, before_mean, after_mean.

    A repeated departure is reported as often as the level before it stays in
    the window.
    """
    w = series.by_video()
    df = df.withColumn("_s", series.moving_average(column, smooth) if smooth > 1 else F.col(column).cast("double"))
    before, after = series.before_after("_s", error, hold)
    df = df.withColumns({"_b": before, "_a": after, "_i": F.row_number().over(w) - 1, "_up": series.sustained(column), "_new": series.novel(column), "_down": series.local_drop(column)})
    ahead = w.rowsBetween(0, hold - 1)
    first_up = F.min(F.when(F.col("_up"), F.struct("second", F.col("_new").alias("ok")))).over(ahead)
    first_down = F.min(F.when(F.col("_down"), F.col("second"))).over(ahead)
    df = df.withColumns({"_u": first_up, "_d": F.coalesce(first_down, F.col("second"))})
    arrives = (F.col("_a") - F.col("_b") >= 0.8) & (F.col("_a") >= 1.0) & (F.col("_i") > error) & F.coalesce(F.col("_u.ok"), F.lit(False))
    departs = (F.col("_b") - F.col("_a") >= step) & (F.col("_a") <= F.greatest(F.lit(0.5), F.col("_b") - step))
    found = df.where(arrives | departs).select("video_id", F.col("second").alias("t"), F.when(arrives, "arrival").otherwise("departure").alias("type"), F.when(arrives, F.col("_u.second")).otherwise(F.col("_d")).alias("at"), F.col("_b").alias("before_mean"), F.col("_a").alias("after_mean"))
    found = found.withColumn("resume", F.col("at") + 2)
    chosen = jump_select(found, "video_id", "t", "resume", "type", "before_mean", "after_mean")
    return chosen.select("video_id", (F.col("resume") - 2).alias("second"), "type", "before_mean", "after_mean")
