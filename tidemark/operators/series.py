"""Dense per-second series and window expressions over them.

A series has the keys video_id and second; every video has all seconds from 0
to its last, so frames of rows are frames of seconds. Boxes are first counted by
video and second, which leaves no more of a hot video than its seconds; what
remains is partitioned by video_id once, for gaps and all windows after them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import boxes


def by_video():
    return W.partitionBy("video_id").orderBy("second")


def whole():
    return W.partitionBy("video_id")


def seconds_of(frame: str, fps: int, original_fps: int = 25) -> Column:
    """The second of a frame number (floor, also below zero)."""
    return F.floor(F.col(frame) / (original_fps if fps == 1 else fps)).cast("bigint")


def by_second(df: DataFrame, *aggs: Column) -> DataFrame:
    """One row per video and second that occurs (seconds below zero are left out)."""
    return df.where("second >= 0").groupBy("video_id", "second").agg(*aggs)


def filled(found: DataFrame, *zero: str) -> DataFrame:
    """All seconds from 0 to each video's last: a second that `found` lacks gets 0
    in the columns `zero` and null in the others. A row brings the gap before it."""
    rows = found.withColumn("_from", F.coalesce(F.lag("second").over(by_video()) + 1, F.lit(0).cast("bigint")))
    rows = rows.withColumn("_at", F.explode(F.sequence("_from", "second")))
    own = lambda c: F.when(F.col("_at") == F.col("second"), F.col(c))
    values = [(F.coalesce(own(c), F.lit(0).cast("bigint")) if c in zero else own(c)).alias(c) for c in found.columns if c not in ("video_id", "second")]
    return rows.select("video_id", F.col("_at").alias("second"), *values)


def per_second(df: DataFrame, classes, *more: Column) -> DataFrame:
    """Dense counts, mean centres, areas and confidences per class, and aggregates
    `more` (null where a second is empty). Other classes extend the series but
    are not counted."""
    aggs = []
    for c in classes:
        mine = F.col("class") == c
        pick = lambda x: F.when(mine, x)  # noqa: B023, E731
        aggs += [F.count_if(mine).alias(f"count_{c}"), F.avg(pick(boxes.center_x())).alias(f"{c}_mean_x"), F.avg(pick(boxes.center_y())).alias(f"{c}_mean_y"), F.avg(pick(boxes.area())).alias(f"{c}_mean_area"), F.max(pick(boxes.area())).alias(f"{c}_max_area"), F.avg(pick(F.col("confidence"))).alias(f"{c}_mean_conf")]
    out = filled(by_second(df, *aggs, *more), *(f"count_{c}" for c in classes))
    return out.withColumn("count_total", sum((F.col(f"count_{c}") for c in classes), F.lit(0).cast("bigint")))


def counts(df: DataFrame, classes, *more: Column) -> DataFrame:
    """(video_id, second, c): dense total count of some classes; aggregates `more`
    come with it, null where a second is empty."""
    return filled(by_second(df, F.count_if(F.col("class").isin(*classes)).alias("c"), *more), "c")


def moving_average(column: str, size: int) -> Column:
    """Centred mean of `size` seconds; the first and last value are repeated beyond the ends."""
    left, right = size // 2, size - 1 - size // 2
    i, n = F.row_number().over(by_video()) - 1, F.count("*").over(whole())
    lost_left = F.greatest(F.lit(0), F.lit(left) - i)
    lost_right = F.greatest(F.lit(0), i + right - (n - 1))
    full = by_video().rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    total = F.sum(column).over(by_video().rowsBetween(-left, right))
    return (total + lost_left * F.first(column).over(full) + lost_right * F.last(column).over(full)) / float(size)


def trailing(column: str, size: int, full: bool = False) -> Column:
    """Mean of the last `size` seconds; with `full`, null until there are that many."""
    w = by_video().rowsBetween(-(size - 1), 0)
    return F.when(F.count(column).over(w) == size, F.avg(column).over(w)) if full else F.avg(column).over(w)


def centered(column: str, reach: int) -> Column:
    return F.avg(column).over(by_video().rowsBetween(-reach, reach))


def before_after(column: str, error: int, hold: int) -> tuple[Column, Column]:
    """Means of [t - error, t) and [t, t + hold)."""
    return F.coalesce(F.avg(column).over(by_video().rowsBetween(-error, -1)), F.lit(0.0)), F.avg(column).over(by_video().rowsBetween(0, hold - 1))


def sustained(column: str = "c") -> Column:
    """A rise at t of which at least 60 % of the next (up to 3) samples keep the level; two samples are needed."""
    w, c = by_video(), F.col(column)
    next1, next2 = F.lead(column, 1).over(w), F.lead(column, 2).over(w)
    window = F.lit(1) + next1.isNotNull().cast("int") + next2.isNotNull().cast("int")
    held = F.lit(1) + F.coalesce((next1 >= c).cast("int"), F.lit(0)) + F.coalesce((next2 >= c).cast("int"), F.lit(0))
    return F.coalesce((c > F.lag(column).over(w)) & (window >= 2) & (held >= F.greatest(F.lit(1.0), window * 0.6)), F.lit(False))


def novel(column: str = "c") -> Column:
    """Higher than the three samples before."""
    top = F.max(column).over(by_video().rowsBetween(-3, -1))
    return top.isNull() | (F.col(column) > top)


def local_drop(column: str = "c") -> Column:
    """Below the mean of the two samples before by over 0.5; not at the last sample."""
    mean = F.avg(column).over(by_video().rowsBetween(-2, -1))
    return F.coalesce((F.col(column) < mean - 0.5) & F.lead(column).over(by_video()).isNotNull(), F.lit(False))


def smooth_outliers(column: str, reach: int, k: float) -> Column:
    """The median of the surrounding seconds where a value is over k deviations off
    (a deviation of 0 counts as 1), cut to a whole number; else the value."""
    w = by_video().rowsBetween(-reach, reach)
    std = F.stddev_pop(column).over(w)
    off = F.abs(F.col(column) - F.avg(column).over(w)) > k * F.when(std == 0, 1.0).otherwise(std)
    return F.when((F.count(column).over(w) > 2) & off, F.percentile(column, 0.5).over(w).cast("bigint")).otherwise(F.col(column))


def _repair(df: DataFrame, column: str, longest: int, dip: bool) -> DataFrame:
    """Replace short excursions by the level before them.

    An excursion starts after i if the series first comes back to the level of
    i at step k, 2 <= k <= longest + 1 (dips: to at most one above it). Such
    intervals are nested or apart, so the farthest start that covers a second
    decides.
    """
    w = by_video()
    c = F.col(column)
    back = F.lit(None).cast("int")
    level = F.lit(None).cast("bigint")
    for k in range(longest + 1, 0, -1):
        ahead = F.lead(column, k).over(w)
        comes = (ahead >= c) if dip else (ahead <= c)
        back = F.when(comes, F.lit(k)).otherwise(back)
        level = F.when(comes, ahead).otherwise(level)
    i, n = F.row_number().over(w) - 1, F.count("*").over(whole())
    ok = (back >= 2) & (i < n - longest - 1)
    if dip:
        ok = ok & (level - c <= 1)
    df = df.withColumn("_reach", F.when(ok, back))
    out = c
    for d in range(1, longest + 1):  # the farthest start wins, so it is put outermost
        out = F.when(F.lag("_reach", d).over(w) > d, F.lag(column, d).over(w)).otherwise(out)
    return df.withColumn(column, out).drop("_reach")


def remove_spikes(df: DataFrame, column: str = "c", longest: int = 1) -> DataFrame:
    return _repair(df, column, longest, False)


def remove_dips(df: DataFrame, column: str = "c", longest: int = 1) -> DataFrame:
    return _repair(df, column, longest, True)


def repaired(df: DataFrame, column: str = "c", spike: int = 1, dip: int = 2) -> DataFrame:
    """Spikes first, then dips."""
    return remove_dips(remove_spikes(df, column, spike), column, dip)


def stability(df: DataFrame, column: str = "c") -> DataFrame:
    """Per video: mean, deviation, extremes, range, number of changes, mean absolute change."""
    step = df.withColumn("_d", F.col(column) - F.lag(column).over(by_video()))
    return step.groupBy("video_id").agg(F.avg(column).alias("mean_count"), F.stddev_pop(column).alias("std_count"), F.min(column).alias("min_count"), F.max(column).alias("max_count"), (F.max(column) - F.min(column)).alias("count_range"), F.count_if(F.col("_d") != 0).alias("n_changes"), F.avg(F.abs("_d")).alias("mean_abs_change"))


def one_sample_noise(df: DataFrame, column: str = "c") -> DataFrame:
    """Per video: spikes (up, then back or below) and dips (down, then back or above) of one sample."""
    w = by_video()
    a, b = F.lead(column, 1).over(w), F.lead(column, 2).over(w)
    marked = df.select("video_id", ((a > F.col(column)) & (b <= F.col(column))).alias("s"), ((a < F.col(column)) & (b >= F.col(column))).alias("d"))
    return marked.groupBy("video_id").agg(F.count_if("s").alias("n_spikes"), F.count_if("d").alias("n_dips"))


def hysteresis(df: DataFrame, column: str, size: int, threshold: float) -> DataFrame:
    """Sessions of seconds whose trailing mean exceeds a threshold: id, first and
    last second, duration. A series that is high from its first sample has id 0."""
    w = by_video()
    state = df.withColumn("_s", F.coalesce((trailing(column, size, True) > threshold).cast("int"), F.lit(0)))
    edge = (F.col("_s") == 1) & (F.lag("_s").over(w) == 0)
    ided = state.withColumn("session", F.sum(F.coalesce(edge, F.lit(False)).cast("bigint")).over(w)).where("_s = 1")
    return ided.groupBy("video_id", "session").agg(F.min("second").alias("start_second"), F.max("second").alias("end_second"), (F.max("second") - F.min("second")).alias("duration"))


def quiet_periods(events: DataFrame, totals: DataFrame, buffer: int) -> DataFrame:
    """Stretches of each video farther than `buffer` seconds from any event.
    totals: video_id, n (seconds of the video)."""
    w = W.partitionBy("video_id").orderBy("second")
    known = events.select("video_id", "second")
    ends = totals.select("video_id", (F.col("n") + buffer).alias("second"))
    gaps = known.union(ends).withColumn("from_", F.coalesce(F.lag("second").over(w) + buffer, F.lit(0).cast("bigint")))
    return gaps.select("video_id", F.col("from_").alias("start_second"), (F.col("second") - buffer).alias("end_second")).where("end_second > start_second")
