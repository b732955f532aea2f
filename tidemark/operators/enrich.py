"""What surrounds an event: fish nearby, movement, sudden size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import boxes, series, states


def fish_boxes(fish: str = "fish") -> list[Column]:
    """Aggregates of a second's fish boxes that with_fish reads."""
    area = F.when(F.col("class") == fish, boxes.area())
    return [F.count(area).alias("_fish_n"), F.sum(area).alias("_fish_sum"), F.max(area).alias("_fish_max")]


def with_fish(df: DataFrame, reach: int = 5) -> DataFrame:
    """The events of a marked dense series (see states.marked) that has fish_boxes:
    arrivals get the fish boxes within `reach` seconds: count, mean and largest
    area, flag. The seconds around an event lie in its window, so nothing is joined."""
    w = series.by_video().rowsBetween(-reach, reach)
    near = lambda total: F.when(F.col("event.type") == "arrival", total)
    df = df.withColumns({"_n": F.coalesce(near(F.sum("_fish_n").over(w)), F.lit(0).cast("bigint")), "_sum": near(F.sum("_fish_sum").over(w)), "_max": near(F.max("_fish_max").over(w))})
    events = df.select("video_id", "second", F.col("event.type").alias("type"), F.col("_n").alias("fish_count"), F.try_divide("_sum", "_n").alias("fish_mean_area"), F.col("_max").alias("fish_max_area"))
    return events.where("type is not null").withColumn("arrival_with_fish", (F.col("fish_count") > 0).cast("int"))


def movement(per_second: DataFrame, classes, smooth: int = 5, parity: bool = True) -> DataFrame:
    """Distance that the count-weighted mean position moves from second to second.

    With `parity` missing positions count as 0 in the smoothing, as in the
    published detector; otherwise they are left out of the mean.
    """
    n = sum((F.col(f"count_{c}") for c in classes), F.lit(0))
    mean = lambda axis: F.when(n > 0, sum((F.coalesce(F.col(f"{c}_mean_{axis}"), F.lit(0.0)) * F.col(f"count_{c}") for c in classes), F.lit(0.0)) / n)
    return moved(per_second.select("video_id", "second", mean("x").alias("x_mean"), mean("y").alias("y_mean")), smooth, parity).where("x_mean is not null")


def moved(df: DataFrame, smooth: int = 5, parity: bool = True) -> DataFrame:
    """`df`, a dense series with x_mean and y_mean, with x_smooth, y_smooth and movement_delta."""
    if parity:
        df = df.withColumns({"_x": F.coalesce("x_mean", F.lit(0.0)), "_y": F.coalesce("y_mean", F.lit(0.0))})
        df = df.withColumns({"x_smooth": series.moving_average("_x", smooth), "y_smooth": series.moving_average("_y", smooth)}).drop("_x", "_y")
    else:
        df = df.withColumns({"x_smooth": series.centered("x_mean", smooth // 2), "y_smooth": series.centered("y_mean", smooth // 2)})
    w = series.by_video()
    step = lambda c: F.col(c) - F.lag(c).over(w)
    return df.withColumn("movement_delta", F.hypot(step("x_smooth"), step("y_smooth")))


def flaps(detections: DataFrame, bird: str = "adult", k: float = 3.0, baseline: int = 30) -> DataFrame:
    """Boxes at least k times the median area of the boxes of the seconds before
    (the current second excluded)."""
    w = W.partitionBy("video_id").orderBy("second").rangeBetween(-baseline, -1)
    own = detections.where(F.col("class") == bird).select("video_id", "second", "event_id", boxes.area().alias("area"), boxes.center_x().alias("center_x"), boxes.center_y().alias("center_y"), "confidence")
    own = own.withColumn("baseline_median", F.percentile("area", 0.5).over(w))
    return own.where((F.col("baseline_median") > 0) & (F.col("area") >= k * F.col("baseline_median"))).withColumn("multiplier", F.col("area") / F.col("baseline_median"))


def minute_rows(boxes_: DataFrame, classes, birds, bird: str, fish_area: str, fish: str = "fish", spike: int = 1, dip: int = 2, shortest: int = 5, smooth: int = 5) -> DataFrame:
    """Seconds with all that per_minute reads, from one pass over the boxes: counts,
    movement of `birds`, events of the repaired total count with fish around them."""
    n = sum((F.col(f"count_{c}") for c in birds), F.lit(0))
    mean = lambda axis: F.when(n > 0, sum((F.coalesce(F.col(f"{c}_mean_{axis}"), F.lit(0.0)) * F.col(f"count_{c}") for c in birds), F.lit(0.0)) / n)
    ps = series.per_second(boxes_, classes, F.count_if(F.col("class") == fish).alias("_fish_n"))
    df = ps.select("video_id", "second", F.col(f"count_{bird}").alias("birds"), F.col(f"{fish_area}_mean_area").alias("fish_area"), "_fish_n", F.col("count_total").alias("c"), mean("x").alias("x_mean"), mean("y").alias("y_mean"))
    df = states.marked(series.repaired(moved(df, smooth), "c", spike, dip), "c", shortest)
    near = F.coalesce(F.sum("_fish_n").over(series.by_video().rowsBetween(-5, 5)), F.lit(0))
    return df.select("video_id", "second", "birds", "fish_area", F.when(F.col("x_mean").isNotNull(), F.col("movement_delta")).alias("movement_delta"), F.col("event.type").alias("type"), (near > 0).alias("fish_near"))


def per_minute(seconds: DataFrame, flapping: DataFrame, bin_: int = 60) -> DataFrame:
    """Sums and means by minute of minute_rows and flaps; minutes without activity are dropped."""
    flap = flapping.select("video_id", "second", F.lit(1).alias("flap"))
    rows = seconds.withColumn("flap", F.lit(0)).unionByName(flap, allowMissingColumns=True)
    own = F.col("flap") == 0
    out = rows.groupBy("video_id", F.floor(F.col("second") / bin_).cast("bigint").alias("minute")).agg(
        F.coalesce(F.sum("birds"), F.lit(0).cast("bigint")).alias("total_adult_count"),
        F.coalesce(F.avg("birds"), F.lit(0.0)).alias("mean_adult_count_per_s"),
        F.count_if(own & (F.col("type") == "arrival")).alias("arrivals"),
        F.count_if(own & (F.col("type") == "departure")).alias("departures"),
        F.count_if(own & (F.col("type") == "arrival") & F.col("fish_near")).alias("arrivals_with_fish"),
        F.count_if(~own).alias("flapping_events"),
        F.coalesce(F.avg("movement_delta"), F.lit(0.0)).alias("avg_movement_delta_px"),
        F.avg("fish_area").alias("avg_fish_area_px"),
    )
    out = out.where("total_adult_count > 0 or arrivals > 0 or departures > 0 or flapping_events > 0")
    return out.select("video_id", "minute", (F.col("minute") * bin_).alias("start_second"), (F.col("minute") * bin_ + bin_ - 1).alias("end_second"), *out.columns[2:])
