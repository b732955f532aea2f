"""Roll-ups: bins, pivots, histograms, quality of a classification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def tumbling(df: DataFrame, at: str, width: str, keys: list[str], **aggs: Column) -> DataFrame:
    """Aggregates per epoch-aligned bin (column bin); empty bins are left out."""
    return df.groupBy(F.window(at, width).alias("w"), *keys).agg(*(e.alias(n) for n, e in aggs.items())).select(F.col("w.start").alias("bin"), *keys, *aggs)


def wide(df: DataFrame, keys: list[str], column: str, values: list, agg: str, value: str, fill=None) -> DataFrame:
    """A pivot with given values, so that no job is needed to find them."""
    out = getattr(df.groupBy(*keys).pivot(column, values), agg)(value)
    return out.fillna(fill, [str(v) for v in values]) if fill is not None else out


def dense_hours(df: DataFrame, at: str, keys: list[str]) -> DataFrame:
    """Counts per hour of the day, 0 to 23, for all keys that occur."""
    n = df.groupBy(*keys, F.hour(at).alias("hour")).agg(F.count("*").alias("n"))
    grid = df.select(*keys).distinct().withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    return grid.join(n, [*keys, "hour"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def histogram(df: DataFrame, value: str, bins: int) -> DataFrame:
    """Counts of equal bins between the extremes; the last bin is closed. Extremes
    are one row, so they are joined by broadcast."""
    ends = df.agg(F.min(value).alias("lo"), F.max(value).alias("hi"))
    at = F.least(F.floor((F.col(value) - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins), F.lit(bins - 1)).cast("int")
    return df.crossJoin(F.broadcast(ends)).where(F.col(value).isNotNull()).groupBy(F.coalesce(at, F.lit(0)).alias("bin")).agg(F.count("*").alias("n"))


def confusion(df: DataFrame, truth: Column, said: Column, *keys: str) -> DataFrame:
    """tp, tn, fp, fn, precision, recall, f1 and accuracy; 0 where a denominator is 0."""
    t, s = truth == 1, said == 1
    c = df.groupBy(*keys).agg(F.count_if(t & s).alias("tp"), F.count_if(~t & ~s).alias("tn"), F.count_if(~t & s).alias("fp"), F.count_if(t & ~s).alias("fn"))
    return rates(c)


def rates(c: DataFrame) -> DataFrame:
    z = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    c = c.withColumns({"precision": z(tp, tp + fp), "recall": z(tp, tp + fn)})
    p, r = F.col("precision"), F.col("recall")
    c = c.withColumn("f1", z(2 * p * r, p + r))
    return c.withColumn("accuracy", z(tp + F.col("tn"), tp + F.col("tn") + fp + fn)) if "tn" in c.columns else c


def intensity(df: DataFrame, *keys: str) -> DataFrame:
    """Activity score of a minute, and its share of the largest score."""
    score = F.col("arrivals") + F.col("departures") + F.col("adults") / 10 + F.col("flaps")
    top = F.max("score").over(W.partitionBy(*keys))
    return df.withColumn("score", score).withColumn("intensity", F.when(top > 0, F.col("score") / top).otherwise(0.0))


def against_baseline(df: DataFrame, name: str, metric: str, baseline: str) -> DataFrame:
    """Ratio of a metric to the named row's (or, if there is none, the first row's), best first."""
    one = df.orderBy(F.desc(F.col(name) == baseline), name).limit(1).select(F.col(metric).alias("_base"))
    return df.crossJoin(F.broadcast(one)).withColumn("ratio", F.try_divide(F.col(metric), F.col("_base"))).drop("_base")


def mean_gap(df: DataFrame, at: str, *keys: str) -> DataFrame:
    """Mean distance between neighbouring events."""
    w = W.partitionBy(*keys).orderBy(at)
    return df.withColumn("_g", F.col(at) - F.lag(at).over(w)).groupBy(*keys).agg(F.avg("_g").alias("mean_gap"), F.count("*").alias("n"))


def daily(df: DataFrame) -> DataFrame:
    """Per station and date: first and last observation, minutes, files. Needs
    start_time and n_seconds per file."""
    end = F.timestamp_add("SECOND", F.col("n_seconds"), F.col("start_time"))
    return df.groupBy("station", "date").agg(F.min("start_time").alias("first_observation"), F.max(end).alias("last_observation"), (F.sum("n_seconds") / 60).alias("minutes"), F.count("*").alias("files"))
