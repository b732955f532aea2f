"""Ordered, stratified, diverse and reproducible selections."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import boxes, series


def dealt(seed: int, *keys: str) -> Column:
    """A reproducible order that looks random: by MD5, so that other engines agree."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *(F.col(k).cast("string") for k in keys)).cast("binary"))


def sample(df: DataFrame, n: int, seed: int, *keys: str) -> DataFrame:
    return df.orderBy(dealt(seed, *keys), *keys).limit(n)


def first_per_type(df: DataFrame, kind: str, order: str, k: int) -> DataFrame:
    """The first k rows of each type, in the order given."""
    return df.withColumn("_n", F.row_number().over(W.partitionBy(kind).orderBy(order))).where(F.col("_n") <= k).drop("_n")


def ranked(df: DataFrame, score: Column, diverse: list[str], k: int, prefilter: int, costly: Column | None, *tie: str) -> DataFrame:
    """Top k by score: a cheap top list first, the costly score only on it; then the
    best of each group, then the rest in order until there are k."""
    top = df.withColumn("_s", score).orderBy(F.desc("_s"), *tie).limit(max(5 * k, prefilter))
    if costly is not None:
        top = top.withColumn("_s", F.col("_s") + costly)
    w = W.partitionBy(*diverse).orderBy(F.desc("_s"), *tie)
    return top.withColumn("_n", F.row_number().over(w)).orderBy(F.col("_n") > 1, F.desc("_s"), *tie).limit(k).withColumnRenamed("_s", "score").withColumnRenamed("_n", "rank_in_group")


def evenly(df: DataFrame, group: str, order: str, most: int, groups: int) -> DataFrame:
    """About most / groups rows of each group, evenly spaced; then others in input
    order until there are `most`."""
    k = max(1, most // max(groups, 1))
    w = W.partitionBy(group).orderBy(order)
    i, n = F.col("_i"), F.col("_n")
    df = df.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(W.partitionBy(group))})
    # i is chosen if some step j of k has floor(j * (n - 1) / (k - 1)) = i
    steps = F.sequence(F.lit(0), F.lit(k - 1))
    spot = F.transform(steps, lambda j: F.floor(j * (n - 1) / F.lit(max(k - 1, 1))))
    chosen = (n <= k) | F.array_contains(spot, i.cast("bigint"))
    return df.withColumn("_chosen", chosen).orderBy(F.desc("_chosen"), order, group).limit(most).drop("_i", "_n", "_chosen")


def tiers(df: DataFrame, both: Column, either: Column, n: int, seed: int, *keys: str) -> DataFrame:
    """Rows with both marks first, then with either, then others; dealt within a tier."""
    tier = F.when(both, 0).when(either, 1).otherwise(2)
    return df.withColumn("tier", tier).orderBy("tier", dealt(seed, *keys), *keys).limit(n)


def stratified(df: DataFrame, category: str, total: int, categories: list, order: Column | str) -> DataFrame:
    """Equal quotas per category; the remainder goes to the first categories."""
    share, rest = divmod(total, len(categories))
    quota = F.create_map(*(F.lit(x) for i, c in enumerate(categories) for x in (c, share + (i < rest))))
    n = F.row_number().over(W.partitionBy(category).orderBy(order))
    return df.where(F.col(category).isin(*categories)).withColumn("_n", n).where(F.col("_n") <= quota[F.col(category)]).drop("_n")


def targets(df: DataFrame, duration: Column, k: int) -> DataFrame:
    """k offsets between 10 % and 90 % of a clip, evenly spaced."""
    at = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda j: duration * (0.1 + 0.8 * j / max(k - 1, 1)))
    return df.withColumn("offset", F.explode(at))


def chronological_split(df: DataFrame, keys: list[str], order: list[str], share: float) -> DataFrame:
    """Column part: the first rows train, the rest validate; at least one on either
    side. The table is a set of labelled events, which one task can order."""
    w = W.partitionBy(*keys) if keys else W.partitionBy(F.lit(0))
    n = F.count("*").over(w)
    cut = F.greatest(F.lit(1), F.least(n - 1, F.bround(n * share)))
    return df.withColumn("part", F.when(F.row_number().over(w.orderBy(*order)) <= cut, "train").otherwise("val"))


def random_split(df: DataFrame, shares: dict[str, float], seed: int, *keys: str) -> DataFrame:
    """Column part by the place of a row's hash on the unit interval: no shuffle."""
    u = F.conv(F.substring(dealt(seed, *keys), 1, 8), 16, 10).cast("double") / float(1 << 32)
    part, top = F.lit(None).cast("string"), 1.0
    for name, share in reversed(list(shares.items())):
        part = F.when(u < top, name).otherwise(part)
        top -= share
    return df.withColumn("part", part)


def worst(df: DataFrame, missed: str, extra: str) -> DataFrame:
    """Files with a miss or over one extra detection, most of both first."""
    return df.where((F.col(missed) > 0) | (F.col(extra) > 1)).orderBy(F.desc(F.col(missed) + F.col(extra)))


def batches(df: DataFrame, size: int, key: str, group: list[str]) -> DataFrame:
    """Column batch: numbers of fixed-size batches in order of a key."""
    return df.withColumn("batch", F.floor((F.row_number().over(W.partitionBy(*group).orderBy(key)) - 1) / size).cast("bigint"))


def problem_frames(df: DataFrame, classes, fish: str, margin: float = 50, spike: int = 1, dip: int = 2, high: int = 10) -> DataFrame:
    """video_id, second, problem: boxes at the edge, repaired spikes and dips, high
    counts, changes of the count, fish. One pass over the boxes; a second's
    problems are flags of its row."""
    edge, some = F.max(~boxes.inside(margin=margin)).alias("_edge"), F.max(F.col("class") == fish).alias("_fish")
    s = series.counts(df, classes, edge, some).withColumns({"_spike": F.col("c"), "_dip": F.col("c")})
    s = series.remove_dips(series.remove_spikes(s, "_spike", spike), "_dip", dip)
    found = {
        "edge": F.col("_edge"),
        "spike": F.col("c") != F.col("_spike"),
        "dip": F.col("c") != F.col("_dip"),
        "high_count": F.col("c") >= high,
        "transition": F.col("c") != F.lag("c").over(series.by_video()),
        "fish": F.col("_fish"),
    }
    problems = F.array_compact(F.array(*(F.when(test, F.lit(name)) for name, test in found.items())))
    return s.withColumn("_problems", problems).select("video_id", "second", F.explode("_problems").alias("problem"))


def low_quality(brightness: Column, blur: Column) -> Column:
    """Up to 1 for darkness below 60 and up to 1 for a blur variance below 100."""
    return F.greatest(F.lit(0.0), (60 - brightness) / 60) + F.greatest(F.lit(0.0), (100 - blur) / 100)


def merge_labels(a: DataFrame, b: DataFrame, shift: int) -> DataFrame:
    """Two label sets, the second with its class numbers moved up."""
    return a.unionByName(b.withColumn("class_id", F.col("class_id") + shift))
