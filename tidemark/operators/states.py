"""Stable states of a series and the events between them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import series
from tidemark.operators.select import jump_select


def _reaches(points, variation: int):
    """For each place of an array, the length of the longest stretch from it on
    whose range is at most `variation`.

    Level k holds the extremes of the 2**k places from each one on. A stretch is
    put together from the highest level down, so a video of n seconds takes n log n
    steps; levels go up to 2**20 seconds.
    """
    levels = 21
    low = F.transform(points, lambda x: F.struct(x.alias("lo"), x.alias("hi")))

    def doubled(tables, k):
        step = F.call_function("shiftleft", F.lit(1), k)
        last = F.element_at(tables, -1)
        wider = F.transform(last, lambda x, i: F.struct(F.least(x["lo"], F.get(last, i + step)["lo"]).alias("lo"), F.greatest(x["hi"], F.get(last, i + step)["hi"]).alias("hi")))
        return F.when(step < F.size(points), F.concat(tables, F.array(wider))).otherwise(tables)

    tables = F.aggregate(F.sequence(F.lit(0), F.lit(levels - 2)), F.array(low), doubled)

    def from_place(tables, i):
        def longer(state, k):
            step = F.call_function("shiftleft", F.lit(1), k)
            at = i + state["n"]
            x = F.get(F.get(tables, k), at)
            lo, hi = F.least(state["lo"], x["lo"]), F.greatest(state["hi"], x["hi"])
            fits = (at + step <= F.size(points)) & (hi - lo <= variation)
            return F.when(F.coalesce(fits, F.lit(False)), F.struct((state["n"] + step).alias("n"), lo.alias("lo"), hi.alias("hi"))).otherwise(state)

        start = F.struct(F.lit(0).alias("n"), F.get(points, i).alias("lo"), F.get(points, i).alias("hi"))
        return F.aggregate(F.reverse(F.sequence(F.lit(0), F.size(tables) - 1)), start, longer, lambda s: s["n"])

    return F.get(F.transform(F.array(tables), lambda t: F.transform(points, lambda x, i: from_place(t, i))), F.lit(0))


def stable_periods(df: DataFrame, column: str = "c", shortest: int = 5, variation: int = 0) -> DataFrame:
    """Greedy maximal windows of at least `shortest` seconds whose range is at
    most `variation`. Without variation these are runs of equal values."""
    w = series.by_video()
    if variation == 0:
        new = F.coalesce((F.col(column) != F.lag(column).over(w)).cast("int"), F.lit(1))
        runs = df.withColumn("_run", F.sum(new).over(w))
        spans = runs.groupBy("video_id", "_run").agg(F.min("second").alias("start_second"), F.max("second").alias("end_second"), F.count("*").alias("duration"), F.avg(column).alias("mean_count"), F.percentile(column, 0.5).alias("median_count"), F.min(column).alias("min_count"), F.max(column).alias("max_count")).drop("_run")
        return spans.where(F.col("duration") >= shortest)
    # the end of a window that begins here is the first second beyond which its
    # range grows too wide: found by doubling steps over precomputed extremes
    points = df.groupBy("video_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("second", F.col(column).alias("c")))), lambda x: x["c"]).alias("p"))
    reach = F.transform(_reaches(F.col("p"), variation), lambda n, i: F.struct(i.cast("bigint").alias("t"), n.cast("bigint").alias("n")))
    found = points.select("video_id", F.explode(reach).alias("r")).select("video_id", F.col("r.t").alias("t"), (F.col("r.t") + F.col("r.n")).alias("resume")).where(F.col("resume") - F.col("t") >= shortest)
    chosen = jump_select(found, "video_id", "t", "resume").select("video_id", F.col("t").alias("start_second"), (F.col("resume") - 1).alias("end_second"))
    inside = df.join(chosen, "video_id").where("second between start_second and end_second")
    return inside.groupBy("video_id", "start_second", "end_second").agg(F.count("*").alias("duration"), F.avg(column).alias("mean_count"), F.percentile(column, 0.5).alias("median_count"), F.min(column).alias("min_count"), F.max(column).alias("max_count"))


def confidence(before: str, after: str):
    """0.3 for duration, 0.4 for the change, 0.3 for calm, of two state structs."""
    b, a = F.col(before), F.col(after)
    calm = ((b.max_count - b.min_count) + (a.max_count - a.min_count)) / 2
    return 0.3 * F.least(F.least(b.duration, a.duration) / 10.0, F.lit(1.0)) + 0.4 * F.least(F.abs(a.median_count - b.median_count) / 3.0, F.lit(1.0)) + 0.3 * F.greatest(F.lit(0.0), 1.0 - calm)


def state_events(states: DataFrame, least_change: int = 1, longest_gap: int = 15) -> DataFrame:
    """An event at the start of each state whose median differs from the one before."""
    w = W.partitionBy("video_id").orderBy("start_second")
    fields = ["start_second", "end_second", "duration", "median_count", "min_count", "max_count"]
    pairs = states.select("video_id", F.struct(*fields).alias("a"), F.lag(F.struct(*fields)).over(w).alias("b")).where("b is not null")
    change = F.col("a.median_count").cast("bigint") - F.col("b.median_count").cast("bigint")
    gap = F.col("a.start_second") + 1 - F.col("b.end_second")
    return pairs.where((F.abs(change) >= least_change) & (gap <= longest_gap)).select(
        "video_id",
        F.col("a.start_second").alias("second"),
        F.when(change > 0, "arrival").otherwise("departure").alias("type"),
        change.alias("count_change"),
        confidence("b", "a").alias("confidence"),
        F.col("b.median_count").cast("bigint").alias("from_count"),
        F.col("a.median_count").cast("bigint").alias("to_count"),
    )


def marked(df: DataFrame, column: str = "c", shortest: int = 5, least_change: int = 1, longest_gap: int = 15) -> DataFrame:
    """`df` with a struct `event` on the seconds at which a state of equal counts
    begins that differs from the one before it, null on all others. As
    state_events of stable_periods without variation, but in windows over one
    partitioning by video, so other columns stay at hand."""
    w, c = series.by_video(), F.col(column)
    run = W.partitionBy("video_id", "_run")
    df = df.withColumn("_run", F.sum(F.coalesce((c != F.lag(c).over(w)).cast("int"), F.lit(1))).over(w))
    df = df.withColumns({"_n": F.count("*").over(run), "_first": F.col("second") == F.min("second").over(run)})
    state = F.when(F.col("_first") & (F.col("_n") >= shortest), F.struct(F.col("second").alias("start"), F.col("_n").alias("n"), c.cast("bigint").alias("c")))
    df = df.withColumn("_state", state)
    df = df.withColumn("_before", F.last("_state", True).over(w.rowsBetween(W.unboundedPreceding, -1)))
    a, b = F.col("_state"), F.col("_before")
    change, gap = a["c"] - b["c"], a["start"] + 1 - (b["start"] + b["n"] - 1)
    sure = 0.3 * F.least(F.least(b["n"], a["n"]) / 10.0, F.lit(1.0)) + 0.4 * F.least(F.abs(change) / 3.0, F.lit(1.0)) + 0.3
    event = F.struct(F.when(change > 0, "arrival").otherwise("departure").alias("type"), change.alias("count_change"), sure.alias("confidence"), b["c"].alias("from_count"), a["c"].alias("to_count"))
    return df.withColumn("event", F.when((F.abs(change) >= least_change) & (gap <= longest_gap), event)).drop("_run", "_n", "_first", "_state", "_before")


def detect(df: DataFrame, column: str = "c", spike: int = 1, dip: int = 2, shortest: int = 5, variation: int = 0, least_change: int = 1) -> DataFrame:
    """Repair, find states, report the changes between them."""
    fixed = series.repaired(df, column, spike, dip)
    if variation == 0:
        return marked(fixed, column, shortest, least_change).where("event is not null").select("video_id", "second", "event.*")
    return state_events(stable_periods(fixed, column, shortest, variation), least_change)
