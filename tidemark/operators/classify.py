"""Features of a clip, rules, a linear model, and how to set them up."""

from __future__ import annotations

from itertools import product

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions.names import sigmoid
from tidemark.operators import boxes
from tidemark.operators.rollup import rates

# Names of the features, in the order in which a model lists its weights.
FEATURES = (
    "total_frames", "bird_frames", "fish_frames", "fish_detection_count", "fish_avg_confidence", "fish_confidence_std", "fish_presence_ratio",
    "fish_first_frame_ratio", "fish_last_frame_ratio", "fish_conf_late_minus_early", "fish_area_mean", "fish_area_trend", "bird_displacement", "bird_mean_motion",
    "bird_path_efficiency", "fish_bird_mean_distance", "fish_bird_min_distance", "fish_to_bird_first_frame_ratio_gap", "arrival_with_fish_stage2",
)


def centroids(df: DataFrame, kind: str) -> DataFrame:
    """Mean centre of a class per clip and frame."""
    return df.where(F.lower("class") == kind).groupBy("event_id", "frame").agg(F.avg(boxes.center_x()).alias("x"), F.avg(boxes.center_y()).alias("y"))


def motion(points: DataFrame) -> DataFrame:
    """Displacement, mean step and path efficiency per clip; zeros for fewer than two frames."""
    w = W.partitionBy("event_id").orderBy("frame")
    step = points.withColumn("_d", F.hypot(F.col("x") - F.lag("x").over(w), F.col("y") - F.lag("y").over(w)))
    ends = step.groupBy("event_id").agg(F.min_by(F.struct("x", "y"), "frame").alias("a"), F.max_by(F.struct("x", "y"), "frame").alias("b"), F.avg("_d").alias("m"), F.sum("_d").alias("path"), F.count("*").alias("n"), F.min("frame").alias("first"))
    disp = F.hypot(F.col("b.x") - F.col("a.x"), F.col("b.y") - F.col("a.y"))
    return ends.select("event_id", F.col("n").alias("bird_frames"), F.col("first").alias("bird_first"), F.when(F.col("n") > 1, disp).otherwise(0.0).alias("bird_displacement"), F.coalesce("m", F.lit(0.0)).alias("bird_mean_motion"), F.when(F.col("path") > 0, disp / F.col("path")).otherwise(0.0).alias("bird_path_efficiency"))


def features(events: DataFrame, df: DataFrame, bird: str = "adult", fish: str = "fish", flag: str = "arrival_with_fish_stage2") -> DataFrame:
    """The features of each event's clip; clips without boxes get the defaults."""
    total = df.groupBy("event_id").agg((F.max("frame") + 1).alias("total_frames"))
    own = df.where(F.lower("class") == fish).join(total, "event_id")
    half = F.floor(F.col("total_frames") * 0.5)
    conf, size = F.coalesce("confidence", F.lit(0.0)), F.coalesce((F.col("xmax") - F.col("xmin")) * (F.col("ymax") - F.col("ymin")), F.lit(0.0))
    mean = F.avg(conf)
    early, late = F.avg(F.when(F.col("frame") <= half, conf)), F.avg(F.when(F.col("frame") > half, conf))
    f = own.groupBy("event_id").agg(F.count_distinct("frame").alias("fish_frames"), F.count("*").alias("fish_detection_count"), mean.alias("fish_avg_confidence"), F.stddev_pop(conf).alias("fish_confidence_std"), (F.coalesce(late, mean) - F.coalesce(early, mean)).alias("fish_conf_late_minus_early"), F.avg(size).alias("fish_area_mean"), F.coalesce(F.regr_slope(size, F.col("frame")), F.lit(0.0)).alias("fish_area_trend"), F.min("frame").alias("f_first"), F.max("frame").alias("f_last"))
    birds, fishes = centroids(df, bird), centroids(df, fish).withColumnsRenamed({"x": "fx", "y": "fy"})
    apart = birds.join(fishes, ["event_id", "frame"]).withColumn("_d", F.hypot(F.col("x") - F.col("fx"), F.col("y") - F.col("fy"))).groupBy("event_id").agg(F.avg("_d").alias("fish_bird_mean_distance"), F.min("_d").alias("fish_bird_min_distance"))
    out = events.select("event_id", F.col(flag).cast("int").alias("arrival_with_fish_stage2"))
    for part in (total, f, motion(birds), apart):
        out = out.join(part, "event_id", "left")
    n = F.col("total_frames")
    part = lambda c, empty: F.coalesce(F.col(c) / n, F.lit(empty))
    out = out.withColumns({"fish_presence_ratio": part("fish_frames", 0.0), "fish_first_frame_ratio": part("f_first", 1.0), "fish_last_frame_ratio": part("f_last", 0.0), "bird_first_ratio": part("bird_first", 1.0)})
    gap = F.when(n.isNull(), 1.0).otherwise(F.col("fish_first_frame_ratio") - F.col("bird_first_ratio"))
    out = out.withColumn("fish_to_bird_first_frame_ratio_gap", gap)
    far = {"fish_bird_mean_distance", "fish_bird_min_distance"}
    whole = {"total_frames", "bird_frames", "fish_frames", "fish_detection_count"}
    fill = lambda c: F.coalesce(F.col(c), F.lit(9999.0 if c in far else 0).cast("bigint" if c in whole else "double")) if c != "arrival_with_fish_stage2" else F.col(c)
    return out.select("event_id", *(fill(c).alias(c) for c in FEATURES))


def linear_score(names, means, stds, weights, bias: float) -> Column:
    """Probability of a linear model; a deviation of 0 or less counts as 1, a missing feature as 0."""
    z = F.lit(float(bias))
    for n, m, s, w in zip(names, means, stds, weights):
        z = z + float(w) * (F.coalesce(F.col(n).cast("double"), F.lit(0.0)) - float(m)) / (float(s) if s > 0 else 1.0)
    return sigmoid(z)


def classify(df: DataFrame, model: dict | None = None, bird_frames: int = 8, displacement: float = 20.0, step: float = 2.0, fish_frames: int = 3, early: float = 0.15, threshold: float = 0.49) -> DataFrame:
    """Gates, rules and the optional model; a list of what was hit.

    Needs event_type, stage3_status, has_detections and the features.
    """
    frames, moved, steps = F.col("bird_frames") >= bird_frames, F.col("bird_displacement") >= displacement, F.col("bird_mean_motion") >= step
    real = frames & (moved | steps)
    flag, enough, late = F.col("arrival_with_fish_stage2") == 1, F.col("fish_frames") >= fish_frames, F.col("fish_first_frame_ratio") > early
    new = flag & enough & late
    hit = lambda c, name: F.when(c, F.lit(name))
    hits = [hit(frames, "bird_frames_ok"), hit(moved, "bird_displacement_ok"), hit(steps, "bird_motion_ok"), hit(~real, "actual_arrival_rejected"), hit(~real, "not_actual_arrival")]
    hits += [hit(real & c, n) for c, n in ((flag, "stage2_arrival_with_fish"), (enough, "fish_frames_ok"), (late, "fish_not_early"), (~new, "new_fish_arrival_rejected"))]
    score, source, said = F.lit(None).cast("double"), F.lit("rules"), new
    if model:
        score = F.when(real, linear_score(model["feature_names"], model["means"], model["stds"], model["weights"], model["bias"]))
        source, said = F.when(real, "model").otherwise("rules"), score >= threshold
        hits += [F.when(real, F.when(said, "model_positive").otherwise("model_negative")), hit(real, f"model_threshold_{threshold:.3f}")]
    gate = F.when(F.col("event_type") != "arrival", "non_arrival_event").when(F.coalesce(F.col("stage3_status"), F.lit("")) != "completed", "stage3_not_completed").when(~F.col("has_detections"), "missing_detections_csv")
    open_ = gate.isNull()
    return df.select(
        "*",
        F.when(open_, real).otherwise(False).cast("int").alias("is_actual_arrival"),
        F.when(open_, real & said).otherwise(False).cast("int").alias("is_new_fish_arrival"),
        F.when(open_, F.array_compact(F.array(*hits))).otherwise(F.array(gate)).alias("rule_hits"),
        F.when(open_, score).alias("model_score"),
        F.when(open_, source).otherwise("rules").alias("decision_source"),
    )


def fit_logistic(df: DataFrame, names: list[str], truth: str, l2: float = 0.01, rounds: int = 30, tolerance: float = 1e-10) -> dict:
    """The linear model with the least mean log loss + l2 / 2 * |weights|^2 over
    standardised features (a deviation under 1e-6 counts as 1, a missing value as
    the mean).

    Newton's method: a round is one aggregate over all rows, which returns
    gradient and curvature, some hundreds of sums at most; the driver solves for
    the step, and halves it while the loss grows.
    """
    k = len(names)
    first = df.agg(*(F.avg(F.col(n).cast("double")).alias(f"m{i}") for i, n in enumerate(names)), *(F.stddev_pop(F.col(n).cast("double")).alias(f"s{i}") for i, n in enumerate(names))).first()
    means = [float(first[f"m{i}"] or 0.0) for i in range(k)]
    stds = [s if (s := float(first[f"s{i}"] or 0.0)) >= 1e-6 else 1.0 for i in range(k)]
    z = [F.coalesce((F.col(n).cast("double") - m) / s, F.lit(0.0)) for n, m, s in zip(names, means, stds)]
    rows = df.select(*(x.alias(f"z{i}") for i, x in enumerate(z)), F.lit(1.0).alias(f"z{k}"), F.col(truth).cast("double").alias("y"))
    ridge = np.diag([l2] * k + [0.0])

    def measure(at: np.ndarray):
        eta = sum((F.col(f"z{i}") * float(v) for i, v in enumerate(at)), F.lit(0.0))
        seen = rows.select("*", eta.alias("eta"), sigmoid(eta).alias("p"))
        # log(1 + exp(eta)) - y * eta, without overflow
        loss = F.greatest("eta", F.lit(0.0)) + F.log1p(F.exp(-F.abs("eta"))) - F.col("y") * F.col("eta")
        pairs = [(i, j) for i in range(k + 1) for j in range(i + 1)]
        sums = seen.agg(F.avg(loss).alias("loss"), *(F.avg((F.col("p") - F.col("y")) * F.col(f"z{i}")).alias(f"g{i}") for i in range(k + 1)), *(F.avg(F.col("p") * (1 - F.col("p")) * F.col(f"z{i}") * F.col(f"z{j}")).alias(f"h{i}_{j}") for i, j in pairs)).first()
        if sums["loss"] is None:
            return 0.0, np.zeros(k + 1), np.eye(k + 1)
        curve = np.zeros((k + 1, k + 1))
        for i, j in pairs:
            curve[i, j] = curve[j, i] = sums[f"h{i}_{j}"]
        return sums["loss"] + at @ ridge @ at / 2, np.array([sums[f"g{i}"] for i in range(k + 1)]) + ridge @ at, curve + ridge

    at = np.zeros(k + 1)
    loss, slope, curve = measure(at)
    for _ in range(rounds):
        if np.abs(slope).max() <= tolerance:
            break
        step = np.linalg.lstsq(curve + 1e-12 * np.eye(k + 1), slope, rcond=None)[0]
        there = measure(at - step)
        while there[0] > loss + 1e-12 and np.abs(step).max() > 1e-9:
            step = step / 2
            there = measure(at - step)
        at, (loss, slope, curve) = at - step, there
    return {"means": means, "stds": stds, "weights": at[:k].tolist(), "bias": float(at[k]), "loss": float(loss)}


def over_thresholds(df: DataFrame, truth: str, score: str, steps: int = 81, low: float = 0.1, high: float = 0.9) -> DataFrame:
    """Quality at evenly spaced thresholds. Counts per threshold come from one pass:
    each row is put into the step below its score, then summed from above."""
    width = (high - low) / (steps - 1)
    at = F.least(F.greatest(F.floor((F.col(score) - low) / width + 1e-9), F.lit(-1)), F.lit(steps - 1)).cast("int")
    n = df.groupBy(at.alias("step")).agg(F.count_if(F.col(truth) == 1).alias("p"), F.count_if(F.col(truth) != 1).alias("q"))
    grid = df.sparkSession.range(-1, steps).select(F.col("id").cast("int").alias("step"))
    up = W.partitionBy(F.lit(0)).orderBy(F.desc("step")).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(F.lit(0))
    g = grid.join(n, "step", "left").fillna(0, ["p", "q"])
    g = g.select("step", F.sum("p").over(up).alias("tp"), F.sum("q").over(up).alias("fp"), (F.sum("p").over(whole) - F.sum("p").over(up)).alias("fn"), (F.sum("q").over(whole) - F.sum("q").over(up)).alias("tn")).where("step >= 0")
    return rates(g).withColumn("threshold", F.round(low + F.col("step") * width, 6)).drop("step")


def best_threshold(table: DataFrame) -> DataFrame:
    """The first threshold with the highest F1."""
    return table.orderBy(F.desc("f1"), "threshold").limit(1)


def search_rule(df: DataFrame, truth: str, grid: list[tuple[str, str, list]], validates: Column) -> DataFrame:
    """Quality of all combinations of bounds, (column, ">=" or "<=", values) each:
    counts and rates over the rows that validate, counts (train_...) over the
    others, and `chosen` for the first combination with the best F1 on the former.
    The grid is bounded, so each row is checked against it in one pass."""
    spark, keys = df.sparkSession, [c for c, _, _ in grid]
    combos = spark.createDataFrame([tuple(float(v) for v in c) for c in product(*(values for _, _, values in grid))], ", ".join(f"_{c} double" for c in keys))
    said = F.lit(True)
    for c, way, _ in grid:
        said = said & (F.col(c) >= F.col(f"_{c}") if way == ">=" else F.col(c) <= F.col(f"_{c}"))
    joined = df.select(*keys, (F.col(truth) == 1).alias("_t"), validates.alias("_v")).crossJoin(F.broadcast(combos)).withColumn("_s", said)
    t, s, v = F.col("_t"), F.col("_s"), F.col("_v")
    counts = {f"{part}{name}": F.count_if(rows & hit) for part, rows in (("train_", ~v), ("", v)) for name, hit in (("tp", t & s), ("tn", ~t & ~s), ("fp", ~t & s), ("fn", t & ~s))}
    rated = rates(joined.groupBy(*(f"_{c}" for c in keys)).agg(*(c.alias(n) for n, c in counts.items())))
    best = F.row_number().over(W.partitionBy(F.lit(0)).orderBy(F.desc("f1"), *(f"_{c}" for c in keys)))
    return rated.withColumn("chosen", best == 1).withColumnsRenamed({f"_{c}": c for c in keys})
