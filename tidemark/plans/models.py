"""Features, rules, model and tuning over events in the role of clips."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import classify, grid, rollup, select, states
from tidemark.plans.core import ser
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, detections, table

_MODEL = {"feature_names": ["bird_displacement", "fish_frames"], "means": [300.0, 5.0], "stds": [200.0, 3.0], "weights": [1.0, 0.5], "bias": 0.1}


def _clips(spark, sf_dir):
    """A user's events of one type are an event's clip: views are birds, clicks fish."""
    d = detections(spark, sf_dir).drop("event_id").withColumnRenamed("video_id", "event_id").withColumnRenamed("second", "frame")
    events = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("event_id"), (F.col("c_custkey") % 2).alias("arrival_with_fish_stage2"))
    return events, d


_FEATURES = f"""{DET}, ev AS (SELECT c_custkey AS event_id, CAST(c_custkey % 2 AS INTEGER) AS arrival_with_fish_stage2 FROM customer),
    tot AS (SELECT video_id, max(second) + 1 AS total_frames FROM det GROUP BY 1),
    fi AS (SELECT d.*, total_frames, (xmax - xmin) * (ymax - ymin) AS a FROM det d JOIN tot USING (video_id) WHERE class = 'click'),
    fa AS (SELECT video_id, count(DISTINCT second) AS fish_frames, count(*) AS fish_detection_count, avg(confidence) AS fish_avg_confidence, stddev_pop(confidence) AS fish_confidence_std,
        coalesce(avg(confidence) FILTER (second > floor(total_frames * 0.5)), avg(confidence)) - coalesce(avg(confidence) FILTER (second <= floor(total_frames * 0.5)), avg(confidence)) AS fish_conf_late_minus_early,
        avg(a) AS fish_area_mean, CASE WHEN var_pop(second) > 0 THEN regr_slope(a, second) ELSE 0 END AS fish_area_trend, min(second) AS f1, max(second) AS f2 FROM fi GROUP BY 1),
    ce AS (SELECT video_id, second, class, avg((xmin + xmax) / 2) AS x, avg((ymin + ymax) / 2) AS y FROM det WHERE class IN ('view', 'click') GROUP BY ALL),
    bs AS (SELECT *, sqrt(pow(x - lag(x) OVER w, 2) + pow(y - lag(y) OVER w, 2)) AS d FROM ce WHERE class = 'view' WINDOW w AS (PARTITION BY video_id ORDER BY second)),
    bm AS (SELECT video_id, count(*) AS bird_frames, min(second) AS b1, sqrt(pow(arg_max(x, second) - arg_min(x, second), 2) + pow(arg_max(y, second) - arg_min(y, second), 2)) AS disp, avg(d) AS m, sum(d) AS path FROM bs GROUP BY 1),
    ap AS (SELECT a.video_id, avg(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS dm, min(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS dn FROM ce a JOIN ce b ON a.video_id = b.video_id AND a.second = b.second AND a.class = 'view' AND b.class = 'click' GROUP BY 1),
    ft AS (SELECT event_id, coalesce(total_frames, 0) AS total_frames, coalesce(bird_frames, 0) AS bird_frames, coalesce(fish_frames, 0) AS fish_frames, coalesce(fish_detection_count, 0) AS fish_detection_count, coalesce(fish_avg_confidence, 0) AS fish_avg_confidence, coalesce(fish_confidence_std, 0) AS fish_confidence_std,
        coalesce(fish_frames / total_frames, 0) AS fish_presence_ratio, coalesce(f1 / total_frames, 1) AS fish_first_frame_ratio, coalesce(f2 / total_frames, 0) AS fish_last_frame_ratio, coalesce(fish_conf_late_minus_early, 0) AS fish_conf_late_minus_early, coalesce(fish_area_mean, 0) AS fish_area_mean, coalesce(fish_area_trend, 0) AS fish_area_trend,
        CASE WHEN bird_frames > 1 THEN disp ELSE 0 END AS bird_displacement, coalesce(m, 0) AS bird_mean_motion, CASE WHEN path > 0 THEN disp / path ELSE 0 END AS bird_path_efficiency, coalesce(dm, 9999) AS fish_bird_mean_distance, coalesce(dn, 9999) AS fish_bird_min_distance,
        CASE WHEN total_frames IS NULL THEN 1 ELSE coalesce(f1 / total_frames, 1) - coalesce(b1 / total_frames, 1) END AS fish_to_bird_first_frame_ratio_gap, arrival_with_fish_stage2
      FROM ev LEFT JOIN tot ON tot.video_id = event_id LEFT JOIN fa ON fa.video_id = event_id LEFT JOIN bm ON bm.video_id = event_id LEFT JOIN ap ON ap.video_id = event_id)"""
_ROUNDED = [c for c in classify.FEATURES if c not in ("total_frames", "bird_frames", "fish_frames", "fish_detection_count", "arrival_with_fish_stage2")]


@query("op_118_160_features", f"WITH {_FEATURES} SELECT event_id, total_frames, bird_frames, fish_frames, fish_detection_count, arrival_with_fish_stage2, {', '.join(f'round({c} + 1e-7, 4) AS {c}' for c in _ROUNDED)} FROM ft")
def op_118(spark, sf_dir):
    out = classify.features(*_clips(spark, sf_dir), bird="view", fish="click")
    return out.withColumns({c: F.round(F.col(c) + 1e-7, 4) for c in _ROUNDED})


def _gated(spark, sf_dir):
    f = classify.features(*_clips(spark, sf_dir), bird="view", fish="click")
    k = F.col("event_id")
    return f.withColumns({"event_type": F.when(k % 10 == 9, "departure").otherwise("arrival"), "stage3_status": F.when(k % 7 != 6, "completed"), "has_detections": F.col("total_frames") > 0})


_GATE = "CASE WHEN event_id % 10 = 9 THEN 'non_arrival_event' WHEN event_id % 7 = 6 THEN 'stage3_not_completed' WHEN total_frames = 0 THEN 'missing_detections_csv' END"
_RULES = f"""{_FEATURES}, ru AS (SELECT *, {_GATE} AS gate, bird_frames >= 8 AS r1, bird_displacement >= 20 AS r2, bird_mean_motion >= 2 AS r3, arrival_with_fish_stage2 = 1 AS s1, fish_frames >= 3 AS s2, fish_first_frame_ratio > 0.15 AS s3 FROM ft),
    rv AS (SELECT *, r1 AND (r2 OR r3) AS ok FROM ru), rw AS (SELECT *, 1 / (1 + exp(-(0.1 + (bird_displacement - 300) / 200 + 0.5 * (fish_frames - 5) / 3))) AS p FROM rv)"""
_HITS = "concat_ws('+', CASE WHEN r1 THEN 'bird_frames_ok' END, CASE WHEN r2 THEN 'bird_displacement_ok' END, CASE WHEN r3 THEN 'bird_motion_ok' END, CASE WHEN NOT ok THEN 'actual_arrival_rejected+not_actual_arrival' END, CASE WHEN ok AND s1 THEN 'stage2_arrival_with_fish' END, CASE WHEN ok AND s2 THEN 'fish_frames_ok' END, CASE WHEN ok AND s3 THEN 'fish_not_early' END, CASE WHEN ok AND NOT (s1 AND s2 AND s3) THEN 'new_fish_arrival_rejected' END"


@query("op_220_222_rules", f"WITH {_RULES} SELECT event_id, CAST(gate IS NULL AND ok AS INTEGER) AS is_actual_arrival, CAST(gate IS NULL AND ok AND s1 AND s2 AND s3 AS INTEGER) AS is_new_fish_arrival, coalesce(gate, {_HITS})) AS rule_hits, 'rules' AS decision_source FROM rw")
def op_220(spark, sf_dir):
    out = classify.classify(_gated(spark, sf_dir))
    return out.select("event_id", "is_actual_arrival", "is_new_fish_arrival", F.array_join("rule_hits", "+").alias("rule_hits"), "decision_source")


@query("op_223_model", f"WITH {_RULES} SELECT event_id, CAST(gate IS NULL AND ok AND p >= 0.49 AS INTEGER) AS is_new_fish_arrival, CASE WHEN gate IS NULL AND ok THEN round(p, 6) END AS model_score, CASE WHEN gate IS NULL AND ok THEN 'model' ELSE 'rules' END AS decision_source FROM rw")
def op_223(spark, sf_dir):
    out = classify.classify(_gated(spark, sf_dir), _MODEL)
    return out.select("event_id", "is_new_fish_arrival", F.round("model_score", 6).alias("model_score"), "decision_source")


@query("op_224_logistic", None)
def op_224(spark, sf_dir):
    """Fit on all clips with boxes, score them."""
    f = classify.features(*_clips(spark, sf_dir), bird="view", fish="click").where("total_frames > 0").persist()
    names = ["fish_frames", "bird_frames", "bird_displacement"]
    model = classify.fit_logistic(f, names, "arrival_with_fish_stage2")
    return f.select("event_id", F.round(classify.linear_score(names, model["means"], model["stds"], model["weights"], model["bias"]), 6).alias("score"))


_SC = "sc AS (SELECT doc_id, toxic, (doc_id * 37 % 100) / 100.0 AS score FROM labels)"


@query("op_225_thresholds", f"WITH {_SC}, t AS (SELECT round(0.1 + k * 0.01, 6) AS threshold FROM (SELECT unnest(range(0, 81)) AS k)), c AS (SELECT threshold, count(*) FILTER (toxic = 1 AND score >= threshold - 1e-9) AS tp, count(*) FILTER (toxic <> 1 AND score >= threshold - 1e-9) AS fp, count(*) FILTER (toxic = 1 AND score < threshold - 1e-9) AS fn FROM sc, t GROUP BY 1) SELECT threshold, tp, fp, fn, round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM c")
def op_225(spark, sf_dir):
    s = table(spark, sf_dir, "labels").select("toxic", (F.col("doc_id") * 37 % 100 / 100.0).alias("score"))
    out = classify.over_thresholds(s, "toxic", "score")
    return out.select("threshold", "tp", "fp", "fn", F.round("f1", 6).alias("f1"))


#: Bounds of the rule search: column, comparison, values.
_RULE_GRID = [("fish_detection_count", ">=", [2, 3, 4, 6]), ("fish_first_frame_ratio", ">=", [0.05, 0.1, 0.15, 0.2, 0.25]), ("fish_bird_min_distance", "<=", [60.0, 80.0, 100.0, 140.0]), ("fish_avg_confidence", ">=", [0.45, 0.55, 0.65, 0.75])]
_GRID_SQL = ", ".join(f"(SELECT unnest({[float(v) for v in values]}::DOUBLE[]) AS b{i})" for i, (_, _, values) in enumerate(_RULE_GRID))
_SAID_SQL = " AND ".join(f"{c} {op} b{i}" for i, (c, op, _) in enumerate(_RULE_GRID))


@query("op_226_rule_search", f"""WITH {_FEATURES}, v AS (SELECT *, event_id % 5 = 0 AS val, arrival_with_fish_stage2 = 1 AS t FROM ft),
    n AS (SELECT b0, b1, b2, b3, count(*) FILTER (NOT val AND t AND s) AS train_tp, count(*) FILTER (NOT val AND NOT t AND s) AS train_fp, count(*) FILTER (NOT val AND t AND NOT s) AS train_fn, count(*) FILTER (val AND t AND s) AS tp, count(*) FILTER (val AND NOT t AND s) AS fp, count(*) FILTER (val AND t AND NOT s) AS fn
      FROM (SELECT *, {_SAID_SQL} AS s FROM v, {_GRID_SQL}) GROUP BY ALL)
    SELECT b0 AS fish_detection_count, b1 AS fish_first_frame_ratio, b2 AS fish_bird_min_distance, b3 AS fish_avg_confidence, train_tp, train_fp, train_fn, tp, fp, fn, row_number() OVER (ORDER BY coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) DESC, b0, b1, b2, b3) = 1 AS chosen FROM n""")
def op_226(spark, sf_dir):
    """Clips of every fifth event validate: the rule with the best F1 on them is chosen."""
    f = classify.features(*_clips(spark, sf_dir), bird="view", fish="click")
    out = classify.search_rule(f, "arrival_with_fish_stage2", _RULE_GRID, F.col("event_id") % 5 == 0)
    return out.select(*(c for c, _, _ in _RULE_GRID), "train_tp", "train_fp", "train_fn", "tp", "fp", "fn", "chosen")


@query("op_227_detector_grid", None)
def op_227(spark, sf_dir):
    """State detectors of a small grid against purchases as truth: the series is
    computed once, each combination only varies later steps."""
    s = ser(spark, sf_dir).persist()
    truth = detections(spark, sf_dir).where("class = 'purchase'").selectExpr("video_id file", "event_id truth_no", "'arrival' type", "second")
    total, out = truth.agg(F.count("*").alias("truths")), None
    for spike, dip, shortest in ((0, 0, 3), (1, 2, 3), (2, 3, 3), (2, 3, 5)):
        found = states.detect(s, spike=spike, dip=dip, shortest=shortest).selectExpr("video_id file", "second * 10 + count_change found_no", "type", "second")
        c = select.match_nearest(truth, found, 3).agg(F.count("*").alias("tp")).crossJoin(found.agg(F.count("*").alias("found"))).crossJoin(total)
        c = rollup.rates(c.select(F.lit(spike).alias("spike"), F.lit(dip).alias("dip"), F.lit(shortest).alias("shortest"), "tp", (F.col("found") - F.col("tp")).alias("fp"), (F.col("truths") - F.col("tp")).alias("fn")))
        out = c if out is None else out.unionByName(c)
    return out


@query("op_164_mahalanobis", None)
def op_164(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("label", "vec_id", F.col("embedding").alias("v"))
    return grid.mahalanobis(e, "label", "vec_id", "v", 20).withColumn("score", F.round("score", 5))


@query("op_230_114_adaptive_grid", None)
def op_230(spark, sf_dir):
    """Cells from a bounded sample of 1000 centres, then all boxes by cell."""
    d = detections(spark, sf_dir)
    pts = d.orderBy(F.xxhash64("event_id"), "event_id").limit(1000).selectExpr("(xmin + xmax) / 2 x", "(ymin + ymax) / 2 y").toPandas().to_numpy()
    cells = spark.createDataFrame(grid.adaptive_cells(pts, 2688, 1520, 40), "cell_id int, cell_xmin double, cell_ymin double, cell_xmax double, cell_ymax double, points int")
    return grid.embed_adaptive(d.withColumnRenamed("second", "frame"), cells, ("view", "click")).withColumn("f3", F.round("f3", 6))


@query("op_231_pca", None)
def op_231(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return grid.principal_components(e, "embedding", 2).select("vec_id", F.round(F.col("pca")[0], 5).alias("p1"), F.round(F.col("pca")[1], 5).alias("p2"))
