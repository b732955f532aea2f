"""Series, repair, states, detectors and what they add."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boxes, enrich, series, states, threshold
from tidemark.plans.registry import query
from tidemark.plans.roles import CLASSES, DET, GRID, detections

W = "(PARTITION BY video_id ORDER BY second)"


def ser(spark, sf_dir):
    return series.counts(detections(spark, sf_dir), CLASSES)


def r6(*names):
    return [F.round(n, 6).alias(n) for n in names]


@query("op_100_per_second", f"""WITH {GRID}, agg AS (SELECT video_id, second, {', '.join(f"count(*) FILTER (class = '{c}') AS count_{c}, round(avg((xmin+xmax)/2) FILTER (class = '{c}'), 6) AS {c}_mean_x, round(avg((ymin+ymax)/2) FILTER (class = '{c}'), 6) AS {c}_mean_y, round(avg(greatest(0, (xmax-xmin)*(ymax-ymin))) FILTER (class = '{c}'), 6) AS {c}_mean_area, max(greatest(0, (xmax-xmin)*(ymax-ymin))) FILTER (class = '{c}') AS {c}_max_area, round(avg(confidence) FILTER (class = '{c}'), 6) AS {c}_mean_conf" for c in CLASSES)} FROM det GROUP BY ALL)
    SELECT g.video_id, g.second, {', '.join(f"coalesce(count_{c}, 0) AS count_{c}, {c}_mean_x, {c}_mean_y, {c}_mean_area, {c}_max_area, {c}_mean_conf" for c in CLASSES)}, {' + '.join(f"coalesce(count_{c}, 0)" for c in CLASSES)} AS count_total FROM grid g LEFT JOIN agg USING (video_id, second)""")
def op_100(spark, sf_dir):
    out = series.per_second(detections(spark, sf_dir), CLASSES)
    return out.withColumns({f"{c}_{x}": F.round(f"{c}_{x}", 6) for c in CLASSES for x in ("mean_x", "mean_y", "mean_area", "mean_conf")})


@query("op_101_frames_to_seconds", "SELECT event_id, CAST(floor((event_id - 500) / 25) AS BIGINT) AS s1, CAST(floor((event_id - 500) / 5) AS BIGINT) AS s5 FROM events")
def op_101(spark, sf_dir):
    d = detections(spark, sf_dir).select("event_id", (F.col("event_id") - 500).alias("f"))
    return d.select("event_id", series.seconds_of("f", 1).alias("s1"), series.seconds_of("f", 5).alias("s5"))


@query("op_140_moving_average", f"""WITH {GRID}, x AS (SELECT *, list(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l FROM ser)
    SELECT video_id, second, round(list_sum([l[greatest(1, least(n, second + 1 + o))] for o in range(-2, 3)]) / 5.0, 6) AS smooth FROM x""")
def op_140(spark, sf_dir):
    return ser(spark, sf_dir).withColumn("smooth", series.moving_average("c", 5)).select("video_id", "second", *r6("smooth"))


@query("op_141_trailing_mean", f"WITH {GRID} SELECT video_id, second, round(avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS 9 PRECEDING), 6) AS m FROM ser")
def op_141(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", F.round(series.trailing("c", 10), 6).alias("m"))


@query("op_142_full_trailing_mean", f"WITH {GRID} SELECT video_id, second, CASE WHEN second >= 9 THEN round(avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS 9 PRECEDING), 6) END AS m FROM ser")
def op_142(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", F.round(series.trailing("c", 10, True), 6).alias("m"))


@query("op_143_centered_mean", f"WITH {GRID} SELECT video_id, second, round(avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS m FROM ser")
def op_143(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", F.round(series.centered("c", 2), 6).alias("m"))


@query("op_144_before_after", f"WITH {GRID} SELECT video_id, second, round(coalesce(avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 0), 6) AS b, round(avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING), 6) AS a FROM ser")
def op_144(spark, sf_dir):
    b, a = series.before_after("c", 10, 8)
    return ser(spark, sf_dir).select("video_id", "second", F.round(b, 6).alias("b"), F.round(a, 6).alias("a"))


@query("op_145_lag_diff", f"WITH {GRID} SELECT video_id, second, c - lag(c) OVER {W} AS d FROM ser")
def op_145(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", (F.col("c") - F.lag("c").over(series.by_video())).alias("d"))


_FLAGS = f"""{GRID}, l AS (SELECT *, lag(c) OVER {W} AS p, lead(c, 1) OVER {W} AS n1, lead(c, 2) OVER {W} AS n2, max(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS top, avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN 2 PRECEDING AND 1 PRECEDING) AS near FROM ser),
    fl AS (SELECT *, coalesce(c > p AND n1 IS NOT NULL AND 1 + coalesce(CAST(n1 >= c AS INTEGER), 0) + coalesce(CAST(n2 >= c AS INTEGER), 0) >= greatest(1.0, (2 + CAST(n2 IS NOT NULL AS INTEGER)) * 0.6), false) AS up, top IS NULL OR c > top AS new, coalesce(c < near - 0.5 AND n1 IS NOT NULL, false) AS down FROM l)"""


@query("op_146_148_step_tests", f"WITH {_FLAGS} SELECT video_id, second, up, new, down FROM fl")
def op_146(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", series.sustained().alias("up"), series.novel().alias("new"), series.local_drop().alias("down"))


@query("op_150_outlier_smoothing", f"""WITH {GRID}, x AS (SELECT *, avg(c) OVER f AS m, stddev_pop(c) OVER f AS s, count(*) OVER f AS k, quantile_cont(c, 0.5) OVER f AS q FROM ser WINDOW f AS (PARTITION BY video_id ORDER BY second ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
    SELECT video_id, second, CASE WHEN k > 2 AND abs(c - m) > 1.75 * (CASE WHEN s = 0 THEN 1 ELSE s END) THEN CAST(floor(q) AS BIGINT) ELSE c END AS c FROM x""")
def op_150(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", series.smooth_outliers("c", 3, 1.75).alias("c"))


def repair_sql(source: str, name: str, m: int, dip: bool) -> str:
    """CTEs of a repair, by looking at all starts of each second."""
    leads = ", ".join(f"lead(c, {k}) OVER {W} AS f{k}" for k in range(1, m + 2))
    sign = ">=" if dip else "<="
    k = "CASE " + " ".join(f"WHEN f{k} {sign} c THEN {k}" for k in range(1, m + 2)) + " END"
    v = "CASE " + " ".join(f"WHEN f{k} {sign} c THEN f{k}" for k in range(1, m + 2)) + " END"
    ok = f"k >= 2 AND second < n - {m} - 1" + (" AND v - c <= 1" if dip else "")
    pick = "CASE " + " ".join(f"WHEN lag(r, {d}) OVER {W} > {d} THEN lag(c, {d}) OVER {W}" for d in range(m, 0, -1)) + " ELSE c END"
    return f"{name}1 AS (SELECT video_id, second, n, c, {leads} FROM {source}), {name}2 AS (SELECT video_id, second, n, c, {k} AS k, {v} AS v FROM {name}1), {name}3 AS (SELECT video_id, second, n, c, CASE WHEN {ok} THEN k END AS r FROM {name}2), {name} AS (SELECT video_id, second, n, {pick} AS c FROM {name}3)"


@query("op_151_remove_spikes", f"WITH {GRID}, {repair_sql('ser', 'sp', 2, False)} SELECT video_id, second, c FROM sp")
def op_151(spark, sf_dir):
    return series.remove_spikes(ser(spark, sf_dir), longest=2)


@query("op_152_remove_dips", f"WITH {GRID}, {repair_sql('ser', 'dp', 3, True)} SELECT video_id, second, c FROM dp")
def op_152(spark, sf_dir):
    return series.remove_dips(ser(spark, sf_dir), longest=3)


_REPAIRED = f"{GRID}, {repair_sql('ser', 'sp', 2, False)}, {repair_sql('sp', 'rp', 3, True)}"


@query("op_153_repaired", f"WITH {_REPAIRED} SELECT video_id, second, c FROM rp")
def op_153(spark, sf_dir):
    return series.repaired(ser(spark, sf_dir), spike=2, dip=3)


_STATES = f"""{_REPAIRED}, i1 AS (SELECT video_id, second, c, CASE WHEN c = lag(c) OVER {W} THEN 0 ELSE 1 END AS e FROM rp), i2 AS (SELECT *, sum(e) OVER {W} AS run FROM i1),
    st AS (SELECT video_id, min(second) AS start_second, max(second) AS end_second, count(*) AS duration, avg(c) AS mean_count, CAST(min(c) AS DOUBLE) AS median_count, min(c) AS min_count, max(c) AS max_count FROM i2 GROUP BY video_id, run HAVING count(*) >= 3)"""


@query("op_154_stable_periods", f"WITH {_STATES} SELECT * FROM st")
def op_154(spark, sf_dir):
    return states.stable_periods(series.repaired(ser(spark, sf_dir), spike=2, dip=3), shortest=3)


_STATE_EVENTS = f"""{_STATES}, sl AS (SELECT *, lag(median_count) OVER w AS pm, lag(duration) OVER w AS pd, lag(end_second) OVER w AS pe, lag(max_count - min_count) OVER w AS pr FROM st WINDOW w AS (PARTITION BY video_id ORDER BY start_second)),
    sev AS (SELECT video_id, start_second AS second, CASE WHEN median_count > pm THEN 'arrival' ELSE 'departure' END AS type, CAST(median_count - pm AS BIGINT) AS count_change, round(0.3 * least(least(pd, duration) / 10.0, 1) + 0.4 * least(abs(median_count - pm) / 3.0, 1) + 0.3 * greatest(0, 1 - (pr + max_count - min_count) / 2.0), 6) AS confidence, CAST(pm AS BIGINT) AS from_count, CAST(median_count AS BIGINT) AS to_count
      FROM sl WHERE abs(median_count - pm) >= 1 AND start_second + 1 - pe <= 15)"""


@query("op_157_state_events", f"WITH {_STATE_EVENTS} SELECT * FROM sev")
def op_157(spark, sf_dir):
    """Operators 155 and 156 as well: events between states, with their confidence."""
    out = states.detect(ser(spark, sf_dir), spike=2, dip=3, shortest=3)
    return out.withColumn("confidence", F.round("confidence", 6))


_CHOSEN = """first AS (SELECT video_id, min(t) AS t, arg_min(resume, t) AS resume FROM cand GROUP BY video_id),
    pick AS (SELECT * FROM first UNION ALL SELECT c.video_id, min(c.t), arg_min(c.resume, c.t) FROM pick p JOIN cand c ON c.video_id = p.video_id AND c.t >= p.resume GROUP BY c.video_id)"""


@query("op_154_stable_periods_varied", f"""WITH RECURSIVE {GRID}, w AS (SELECT a.video_id, a.second AS t, max(b.c) OVER x - min(b.c) OVER x AS spread FROM ser a JOIN ser b ON b.video_id = a.video_id AND b.second >= a.second WINDOW x AS (PARTITION BY a.video_id, a.second ORDER BY b.second)),
    cand AS (SELECT video_id, t, t + count(*) AS resume FROM w WHERE spread <= 1 GROUP BY 1, 2 HAVING count(*) >= 5), {_CHOSEN}
    SELECT p.video_id, p.t AS start_second, p.resume - 1 AS end_second, count(*) AS duration, avg(c) AS mean_count, quantile_cont(c, 0.5) AS median_count, min(c) AS min_count, max(c) AS max_count FROM pick p JOIN ser s ON s.video_id = p.video_id AND s.second >= p.t AND s.second < p.resume GROUP BY ALL""")
def op_154_varied(spark, sf_dir):
    return states.stable_periods(ser(spark, sf_dir), shortest=5, variation=1)


@query("op_158_threshold_events", f"""WITH RECURSIVE {_FLAGS}, ls AS (SELECT video_id, second, list(c) OVER (PARTITION BY video_id ORDER BY second ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS l, n FROM ser),
    sm AS (SELECT video_id, second, list_sum([l[greatest(1, least(n, second + 1 + o))] for o in range(-1, 2)]) / 3.0 AS s FROM ls),
    m AS (SELECT f.*, coalesce(avg(s) OVER (PARTITION BY f.video_id ORDER BY f.second ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING), 0) AS b, avg(s) OVER h AS a, min(CASE WHEN up THEN f.second END) OVER h AS u, coalesce(min(CASE WHEN down THEN f.second END) OVER h, f.second) AS d
      FROM fl f JOIN sm USING (video_id, second) WINDOW h AS (PARTITION BY f.video_id ORDER BY f.second ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)),
    k AS (SELECT m.*, a - b >= 0.8 AND a >= 1 AND m.second > 10 AND coalesce(g.new, false) AS arr, b - a >= 1 AND a <= greatest(0.5, b - 1) AS dep FROM m LEFT JOIN fl g ON g.video_id = m.video_id AND g.second = u),
    e AS (SELECT video_id, second AS t, CASE WHEN arr THEN 'arrival' ELSE 'departure' END AS type, CASE WHEN arr THEN u ELSE d END AS m, a, b FROM k WHERE arr OR dep), cand AS (SELECT *, m + 2 AS resume FROM e), {_CHOSEN}
    SELECT p.video_id, p.resume - 2 AS second, type, round(b, 6) AS before_mean, round(a, 6) AS after_mean FROM pick p JOIN cand c ON c.video_id = p.video_id AND c.t = p.t""")
def op_158(spark, sf_dir):
    return threshold.detect(ser(spark, sf_dir), smooth=3).withColumns({c: F.round(c, 6) for c in ("before_mean", "after_mean")})


@query("op_079_events_with_fish", f"""WITH {_STATE_EVENTS} SELECT s.video_id, s.second, s.type, count(d.event_id) AS fish_count, round(avg((d.xmax - d.xmin) * (d.ymax - d.ymin)), 6) AS fish_mean_area, max((d.xmax - d.xmin) * (d.ymax - d.ymin)) AS fish_max_area, CAST(count(d.event_id) > 0 AS INTEGER) AS arrival_with_fish
    FROM sev s LEFT JOIN det d ON d.video_id = s.video_id AND d.class = 'signup' AND abs(d.second - s.second) <= 5 AND s.type = 'arrival' GROUP BY ALL""")
def op_079(spark, sf_dir):
    s = series.counts(detections(spark, sf_dir), CLASSES, *enrich.fish_boxes("signup"))
    out = enrich.with_fish(states.marked(series.repaired(s, spike=2, dip=3), shortest=3))
    return out.withColumn("fish_mean_area", F.round("fish_mean_area", 6))


_MOVE = f"""{GRID}, pc AS (SELECT video_id, second, avg((xmin + xmax) / 2) AS x_mean, avg((ymin + ymax) / 2) AS y_mean FROM det WHERE class IN ('view', 'click') GROUP BY ALL),
    mv AS (SELECT s.video_id, s.second, n, x_mean, y_mean, coalesce(x_mean, 0) AS x0, coalesce(y_mean, 0) AS y0 FROM ser s LEFT JOIN pc USING (video_id, second)),
    ml AS (SELECT *, list(x0) OVER f AS lx, list(y0) OVER f AS ly FROM mv WINDOW f AS (PARTITION BY video_id ORDER BY second ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
    ms AS (SELECT video_id, second, x_mean, y_mean, list_sum([lx[greatest(1, least(n, second + 1 + o))] for o in range(-2, 3)]) / 5.0 AS x_smooth, list_sum([ly[greatest(1, least(n, second + 1 + o))] for o in range(-2, 3)]) / 5.0 AS y_smooth FROM ml),
    md AS (SELECT *, sqrt(pow(x_smooth - lag(x_smooth) OVER {W}, 2) + pow(y_smooth - lag(y_smooth) OVER {W}, 2)) AS movement_delta FROM ms)"""


@query("op_159_movement", f"WITH {_MOVE} SELECT video_id, second, round(x_mean, 4) AS x_mean, round(y_mean, 4) AS y_mean, round(x_smooth, 4) AS x_smooth, round(y_smooth, 4) AS y_smooth, round(movement_delta, 4) AS movement_delta FROM md WHERE x_mean IS NOT NULL")
def op_159(spark, sf_dir):
    out = enrich.movement(series.per_second(detections(spark, sf_dir), CLASSES), ("view", "click"))
    return out.select("video_id", "second", *(F.round(c, 4).alias(c) for c in ("x_mean", "y_mean", "x_smooth", "y_smooth", "movement_delta")))


_FLAP = "fb AS (SELECT video_id, second, event_id, (xmax - xmin) * (ymax - ymin) AS area, (xmin + xmax) / 2 AS center_x, (ymin + ymax) / 2 AS center_y, confidence FROM det WHERE class = 'view'), fm AS (SELECT *, quantile_cont(area, 0.5) OVER (PARTITION BY video_id ORDER BY second RANGE BETWEEN 30 PRECEDING AND 1 PRECEDING) AS q FROM fb), flap AS (SELECT *, area / q AS multiplier FROM fm WHERE q > 0 AND area >= 2 * q)"


@query("op_149_flaps", f"WITH {DET}, {_FLAP} SELECT video_id, second, event_id, area, center_x, center_y, confidence, round(q, 6) AS baseline_median, round(multiplier, 6) AS multiplier FROM flap")
def op_149(spark, sf_dir):
    return enrich.flaps(detections(spark, sf_dir), "view", 2.0).withColumns({c: F.round(c, 6) for c in ("baseline_median", "multiplier")})


@query("op_102_per_minute", f"""WITH {_STATE_EVENTS}, {_MOVE.replace(GRID + ', ', '').strip()}, {_FLAP},
    fishes AS (SELECT s.video_id, s.second, s.type, count(d.event_id) AS k FROM sev s LEFT JOIN det d ON d.video_id = s.video_id AND d.class = 'signup' AND abs(d.second - s.second) <= 5 AND s.type = 'arrival' GROUP BY ALL),
    pu AS (SELECT video_id, second, count(*) FILTER (class = 'view') AS v, avg((xmax - xmin) * (ymax - ymin)) FILTER (class = 'purchase') AS fa FROM det GROUP BY ALL),
    a AS (SELECT s.video_id, s.second // 10 AS minute, sum(coalesce(v, 0)) AS t, avg(coalesce(v, 0)) AS m, avg(fa) AS f FROM ser s LEFT JOIN pu USING (video_id, second) GROUP BY ALL),
    b AS (SELECT video_id, second // 10 AS minute, count(*) FILTER (type = 'arrival') AS ar, count(*) FILTER (type = 'departure') AS de, count(*) FILTER (type = 'arrival' AND k > 0) AS af FROM fishes GROUP BY ALL),
    c AS (SELECT video_id, second // 10 AS minute, count(*) AS fl FROM flap GROUP BY ALL), d AS (SELECT video_id, second // 10 AS minute, avg(movement_delta) AS mo FROM md WHERE x_mean IS NOT NULL GROUP BY ALL)
    SELECT video_id, minute, minute * 10 AS start_second, minute * 10 + 9 AS end_second, CAST(coalesce(t, 0) AS BIGINT) AS total_adult_count, round(coalesce(m, 0), 6) AS mean_adult_count_per_s, coalesce(ar, 0) AS arrivals, coalesce(de, 0) AS departures, coalesce(af, 0) AS arrivals_with_fish, coalesce(fl, 0) AS flapping_events, round(coalesce(mo, 0), 4) AS avg_movement_delta_px, round(f, 4) AS avg_fish_area_px
    FROM a FULL JOIN b USING (video_id, minute) FULL JOIN c USING (video_id, minute) LEFT JOIN d USING (video_id, minute) WHERE coalesce(t, 0) > 0 OR ar > 0 OR de > 0 OR fl > 0""")
def op_102(spark, sf_dir):
    d = detections(spark, sf_dir)
    seconds = enrich.minute_rows(d, CLASSES, ("view", "click"), "view", "purchase", "signup", spike=2, dip=3, shortest=3)
    out = enrich.per_minute(seconds, enrich.flaps(d, "view", 2.0), 10)
    return out.withColumns({"mean_adult_count_per_s": F.round("mean_adult_count_per_s", 6), "avg_movement_delta_px": F.round("avg_movement_delta_px", 4), "avg_fish_area_px": F.round("avg_fish_area_px", 4)})


@query("op_121_stability", f"WITH {GRID}, x AS (SELECT *, c - lag(c) OVER {W} AS d FROM ser) SELECT video_id, round(avg(c), 6) AS mean_count, round(stddev_pop(c), 6) AS std_count, min(c) AS min_count, max(c) AS max_count, max(c) - min(c) AS count_range, count(*) FILTER (d <> 0) AS n_changes, round(avg(abs(d)), 6) AS mean_abs_change FROM x GROUP BY video_id")
def op_121(spark, sf_dir):
    return series.stability(ser(spark, sf_dir)).withColumns({c: F.round(c, 6) for c in ("mean_count", "std_count", "mean_abs_change")})


@query("op_122_edge_effect", f"""WITH {GRID}, e AS (SELECT video_id, second, count(*) AS k FROM det WHERE class IN ('view', 'click', 'purchase') AND xmin >= 300 AND xmax <= 2388 AND ymin >= 300 AND ymax <= 1220 GROUP BY ALL),
    j AS (SELECT s.video_id, s.second, c, coalesce(k, 0) AS k FROM ser s LEFT JOIN e USING (video_id, second)), x AS (SELECT *, abs(c - lag(c) OVER {W}) > 1 AS fr, abs(k - lag(k) OVER {W}) > 1 AS ff FROM j)
    SELECT video_id, CAST(sum(c) AS BIGINT) AS raw, CAST(sum(k) AS BIGINT) AS filtered, count(*) FILTER (fr) AS raw_flicker, count(*) FILTER (ff) AS filtered_flicker, round(100.0 * (sum(c) - sum(k)) / nullif(sum(c), 0), 6) AS reduction FROM x GROUP BY video_id""")
def op_122(spark, sf_dir):
    d = detections(spark, sf_dir)
    own = F.col("class").isin(*CLASSES)
    j = series.counts(d, CLASSES, F.count_if(own & boxes.inside(margin=300)).alias("k")).fillna(0, ["k"])
    w = series.by_video()
    x = j.withColumns({"fr": F.abs(F.col("c") - F.lag("c").over(w)) > 1, "ff": F.abs(F.col("k") - F.lag("k").over(w)) > 1})
    return x.groupBy("video_id").agg(F.sum("c").alias("raw"), F.sum("k").alias("filtered"), F.count_if("fr").alias("raw_flicker"), F.count_if("ff").alias("filtered_flicker"), F.round(F.try_divide(F.lit(100.0) * (F.sum("c") - F.sum("k")), F.sum("c")), 6).alias("reduction"))


@query("op_161_hysteresis", f"""WITH {GRID}, a AS (SELECT video_id, second, CAST(second >= 4 AND avg(c) OVER (PARTITION BY video_id ORDER BY second ROWS 4 PRECEDING) > 0.75 AS INTEGER) AS s FROM ser), b AS (SELECT *, sum(CASE WHEN s = 1 AND p = 0 THEN 1 ELSE 0 END) OVER {W} AS session FROM (SELECT *, lag(s) OVER {W} AS p FROM a))
    SELECT video_id, CAST(session AS BIGINT) AS session, min(second) AS start_second, max(second) AS end_second, max(second) - min(second) AS duration FROM b WHERE s = 1 GROUP BY video_id, session""")
def op_161(spark, sf_dir):
    return series.hysteresis(ser(spark, sf_dir), "c", 5, 0.75)


@query("op_162_one_sample_noise", f"WITH {GRID}, x AS (SELECT video_id, c, lead(c, 1) OVER {W} AS a, lead(c, 2) OVER {W} AS b FROM ser) SELECT video_id, count(*) FILTER (a > c AND b <= c) AS n_spikes, count(*) FILTER (a < c AND b >= c) AS n_dips FROM x GROUP BY video_id")
def op_162(spark, sf_dir):
    return series.one_sample_noise(ser(spark, sf_dir))


@query("op_163_quiet_periods", f"""WITH {_STATE_EVENTS}, k AS (SELECT video_id, second FROM sev UNION ALL SELECT video_id, m + 1 + 4 FROM top), g AS (SELECT video_id, second, coalesce(lag(second) OVER {W} + 4, 0) AS s FROM k)
    SELECT video_id, s AS start_second, second - 4 AS end_second FROM g WHERE second - 4 > s""")
def op_163(spark, sf_dir):
    s = ser(spark, sf_dir)
    totals = s.groupBy("video_id").agg((F.max("second") + 1).alias("n"))
    return series.quiet_periods(states.detect(s, spike=2, dip=3, shortest=3), totals, 4)
