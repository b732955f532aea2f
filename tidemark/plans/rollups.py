"""Aggregations over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import rollup
from tidemark.plans.lookups import JOBS, jobs
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, detections, table

TYPES = ["view", "click", "purchase", "signup", "error"]


@query("op_103_tumbling_bins", f"WITH {DET} SELECT time_bucket(INTERVAL 5 MINUTE, ts) AS bin, class, round(avg(confidence), 6) AS conf, count(*) AS n FROM det GROUP BY ALL")
def op_103(spark, sf_dir):
    return rollup.tumbling(detections(spark, sf_dir), "ts", "5 minutes", ["class"], conf=F.round(F.avg("confidence"), 6), n=F.count("*"))


@query("op_104_pivot_sum", f"WITH {DET} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {', '.join(f'''round(coalesce(sum(value) FILTER (class = '{c}'), 0), 4) AS {c}''' for c in TYPES)} FROM det GROUP BY 1")
def op_104(spark, sf_dir):
    out = rollup.wide(detections(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string")), ["day"], "class", TYPES, "sum", "value", 0.0)
    return out.select("day", *(F.round(c, 4).alias(c) for c in TYPES))


@query("op_105_pivot_mean", f"WITH {DET} SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, {', '.join(f'''round(avg(value) FILTER (class = '{c}') + 1e-7, 4) AS {c}''' for c in TYPES)} FROM det GROUP BY 1")
def op_105(spark, sf_dir):
    out = rollup.wide(detections(spark, sf_dir).withColumn("day", F.to_date("ts").cast("string")), ["day"], "class", TYPES, "avg", "value")
    return out.select("day", *(F.round(F.col(c) + 1e-7, 4).alias(c) for c in TYPES))


@query("op_106_hours", "WITH g AS (SELECT event_type, unnest(range(0, 24)) AS hour FROM (SELECT DISTINCT event_type FROM events)), n AS (SELECT event_type, hour(ts) AS hour, count(*) AS n FROM events GROUP BY ALL) SELECT event_type, CAST(hour AS INTEGER) AS hour, coalesce(n, 0) AS n FROM g LEFT JOIN n USING (event_type, hour)")
def op_106(spark, sf_dir):
    return rollup.dense_hours(table(spark, sf_dir, "events"), "ts", ["event_type"])


@query("op_107_minutes_of_day", "WITH g AS (SELECT unnest(range(0, 1440)) AS minute), n AS (SELECT hour(ts) * 60 + minute(ts) AS minute, count(*) AS n FROM events WHERE event_type = 'error' GROUP BY 1) SELECT minute, coalesce(n, 0) AS n FROM g LEFT JOIN n USING (minute)")
def op_107(spark, sf_dir):
    n = table(spark, sf_dir, "events").where("event_type = 'error'").groupBy((F.hour("ts") * 60 + F.minute("ts")).cast("bigint").alias("minute")).agg(F.count("*").alias("n"))
    return spark.range(1440).withColumnRenamed("id", "minute").join(n, "minute", "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


@query("op_108_edge_per_second", f"WITH {DET} SELECT video_id, second, count(*) AS n FROM det WHERE xmin < 300 OR xmax > 2388 OR ymin < 300 OR ymax > 1220 GROUP BY ALL")
def op_108(spark, sf_dir):
    from tidemark.operators import boxes

    return boxes.only_edge(detections(spark, sf_dir), margin=300).groupBy("video_id", "second").agg(F.count("*").alias("n"))


@query("op_109_progress", f"WITH {JOBS}, g AS (SELECT * FROM (SELECT CAST(unnest(range(1, 5)) AS BIGINT) AS stage), (SELECT unnest(['pending', 'in_progress', 'completed', 'failed', 'skipped']) AS status)) SELECT stage, status, coalesce(n, 0) AS n FROM g LEFT JOIN (SELECT stage, status, count(*) AS n FROM jobs GROUP BY ALL) USING (stage, status)")
def op_109(spark, sf_dir):
    from tidemark.operators import ledger

    return ledger.progress(jobs(spark, sf_dir))


@query("op_110_daily", "SELECT o_orderpriority AS station, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, min(o_orderdate) AS first_observation, max(o_orderdate + to_seconds(o_custkey)) AS last_observation, round(sum(o_custkey) / 60.0, 6) AS minutes, count(*) AS files FROM orders GROUP BY 1, 2")
def op_110(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("station"), F.to_date("o_orderdate").cast("string").alias("date"), F.col("o_orderdate").alias("start_time"), F.col("o_custkey").alias("n_seconds"))
    return rollup.daily(o).withColumn("minutes", F.round("minutes", 6))


@query("op_111_daily_metrics", "SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day, count(*) AS n, round(count(*) / 1440.0, 6) AS per_minute, round(avg(value), 6) AS mean, max(value) AS peak FROM events GROUP BY 1")
def op_111(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("n"), F.round(F.try_divide(F.count("*"), F.lit(1440.0)), 6).alias("per_minute"), F.round(F.avg("value"), 6).alias("mean"), F.max("value").alias("peak"))


@query("op_112_run_metrics", f"WITH {DET}, g AS (SELECT video_id, second - lag(second) OVER (PARTITION BY video_id ORDER BY second) AS d, second FROM det), c AS (SELECT video_id, second, count(*) AS k FROM det GROUP BY ALL), t AS (SELECT video_id, min(second) AS busiest FROM (SELECT *, max(k) OVER (PARTITION BY video_id) AS mk FROM c) WHERE k = mk GROUP BY 1) SELECT video_id, round(avg(d), 6) AS mean_gap, count(*) AS n, any_value(busiest) AS busiest FROM g JOIN t USING (video_id) GROUP BY video_id")
def op_112(spark, sf_dir):
    d = detections(spark, sf_dir)
    busiest = d.groupBy("video_id", "second").agg(F.count("*").alias("k")).groupBy("video_id").agg(F.max_by("second", F.struct("k", -F.col("second"))).alias("busiest"))
    return rollup.mean_gap(d, "second", "video_id").withColumn("mean_gap", F.round("mean_gap", 6)).join(busiest, "video_id")


@query("op_119_confusion", "SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality <> 1 AND toxic <> 1) AS tn, count(*) FILTER (quality <> 1 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic <> 1) AS fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1, round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy FROM labels")
def op_119(spark, sf_dir):
    out = rollup.confusion(table(spark, sf_dir, "labels"), F.col("quality"), F.col("toxic"))
    return out.withColumns({c: F.round(c, 6) for c in ("precision", "recall", "f1", "accuracy")})


@query("op_120_benchmark", "WITH d AS (SELECT lang, quality, toxic FROM labels JOIN documents USING (doc_id)), c AS (SELECT lang, count(*) FILTER (quality = 1 AND toxic = 1) AS tp, count(*) FILTER (quality <> 1 AND toxic = 1) AS fp, count(*) FILTER (quality = 1 AND toxic <> 1) AS fn FROM d GROUP BY GROUPING SETS ((lang), ())), r AS (SELECT *, coalesce(tp / nullif(tp + fp, 0), 0) AS p, coalesce(tp / nullif(tp + fn, 0), 0) AS q FROM c) SELECT lang, tp, fp, fn, round(p, 6) AS precision, round(q, 6) AS recall, round(coalesce(2 * p * q / nullif(p + q, 0), 0), 6) AS f1 FROM r")
def op_120(spark, sf_dir):
    d = table(spark, sf_dir, "labels").join(table(spark, sf_dir, "documents").select("doc_id", "lang"), "doc_id")
    c = d.groupingSets([["lang"], []], "lang").agg(F.count_if((F.col("quality") == 1) & (F.col("toxic") == 1)).alias("tp"), F.count_if((F.col("quality") != 1) & (F.col("toxic") == 1)).alias("fp"), F.count_if((F.col("quality") == 1) & (F.col("toxic") != 1)).alias("fn"))
    return rollup.rates(c).withColumns({x: F.round(x, 6) for x in ("precision", "recall", "f1")})


@query("op_123_histogram", "WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events) SELECT CAST(least(floor((value - lo) / (hi - lo) * 20), 19) AS INTEGER) AS bin, count(*) AS n FROM events, e GROUP BY 1")
def op_123(spark, sf_dir):
    return rollup.histogram(table(spark, sf_dir, "events"), "value", 20)


@query("op_124_throughput", "SELECT event_type, round(avg(value), 6) AS mean_ms, round(count(*) / (sum(value) / 1000), 4) AS per_second, round(100 * sum(value) / (SELECT sum(value) FROM events), 6) AS share FROM events GROUP BY 1")
def op_124(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    total = e.agg(F.sum("value").alias("total"))
    g = e.groupBy("event_type").agg(F.avg("value").alias("m"), F.count("*").alias("n"), F.sum("value").alias("s")).crossJoin(F.broadcast(total))
    return g.select("event_type", F.round("m", 6).alias("mean_ms"), F.round(F.try_divide("n", F.col("s") / 1000), 4).alias("per_second"), F.round(F.try_divide(100 * F.col("s"), "total"), 6).alias("share"))


@query("op_125_dates", "SELECT DISTINCT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders WHERE o_orderpriority = '1-URGENT' ORDER BY 1 DESC LIMIT 10")
def op_125(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.to_date("o_orderdate").cast("string").alias("day")).distinct().orderBy(F.desc("day")).limit(10)


@query("op_126_legacy_sum", "SELECT date_trunc('hour', ts) AS at, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY 1")
def op_126(spark, sf_dir):
    return table(spark, sf_dir, "events").where("event_type <> 'view'").groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("at")).agg(F.count("*").alias("n"))


@query("op_127_tallies", "SELECT lang, source, count(*) AS n FROM documents GROUP BY ALL")
def op_127(spark, sf_dir):
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.count("*").alias("n"))


@query("op_128_intensity", f"WITH {DET}, m AS (SELECT video_id, second // 10 AS minute, count(*) FILTER (class = 'click') + count(*) FILTER (class = 'signup') + count(*) FILTER (class = 'view') / 10 + count(*) FILTER (class = 'error') AS score FROM det GROUP BY ALL) SELECT video_id, minute, round(score, 6) AS score, round(coalesce(score / nullif(max(score) OVER (PARTITION BY video_id), 0), 0), 6) AS intensity FROM m")
def op_128(spark, sf_dir):
    k = lambda c: F.count_if(F.col("class") == c)
    m = detections(spark, sf_dir).groupBy("video_id", F.floor(F.col("second") / 10).alias("minute")).agg(k("click").alias("arrivals"), k("signup").alias("departures"), k("view").alias("adults"), k("error").alias("flaps"))
    return rollup.intensity(m, "video_id").select("video_id", "minute", F.round("score", 6).alias("score"), F.round("intensity", 6).alias("intensity"))


@query("op_129_baseline_ratio", "WITH t AS (SELECT event_type, sum(value) AS s FROM events GROUP BY 1) SELECT event_type, round(s, 4) AS s, round(s / (SELECT s FROM t WHERE event_type = 'purchase'), 6) AS ratio FROM t")
def op_129(spark, sf_dir):
    t = table(spark, sf_dir, "events").groupBy("event_type").agg(F.sum("value").alias("s"))
    return rollup.against_baseline(t, "event_type", "s", "purchase").select("event_type", F.round("s", 4).alias("s"), F.round("ratio", 6).alias("ratio"))


@query("op_113_grid_embedding", f"WITH {DET} SELECT video_id, second AS frame, CAST(floor((ymin + ymax) / 2 / 400) * 7 + floor((xmin + xmax) / 2 / 400) AS BIGINT) AS cell, count(*) FILTER (class = 'view') AS f0, count(*) FILTER (class = 'click') AS f1, count(*) FILTER (class = 'purchase') AS f2, sum((xmax - xmin) * (ymax - ymin)) AS f3, round(avg(confidence), 6) AS f4 FROM det GROUP BY ALL")
def op_113(spark, sf_dir):
    from tidemark.operators import grid

    return grid.embed(detections(spark, sf_dir).withColumnRenamed("second", "frame"), ("view", "click", "purchase"), 400, 7).withColumn("f4", F.round("f4", 6))


@query("op_115_frame_size", f"WITH {DET} SELECT CAST(ceil(max(xmax) * 1.05) AS BIGINT) AS width, CAST(ceil(max(ymax) * 1.05) AS BIGINT) AS height FROM det")
def op_115(spark, sf_dir):
    from tidemark.operators import grid

    return grid.frame_size(detections(spark, sf_dir))


@query("op_116_heat_map", f"WITH {DET}, t AS (SELECT video_id, count(DISTINCT second) AS k FROM det GROUP BY 1) SELECT video_id, CAST(floor((ymin + ymax) / 2 / 400) * 7 + floor((xmin + xmax) / 2 / 400) AS BIGINT) AS cell, round(count(*) FILTER (class = 'view') / any_value(k), 6) AS heat FROM det JOIN t USING (video_id) GROUP BY 1, 2")
def op_116(spark, sf_dir):
    from tidemark.operators import grid

    e = grid.embed(detections(spark, sf_dir).withColumnRenamed("second", "frame"), ("view", "click", "purchase"), 400, 7)
    return grid.heat_map(e).withColumn("heat", F.round("heat", 6))
