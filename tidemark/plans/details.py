"""Operators that other queries hold as parts, each on its own."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import boxes, classify, series, states
from tidemark.plans.core import _FLAGS, _STATE_EVENTS, ser
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, GRID, detections, table
from tidemark.plans.session import scratch
from tidemark.sources import files, sinks

_NEAR = "xmin >= 200 AND xmax <= 2488 AND ymin >= 200 AND ymax <= 1320"


@query("op_002_scan_for_embedding", f"WITH {DET} SELECT event_id, second, class, confidence, xmin, ymin, xmax, ymax FROM det WHERE confidence >= 0.4")
def op_002(spark, sf_dir):
    return boxes.at_least(detections(spark, sf_dir), 0.4).select("event_id", "second", "class", "confidence", "xmin", "ymin", "xmax", "ymax")


@query("op_006_first_path_per_stem", "SELECT regexp_extract(url, '([^/]+)\\.[^./]+$', 1) AS stem, min(url) AS path FROM pages GROUP BY 1")
def op_006(spark, sf_dir):
    paths = table(spark, sf_dir, "pages").select(F.col("url").alias("path"), F.regexp_extract("url", r"([^/]+)\.[^./]+$", 1).alias("stem"))
    return files.index_by_stem(paths).select("stem", "path")


@query("op_007_event_scan", f"WITH {DET} SELECT video_id, event_id, second, class FROM det WHERE video_id = 7 ORDER BY coalesce(second, 0), event_id")
def op_007(spark, sf_dir):
    d = detections(spark, sf_dir).where("video_id = 7")
    return d.orderBy(F.coalesce("second", F.lit(0)), "event_id").select("video_id", "event_id", "second", "class")


@query("op_008_many_stores", "SELECT 'a' AS store, o_orderpriority AS station, count(*) AS n FROM orders WHERE o_orderkey % 2 = 0 GROUP BY 2 UNION ALL SELECT 'b', o_orderpriority, count(*) FROM orders WHERE o_orderkey % 2 = 1 GROUP BY 2")
def op_008(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("station"))
    both = o.where("o_orderkey % 2 = 0").withColumn("store", F.lit("a")).unionByName(o.where("o_orderkey % 2 = 1").withColumn("store", F.lit("b")))
    return both.groupBy("store", "station").agg(F.count("*").alias("n"))


@query("op_027_append_metrics", "SELECT o_orderstatus AS stage, count(*) AS n, CAST(0 AS BIGINT) AS run FROM orders GROUP BY 1 UNION ALL SELECT o_orderpriority, count(*), 1 FROM orders GROUP BY 1")
def op_027(spark, sf_dir):
    """Two runs append their metrics to one table."""
    o, path = table(spark, sf_dir, "orders"), scratch(spark, "metrics")
    for k, c in enumerate(("o_orderstatus", "o_orderpriority")):
        sinks.append(o.groupBy(F.col(c).alias("stage")).agg(F.count("*").alias("n")).withColumn("run", F.lit(k).cast("bigint")), path)
    return spark.read.parquet(path)


@query("op_028_embedding_columns", "SELECT vec_id AS frame, " + ", ".join(f"round(CAST(embedding[{16 * r + 4 * c + k + 1}] AS DOUBLE), 6) AS cell_{r}_{c}_{k}" for r in range(4) for c in range(4) for k in range(4)) + " FROM embeddings")
def op_028(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("frame"), F.col("embedding").cast("array<double>").alias("values"))
    out = sinks.embedding_columns(e, 4, 4, 4)
    return out.select("frame", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


@query("op_031_rejected_times", r"SELECT page_id, url FROM pages WHERE try_cast(nullif(regexp_extract(url, '([0-9]{4}-[0-9]{2}-[0-9]{2})', 1), '') AS DATE) IS NULL")
def op_031(spark, sf_dir):
    day = F.nullif(F.regexp_extract("url", "([0-9]{4}-[0-9]{2}-[0-9]{2})", 1), F.lit(""))
    return table(spark, sf_dir, "pages").where(day.try_cast("date").isNull()).select("page_id", "url")


@query("op_031_rejected_lines", "SELECT CASE WHEN event_id % 7 = 0 THEN 'n/a' ELSE CAST(event_id AS VARCHAR) END AS frame, CASE WHEN event_id % 5 = 0 THEN 'x' ELSE '0.5' END AS confidence, count(*) AS n FROM events WHERE event_id % 7 = 0 OR event_id % 5 = 0 GROUP BY ALL")
def op_031_lines(spark, sf_dir):
    """Lines of detection files that don't convert, appended to the audit table."""
    path, audit = scratch(spark, "raw"), scratch(spark, "audit")
    e = table(spark, sf_dir, "events").selectExpr("if(event_id % 7 = 0, 'n/a', cast(event_id as string)) frame", "event_type class", "if(event_id % 5 = 0, 'x', '0.5') confidence", "1 xmin", "2 ymin", "3 xmax", "4 ymax")
    e.write.option("header", True).csv(path)
    sinks.append(files.rejected(spark, path), audit)
    return spark.read.parquet(audit).groupBy("frame", "confidence").agg(F.count("*").alias("n"))


@query("op_033_not_done", f"WITH {DET} SELECT DISTINCT video_id FROM det WHERE video_id NOT IN (SELECT video_id FROM det WHERE class = 'error')")
def op_033(spark, sf_dir):
    d = detections(spark, sf_dir)
    return sinks.pending(d.select("video_id").distinct(), d.where("class = 'error'").select("video_id"), ["video_id"])


@query("op_041_edge_filter", f"WITH {DET} SELECT video_id, event_id FROM det WHERE {_NEAR}")
def op_041(spark, sf_dir):
    return boxes.drop_edge(detections(spark, sf_dir), margin=200).select("video_id", "event_id")


@query("op_043_spatial_temporal", f"WITH {GRID}, k AS (SELECT video_id, second, count(*) AS n FROM det WHERE class = 'view' AND confidence >= 0.3 AND {_NEAR} GROUP BY ALL) SELECT g.video_id, g.second, coalesce(n, 0) AS c FROM grid g LEFT JOIN k USING (video_id, second)")
def op_043(spark, sf_dir):
    d = detections(spark, sf_dir)
    keep = (F.col("class") == "view") & (F.col("confidence") >= 0.3) & boxes.inside(margin=200)
    return series.filled(series.by_second(d, F.count_if(keep).alias("c")), "c")


@query("op_044_class_filter", "SELECT p_partkey, lower(p_brand) AS class FROM part WHERE lower(p_brand) IN ('brand#12', 'brand#23', 'brand#34')")
def op_044(spark, sf_dir):
    p = table(spark, sf_dir, "part").select("p_partkey", F.lower("p_brand").alias("class"))
    return p.where(F.col("class").isin("brand#12", "brand#23", "brand#34"))


@query("op_054_source_match", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN regexp_replace(upper('obs ' || s_name), '[^A-Z0-9]', '', 'g') = 'OBSSUPPLIER000000003' ELSE upper(s_name) LIKE '%1' END AS hit FROM supplier")
def op_054(spark, sf_dir):
    """By the file's name in upper case; only where that is empty by the cleaned period."""
    file = F.when(F.col("s_suppkey") % 3 != 0, F.col("s_name")).otherwise("")
    period = names.plain(F.concat(F.lit("obs "), F.col("s_name")))
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.when(file == "", period == "OBSSUPPLIER000000003").otherwise(F.upper(file).endswith("1")).alias("hit"))


@query("op_059_reorder", f"WITH {DET} SELECT 'run1' AS run, video_id, second, class AS det_class, confidence AS det_confidence FROM det")
def op_059(spark, sf_dir):
    d = detections(spark, sf_dir)
    return d.select(F.lit("run1").alias("run"), "video_id", "second", *(F.col(c).alias(f"det_{c}") for c in ("class", "confidence")))


@query("op_077_lookup", "SELECT l_orderkey, l_linenumber, s_name FROM lineitem JOIN supplier ON s_suppkey = l_suppkey")
def op_077(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey")).select("l_orderkey", "l_linenumber", "s_name")


@query("op_117_centroids", f"WITH {DET} SELECT video_id AS event_id, second AS frame, round(avg((xmin + xmax) / 2), 6) AS x, round(avg((ymin + ymax) / 2), 6) AS y FROM det WHERE class = 'view' GROUP BY ALL")
def op_117(spark, sf_dir):
    d = detections(spark, sf_dir).withColumns({"event_id": F.col("video_id"), "frame": F.col("second")})
    return classify.centroids(d, "view").withColumns({"x": F.round("x", 6), "y": F.round("y", 6)})


@query("op_147_novel", f"WITH {_FLAGS} SELECT video_id, second FROM fl WHERE new")
def op_147(spark, sf_dir):
    return ser(spark, sf_dir).select("video_id", "second", series.novel().alias("new")).where("new").drop("new")


@query("op_155_156_events_of_states", f"WITH {_STATE_EVENTS} SELECT video_id, second, count_change, confidence FROM sev WHERE confidence >= 0.4")
def op_155(spark, sf_dir):
    found = states.stable_periods(series.repaired(ser(spark, sf_dir), spike=2, dip=3), shortest=3)
    out = states.state_events(found, least_change=1, longest_gap=15)
    return out.select("video_id", "second", "count_change", F.round("confidence", 6).alias("confidence")).where("confidence >= 0.4")


@query("op_165_timestamps", f"WITH {DET} SELECT event_id, TIMESTAMP '2024-01-01' + to_minutes(CAST(second AS BIGINT)) AS minute_at, TIMESTAMP '2024-01-01' + to_seconds(CAST(second AS BIGINT)) AS second_at FROM det")
def op_165(spark, sf_dir):
    start = F.expr("timestamp_ntz'2024-01-01 00:00:00'")
    return detections(spark, sf_dir).select("event_id", F.timestamp_add("MINUTE", F.col("second"), start).alias("minute_at"), F.timestamp_add("SECOND", F.col("second"), start).alias("second_at"))


@query("op_166_running_index", f"WITH {DET} SELECT video_id, event_id, CAST(row_number() OVER (PARTITION BY video_id ORDER BY confidence DESC, event_id) - 1 AS INTEGER) AS idx FROM det QUALIFY idx < 3")
def op_166(spark, sf_dir):
    w = W.partitionBy("video_id").orderBy(F.desc("confidence"), "event_id")
    return detections(spark, sf_dir).select("video_id", "event_id", (F.row_number().over(w) - 1).alias("idx")).where("idx < 3")


@query("op_203_intersection", f"WITH {DET} SELECT video_id, second FROM det WHERE class = 'view' INTERSECT SELECT video_id, second FROM det WHERE class = 'click'")
def op_203(spark, sf_dir):
    d = detections(spark, sf_dir)
    frames = lambda c: d.where(F.col("class") == c).select("video_id", "second")
    return frames("view").intersect(frames("click"))


@query("op_204_difference", f"WITH {DET} SELECT video_id, second FROM det WHERE class = 'view' EXCEPT SELECT video_id, second FROM det WHERE class = 'click'")
def op_204(spark, sf_dir):
    d = detections(spark, sf_dir)
    frames = lambda c: d.where(F.col("class") == c).select("video_id", "second")
    return frames("view").subtract(frames("click"))
