"""Scans, filters, projections and scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import names
from tidemark.operators import boxes
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, detections, table
from tidemark.sources import files, sinks

KEY = ("video_id", "event_id")
_IN = "xmin >= 50 AND xmax <= 2638 AND ymin >= 50 AND ymax <= 1470"


@query("op_001_scan", f"WITH {DET} SELECT video_id, event_id, second, class, confidence, xmin, ymin, xmax, ymax FROM det WHERE confidence >= 0.25 AND {_IN}")
def op_001(spark, sf_dir):
    return boxes.drop_edge(boxes.at_least(detections(spark, sf_dir), 0.25)).select(*KEY, "second", "class", "confidence", "xmin", "ymin", "xmax", "ymax")


@query("op_018_every_kth", "SELECT event_id FROM events WHERE event_id % 25 = 0")
def op_018(spark, sf_dir):
    return files.every_kth(table(spark, sf_dir, "events"), 25, "event_id").select("event_id")


@query("op_040_confidence", f"WITH {DET} SELECT class, count(*) FILTER (confidence >= 0.6) AS at_least, count(*) FILTER (confidence > 0.6) AS above FROM det GROUP BY class")
def op_040(spark, sf_dir):
    d = detections(spark, sf_dir)
    a = boxes.at_least(d, 0.6).groupBy("class").agg(F.count("*").alias("at_least"))
    return a.join(boxes.above(d, 0.6).groupBy("class").agg(F.count("*").alias("above")), "class")


@query("op_042_edge_boxes", f"WITH {DET} SELECT video_id, event_id FROM det WHERE NOT ({_IN})")
def op_042(spark, sf_dir):
    return boxes.only_edge(detections(spark, sf_dir)).select(*KEY)


@query("op_045_046_area_center", f"WITH {DET} SELECT event_id, greatest(0.0, (xmax - xmin) * (ymax - ymin)) AS area, (xmin + xmax) / 2 AS cx, (ymin + ymax) / 2 AS cy FROM det")
def op_045(spark, sf_dir):
    return detections(spark, sf_dir).select("event_id", boxes.area().alias("area"), boxes.center_x().alias("cx"), boxes.center_y().alias("cy"))


_PAIR = f"""{DET}, p AS (SELECT a.event_id, greatest(0, least(a.xmax, b.xmax) - greatest(a.xmin, b.xmin)) * greatest(0, least(a.ymax, b.ymax) - greatest(a.ymin, b.ymin)) AS i, (a.xmax - a.xmin) * (a.ymax - a.ymin) + (b.xmax - b.xmin) * (b.ymax - b.ymin) AS s FROM det a JOIN det b ON b.event_id = a.event_id + 1)"""


@query("op_047_048_iou", f"WITH {_PAIR} SELECT event_id, round(i / (s - i), 6) AS iou, round(i / (s - i + 1e-8), 6) AS iou_eps FROM p")
def op_047(spark, sf_dir):
    box = F.struct("xmin", "ymin", "xmax", "ymax")
    a = detections(spark, sf_dir).select("event_id", box.alias("a"))
    b = a.select((F.col("event_id") - 1).alias("event_id"), F.col("a").alias("b"))
    return a.join(b, "event_id").select("event_id", F.round(boxes.iou("a", "b"), 6).alias("iou"), F.round(boxes.iou("a", "b", 1e-8), 6).alias("iou_eps"))


@query("op_049_from_center", f"WITH {DET} SELECT event_id, greatest(0.0, least(xmin - 40.0, 960.0)) AS xmin, greatest(0.0, least(ymin - 20.0, 960.0)) AS ymin, greatest(0.0, least(xmin + 40.0, 960.0)) AS xmax, greatest(0.0, least(ymin + 20.0, 960.0)) AS ymax FROM det")
def op_049(spark, sf_dir):
    d = detections(spark, sf_dir).select("event_id", F.col("xmin").alias("cx"), F.col("ymin").alias("cy"), F.lit(80.0).alias("w"), F.lit(40.0).alias("h"))
    return boxes.from_center(d, 960, 960).select("event_id", "xmin", "ymin", "xmax", "ymax")


@query("op_050_normalized", f"WITH {DET}, c AS (SELECT event_id, xmin AS a, least(xmax, 2688) AS b, ymin AS c, least(ymax, 1520) AS d FROM det) SELECT event_id, round((a + b) / 2 / 2688, 6) AS nx, round((c + d) / 2 / 1520, 6) AS ny, round((b - a) / 2688, 6) AS nw, round((d - c) / 1520, 6) AS nh FROM c")
def op_050(spark, sf_dir):
    return boxes.normalized(detections(spark, sf_dir), 2688, 1520).select("event_id", *(F.round(c, 6).alias(c) for c in ("nx", "ny", "nw", "nh")))


@query("op_051_class_map", "SELECT event_id, CASE event_type WHEN 'view' THEN 0 WHEN 'click' THEN 1 ELSE 9 END AS class_id FROM events")
def op_051(spark, sf_dir):
    ids = spark.createDataFrame([("view", 0), ("click", 1)], "event_type string, id int")
    return table(spark, sf_dir, "events").join(F.broadcast(ids), "event_type", "left").select("event_id", F.coalesce("id", F.lit(9)).alias("class_id"))


@query("op_052_class_threshold", f"WITH {DET} SELECT event_id FROM det WHERE confidence >= CASE class WHEN 'view' THEN 0.5 WHEN 'click' THEN 0.7 ELSE 0.3 END")
def op_052(spark, sf_dir):
    return boxes.class_threshold(detections(spark, sf_dir), {"view": 0.5, "click": 0.7}).select("event_id")


@query("op_055_station_match", "SELECT s_suppkey, contains(upper(s_name), 'SUPPLIER#00000001') OR contains(regexp_replace(upper(s_name), '[^A-Z0-9]', '', 'g'), 'SUPPLIER00000002') AS hit FROM supplier")
def op_055(spark, sf_dir):
    return table(spark, sf_dir, "supplier").select("s_suppkey", names.station_matches(F.col("s_name"), ["supplier#00000001", "supplier-00000002"]).alias("hit"))


@query("op_056_date_range", "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'")
def op_056(spark, sf_dir):
    return table(spark, sf_dir, "orders").where("cast(o_orderdate as date) between date'1997-01-01' and date'1997-12-31'").select("o_orderkey")


@query("op_058_regex_filter", "SELECT page_id FROM pages WHERE regexp_matches(url, '/en/') AND NOT regexp_matches(url, 'blog|www')")
def op_058(spark, sf_dir):
    return table(spark, sf_dir, "pages").where(F.col("url").rlike("/en/") & ~F.col("url").rlike("blog|www")).select("page_id")


@query("op_060_061_type_and_route", "SELECT event_id, CASE WHEN event_type = 'view' THEN 'arrival' WHEN event_type = 'click' THEN 'departure' END AS type, CASE WHEN event_type = 'view' AND value > 20 THEN 'arrival_with_fish' WHEN event_type = 'view' THEN 'arrival_no_fish' ELSE 'departure' END AS route FROM events")
def op_060(spark, sf_dir):
    ident = F.concat(F.col("event_id").cast("string"), F.when(F.col("event_type") == "view", "_arr").when(F.col("event_type") == "click", "_dep").otherwise("_x"))
    kind = names.type_of_id(ident, F.lit(None).cast("string"))
    return table(spark, sf_dir, "events").select("event_id", kind.alias("type"), F.when(F.coalesce(kind == "arrival", F.lit(False)), F.when(F.col("value") > 20, "arrival_with_fish").otherwise("arrival_no_fish")).otherwise("departure").alias("route"))


@query("op_063_model_short", r"SELECT p_partkey, coalesce(nullif(regexp_extract(s, '(?:^|[^0-9])([0-9]{4})(?:[^0-9]|$)', 1), ''), nullif(regexp_extract(s, '([0-9]+)$', 1), ''), s) AS short FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN 'net_' || (6000 + p_partkey % 1000) || '_x' WHEN p_partkey % 3 = 1 THEN p_brand ELSE p_type END AS s FROM part)")
def op_063(spark, sf_dir):
    s = F.when(F.col("p_partkey") % 3 == 0, F.concat(F.lit("net_"), (6000 + F.col("p_partkey") % 1000).cast("string"), F.lit("_x"))).when(F.col("p_partkey") % 3 == 1, F.col("p_brand")).otherwise(F.col("p_type"))
    return table(spark, sf_dir, "part").select("p_partkey", names.model_short(s).alias("short"))


@query("op_064_event_id", f"WITH {DET} SELECT event_id, 'm1_ST' || video_id || '_' || (CASE WHEN event_id % 5 = 0 THEN 'v' || video_id || '_s' || lpad(CAST(second AS VARCHAR), 6, '0') ELSE strftime(ts, '%Y%m%dT%H%M%S') END) || (CASE WHEN class = 'view' THEN '_arr' ELSE '_dep' END) AS ident FROM det")
def op_064(spark, sf_dir):
    v = F.col("video_id").cast("string")
    ident = names.event_id(F.lit("m1"), F.concat(F.lit("ST"), v), F.when(F.col("event_id") % 5 != 0, F.col("ts")), F.concat(F.lit("v"), v), F.col("second"), F.when(F.col("class") == "view", "arrival").otherwise("departure"))
    return detections(spark, sf_dir).select("event_id", ident.alias("ident"))


@query("op_fn_names", """SELECT page_id, upper(substr(md5(url), 1, 6)) AS short_id, try_cast(nullif(regexp_extract(url, '/((?:19|20)[0-9]{2})(?:/|$)', 1), '') AS INTEGER) AS year,
    upper(nullif(regexp_extract(split_part(url, '//', 2), '^(?:[0-9]+_)?([A-Za-z][A-Za-z0-9]*)', 1), '')) AS station FROM pages""")
def op_names(spark, sf_dir):
    host = F.split_part("url", F.lit("//"), F.lit(2))
    return table(spark, sf_dir, "pages").select("page_id", names.short_id(F.col("url")).alias("short_id"), names.year_in(F.col("url")).alias("year"), names.station_of(host).alias("station"))


@query("op_fn_times", """SELECT event_id, date_trunc('second', ts) AS a, CASE WHEN event_id % 4 = 3 THEN NULL ELSE date_trunc('second', ts) END AS b,
    date_trunc('day', ts) + to_seconds(CAST(event_id % 24 * 3600 + event_id % 60 * 60 + event_id % 100 AS BIGINT)) AS c FROM events""")
def op_times(spark, sf_dir):
    ts = F.col("ts")
    forms = [F.concat(F.lit("FAR3_"), F.date_format(ts, "yyyyMMdd'T'HHmmss")), F.concat(F.lit("Rost3_"), F.date_format(ts, "yyyyMMdd_HHmmss")), F.concat(F.lit("12_B_"), F.date_format(ts, "yyyy-MM-dd_HH.mm.ss"), F.lit("_7"))]
    k = F.col("event_id") % 4
    stem = F.when(k == 0, forms[0]).when(k == 1, forms[1]).when(k == 2, forms[2]).otherwise("x_20249999T000000")
    digits = F.format_string("%02d%02d%02d", F.col("event_id") % 24, F.col("event_id") % 60, F.col("event_id") % 100)
    e = table(spark, sf_dir, "events")
    return e.select("event_id", names.any_time(forms[0]).alias("a"), names.start_time(stem).alias("b"), names.overflow_time(F.to_date("ts"), digits).alias("c"))


@query("op_fn_conversions", """SELECT event_id, coalesce(CAST(trunc(try_cast(CASE WHEN event_id % 3 = 0 THEN 'x' ELSE CAST(value AS VARCHAR) END AS DOUBLE)) AS BIGINT), 0) AS whole, event_type IN ('view') AS flag, CAST(event_id % 60 AS INTEGER) * 60 + 5 AS secs,
    printf('%02d:%02d:%02d.%03d', event_id // 3600, event_id // 60 % 60, event_id % 60, 250) AS clock, round(CASE WHEN value >= 40 THEN 1 / (1 + exp(-(value - 40))) ELSE exp(value - 40) / (1 + exp(value - 40)) END, 6) AS sig, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events""")
def op_conversions(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    return e.select("event_id", names.whole(F.when(F.col("event_id") % 3 == 0, "x").otherwise(F.col("value").cast("string"))).alias("whole"), names.flag(F.when(F.col("event_type") == "view", " Yes").otherwise("no")).alias("flag"), names.clock_to_seconds(F.format_string("%02d:05", F.col("event_id") % 60)).alias("secs"), names.seconds_to_clock(F.col("event_id") + 0.25).alias("clock"), F.round(names.sigmoid(F.col("value") - 40), 6).alias("sig"), F.from_json("props", "k int")["k"].alias("k"))


@query("op_030_label_lines", "SELECT 'img' || (event_id % 50) AS image, string_agg(printf('%d %.6f %.6f %.6f %.6f', 1, 0.5, 0.25, (event_id % 8) / 8.0, 0.125), chr(10) ORDER BY event_id) AS text FROM events GROUP BY 1")
def op_030(spark, sf_dir):
    d = table(spark, sf_dir, "events").select(F.concat(F.lit("img"), (F.col("event_id") % 50).cast("string")).alias("image"), F.col("event_id").alias("box_no"), F.lit(1).alias("class_id"), F.lit(0.5).alias("nx"), F.lit(0.25).alias("ny"), ((F.col("event_id") % 8) / 8.0).alias("nw"), F.lit(0.125).alias("nh"))
    return sinks.label_lines(d)


@query("op_023_upsert", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'NEW_' || n_nationkey ELSE n_name END AS n_name, CASE WHEN n_nationkey % 2 = 0 THEN 3 END AS version FROM nation")
def op_023(spark, sf_dir):
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    new = n.where("n_nationkey % 2 = 0").select("n_nationkey", F.explode(F.array(F.lit(1), F.lit(3), F.lit(2))).alias("version")).select("n_nationkey", F.when(F.col("version") == 3, F.concat(F.lit("NEW_"), F.col("n_nationkey").cast("string"))).otherwise("old").alias("n_name"), "version")
    return sinks.upsert(n, new, ["n_nationkey"], ["version"])


@query("op_029_manifest", "SELECT event_type, count(*) AS n FROM events GROUP BY ROLLUP (event_type)")
def op_029(spark, sf_dir):
    return sinks.manifest(table(spark, sf_dir, "events"), "event_type")


@query("op_022_report", "SELECT 'n_events' AS metric, CAST(count(*) AS VARCHAR) AS value FROM events UNION ALL SELECT 'n_users', CAST(count(DISTINCT user_id) AS VARCHAR) FROM events")
def op_022(spark, sf_dir):
    return sinks.report(table(spark, sf_dir, "events"), {"n_events": F.count("*"), "n_users": F.count_distinct("user_id")})
