"""Sources and sinks: tables written in a format and read back by its reader.

Files go to the folder that the cluster names in spark.checkpoint.dir.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.registry import query
from tidemark.plans.roles import detections, table
from tidemark.plans.session import scratch
from tidemark.sources import files, sinks


def _csv(df, tag: str, sep: str = ",") -> str:
    path = scratch(df.sparkSession, tag)
    df.write.option("header", True).option("sep", sep).csv(path)
    return path


@query("op_003_legacy_scan", "SELECT CAST(event_id % 5 AS INTEGER) AS class, count(*) AS n, min(date_trunc('second', ts)) AS first, max(event_id) AS last_frame FROM events GROUP BY 1")
def op_003(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id % 5 class", "value / 100 conf", "0 time", "event_id frame", "'S1' station", "concat('f', user_id) filename", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') datetime")
    return files.read_legacy(spark, _csv(e, "legacy")).groupBy("class").agg(F.count("*").alias("n"), F.min(F.col("datetime").cast("timestamp_ntz")).alias("first"), F.max("frame").alias("last_frame"))


@query("op_005_file_discovery", "SELECT CAST('in' AS VARCHAR) AS folder, CAST(4 AS BIGINT) AS n")
def op_005(spark, sf_dir):
    """Files of one folder; @eaDir and other extensions are left out."""
    base = scratch(spark, "videos")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"))
    for part, n in (("in", 4), ("@eaDir", 3)):
        rows.repartition(n).write.text(f"{base}/{part}")
    found = files.list_files(spark, base, "*.txt")
    return found.groupBy(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("folder")).agg(F.count("*").alias("n"))


@query("op_009_010_event_files", "SELECT CAST(event_id AS VARCHAR) AS event_id, date_trunc('second', ts) AS at FROM events WHERE event_type IN ('view', 'click') AND event_id % 3 = 0")
def op_009(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", "event_type type", "date_format(ts, 'yyyy-MM-dd HH:mm:ss') timestamp", "if(event_id % 3 = 0, 'Yes', 'no') arrival_with_fish")
    found = files.read_events(spark, _csv(e, "events"), ["view", "click"], fish_only=True)
    return found.select("event_id", F.col("at").cast("timestamp_ntz").alias("at"))


@query("op_011_missing_is_empty", "SELECT n_name, CAST(n_nationkey AS BIGINT) AS n FROM nation")
def op_011(spark, sf_dir):
    n = table(spark, sf_dir, "nation").selectExpr("n_name", "cast(n_nationkey as bigint) n")
    there = files.read_or_empty(spark, _csv(n, "there"), "n_name string, n bigint")
    return there.unionByName(files.read_or_empty(spark, scratch(spark, "missing"), "n_name string, n bigint"))


@query("op_012_annotations", "SELECT 'ST_20240101T080000' AS file, event_type AS event_type, CAST(event_id % 600 AS BIGINT) AS second, event_id % 2 = 0 AS with_fish FROM events")
def op_012(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("'ST_20240101T080000.mp4' File_name", "initcap(event_type) Event", "date_format(timestamp_ntz'2024-01-01 08:00:00' + make_dt_interval(0, 0, 0, event_id % 600), 'HH:mm:ss') Time", "if(event_id % 2 = 0, 'Yes', 'No') With_fish")
    return files.read_annotations(spark, _csv(e, "annotations", ";")).select("file", "event_type", "second", "with_fish")


@query("op_013_validation_rows", "SELECT CAST(event_id AS VARCHAR) AS event_id FROM events WHERE event_type = 'view' AND event_id % 4 <> 0 AND user_id % 2 = 0")
def op_013(spark, sf_dir):
    e = table(spark, sf_dir, "events").selectExpr("event_id", "concat('S', user_id % 2) ` station`", "event_type `event_type `", "date_format(ts, 'yyyy-MM-dd') date", "user_id video_id", "event_id % 60 second", "if(event_id % 4 = 0, null, '1') valid_fish_arrival")
    return files.read_validation(spark, _csv(e, "validation", ";"), ["S0"], ["view"], "2000-01-01", "2100-01-01").select("event_id")


@query("op_014_xml_boxes", "SELECT 'img' || user_id AS image, event_type AS class, CAST(event_id % 2500 AS DOUBLE) AS xmin, CAST(event_id % 2500 + 10 AS DOUBLE) AS xmax FROM events")
def op_014(spark, sf_dir):
    box = "named_struct('name', event_type, 'bndbox', named_struct('xmin', event_id % 2500, 'ymin', 1, 'xmax', event_id % 2500 + 10, 'ymax', 5))"
    e = table(spark, sf_dir, "events").groupBy("user_id").agg(F.expr(f"collect_list({box})").alias("object"))
    path = scratch(spark, "xml")
    e.selectExpr("concat('img', user_id) filename", "named_struct('width', 100, 'height', 50) size", "object").write.format("xml").option("rowTag", "annotation").save(path)
    return files.read_boxes_xml(spark, path).select("image", "class", "xmin", "xmax")


@query("op_020_result_tables", "SELECT user_id, count(*) AS n FROM events GROUP BY 1 UNION ALL SELECT event_id % 7, event_id FROM events")
def op_020(spark, sf_dir):
    e, path = table(spark, sf_dir, "events"), scratch(spark, "results")
    sinks.write_results({"events": e.selectExpr("event_id % 7 user_id", "event_id n"), "per_minute": e.groupBy("user_id").agg(F.count("*").alias("n"))}, path)
    return spark.read.parquet(f"{path}/events").unionByName(spark.read.parquet(f"{path}/per_minute"))


@query("op_021_daily_tables", "SELECT event_type AS station, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, CASE WHEN event_type = 'view' THEN 2 ELSE 1 END AS version, count(*) AS n FROM events GROUP BY ALL")
def op_021(spark, sf_dir):
    """A second write replaces only the partitions that it holds."""
    d, path = detections(spark, sf_dir), scratch(spark, "daily")
    day = d.select(F.col("class").alias("station"), F.date_format("ts", "yyyy-MM-dd").alias("date"), "event_id")
    sinks.write_daily(day.withColumn("version", F.lit(1)), path)
    sinks.write_daily(day.where("station = 'view'").withColumn("version", F.lit(2)), path)
    back = spark.read.schema("event_id bigint, version int, station string, date string").parquet(path)
    return back.groupBy("station", "date", "version").agg(F.count("*").alias("n"))


@query("op_032_tuning_results", "SELECT CAST(t AS DOUBLE) / 10 AS threshold, count(*) FILTER (value >= t * 10) AS n FROM events, (SELECT unnest(range(1, 6)) AS t) GROUP BY t")
def op_032(spark, sf_dir):
    counts = table(spark, sf_dir, "events").agg(*(F.count_if(F.col("value") >= 10 * t).alias(str(t)) for t in range(1, 6)))
    out, path = counts.unpivot([], [str(t) for t in range(1, 6)], "t", "n").selectExpr("cast(t as double) / 10 threshold", "n"), scratch(spark, "tuning")
    sinks.write_results({"tuning": out}, path, as_csv=True)
    return files.read_or_empty(spark, f"{path}/tuning", "threshold double, n bigint")
