"""Videos and their metadata by name, files by listing, and what streams of them do."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import clips, ledger, sampling
from tidemark.plans.lookups import JOBS, jobs
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, detections, table
from tidemark.plans.session import scratch
from tidemark.sources import files
from tidemark.streaming import twins

_H = "h AS (SELECT o_orderkey AS k, o_orderkey // 16 AS h, o_orderkey % 8 AS i FROM orders)"
#: Paths of all forms of name; some are no videos, several name one video.
_PATHS = f"""{_H}, n AS (SELECT k, h, i, 'ROST' || h % 5 AS st, DATE '2019-01-01' + CAST(h % 1500 AS INTEGER) AS day, TIMESTAMP '2024-07-01' + to_seconds(CAST(h AS BIGINT)) AS modified, lpad(CAST(h % 24 AS VARCHAR), 2, '0') AS hh, lpad(CAST(h % 60 AS VARCHAR), 2, '0') AS mm FROM h),
    p AS (SELECT *, strftime(day, '%Y%m%d') AS ymd, '/data/' || k || '/' AS dir FROM n),
    f AS (SELECT *, CASE i WHEN 0 THEN dir || lower(st) || '_' || ymd || 'T' || hh || mm || '07.mkv' WHEN 1 THEN dir || st || '_' || ymd || '_' || hh || mm || '07.AVI' WHEN 2 THEN dir || st || '_' || ymd || hh || mm || '07.mp4'
        WHEN 3 THEN dir || '55_' || st || '_(10.0.0.1)_' || strftime(day, '%Y-%m-%d') || '_' || hh || '.' || mm || '.07_' || k || '.mp4' WHEN 4 THEN dir || st || '_' || strftime(day, '%Y-%m-%d') || '_' || hh || '-' || mm || '-07.mkv'
        WHEN 5 THEN dir || st || '_' || ymd || '.mkv' WHEN 6 THEN '/data/' || st || '/2024/' || strftime(day, '%Y-%m-%d') || '/clip' || k || '.mkv' ELSE CASE WHEN h % 2 = 0 THEN '/data/@eaDir/' || st || '_' || ymd || 'T000000.mkv' ELSE dir || st || '_' || ymd || 'T000000.txt' END END AS path FROM p)"""


def _paths(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k"), F.expr("o_orderkey div 16").alias("h"), (F.col("o_orderkey") % 8).alias("i"))
    o = o.selectExpr("*", "concat('ROST', h % 5) st", "date_add(date'2019-01-01', cast(h % 1500 as int)) day", "timestampadd(SECOND, h, timestamp_ntz'2024-07-01 00:00:00') modified", "lpad(cast(h % 24 as string), 2, '0') hh", "lpad(cast(h % 60 as string), 2, '0') mm", "concat('/data/', k, '/') dir")
    o = o.selectExpr("*", "date_format(day, 'yyyyMMdd') ymd", "date_format(day, 'yyyy-MM-dd') dashed")
    path = """case i when 0 then concat(dir, lower(st), '_', ymd, 'T', hh, mm, '07.mkv') when 1 then concat(dir, st, '_', ymd, '_', hh, mm, '07.AVI') when 2 then concat(dir, st, '_', ymd, hh, mm, '07.mp4')
        when 3 then concat(dir, '55_', st, '_(10.0.0.1)_', dashed, '_', hh, '.', mm, '.07_', k, '.mp4') when 4 then concat(dir, st, '_', dashed, '_', hh, '-', mm, '-07.mkv') when 5 then concat(dir, st, '_', ymd, '.mkv')
        when 6 then concat('/data/', st, '/2024/', dashed, '/clip', k, '.mkv') else if(h % 2 = 0, concat('/data/@eaDir/', st, '_', ymd, 'T000000.mkv'), concat(dir, st, '_', ymd, 'T000000.txt')) end"""
    return o.selectExpr(f"{path} path", "modified")


_VIDEOS = f"""{_PATHS}, v AS (SELECT path, st AS station, CASE WHEN i < 5 THEN CAST(day AS TIMESTAMP) + to_hours(CAST(hh AS INTEGER)) + to_minutes(CAST(mm AS INTEGER)) + to_seconds(7) WHEN i = 5 THEN CAST(day AS TIMESTAMP) ELSE modified END AS t0,
    CASE WHEN i < 5 THEN st || '_' || ymd || 'T' || hh || mm || '07' WHEN i = 5 THEN st || '_' || ymd || '_' || upper(md5(path)[1:6]) ELSE st || '_' || strftime(modified, '%Y%m%dT%H%M%S') || '_' || upper(md5(path)[1:6]) END AS video_id FROM f WHERE i < 7)"""


@query("op_005_videos", f"WITH {_VIDEOS}, d AS (SELECT video_id, min(path) AS path, any_value(station) AS station, any_value(t0) AS t0 FROM v GROUP BY 1) SELECT video_id, station, t0 AS \"at\", CAST(year(t0) AS INTEGER) AS year, strftime(t0, '%Y-%m-%d') AS date, regexp_extract(path, '([^/]+)$', 1) AS filename, path FROM d WHERE station <> 'ROST3' AND station IN ('ROST1', 'ROST2', 'ROST3') AND year(t0) IN (2019, 2020, 2024) AND t0 >= '2019-03-01' AND t0 < '2024-08-01'")
def op_005_videos(spark, sf_dir):
    """Operators 058, 182 and the name parser: one row per video, first path first."""
    return files.videos(_paths(spark, sf_dir), ["rost1", "ROST-2", "rost3"], ["Rost3"], [2019, 2020, 2024], "2019-03-01", "2024-07-31")


@query("op_name_forms", f"WITH {_VIDEOS} SELECT path, station, t0 AS \"at\", video_id FROM v")
def op_name_forms(spark, sf_dir):
    from tidemark.functions import names

    p = _paths(spark, sf_dir).where(~F.col("path").contains("@eaDir") & ~F.col("path").endswith(".txt"))
    return p.select("path", names.video(F.col("path"), F.col("modified")).alias("v")).select("path", "v.*")


@query("op_004_sampled_files", "WITH n AS (SELECT n_regionkey AS folder FROM nation WHERE n_regionkey <> 3 GROUP BY 1) SELECT folder FROM n ORDER BY md5('7|' || folder), folder LIMIT 3")
def op_004(spark, sf_dir):
    """Files of a tree by include and exclude patterns, a seeded sample, then the rows that they hold."""
    path = scratch(spark, "tree")
    table(spark, sf_dir, "nation").select("n_regionkey", "n_name").repartition(1).write.partitionBy("n_regionkey").option("header", True).csv(path)
    found = files.list_files(spark, path, "*.csv", include=("n_regionkey=[0-9]+/", "n_regionkey=x/"), exclude=("n_regionkey=3/",))
    folder = F.regexp_extract("path", "n_regionkey=([0-9]+)", 1).cast("bigint")
    return sampling.sample(found.select(folder.alias("folder")), 3, 7, "folder")


@query("op_015_label_text", "SELECT CAST(c_custkey % 100 AS INTEGER) AS class, round(c_nationkey / 25.0, 6) AS cx, count(*) AS n FROM customer GROUP BY ALL")
def op_015(spark, sf_dir):
    """Label lines written as text and read back."""
    path = scratch(spark, "labels")
    line = F.format_string("%d %.6f %.6f %.6f %.6f", F.col("c_custkey") % 100, F.col("c_nationkey") / 25.0, F.lit(0.5), F.lit(0.25), F.lit(0.125))
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    return files.read_label_text(spark, path).groupBy("class", F.round("cx", 6).alias("cx")).agg(F.count("*").alias("n"))


@query("op_016_json", "SELECT n_nationkey AS id, n_name AS name, n_regionkey AS a, n_nationkey AS b FROM nation")
def op_016(spark, sf_dir):
    path = scratch(spark, "json")
    table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), F.array("n_regionkey", "n_nationkey").alias("ids")).write.json(path)
    return files.read_json(spark, path, "id bigint, name string, ids array<bigint>", lines=True).select("id", "name", F.col("ids")[0].alias("a"), F.col("ids")[1].alias("b"))


@query("op_053_event_filter", f"WITH {DET} SELECT event_id FROM det WHERE class = 'view' AND value > 20 AND (event_id % 3 <> 0 OR event_id % 5 <> 0)")
def op_053(spark, sf_dir):
    e = detections(spark, sf_dir).select("event_id", F.when(F.col("class") == "view", "arrival").otherwise(F.col("class")).alias("type"), (F.col("value") > 20).alias("arrival_with_fish"), F.when(F.col("event_id") % 3 != 0, F.col("ts")).alias("timestamp"), F.when(F.col("event_id") % 5 != 0, F.col("second")).alias("second"))
    return clips.worth_a_clip(e, ["arrival", "click"], fish_only=True).select("event_id")


@query("op_057_target_events", f"WITH {DET} SELECT event_id FROM det WHERE class = 'click' OR (class = 'view' AND (value > 90 OR event_id % 4 > 1))")
def op_057(spark, sf_dir):
    kind = F.when(F.col("class") == "view", "arrival").otherwise(F.col("class"))
    return detections(spark, sf_dir).where(clips.is_target(kind, ["arrival", "click"], F.col("value") > 90, F.when(F.col("event_id") % 4 > 0, F.col("event_id") % 4 - 1))).select("event_id")


@query("op_062_clip_window", "WITH x AS (SELECT event_id, CASE WHEN event_id % 11 <> 0 THEN value - 30 END AS s, CASE WHEN event_id % 7 <> 0 THEN 60.0 END AS d FROM events), y AS (SELECT event_id, s, greatest(0, s - 5) AS a, coalesce(least(d, s + 10), s + 10) AS b FROM x), z AS (SELECT *, CASE WHEN s IS NULL THEN 'failed_offset' WHEN s < 0 THEN 'failed_negative_offset' WHEN b - a <= 0 THEN 'failed_window' ELSE 'ok' END AS clip_status FROM y) SELECT event_id, CASE WHEN clip_status = 'ok' THEN a END AS clip_start, CASE WHEN clip_status = 'ok' THEN b END AS clip_end, clip_status FROM z")
def op_062(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 11 != 0, F.col("value") - 30).alias("s"), F.when(F.col("event_id") % 7 != 0, 60.0).alias("d"))
    return clips.window(e, F.col("s"), F.col("d"), 5.0, 10.0).drop("s", "d")


@query("op_stream_discovery", "SELECT CAST(6 AS BIGINT) AS files, CAST(6 AS BIGINT) AS again")
def op_stream_discovery(spark, sf_dir):
    """Files found by a stream; a second run of it finds the new ones alone."""
    base, seen, out = scratch(spark, "in"), scratch(spark, "in-checkpoint"), scratch(spark, "in-found")
    rows = table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"))
    rows.repartition(4).write.text(f"{base}/a")
    first = twins.drain(twins.discover(spark, base, "*.txt"), seen, out).count()
    rows.repartition(2).write.text(f"{base}/b")
    found = twins.drain(twins.discover(spark, base, "*.txt"), seen, out)
    return found.agg(F.count("*").alias("files"), (F.count_distinct("path") - 4 + F.lit(first)).alias("again"))


@query("op_stream_claims", f"WITH {JOBS} SELECT video_id, stage, 'in_progress' AS status FROM jobs WHERE status = 'pending' AND stage = 1")
def op_stream_claims(spark, sf_dir):
    """Jobs that arrive on a stream are claimed if they are pending, and worked on."""
    arriving, done = scratch(spark, "jobs"), scratch(spark, "claimed")
    jobs(spark, sf_dir).where("stage = 1").select("video_id", "stage", "status", "retry_count").write.parquet(arriving)
    stream = spark.readStream.schema("video_id bigint, stage bigint, status string, retry_count bigint").parquet(arriving)

    def claim(batch):
        free = ledger.migrate(batch.where("status = 'pending'"), ledger.JOB)
        return ledger.start(free, F.lit(True), F.lit("w1"), F.expr("timestamp_ntz'2024-06-01 12:00:00'"))

    twins.work(stream, claim, lambda df, batch: df.write.mode("overwrite").parquet(f"{done}/part={batch}"), scratch(spark, "jobs-checkpoint"), until_empty=True)
    return spark.read.parquet(done).select("video_id", "stage", "status")
