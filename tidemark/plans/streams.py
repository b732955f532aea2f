"""Streaming twins over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.plans.core import ser
from tidemark.plans.registry import ORACLE, query
from tidemark.plans.session import scratch
from tidemark.streaming import twins


@query("op_103_streaming_bins", "SELECT time_bucket(INTERVAL 1 DAY, ts) AS bin, event_type, count(*) AS n FROM events GROUP BY ALL")
def op_103_streaming(spark, sf_dir):
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    bins = twins.tumbling(stream.withColumn("ts", F.col("ts").cast("timestamp")), "ts", "1 day", ["event_type"], "2 days", n=F.count("*"))
    out = twins.drain(bins, scratch(spark, "bins-checkpoint"), scratch(spark, "bins"), "update")
    return out.groupBy(F.col("bin").cast("timestamp_ntz").alias("bin"), "event_type").agg(F.max("n").alias("n"))


@query("op_161_streaming_sessions", ORACLE["op_161_hysteresis"])
def op_161_streaming(spark, sf_dir):
    dense = scratch(spark, "series")
    ser(spark, sf_dir).write.parquet(dense)
    stream = spark.readStream.schema("video_id long, second long, c long").parquet(dense)
    out = twins.drain(twins.sessions(stream, 5, 0.75), scratch(spark, "sessions-checkpoint"), scratch(spark, "sessions"), "update")
    last = out.groupBy("video_id", "session").agg(F.max_by(F.struct("start_second", "end_second", "duration"), "batch_no").alias("s"))
    return last.select("video_id", "session", "s.*")
