"""The driver tables in the roles of detections, series and so on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Classes counted per second; a bin of six hours stands for a second.
CLASSES = ("view", "click", "purchase")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def detections(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.selectExpr(
        "user_id video_id",
        "event_id",
        "event_type class",
        "ts",
        "cast(floor(timestampdiff(SECOND, timestamp_ntz'2024-01-01 00:00:00', ts) / 21600) as bigint) second",
        "cast(get_json_object(props, '$.k') as int) / 100.0D confidence",
        "cast(event_id % 2500 as double) xmin",
        "cast(event_id * 7 % 1450 as double) ymin",
        "cast(event_id % 2500 + 20 + event_id % 200 as double) xmax",
        "cast(event_id * 7 % 1450 + 10 + event_id * 3 % 100 as double) ymax",
        "value",
    )


#: The same in SQL, to follow WITH.
DET = """det AS (SELECT user_id AS video_id, event_id, event_type AS class, ts,
    CAST(floor(date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) / 21600) AS BIGINT) AS second,
    CAST(json_extract_string(props, '$.k') AS INTEGER) / 100.0 AS confidence,
    CAST(event_id % 2500 AS DOUBLE) AS xmin, CAST(event_id * 7 % 1450 AS DOUBLE) AS ymin,
    CAST(event_id % 2500 + 20 + event_id % 200 AS DOUBLE) AS xmax, CAST(event_id * 7 % 1450 + 10 + event_id * 3 % 100 AS DOUBLE) AS ymax, value FROM events)"""

#: Dense counts of one class per video and second.
GRID = DET + """,
    top AS (SELECT video_id, max(second) AS m FROM det GROUP BY video_id),
    grid AS (SELECT video_id, unnest(range(0, m + 1)) AS second FROM top),
    cnt AS (SELECT video_id, second, count(*) AS c FROM det WHERE class IN ('view', 'click', 'purchase') GROUP BY ALL),
    ser AS (SELECT g.video_id, g.second, CAST(coalesce(c, 0) AS BIGINT) AS c, m + 1 AS n FROM grid g JOIN top USING (video_id) LEFT JOIN cnt USING (video_id, second))"""
