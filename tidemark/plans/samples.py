"""Sorting, limits and sampling over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import boxes, sampling
from tidemark.plans.core import repair_sql
from tidemark.plans.registry import query
from tidemark.plans.roles import CLASSES, DET, GRID, detections, table

_TOP = "SELECT *, CAST(floor(value) AS BIGINT) * 100000 + event_id AS s FROM events ORDER BY s DESC, event_id LIMIT 500"


@query("op_183_event_rank", f"WITH t AS ({_TOP}), q AS (SELECT event_id, user_id, s + CAST(json_extract_string(props, '$.k') AS INTEGER) AS score FROM t), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, event_id) AS n FROM q) SELECT event_id, user_id, score, CAST(n AS INTEGER) AS rank_in_group FROM r ORDER BY n > 1, score DESC, event_id LIMIT 100")
def op_183(spark, sf_dir):
    score = F.floor("value") * 100000 + F.col("event_id")
    out = sampling.ranked(table(spark, sf_dir, "events"), score, ["user_id"], 100, 200, F.get_json_object("props", "$.k").cast("int"), "event_id")
    return out.select("event_id", "user_id", "score", "rank_in_group")


@query("op_184_even_spacing", "WITH x AS (SELECT event_id, event_type, row_number() OVER (PARTITION BY event_type ORDER BY event_id) - 1 AS i, count(*) OVER (PARTITION BY event_type) AS n FROM events), c AS (SELECT event_id, event_type, n <= 8 OR list_contains([CAST(floor(j * (n - 1) / 7) AS BIGINT) for j in range(0, 8)], i) AS ok FROM x) SELECT event_id, event_type FROM c ORDER BY ok DESC, event_id, event_type LIMIT 42")
def op_184(spark, sf_dir):
    return sampling.evenly(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id", 42, 5)


@query("op_185_first_per_type", "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= 7")
def op_185(spark, sf_dir):
    return sampling.first_per_type(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", "event_id", 7)


@query("op_186_tiers", "SELECT event_id, value, CASE WHEN value > 95 THEN 0 WHEN value > 80 THEN 1 ELSE 2 END AS tier FROM events ORDER BY tier, md5('5|' || event_id), event_id LIMIT 300")
def op_186(spark, sf_dir):
    v = F.col("value")
    return sampling.tiers(table(spark, sf_dir, "events").select("event_id", "value"), v > 95, v > 80, 300, 5, "event_id")


@query("op_187_stratified", "SELECT event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY event_id) AS n FROM events) WHERE n <= CASE event_type WHEN 'view' THEN 4 WHEN 'click' THEN 3 WHEN 'error' THEN 3 END")
def op_187(spark, sf_dir):
    return sampling.stratified(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", 10, ["view", "click", "error"], "event_id")


@query("op_188_seeded_sample", "SELECT event_id FROM events ORDER BY md5('42|' || event_id), event_id LIMIT 200")
def op_188(spark, sf_dir):
    return sampling.sample(table(spark, sf_dir, "events").select("event_id"), 200, 42, "event_id")


@query("op_189_targets", "SELECT event_id, round(value * (0.1 + 0.8 * unnest(range(0, 5)) / 4), 6) AS offset FROM events")
def op_189(spark, sf_dir):
    out = sampling.targets(table(spark, sf_dir, "events"), F.col("value"), 5)
    return out.select("event_id", F.round("offset", 6).alias("offset"))


@query("op_190_chronological_split", "WITH x AS (SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT event_id, CASE WHEN i <= greatest(1, least(n - 1, round_even(n * CAST(0.7 AS DOUBLE), 0))) THEN 'train' ELSE 'val' END AS part FROM x")
def op_190(spark, sf_dir):
    return sampling.chronological_split(table(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"], 0.7).select("event_id", "part")


@query("op_191_random_split", "WITH u AS (SELECT event_id, user_id, CAST('0x' || md5('3|' || event_id)[1:8] AS BIGINT) / 4294967296.0::DOUBLE AS u FROM events), p AS (SELECT event_id, user_id, CASE WHEN u < 0.85 THEN 'train' WHEN u < 0.95 THEN 'val' ELSE 'test' END AS part FROM u) SELECT *, CAST(floor((row_number() OVER (PARTITION BY part, user_id ORDER BY event_id) - 1) / 20) AS BIGINT) AS batch FROM p")
def op_191(spark, sf_dir):
    out = sampling.random_split(table(spark, sf_dir, "events").select("event_id", "user_id"), {"train": 0.85, "val": 0.1, "test": 0.05}, 3, "event_id")
    return sampling.batches(out, 20, "event_id", ["part", "user_id"])


@query("op_194_worst_files", "SELECT s_suppkey AS file, s_suppkey % 4 AS missed, s_nationkey % 5 AS extra FROM supplier WHERE s_suppkey % 4 > 0 OR s_nationkey % 5 > 1")
def op_194(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("file"), (F.col("s_suppkey") % 4).alias("missed"), (F.col("s_nationkey") % 5).alias("extra"))
    return sampling.worst(s, "missed", "extra")


@query("op_192_best", "SELECT user_id, round(0.6 * avg(value) + 0.4 * max(value), 6) AS score FROM events GROUP BY 1 HAVING count(*) > 50 ORDER BY score DESC, user_id LIMIT 10")
def op_192(spark, sf_dir):
    g = table(spark, sf_dir, "events").groupBy("user_id").agg(F.round(0.6 * F.avg("value") + 0.4 * F.max("value"), 6).alias("score"), F.count("*").alias("n"))
    return g.where("n > 50").orderBy(F.desc("score"), "user_id").limit(10).drop("n")


_SPIKE = repair_sql("ser", "sp", 2, False)
_DIP = repair_sql("ser", "dp", 3, True)


@query("op_232_233_problem_frames", f"""WITH {GRID}, {_SPIKE}, {_DIP}
    SELECT DISTINCT video_id, second, 'edge' AS problem FROM det WHERE NOT (xmin >= 100 AND xmax <= 2588 AND ymin >= 100 AND ymax <= 1420)
    UNION ALL SELECT s.video_id, s.second, 'spike' FROM ser s JOIN sp USING (video_id, second) WHERE s.c <> sp.c
    UNION ALL SELECT s.video_id, s.second, 'dip' FROM ser s JOIN dp USING (video_id, second) WHERE s.c <> dp.c
    UNION ALL SELECT video_id, second, 'high_count' FROM ser WHERE c >= 3
    UNION ALL SELECT video_id, second, 'transition' FROM (SELECT *, c - lag(c) OVER (PARTITION BY video_id ORDER BY second) AS d FROM ser) WHERE d <> 0
    UNION ALL (SELECT DISTINCT video_id, second, 'fish' FROM det WHERE class = 'signup')""")
def op_232(spark, sf_dir):
    return sampling.problem_frames(detections(spark, sf_dir), CLASSES, "signup", margin=100, spike=2, dip=3, high=3)


@query("op_234_low_quality", "SELECT event_id, round(greatest(0, (60 - value) / 60) + greatest(0, (100 - CAST(json_extract_string(props, '$.k') AS INTEGER)) / 100), 6) AS score FROM events")
def op_234(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", F.round(sampling.low_quality(F.col("value"), F.get_json_object("props", "$.k").cast("int")), 6).alias("score"))


@query("op_235_merge_labels", "SELECT c_custkey AS item, c_nationkey AS class_id FROM customer UNION ALL SELECT s_suppkey, s_nationkey + 25 FROM supplier")
def op_235(spark, sf_dir):
    a = table(spark, sf_dir, "customer").selectExpr("c_custkey item", "c_nationkey class_id")
    return sampling.merge_labels(a, table(spark, sf_dir, "supplier").selectExpr("s_suppkey item", "s_nationkey class_id"), 25)


_NMS = """WITH RECURSIVE {det}, b AS (SELECT strftime(ts, '%Y-%m-%d') AS day, class, event_id, confidence, xmin, ymin, xmin + 900 AS xmax, ymin + 700 AS ymax FROM det WHERE {where}),
    o AS (SELECT *, {{'x1': xmin, 'y1': ymin, 'x2': xmax, 'y2': ymax}} AS box, row_number() OVER (PARTITION BY {group} ORDER BY confidence DESC, event_id) AS i FROM b),
    r AS (SELECT {group}, i, event_id, true AS kept, [box] AS boxes FROM o WHERE i = 1
      UNION ALL SELECT {groups}, o.i, o.event_id, k.kept, CASE WHEN k.kept THEN list_append(r.boxes, o.box) ELSE r.boxes END FROM r JOIN o ON {on} AND o.i = r.i + 1,
        LATERAL (SELECT len(list_filter(r.boxes, lambda k: greatest(0, least(k.x2, o.box.x2) - greatest(k.x1, o.box.x1)) * greatest(0, least(k.y2, o.box.y2) - greatest(k.y1, o.box.y1))
          / ((k.x2 - k.x1) * (k.y2 - k.y1) + (o.box.x2 - o.box.x1) * (o.box.y2 - o.box.y1) - greatest(0, least(k.x2, o.box.x2) - greatest(k.x1, o.box.x1)) * greatest(0, least(k.y2, o.box.y2) - greatest(k.y1, o.box.y1)) + 1e-8) > {limit})) = 0 AS kept) k)
    SELECT {outs}, o.event_id, o.confidence, o.xmin, o.ymin, o.xmax, o.ymax FROM r JOIN o ON {on} AND o.i = r.i WHERE r.kept"""


def _nms_sql(group, limit, where="true"):
    return _NMS.format(det=DET, where=where, limit=limit, group=", ".join(group), groups=", ".join(f"o.{g}" for g in group), outs=", ".join(f"o.{g}" for g in group), on=" AND ".join(f"o.{g} = r.{g}" for g in group))


@query("op_228_suppression", _nms_sql(["day", "class"], 0.5))
def op_228(spark, sf_dir):
    d = detections(spark, sf_dir)
    big = d.withColumns({"xmax": F.col("xmin") + 900, "ymax": F.col("ymin") + 700})
    return boxes.suppress(big.withColumn("day", F.to_date("ts").cast("string")), ["day", "class"], 0.5)


@query("op_229_suppression_strict", _nms_sql(["day"], 0.45, "confidence > 0.25"))
def op_229(spark, sf_dir):
    d = detections(spark, sf_dir)
    big = d.withColumns({"xmax": F.col("xmin") + 900, "ymax": F.col("ymin") + 700})
    return boxes.suppress(big.withColumn("day", F.to_date("ts").cast("string")), ["day"], 0.45, strictly_above=0.25)
