"""Joins and set operations over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import lookup, select
from tidemark.plans.registry import query
from tidemark.plans.roles import DET, detections, table
from tidemark.sources import sinks


def jobs(spark, sf_dir):
    """Orders as videos, times four stages; status and retries by arithmetic."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_orderpriority").alias("station"), "o_orderstatus", F.col("o_totalprice").alias("priority_score"), F.col("o_orderdate").alias("discovered_at"))
    s = o.crossJoin(F.broadcast(spark.range(1, 5).withColumnRenamed("id", "stage")))
    level = F.when(F.col("o_orderstatus") == "F", 4).when(F.col("o_orderstatus") == "P", F.col("video_id") % 4).otherwise(0)
    status = F.when(F.col("stage") <= level, "completed").when((F.col("stage") == level + 1) & (F.col("video_id") % 11 == 0), "failed").when((F.col("stage") == level + 1) & (F.col("video_id") % 5 == 0), "in_progress").otherwise("pending")
    return s.select("video_id", "station", "priority_score", "discovered_at", "stage", status.alias("status"), (F.col("video_id") % 3 + F.col("stage")).alias("retry_count"))


JOBS = """jobs AS (SELECT o_orderkey AS video_id, o_orderpriority AS station, o_totalprice AS priority_score, o_orderdate AS discovered_at, stage,
    CASE WHEN stage <= lv THEN 'completed' WHEN stage = lv + 1 AND o_orderkey % 11 = 0 THEN 'failed' WHEN stage = lv + 1 AND o_orderkey % 5 = 0 THEN 'in_progress' ELSE 'pending' END AS status, o_orderkey % 3 + stage AS retry_count
    FROM (SELECT *, CASE o_orderstatus WHEN 'F' THEN 4 WHEN 'P' THEN o_orderkey % 4 ELSE 0 END AS lv FROM orders), (SELECT CAST(unnest(range(1, 5)) AS BIGINT) AS stage))"""


@query("op_070_071_ready_jobs", f"WITH {JOBS} SELECT j.video_id, j.stage, j.retry_count, j.priority_score FROM jobs j JOIN jobs p ON p.video_id = j.video_id AND p.stage = j.stage - 1 WHERE j.status = 'pending' AND p.status = 'completed'")
def op_070(spark, sf_dir):
    j = jobs(spark, sf_dir)
    before = j.where("status = 'completed'").select("video_id", (F.col("stage") + 1).alias("stage"))
    return j.where("status = 'pending'").join(before, ["video_id", "stage"], "left_semi").select("video_id", "stage", "retry_count", "priority_score")


@query("op_072_placeholders", f"WITH {JOBS}, known AS (SELECT video_id, stage FROM jobs WHERE status = 'completed'), want AS (SELECT o_orderkey AS video_id, CAST(unnest(range(1, 5)) AS BIGINT) AS stage FROM orders) SELECT want.* FROM want ANTI JOIN known USING (video_id, stage)")
def op_072(spark, sf_dir):
    j = jobs(spark, sf_dir)
    want = j.select("video_id").distinct().crossJoin(F.broadcast(spark.range(1, 5).withColumnRenamed("id", "stage")))
    return sinks.pending(want, j.where("status = 'completed'"), ["video_id", "stage"])


@query("op_073_corrupt_archive", f"WITH {JOBS} SELECT j.video_id, o.o_totalprice AS price, j.retry_count FROM jobs j JOIN orders o ON o.o_orderkey = j.video_id WHERE j.status = 'failed'")
def op_073(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_totalprice").alias("price"))
    return jobs(spark, sf_dir).where("status = 'failed'").join(o, "video_id").select("video_id", "price", "retry_count")


@query("op_074_class_names", "SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def op_074(spark, sf_dir):
    return table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query("op_075_prior_prediction", "SELECT d.doc_id, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def op_075(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")


@query("op_076_event_job_audit", "SELECT (s.s_suppkey IS NULL) AS unmatched, count(*) AS n FROM lineitem l LEFT JOIN supplier s ON s.s_suppkey = l.l_partkey GROUP BY 1")
def op_076(spark, sf_dir):
    """Operator 077 as well: hash lookup, with what was not found for the audit."""
    l, s = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    found = l.join(s, l.l_partkey == s.s_suppkey, "left").groupBy(F.col("s_suppkey").isNull().alias("unmatched"))
    return found.agg(F.count("*").alias("n"))


@query("op_078_interval_containment", f"WITH {DET}, s AS (SELECT event_id AS span_id, video_id, ts AS a, ts + INTERVAL 36 HOUR AS b FROM det WHERE class = 'signup') SELECT d.event_id AS point_id, min(span_id) AS span FROM det d JOIN s USING (video_id) WHERE d.class = 'view' AND d.ts >= a AND d.ts < b GROUP BY 1")
def op_078(spark, sf_dir):
    d = detections(spark, sf_dir)
    spans = d.where("class = 'signup'").selectExpr("event_id span_id", "video_id", "ts a", "ts + interval 36 hour b")
    return lookup.containing(d.where("class = 'view'").select("video_id", "ts", F.col("event_id").alias("point_id")), spans, ["video_id"], "ts", "a", "b", "span_id")


@query("op_080_match_nearest", f"""WITH RECURSIVE {DET}, n AS (SELECT t.video_id AS file, t.event_id AS t, f.event_id AS f, f.second - t.second AS o FROM det t JOIN det f ON t.video_id = f.video_id AND abs(t.second - f.second) <= 3 WHERE t.class = 'purchase' AND f.class = 'click'),
    i AS (SELECT file, t, dense_rank() OVER (PARTITION BY file ORDER BY t) AS i FROM (SELECT DISTINCT file, t FROM n)), x AS (SELECT n.*, i FROM n JOIN i USING (file, t)),
    r AS (SELECT DISTINCT file, CAST(0 AS BIGINT) AS i, CAST([] AS BIGINT[]) AS used, CAST(NULL AS BIGINT) AS t, CAST(NULL AS BIGINT) AS f, CAST(NULL AS BIGINT) AS o FROM x
      UNION ALL SELECT r.file, r.i + 1, CASE WHEN b.f IS NULL THEN r.used ELSE list_append(r.used, b.f) END, b.t, b.f, b.o
      FROM r JOIN (SELECT file, max(i) AS most FROM x GROUP BY file) m ON m.file = r.file AND r.i < m.most,
        LATERAL (SELECT min(x.t) AS t, arg_min(x.f, abs(x.o) * 1000000000 + x.f) AS f, arg_min(x.o, abs(x.o) * 1000000000 + x.f) AS o FROM x WHERE x.file = r.file AND x.i = r.i + 1 AND NOT list_contains(r.used, x.f)) b)
    SELECT file, t AS truth_no, f AS found_no, o AS "offset" FROM r WHERE f IS NOT NULL""")
def op_080(spark, sf_dir):
    d = detections(spark, sf_dir)
    truth = d.where("class = 'purchase'").selectExpr("video_id file", "event_id truth_no", "'x' type", "second")
    found = d.where("class = 'click'").selectExpr("video_id file", "event_id found_no", "'x' type", "second")
    return select.match_nearest(truth, found, 3)


@query("op_236_match_loosely", f"WITH {DET} SELECT f.video_id AS file, f.event_id AS found_no, min(t.event_id) AS truth_no FROM (SELECT * FROM det WHERE class = 'click') f LEFT JOIN (SELECT * FROM det WHERE class = 'purchase') t ON t.video_id = f.video_id AND abs(t.second - f.second) <= 3 GROUP BY ALL")
def op_236(spark, sf_dir):
    d = detections(spark, sf_dir)
    return select.match_loosely(d.where("class = 'purchase'").selectExpr("video_id file", "event_id truth_no", "second"), d.where("class = 'click'").selectExpr("video_id file", "event_id found_no", "second"), 3)


@query("op_081_first_cell", f"WITH {DET}, c AS (SELECT n_nationkey AS cell_id, n_nationkey % 5 * 400 AS a, n_nationkey // 5 * 250 AS b FROM nation) SELECT event_id AS point_id, min(cell_id) AS cell_id FROM det JOIN c ON (xmin + xmax) / 2 >= a AND (xmin + xmax) / 2 < a + 450 AND (ymin + ymax) / 2 >= b AND (ymin + ymax) / 2 < b + 300 GROUP BY 1")
def op_081(spark, sf_dir):
    cells = table(spark, sf_dir, "nation").selectExpr("n_nationkey cell_id", "n_nationkey % 5 * 400 cell_xmin", "n_nationkey % 5 * 400 + 450 cell_xmax", "n_nationkey div 5 * 250 cell_ymin", "n_nationkey div 5 * 250 + 300 cell_ymax")
    return lookup.first_cell(detections(spark, sf_dir).selectExpr("event_id point_id", "(xmin + xmax) / 2 x", "(ymin + ymax) / 2 y"), cells)


@query("op_082_centroids_by_frame", f"WITH {DET}, g AS (SELECT video_id, second, class, avg((xmin + xmax) / 2) AS x, avg((ymin + ymax) / 2) AS y FROM det GROUP BY ALL) SELECT a.video_id, a.second, round(sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2)), 6) AS distance FROM g a JOIN g b ON a.video_id = b.video_id AND a.second = b.second AND a.class = 'view' AND b.class = 'click'")
def op_082(spark, sf_dir):
    """Operators 117 and 203 as well: centroids per frame, frames that both classes have."""
    mid = lambda c: detections(spark, sf_dir).where(F.col("class") == c).groupBy("video_id", "second").agg(F.avg(F.expr("(xmin + xmax) / 2")).alias(f"x_{c}"), F.avg(F.expr("(ymin + ymax) / 2")).alias(f"y_{c}"))
    both = mid("view").join(mid("click"), ["video_id", "second"])
    return both.select("video_id", "second", F.round(F.hypot(F.col("x_view") - F.col("x_click"), F.col("y_view") - F.col("y_click")), 6).alias("distance"))


@query("op_083_has_label", "SELECT doc_id FROM documents SEMI JOIN (SELECT doc_id FROM labels WHERE toxic = 1) USING (doc_id)")
def op_083(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id").join(table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), "doc_id", "left_semi")


@query("op_084_not_processed", "SELECT doc_id FROM documents ANTI JOIN labels USING (doc_id)")
def op_084(spark, sf_dir):
    """Operators 033 and 204 as well: inputs that have no output yet."""
    return sinks.pending(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), ["doc_id"])


@query("op_085_193_calendar", "WITH d AS (SELECT CAST(o_orderdate AS DATE) AS day, count(*) AS n FROM orders GROUP BY 1), c AS (SELECT CAST(unnest(range(DATE '1997-01-01', DATE '1998-01-01', INTERVAL 1 DAY)) AS DATE) AS day) SELECT CAST(day AS VARCHAR) AS day, coalesce(n, 0) AS n FROM c LEFT JOIN d USING (day)")
def op_085(spark, sf_dir):
    d = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.count("*").alias("n"))
    c = spark.range(1).select(lookup.calendar(F.expr("date'1997-01-01'"), F.expr("date'1997-12-31'")).alias("day"))
    return c.join(d, "day", "left").select(F.col("day").cast("string").alias("day"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"))


@query("op_200_201_union_last_wins", "SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN 'table' ELSE 'file' END AS src FROM customer")
def op_200(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k"))
    return sinks.upsert(c.withColumn("src", F.lit("file")), c.where("k % 3 = 0").withColumn("src", F.lit("table")), ["k"])


@query("op_202_set_union", "SELECT DISTINCT m FROM (SELECT l_partkey AS m FROM lineitem WHERE l_quantity < 3 UNION ALL SELECT l_suppkey FROM lineitem WHERE l_quantity > 48)")
def op_202(spark, sf_dir):
    l = table(spark, sf_dir, "lineitem")
    return l.where("l_quantity < 3").select(F.col("l_partkey").alias("m")).union(l.where("l_quantity > 48").select("l_suppkey")).distinct()


@query("op_205_content_hash", "SELECT sha1(text) AS digest, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def op_205(spark, sf_dir):
    return lookup.by_content(table(spark, sf_dir, "documents"), "text", "doc_id")


@query("op_206_near_duplicates", "WITH x AS (SELECT vec_id, embedding AS e, lag(embedding) OVER (PARTITION BY label ORDER BY vec_id) AS p FROM embeddings) SELECT vec_id FROM x WHERE p IS NULL OR list_distance(CAST(e AS DOUBLE[]), CAST(p AS DOUBLE[])) >= 1.2")
def op_206(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"), "label")
    return lookup.near_duplicates(e, "v", "vec_id", 1.2, F.col("label")).select("vec_id")


@query("op_207_first_per_time", "SELECT o_orderdate, min(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def op_207(spark, sf_dir):
    return lookup.first_per_key(table(spark, sf_dir, "orders"), ["o_orderdate"], "o_orderkey").select("o_orderdate", "o_orderkey")
