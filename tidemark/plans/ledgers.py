"""Ledger transitions over orders in the role of videos."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ledger
from tidemark.plans.lookups import JOBS, jobs
from tidemark.plans.registry import query
from tidemark.plans.roles import table
from tidemark.sources import sinks


_NOW = "TIMESTAMP '2024-06-01 12:00:00'"
#: Jobs with all columns: started ones have a worker and a time, failed ones a message.
FULL = f"""{JOBS}, fj AS (SELECT video_id, stage, status, retry_count, CASE WHEN status <> 'pending' THEN 'w' || video_id % 3 END AS worker_id, CASE WHEN status <> 'pending' THEN discovered_at END AS started_at,
    CASE WHEN status IN ('completed', 'failed') THEN discovered_at + INTERVAL 1 HOUR END AS completed_at, CASE WHEN status = 'completed' THEN 3600.0 END::DOUBLE AS duration_seconds, CASE WHEN status = 'failed' THEN 'old' END AS error_message, CAST(NULL AS VARCHAR) AS metadata FROM jobs)"""
_ALL = ("status", "retry_count", "worker_id", "started_at", "completed_at", "duration_seconds", "error_message", "metadata")


def full_jobs(spark, sf_dir):
    s, at = F.col("status"), F.col("discovered_at").cast("timestamp_ntz")
    j = jobs(spark, sf_dir).select("video_id", "stage", "status", "retry_count", "discovered_at")
    j = j.withColumns({"worker_id": F.when(s != "pending", F.concat(F.lit("w"), (F.col("video_id") % 3).cast("string"))), "started_at": F.when(s != "pending", at), "completed_at": F.when(s.isin("completed", "failed"), at + F.expr("interval 1 hour")), "duration_seconds": F.when(s == "completed", F.lit(3600.0)), "error_message": F.when(s == "failed", "old")})
    return ledger.migrate(j, ledger.JOB).select("video_id", "stage", *_ALL)


def now():
    return F.expr("timestamp_ntz'2024-06-01 12:00:00'")


def _moved(name, change, where="false", **values):
    """Register a transition; its SQL sets `values` where `where` holds."""
    columns = ", ".join(f"CASE WHEN {where} THEN {values[c]} ELSE {c} END AS {c}" if c in values else c for c in _ALL)

    @query(name, f"WITH {FULL} SELECT video_id, stage, {columns} FROM fj")
    def run(spark, sf_dir):
        return change(full_jobs(spark, sf_dir))

    return run




def _even():
    return F.col("video_id") % 2 == 0


_MESSAGE = "CASE WHEN video_id % 5 = 0 THEN 'Invalid data found when processing input' WHEN video_id % 5 = 1 THEN 'x.mkv appears corrupt or unreadable' ELSE 'no space left' END"
_moved("op_250_start", lambda j: ledger.start(j, _even(), F.lit("w9"), now()), "video_id % 2 = 0 AND status = 'pending'", status="'in_progress'", worker_id="'w9'", started_at=_NOW, completed_at="NULL", duration_seconds="NULL", error_message="NULL")
_moved("op_251_complete", lambda j: ledger.complete(j, _even() & (F.col("status") == "in_progress"), now(), F.when(F.col("video_id") % 4 == 0, 7.5), F.struct(F.col("stage").alias("k"))), "video_id % 2 = 0 AND status = 'in_progress'", status="'completed'", completed_at=_NOW, duration_seconds=f"CASE WHEN video_id % 4 = 0 THEN 7.5 ELSE date_diff('second', started_at, {_NOW}) END", metadata="""'{"k":' || stage || '}'""")
_moved("op_252_fail", lambda j: ledger.fail(j, F.col("status") == "in_progress", F.col("video_id") % 3 == 0, F.expr(_MESSAGE), now()), "status = 'in_progress'", status="CASE WHEN video_id % 3 = 0 THEN 'pending' ELSE 'failed' END", retry_count="retry_count + 1", error_message=_MESSAGE, completed_at=_NOW)
_moved("op_253_give_back", lambda j: ledger.give_back(j, _even() & (F.col("status") == "in_progress")), "video_id % 2 = 0 AND status = 'in_progress'", status="'pending'", worker_id="NULL", started_at="NULL", completed_at="NULL")
_moved("op_254_reset_stuck", lambda j: ledger.reset_stuck(j, F.expr("timestamp_ntz'1998-01-01 00:00:00'")), "status = 'in_progress' AND started_at < TIMESTAMP '1998-01-01'", status="'pending'", worker_id="NULL", started_at="NULL")
_moved("op_254_reset_failed", lambda j: ledger.reset_failed(j, (2, 3, 4)), "status = 'failed' AND stage IN (2, 3, 4)", status="'pending'", worker_id="NULL", started_at="NULL", completed_at="NULL")


@query("op_250_refused", f"WITH {FULL} SELECT video_id, stage, status FROM fj WHERE video_id % 2 = 0 AND status <> 'pending'")
def op_250_refused(spark, sf_dir):
    return ledger.refused(full_jobs(spark, sf_dir), _even()).select("video_id", "stage", "status")


@query("op_073_252_corrupt", f"WITH {FULL}, f AS (SELECT *, {_MESSAGE} AS m FROM fj WHERE status = 'in_progress' AND video_id % 3 <> 0) SELECT video_id, stage, m AS error_message, o_orderpriority AS station FROM f JOIN orders ON o_orderkey = video_id WHERE video_id % 5 IN (0, 1)")
def op_073_corrupt(spark, sf_dir):
    """Failures of this run, and of these the ones that say the file is corrupt."""
    now_failed = ledger.fail(full_jobs(spark, sf_dir).where("status = 'in_progress'"), F.lit(True), F.col("video_id") % 3 == 0, F.expr(_MESSAGE), now())
    videos = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_orderpriority").alias("station"))
    return ledger.corrupt(now_failed, videos)


#: Batches: a supplier's nation and day as station and date.
_BATCHES = """bt AS (SELECT upper('st' || s_nationkey) AS station, CAST(DATE '2024-01-01' + CAST(s_suppkey % 300 AS INTEGER) AS VARCHAR) AS date, s_suppkey AS batch, CASE s_suppkey % 4 WHEN 0 THEN 'pending' WHEN 1 THEN 'in_progress' WHEN 2 THEN 'completed' ELSE 'failed' END AS status,
    CASE WHEN s_suppkey % 4 > 0 THEN TIMESTAMP '2024-05-01' END AS started_at, CASE WHEN s_suppkey % 4 > 1 THEN TIMESTAMP '2024-05-02' END AS completed_at, CAST(0 AS BIGINT) AS clips_created, CAST(0 AS BIGINT) AS clips_failed, CASE WHEN s_suppkey % 4 = 3 THEN 'old' END AS error_message FROM supplier)"""
_BATCH_COLUMNS = ("status", "started_at", "completed_at", "clips_created", "clips_failed", "error_message")


def batches(spark, sf_dir):
    k = F.col("s_suppkey")
    return table(spark, sf_dir, "supplier").select(
        F.upper(F.concat(F.lit("st"), F.col("s_nationkey").cast("string"))).alias("station"),
        F.date_add(F.lit("2024-01-01").cast("date"), (k % 300).cast("int")).cast("string").alias("date"),
        k.alias("batch"),
        F.element_at(F.array(*map(F.lit, ("pending", "in_progress", "completed", "failed"))), (k % 4).cast("int") + 1).alias("status"),
        F.when(k % 4 > 0, F.expr("timestamp_ntz'2024-05-01 00:00:00'")).alias("started_at"),
        F.when(k % 4 > 1, F.expr("timestamp_ntz'2024-05-02 00:00:00'")).alias("completed_at"),
        F.lit(0).cast("bigint").alias("clips_created"),
        F.lit(0).cast("bigint").alias("clips_failed"),
        F.when(k % 4 == 3, "old").alias("error_message"),
    )


def _moved_batch(name, change, where, **values):
    columns = ", ".join(f"CASE WHEN {where} THEN {values[c]} ELSE {c} END AS {c}" if c in values else c for c in _BATCH_COLUMNS)

    @query(name, f"WITH {_BATCHES} SELECT batch, {columns} FROM bt")
    def run(spark, sf_dir):
        return change(batches(spark, sf_dir)).select("batch", *_BATCH_COLUMNS)

    return run




def _third():
    return F.col("batch") % 3 == 0


_moved_batch("op_256_batch_start", lambda b: ledger.start_batch(b, _third(), now()), "batch % 3 = 0", status="'in_progress'", started_at=_NOW, completed_at="NULL", error_message="NULL")
_moved_batch("op_256_batch_complete", lambda b: ledger.complete_batch(b, _third(), F.col("batch") % 10, F.col("batch") % 2, now()), "batch % 3 = 0", status="'completed'", completed_at=_NOW, clips_created="batch % 10", clips_failed="batch % 2", error_message="NULL")
_moved_batch("op_256_batch_fail", lambda b: ledger.fail_batch(b, _third(), F.lit("disk full"), now()), "batch % 3 = 0", status="'failed'", completed_at=_NOW, error_message="'disk full'")
_moved_batch("op_256_batch_reset", lambda b: ledger.reset_batch(b, _third()), "batch % 3 = 0", status="'pending'", started_at="NULL", completed_at="NULL", error_message="NULL")


@query("op_258_recompute", "SELECT o_orderkey AS video_id, CASE WHEN o_orderkey % 2 = 0 THEN 1000.0 * (year(o_orderdate) = 1997)::INTEGER + greatest(0, 365 - (dayofyear(o_orderdate) - 1)) / 365.0 ELSE o_totalprice END AS priority_score FROM orders")
def op_258(spark, sf_dir):
    """New scores replace those of the videos that they name."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("video_id"), F.col("o_totalprice").alias("priority_score"), "o_orderdate", "o_orderpriority")
    score = ledger.priority(F.year("o_orderdate"), F.col("o_orderdate"), F.col("o_orderpriority"), {1997: 1}, {})
    return ledger.update_known(o.select("video_id", "priority_score"), o.where("video_id % 2 = 0").select("video_id", score.alias("priority_score")), ["video_id"])


@query("op_180_181_job_order", f"WITH {JOBS}, r AS (SELECT j.* FROM jobs j LEFT JOIN jobs p ON p.video_id = j.video_id AND p.stage = j.stage - 1 WHERE j.status = 'pending' AND (j.stage = 1 OR p.status = 'completed')) SELECT video_id, stage, priority_score FROM r ORDER BY priority_score DESC, discovered_at, video_id LIMIT 100")
def op_180(spark, sf_dir):
    return ledger.ready(jobs(spark, sf_dir), 100).select("video_id", "stage", "priority_score")


@query("op_182_258_priority", "SELECT o_orderkey, round((CASE year(o_orderdate) WHEN 1997 THEN 3 WHEN 1998 THEN 2 ELSE 0 END) * 1000.0 + (CASE WHEN contains(o_orderpriority, 'URGENT') THEN 9 WHEN contains(o_orderpriority, 'HIGH') THEN 5 ELSE 0 END) * 10.0 + greatest(0, 365 - (dayofyear(o_orderdate) - 1)) / 365.0, 6) AS score FROM orders")
def op_182(spark, sf_dir):
    p = ledger.priority(F.year("o_orderdate"), F.col("o_orderdate"), F.col("o_orderpriority"), {1997: 3, 1998: 2}, {"urgent": 9, "high": 5})
    return table(spark, sf_dir, "orders").select("o_orderkey", F.round(p, 6).alias("score"))


@query("op_255_update_known", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN -1.0 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer")
def op_255(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_mktsegment")
    change = c.where("c_custkey % 2 = 0").select("c_custkey", F.when(F.col("c_custkey") % 4 == 0, -1.0).alias("c_acctbal"))
    return ledger.update_known(c, change, ["c_custkey"])


@query("op_256_batch_fetch", f"WITH {_BATCHES} SELECT station, date, batch, status FROM bt WHERE status IN ('pending', 'failed') AND station IN ('ST1', 'ST2', 'ST3', 'ST4', 'ST5') AND date >= '2024-01-05' AND date <= '2024-11-01'")
def op_256(spark, sf_dir):
    return ledger.fetch_batches(batches(spark, sf_dir), ["pending", "failed"], ["st1", "ST2", "st3", "st4", "st5"], "2024-01-05", "2024-11-01").select("station", "date", "batch", "status")


@query("op_257_all_done", f"WITH {JOBS} SELECT count(*) FILTER (stage = 4 AND status NOT IN ('completed', 'skipped')) AS unfinished, unfinished = 0 AS all_done FROM jobs")
def op_257(spark, sf_dir):
    return ledger.all_done(jobs(spark, sf_dir))


@query("op_259_migrate", "SELECT n_nationkey, CAST(NULL AS VARCHAR) AS note FROM nation")
def op_259(spark, sf_dir):
    return ledger.migrate(table(spark, sf_dir, "nation"), {"n_name": "string", "note": "string"}).select("n_nationkey", "note")


@query("op_024_025_register", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'known' ELSE 'pending' END AS status, CAST(c_custkey % 7 AS BIGINT) AS score FROM customer")
def op_024(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    old = c.where("c_custkey % 3 = 0").select("c_custkey", F.lit("known").alias("status"), F.lit(0).cast("bigint").alias("score"))
    new = c.select("c_custkey", F.lit("pending").alias("status"), (F.col("c_custkey") % 7).alias("score"))
    return sinks.register(old, new, ["c_custkey"], ["status"])


@query("op_026_state", """SELECT 'k' || n_nationkey AS key, CASE WHEN n_nationkey = 3 THEN '{"value":9}' ELSE '{"value":1}' END AS value FROM nation""")
def op_026(spark, sf_dir):
    old = table(spark, sf_dir, "nation").select(F.concat(F.lit("k"), F.col("n_nationkey").cast("string")).alias("key"), F.lit('{"value":1}').alias("value"), F.lit("2024").alias("updated_at"))
    return sinks.set_state(old, "k3", 9, "2025").select("key", "value")
