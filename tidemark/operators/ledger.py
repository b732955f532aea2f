"""The job ledger: rows per video and stage, with transitions as expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATUSES = ("pending", "in_progress", "completed", "failed", "skipped")


def progress(jobs: DataFrame, stages: int = 4) -> DataFrame:
    """Jobs per stage and status, with zeros."""
    spark = jobs.sparkSession
    grid = spark.range(1, stages + 1).withColumnRenamed("id", "stage").withColumn("status", F.explode(F.array(*map(F.lit, STATUSES))))
    return grid.join(jobs.groupBy("stage", "status").agg(F.count("*").alias("n")), ["stage", "status"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))


def ready(jobs: DataFrame, limit: int | None = None, max_retries: int | None = None) -> DataFrame:
    """Pending jobs whose stage before is completed (stage 1: all), best first.
    `max_retries` leaves out jobs that failed as often; off by default."""
    done = jobs.where("status = 'completed'").select("video_id", (F.col("stage") + 1).alias("stage"))
    free = jobs.where("status = 'pending'")
    if max_retries is not None:
        free = free.where(F.col("retry_count") < max_retries)
    out = free.where("stage = 1").unionByName(free.where("stage > 1").join(done, ["video_id", "stage"], "left_semi"))
    return out.orderBy(F.desc("priority_score"), "discovered_at", "video_id").limit(limit) if limit else out


def _update(jobs: DataFrame, where: Column, **values: Column | None) -> DataFrame:
    kinds = dict(jobs.dtypes)
    return jobs.select(*(F.when(where, (values[c] if values[c] is not None else F.lit(None)).cast(kinds[c])).otherwise(F.col(c)).alias(c) if c in values else F.col(c) for c in jobs.columns))


#: Columns of a job beside its keys, and their types: see migrate.
JOB = {"status": "string", "retry_count": "bigint", "worker_id": "string", "started_at": "timestamp_ntz", "completed_at": "timestamp_ntz", "duration_seconds": "double", "error_message": "string", "metadata": "string"}


def start(jobs: DataFrame, picked: Column, worker: Column, now: Column) -> DataFrame:
    """Picked jobs that are pending go to a worker (compare and set): what an
    earlier run left is cleared. Picked jobs in another status stay, see refused."""
    return _update(jobs, picked & (F.col("status") == "pending"), status=F.lit("in_progress"), worker_id=worker, started_at=now, completed_at=None, duration_seconds=None, error_message=None)


def refused(jobs: DataFrame, picked: Column) -> DataFrame:
    """Picked jobs that start can't give out, since they are not pending."""
    return jobs.where(picked & (F.col("status") != "pending"))


def complete(jobs: DataFrame, picked: Column, now: Column, duration: Column | None = None, metadata: Column | None = None) -> DataFrame:
    """Picked jobs are done, whatever their status; a duration that is missing or 0
    is the time since the start, metadata a struct or map kept as JSON."""
    since = (F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    took = F.coalesce(F.nullif(duration.cast("double"), F.lit(0.0)), since) if duration is not None else since
    return _update(jobs, picked, status=F.lit("completed"), completed_at=now, duration_seconds=took, metadata=F.to_json(metadata) if metadata is not None else None)


def fail(jobs: DataFrame, picked: Column, retryable: Column, message: Column, now: Column) -> DataFrame:
    """Retryable failures wait again, others are final; either counts a retry and
    keeps the message."""
    return _update(jobs, picked, status=F.when(retryable, "pending").otherwise("failed"), error_message=message, completed_at=now, retry_count=F.col("retry_count") + 1)


#: What a message says when the file itself is at fault.
CORRUPT = ("Invalid data found when processing input", "appears corrupt or unreadable")


def corrupt(failed: DataFrame, videos: DataFrame) -> DataFrame:
    """Rows for the archive of corrupt videos: final failures (video_id, stage,
    error_message) whose message blames the file, with what is known of the video."""
    blamed = F.contains("error_message", F.lit(CORRUPT[0])) | F.contains("error_message", F.lit(CORRUPT[1]))
    return failed.where((F.col("status") == "failed") & blamed).select("video_id", "stage", "error_message").join(videos, "video_id")


def give_back(jobs: DataFrame, picked: Column) -> DataFrame:
    return _update(jobs, picked, status=F.lit("pending"), worker_id=None, started_at=None, completed_at=None)


def reset_stuck(jobs: DataFrame, before: Column) -> DataFrame:
    """Requeue jobs in progress that started before a time."""
    return _update(jobs, (F.col("status") == "in_progress") & F.coalesce(F.col("started_at") < before, F.lit(False)), status=F.lit("pending"), worker_id=None, started_at=None)


def reset_failed(jobs: DataFrame, stages=()) -> DataFrame:
    """Requeue failed jobs, of some stages or of all."""
    again = F.col("status") == "failed"
    return _update(jobs, again & F.col("stage").isin(*stages) if stages else again, status=F.lit("pending"), worker_id=None, started_at=None, completed_at=None)


# -- batches of a station and date ----------------------------------------------


def fetch_batches(batches: DataFrame, statuses=(), stations=(), first: str | None = None, last: str | None = None, limit: int | None = None) -> DataFrame:
    """Batches by status, station (in either case) and dates, both included, in
    order of date and station; what is empty or None does not restrict."""
    if statuses:
        batches = batches.where(F.col("status").isin(*statuses))
    if stations:
        batches = batches.where(F.col("station").isin(*(s.upper() for s in stations)))
    if first:
        batches = batches.where(F.col("date") >= first)
    if last:
        batches = batches.where(F.col("date") <= last)
    ordered = batches.orderBy("date", "station")
    return ordered.limit(limit) if limit else ordered


def start_batch(batches: DataFrame, picked: Column, now: Column) -> DataFrame:
    return _update(batches, picked, status=F.lit("in_progress"), started_at=now, completed_at=None, error_message=None)


def complete_batch(batches: DataFrame, picked: Column, created: Column, failed: Column, now: Column) -> DataFrame:
    return _update(batches, picked, status=F.lit("completed"), completed_at=now, clips_created=created, clips_failed=failed, error_message=None)


def fail_batch(batches: DataFrame, picked: Column, message: Column, now: Column) -> DataFrame:
    return _update(batches, picked, status=F.lit("failed"), completed_at=now, error_message=message)


def reset_batch(batches: DataFrame, picked: Column) -> DataFrame:
    return _update(batches, picked, status=F.lit("pending"), started_at=None, completed_at=None, error_message=None)


def all_done(jobs: DataFrame, last: int = 4) -> DataFrame:
    """One row: jobs of the last stage that are neither completed nor skipped, and whether there are none."""
    n = F.count_if((F.col("stage") == last) & ~F.col("status").isin("completed", "skipped"))
    return jobs.agg(n.alias("unfinished"), (n == 0).alias("all_done"))


def update_known(rows: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the non-null values of `changes`; keys without a row are ignored."""
    cols = [c for c in changes.columns if c not in keys]
    joined = rows.alias("r").join(changes.alias("c"), keys, "left")
    return joined.select(*keys, *(F.coalesce(F.col(f"c.{c}"), F.col(f"r.{c}")).alias(c) if c in cols else F.col(f"r.{c}") for c in rows.columns if c not in keys))


def priority(year: Column, day: Column, station: Column, year_weights: dict, station_weights: dict) -> Column:
    """1000 per year weight, 10 per station weight (first pattern that fits), and
    up to 1 for early days of the year."""
    years = F.coalesce(F.create_map(*(F.lit(x) for kv in year_weights.items() for x in kv))[year], F.lit(0))
    place = F.lit(0)
    for pattern, weight in reversed(list(station_weights.items())):
        place = F.when(F.contains(F.upper(station), F.lit(pattern.upper())), weight).otherwise(place)
    return years * 1000.0 + place * 10.0 + F.greatest(F.lit(0), 365 - (F.dayofyear(day) - 1)) / 365.0


def migrate(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Add missing columns as nulls."""
    return df.withColumns({c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns})
