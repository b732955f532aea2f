"""Exact duplicates by stateful streaming (operator 10).

A stream of (key, identifier, locator) rows is folded into keyed state that has
no watermark and so never expires: per digest the surviving identifier, the
file that holds its content, and a count. The state is a RocksDB store on the
executors' disks, saved to the shared folder; text never enters it. Hits are
then confirmed on whole texts: the content of the survivor is fetched by its
locator and compared with every member of its group. Groups in which bytes
differ, or whose content is not where the locator says, are grouped anew by
their texts, so no verdict rests on a digest.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from tidemark.llm.common import configured, flat, id_and_bytes, scratch, slices, small_or_shuffled, staged, unused

_STREAM = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # small stores would each reserve several megabytes of disk for their logs
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    # all stores of an executor share this much memory
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "200",
}


def _digests(column) -> list[bytes]:
    data, offsets = flat(column)
    raw = data.tobytes()
    return [hashlib.sha256(raw[a:b].lower()).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]  # bytes.lower() maps A-Z only


def _digest_batches(batches):
    """Add a column of SHA-256 digests of the lower-cased `text` (the second column)."""
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(_digests(batch.column(1)), pa.binary()), batch.column(2).cast(pa.string())], names=["doc_id", "digest", "file"])


def _text_batches(batches, key_bytes):
    """(doc_id, key, text, file) with text lower-cased."""
    for batch in slices(batches):
        texts = [(t or b"").lower() for t in batch.column(1).to_pylist()]
        keys = [hashlib.sha256(t).digest()[:key_bytes] for t in texts]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(keys, pa.binary()), pa.array(texts, pa.binary()), batch.column(2)], names=["doc_id", "key", "text", "file"])


def _distinct_batches(batches):
    """Each row of a batch once."""
    for batch in batches:
        rows = dict.fromkeys(zip(*(c.to_pylist() for c in batch.columns)))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), batch.schema.types)], names=batch.schema.names)


def fold_stream(rows: DataFrame, checkpoint: str, out: str) -> None:
    """Fold a stream of (doc_id, key, file) rows into the state until no input is
    left. Each micro-batch writes the entries that it changed; a repeated
    micro-batch overwrites its own files, so a restart from `checkpoint` is safe."""
    state = rows.groupBy("key").agg(F.max(F.struct("doc_id", "file")).alias("kept"), F.count("*").alias("group_size"))

    def save(changed: DataFrame, batch: int) -> None:
        changed.withColumn("batch", F.lit(batch)).write.mode("overwrite").parquet(f"{out}/part={batch}")

    with configured(rows.sparkSession, _STREAM):
        query = state.writeStream.outputMode("update").option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(save).start()
        query.awaitTermination()


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", key_bytes: int = 32) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z; the largest doc_id
    of a group stays. Null text is empty. A null identifier is smaller than any
    other, so it stays only in a group without one (kept is then true). Rows
    that repeat an identifier and its text are the same document: each counts
    in group_size and all share one verdict; rows that repeat an identifier
    with another text are documents of their own. The state is keyed by the
    first `key_bytes` bytes of the digest; the result doesn't depend on them.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    narrow = id_and_bytes(docs, id_col, text_col)
    located = narrow.withColumn("file", F.input_file_name())
    key = F.substring("digest", 1, key_bytes).alias("key")
    rows = staged(located.mapInArrow(_digest_batches, "doc_id long, digest binary, file string"), "digests")
    out = scratch(spark, "exact-state")
    source = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 10_000).parquet(rows.inputFiles()[0].rpartition("/")[0])
    fold_stream(source.select("doc_id", key, "file"), scratch(spark, "exact-checkpoint"), out)
    verdict = ("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))
    if not rows.head(1):
        return rows.withColumn("keep_id", F.col("doc_id")).withColumn("group_size", F.lit(0).cast("long")).select(*verdict)
    state = spark.read.parquet(out).groupBy("key").agg(F.max_by(F.struct("kept", "group_size"), "batch").alias("s"))
    state = staged(state.selectExpr("key", "s.kept.doc_id keep_id", "s.kept.file kept_file", "s.group_size"), "exact-entries")
    own = rows.select("doc_id", "digest", key)
    # a group with over 1/100,000 of the rows is hot; there are at most 100,000 of them
    hot = max(1000, rows.count() // 100_000)
    entries = state.select("key", "keep_id", "group_size")
    many, few = F.broadcast(entries.where(F.col("group_size") > hot)), entries.where(F.col("group_size") <= hot)
    joined = own.join(many, "key").unionByName(own.join(many, "key", "left_anti").join(few, "key"))
    bad = _unconfirmed(located, state.where("group_size > 1"), key_bytes)
    n = bad.count()
    if n:
        bad = small_or_shuffled(bad, n)
        texts = located.mapInArrow(lambda b: _sized_batches(b, key_bytes), "doc_id long, digest binary, key binary, text binary").join(bad, "key")
        groups = texts.groupBy("key", "text").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        joined = joined.join(bad, "key", "left_anti").unionByName(texts.join(groups, ["key", "text"]).select("key", "doc_id", "digest", "keep_id", "group_size"))
    return joined.select(*verdict)


def _sized_batches(batches, key_bytes):
    """Every row as (doc_id, digest, key, lower-cased text)."""
    for batch in slices(batches):
        digests = _digests(batch.column(1))
        texts = [(t or b"").lower() for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(digests, pa.binary()), pa.array([d[:key_bytes] for d in digests], pa.binary()), pa.array(texts, pa.binary())], names=["doc_id", "digest", "key", "text"])


def _unconfirmed(located: DataFrame, hits: DataFrame, key_bytes: int) -> DataFrame:
    """Keys of the groups with a member whose bytes are not those that the
    group's locator leads to.

    Only texts of groups with several members are moved, and equal texts of a
    batch once. Members meet the survivor's text in an equi-join of which Spark
    can split a hot key.
    """
    groups = hits.select(F.col("key").alias("hit"), "keep_id", "kept_file")
    found = located.mapInArrow(lambda b: _text_batches(b, key_bytes), "doc_id long, key binary, text binary, file string")
    found = found.join(small_or_shuffled(groups, groups.count()), F.col("key") == F.col("hit"))
    there = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.col("file").eqNullSafe(F.col("kept_file"))
    found = found.select("key", "text", there.alias("survivor"))
    found = staged(found.mapInArrow(_distinct_batches, found.schema), "exact-hits")
    kept = found.where("survivor").dropDuplicates(["key"]).select("key", F.col("text").alias("kept_text"))
    return staged(found.join(kept, "key", "left").where("not (text <=> kept_text)").select("key").distinct(), "exact-unconfirmed")


def _marked_batches(batches, column, name):
    for batch in slices(batches):
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(_digests(batch.column(column).cast(pa.binary())), pa.binary())], names=[*batch.schema.names, name])


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one row of each group of equal texts, of the largest identifier.

    A row goes by its identifier and text, so another text of the same
    identifier is left alone. Of rows that repeat the surviving identifier and
    text, any one stays.
    """
    verdicts = exact_dedup(docs, id_col, text_col).groupBy("doc_id", "text_sha256").agg(F.min("kept").alias("kept"), F.count("*").alias("rows"))
    mark, copy, of, kept, column = *(unused(docs, x) for x in ("_digest", "_copy", "_of", "_kept")), docs.columns.index(text_col)
    verdicts = staged(verdicts.where("not kept or rows > 1").select(F.col("doc_id").alias(copy), F.unhex("text_sha256").alias(of), F.col("kept").alias(kept)), "exact-gone")
    schema = StructType([*docs.schema.fields, StructField(mark, BinaryType())])
    marked = docs.mapInArrow(lambda b: _marked_batches(b, column, mark), schema)

    def said(kept_too):
        some = verdicts.where(F.col(kept) == kept_too).drop(kept)
        return small_or_shuffled(some, some.count()), F.col(id_col).cast("long").eqNullSafe(F.col(copy)) & (F.col(mark) == F.col(of))

    rest = marked.join(*said(False), "left_anti")
    if verdicts.where(kept).head(1):
        one = rest.join(*said(True), "left_semi").dropDuplicates([id_col, mark])
        rest = rest.join(*said(True), "left_anti").unionByName(one)
    return rest.drop(mark)
