"""Helpers that several training-data operators share."""

from __future__ import annotations

import hashlib
import tempfile
import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Stands for a null identifier where numbers are compared; no identifier is larger.
NO_ID = np.iinfo(np.int64).max

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_MULT = 0x9E3779B97F4A7C15
_BASE = 0x5851F42D4C957F2D
_MASK = (1 << 64) - 1


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, or,
    in local mode alone, a temporary one where that is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if spark.sparkContext.getCheckpointDir() is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-"))
    return spark.sparkContext.getCheckpointDir()


#: Paths given out inside each open `cleared` block.
_given: list[list[str]] = []


def scratch(spark: SparkSession, tag: str) -> str:
    """A fresh path in the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/tidemark/{tag}-{uuid.uuid4().hex}"
    for paths in _given:
        paths.append(path)
    return path


@contextmanager
def cleared(spark: SparkSession, *more: str):
    """Delete, at the end of a block, the scratch tables that it made, and `more`.
    What the block returns must have been written elsewhere by then."""
    paths = list(more)
    _given.append(paths)
    try:
        yield
    finally:
        _given.remove(paths)
        for path in paths:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def staged(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage and
    outlives lost executors."""
    path = path or scratch(df.sparkSession, tag)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_or_shuffled(df: DataFrame, rows: int, limit: int = 1_000_000) -> DataFrame:
    """Mark a counted table for broadcast if it has at most `limit` rows; beyond
    that the planner shuffles both sides."""
    return F.broadcast(df) if rows <= limit else df


def unused(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def without(docs: DataFrame, dropped: DataFrame, key: str = "doc_id") -> DataFrame:
    """`docs` less the identifiers in `dropped` (a staged table). Rows with a
    null identifier stay."""
    rows = dropped.count()
    gone = unused(docs, "_gone")
    ids = dropped.select(F.col(key).alias(gone))
    return docs.join(small_or_shuffled(ids, rows), F.col(key) == F.col(gone), "left_anti")


def sole(docs: DataFrame, ids: DataFrame, key: str = "doc_id") -> DataFrame:
    """Of identifiers `ids`, those that `docs` has once."""
    again = docs.groupBy(key).count().where("count > 1").select(key)
    return staged(ids.join(again, key, "left_anti"), "sole")


def partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


#: Rows of text in one Arrow batch. The frames that operators return run later, in
#: the caller's session, so its larger setting is lowered for good.
ARROW_ROWS = 2000


def bounded_batches(spark: SparkSession) -> None:
    """Hand texts to Python in batches of at most ARROW_ROWS, so that executors'
    memory does not follow the session's larger default."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, ARROW_ROWS)


def slices(batches, rows: int = ARROW_ROWS):
    """Batches of at most `rows`."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)


@contextmanager
def configured(spark: SparkSession, settings: dict[str, str]):
    """Session settings for the length of a block; what was there comes back."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def id_and_bytes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The two columns an operator needs, under fixed names; null text is empty."""
    bounded_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("text"),
    )


# -- Arrow and numpy ---------------------------------------------------------


def flat(column) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a binary column, and the offset of each value (one more at
    the end). Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays([c.cast(pa.large_binary()) for c in column.chunks]) if column.num_chunks else pa.array([], pa.large_binary())
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def ids_of(column) -> np.ndarray:
    """Identifiers as int64, null as NO_ID."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.cast(pa.int64()).fill_null(NO_ID).to_numpy(zero_copy_only=False)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words `[^\\x20\\x09-\\x0D]+` of concatenated texts: start and end of each,
    and for each text the index of its first word (one more at the end)."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    word = ~_SPACE[data]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    edge = offsets[1:-1]
    begins = edge[edge < len(data)]
    first[begins] = word[begins]
    ends = edge[edge > 0] - 1
    last[ends] = word[ends]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, offsets)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (new array)."""
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(_MULT)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    out = np.full(max(n, 1), base & _MASK, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the hash base and of its inverse, grown on demand."""

    def __init__(self, base: int = _BASE):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up, self.down = powers(base, 1), powers(self.inverse, 1)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            n = 1 << (n - 1).bit_length()
            self.up, self.down = powers(self.base, n), powers(self.inverse, n)
        return self.up, self.down


def prefix_hashes(values: np.ndarray, up: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of (value+1)*base**position over i <= position < j."""
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=out[1:])
    return out


_HEADS = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes: eight at a time, of words over 64 bytes
    by BLAKE2b. Whoever draws conclusions from equal hashes compares the bytes."""
    size = ends - starts
    out = size.astype(np.uint64)
    if not len(starts):
        return out
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, 0, (1,))  # the eight bytes from each place on
    at, left, live = starts, size, np.arange(len(starts))
    for _ in range(8):
        out[live] = mix(out[live] ^ (eight[at] & _HEADS[np.minimum(left, 8)])) * np.uint64(_BASE)
        more = left > 8
        at, left, live = at[more] + 8, left[more] - 8, live[more]
        if not len(live):
            break
    for i in live.tolist():
        out[i] = int.from_bytes(hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


# -- equal stretches -----------------------------------------------------------


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices of all symbols of the stretches, end to end."""
    begin = np.cumsum(lengths) - lengths
    return np.repeat(starts - begin, lengths) + np.arange(int(lengths.sum()))


def portions(sizes: np.ndarray, most: int):
    """Slices of neighbours of some `most` symbols in all."""
    ends, k = np.cumsum(sizes), 0
    while k < len(sizes):
        to = max(k + 1, int(np.searchsorted(ends, (int(ends[k - 1]) if k else 0) + most, "right")))
        yield slice(k, to)
        k = to


def same_stretches(symbols: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each i, whether symbols[a[i] : a[i] + size[i]] equals the stretch at b[i]; sizes are positive."""
    out = np.ones(len(a), bool)
    for s in portions(size, 1 << 19):
        n = size[s]
        differ = symbols[gather(a[s], n)] != symbols[gather(b[s], n)]
        out[s] = ~np.logical_or.reduceat(differ, np.cumsum(n) - n)
    return out


def same_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each i, whether the size[i] words from word a[i] on equal those from word b[i] on, as bytes."""
    out = np.ones(len(a), bool)
    for s in portions(size, 1 << 16):
        n = size[s]
        x, y = gather(a[s], n), gather(b[s], n)
        same = ends[x] - starts[x] == ends[y] - starts[y]
        alike = np.flatnonzero(same)
        x, y = x[alike], y[alike]
        same[alike] = same_stretches(data, starts[x], starts[y], ends[x] - starts[x])
        out[s] = np.logical_and.reduceat(same, np.cumsum(n) - n)
    return out


def classes(key: np.ndarray, equal) -> np.ndarray:
    """For each item the number of the first one that it is equal to. Items meet
    by key; equal(some, others) compares them in full, so chance equals of a key
    stay apart."""
    first = np.arange(len(key))
    rest = first.copy()
    while len(rest):
        order = rest[np.argsort(key[rest], kind="stable")]
        new = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
        head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))][~new]
        member = order[~new]
        ok = equal(member, head)
        first[member[ok]] = head[ok]
        rest = np.sort(member[~ok])
    return first
