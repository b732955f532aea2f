"""Conflict-constrained best-fit packing (operator 5).

Texts are dealt to shards of bounded size; a shard packs its pieces, longest
first, into bins that carry a bitmap of their sources and one of their
duplicate clusters. Bins are ordered by what is left in them: the search starts
at the least remainder that holds the piece and goes on to larger ones until a
bin without a common bit is found.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, flat, slices, words_of

CAPACITY = 2048
#: Texts that one shard holds at most, on average; a shard is packed in one task.
SHARD = 4096
_OUT = "doc_id long, piece int, bin_id string, start long, n_tokens long, source string"


def _measure_batches(batches):
    """(doc_id, source, length in words, digest of the lower-cased words)."""
    for batch in slices(batches):
        data, offsets = flat(batch.column(2))
        raw = data.tobytes()
        _, _, begin = words_of(data, offsets)
        marks = [hashlib.blake2b(b" ".join(raw[a:b].lower().split()), digest_size=8).digest() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1).cast(pa.string()), pa.array(np.diff(begin)), pa.array(np.frombuffer(b"".join(marks), np.int64).copy())], names=["doc_id", "source", "n_tokens", "cluster"])


def best_fit(lengths: np.ndarray, sources: np.ndarray, clusters: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and place in the bin of each piece, taken in the order given.

    sources and clusters are numbers from 0; -1 is in conflict with nothing.
    Each piece goes to the fullest bin that holds it and has no piece of its
    source or cluster; of equally full ones, to the oldest.
    """
    n = len(lengths)
    wide_s, wide_c = int(sources.max(initial=-1)) // 64 + 1, int(clusters.max(initial=-1)) // 64 + 1
    left = np.empty(n, np.int64)  # remainders in order, with the bins they belong to
    owner = np.empty(n, np.int64)
    has_s, has_c = np.zeros((wide_s + 1, n), np.uint64), np.zeros((wide_c + 1, n), np.uint64)
    bin_of, start, bins = np.empty(n, np.int64), np.zeros(n, np.int64), 0
    open_ = 0
    for i in range(n):
        need, s, c = int(lengths[i]), int(sources[i]), int(clusters[i])
        bit_s, bit_c = np.uint64(1 << (s & 63)), np.uint64(1 << (c & 63))
        row_s, row_c = (s >> 6) if s >= 0 else wide_s, (c >> 6) if c >= 0 else wide_c
        at, chosen, step = int(np.searchsorted(left[:open_], need)), -1, 64
        while at < open_:
            to = min(open_, at + step)
            bad = (has_s[row_s, owner[at:to]] & bit_s) | (has_c[row_c, owner[at:to]] & bit_c)
            free = np.flatnonzero(bad == 0)
            if len(free):
                chosen = at + int(free[0])
                break
            at, step = to, step * 4
        if chosen >= 0:
            b, rest = int(owner[chosen]), int(left[chosen]) - need
            start[i] = capacity - left[chosen]
            left[chosen : open_ - 1] = left[chosen + 1 : open_]
            owner[chosen : open_ - 1] = owner[chosen + 1 : open_]
            open_ -= 1
        else:
            b, rest = bins, capacity - need
            bins += 1
        if s >= 0:
            has_s[row_s, b] |= bit_s
        if c >= 0:
            has_c[row_c, b] |= bit_c
        bin_of[i] = b
        lo, hi = int(np.searchsorted(left[:open_], rest, "left")), int(np.searchsorted(left[:open_], rest, "right"))
        place = lo + int(np.searchsorted(owner[lo:hi], b))  # equal remainders: older bins first
        left[place + 1 : open_ + 1] = left[place:open_].copy()
        owner[place + 1 : open_ + 1] = owner[place:open_].copy()
        left[place], owner[place] = rest, b
        open_ += 1
    return bin_of, start


def _numbered(values: np.ndarray, single: bool) -> np.ndarray:
    """Dense numbers; -1 for values that occur once (where `single`)."""
    _, inverse, count = np.unique(values, return_inverse=True, return_counts=True)
    if not single:
        return inverse
    many = count > 1
    return np.where(many[inverse], (np.cumsum(many) - 1)[inverse], -1)


def _pack_shard(key, table: pa.Table, capacity: int) -> pa.Table:
    table = table.sort_by([("doc_id", "ascending"), ("cluster", "ascending"), ("n_tokens", "ascending"), ("source", "ascending")])
    shard = key[0].as_py()
    table = table.take(pa.array(np.repeat(np.arange(table.num_rows), table.column("copies").to_numpy())))
    n = table.column("n_tokens").to_numpy()
    source = np.array([s if s is not None else "" for s in table.column("source").to_pylist()], object)
    known = np.array([s is not None for s in table.column("source").to_pylist()], bool)
    pieces = np.maximum(-(-n // capacity), 1)
    row = np.repeat(np.arange(len(n)), pieces)
    piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    length = np.minimum(n[row] - piece * capacity, capacity)
    # two texts with equal words never share a bin; nor do two pieces of one text
    sources = np.where(known, _numbered(source.astype(str), False), -1) if len(n) else np.zeros(0, int)
    clusters = _numbered(table.column("cluster").to_numpy()[row], True)
    order = np.lexsort((np.arange(len(row)), -length))
    bin_of, start = best_fit(length[order], sources[row][order], clusters[order], capacity)
    ids = table.column("doc_id").combine_chunks()
    return pa.table({
        "doc_id": ids.take(pa.array(row[order])),
        "piece": pa.array(piece[order].astype(np.int32)),
        "bin_id": pa.array([f"{shard}-{b}" for b in bin_of.tolist()], pa.string()),
        "start": pa.array(start),
        "n_tokens": pa.array(length[order]),
        "source": table.column("source").combine_chunks().cast(pa.string()).take(pa.array(row[order])),
    })


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", capacity: int = CAPACITY) -> DataFrame:
    """A row for each piece of a text: doc_id, piece, bin_id, start, n_tokens, source.

    Lengths count words (runs without white space); a text longer than
    `capacity` is cut into pieces of that length and a rest, an empty or null one is
    one piece of length 0. A bin holds at most `capacity` words, at most one
    piece of a source and at most one of a duplicate cluster (equal lower-cased
    words). Rows are dealt to shards by a hash of identifier, words and, where
    equal rows are many, portions of SHARD of them, so a hot source, cluster or
    row is spread. Null sources are in conflict with none; a null
    identifier is kept; repeated rows are one cluster; other columns are
    ignored; an empty table gives none.
    """
    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.coalesce(F.col(text_col).cast("string").cast("binary"), F.lit(b"")).alias("text"))
    bounded_batches(docs.sparkSession)
    rows = docs.count()
    shards = max(1, -(-rows // SHARD))
    sized = narrow.mapInArrow(_measure_batches, "doc_id long, source string, n_tokens long, cluster long")
    counted = sized.groupBy("doc_id", "source", "n_tokens", "cluster").agg(F.count("*").alias("n"))
    portions = counted.withColumn("portion", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / SHARD))))
    portions = portions.withColumn("copies", F.least(F.lit(SHARD).cast("long"), F.col("n") - F.col("portion") * SHARD))
    dealt = portions.withColumn("shard", F.pmod(F.xxhash64("doc_id", "cluster", "portion"), F.lit(shards))).drop("n", "portion")
    return dealt.groupBy("shard").applyInArrow(lambda key, table: _pack_shard(key, table, capacity), _OUT)
