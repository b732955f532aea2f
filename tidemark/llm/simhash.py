"""SimHash near-duplicates by multi-index hashing (operator 7).

A 64-bit fingerprint has two segments of 32 bits. If two fingerprints differ in
at most 3 bits, one segment differs in at most one. So each fingerprint is put
into one table per segment under its own value, and looks up the Hamming ball
of radius 1 around that value: itself and, since of two values that differ in
one bit exactly one has it set, the values with one set bit cleared. What meets
under a key is verified on the complete distance.

A value that more than HOT_HALF fingerprints have is hot, and so are the values
in reach of its balls. Rows under a hot key are dealt out anew by the bytes of
their other segment: it differs in at most 3 bits, so one of its 4 bytes is
equal, and no link is lost. Any other key has at most 33 * HOT_HALF rows.
"""

from __future__ import annotations

from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat, id_and_bytes, ids_of, partitions, slices, small_or_shuffled, sole, staged, without
from tidemark.llm.components import components

SEED = 42
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Hashes summed at once; 16-bit counters hold this many.
_RUN = 60_000
#: Fingerprints that may share one segment before its rows are dealt out anew.
HOT_HALF = 1024


def _shingle_hashes(text: bytes, width: int):
    """XXH64 of each shingle, in arrays of at most _RUN."""
    words = text.translate(_LOWER).split()  # bytes.split() parts at \x20 and \x09-\x0D
    if not words:
        return
    if len(words) <= width:
        yield np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], np.uint64)
        return
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-width] + 1])
    ends = ends[width - 1 :]
    del words
    for k in range(0, len(starts), _RUN):
        a, b = starts[k : k + _RUN].tolist(), ends[k : k + _RUN].tolist()
        yield np.fromiter(map(xxhash.xxh64_intdigest, map(joined.__getitem__, map(slice, a, b)), repeat(SEED)), np.uint64, len(a))


def majorities(hashes: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """uint64 fingerprint of each of n owners from hashes in order of owner: a bit is 1
    if set in over half of them."""
    counts, totals = np.zeros((n, 64), np.int64), np.bincount(owner, minlength=n)
    if len(hashes):
        place = np.arange(len(hashes)) - np.repeat((np.cumsum(totals) - totals)[totals > 0], totals[totals > 0])
        begins = np.flatnonzero(place % _RUN == 0)
        np.add.at(counts, owner[begins], _bit_counts(hashes, begins))
    return ((counts * 2 > totals[:, None]).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _bit_counts(hashes: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """For each run of hashes (at most _RUN), how many have each of the 64 bits."""
    out, lane = np.empty((len(begins), 64), np.int64), np.uint64(0x0001000100010001)
    for bit in range(16):
        sums = np.add.reduceat((hashes >> np.uint64(bit)) & lane, begins)
        for part in range(4):
            out[:, 16 * part + bit] = (sums >> np.uint64(16 * part)) & np.uint64(0xFFFF)
    return out


def fingerprints(texts, width: int = 3) -> np.ndarray:
    """uint64 fingerprint of each text (bytes)."""
    counts, totals = np.zeros((len(texts), 64), np.int64), np.zeros(len(texts), np.int64)
    held, owner, size = [], [], 0

    def add():
        nonlocal held, owner, size
        if held:
            begins = np.cumsum([0] + [len(x) for x in held[:-1]])
            np.add.at(counts, owner, _bit_counts(np.concatenate(held), begins))
            np.add.at(totals, owner, [len(x) for x in held])
        held, owner, size = [], [], 0

    for i, text in enumerate(texts):
        for hashes in _shingle_hashes(text, width):
            held.append(hashes)
            owner.append(i)
            size += len(hashes)
        if size > 4 * _RUN:
            add()
    add()
    bits = counts * 2 > totals[:, None]
    return (bits.astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def _fingerprint_batches(batches, width):
    for batch in slices(batches):
        data, offsets = flat(batch.column(1))
        raw = data.tobytes()
        found = fingerprints([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())], width)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(found.view(np.int64))], names=["doc_id", "fp"])


def _probe_batches(batches):
    """(key, fp, node, own): a table entry (own) and the ball's other keys, per segment."""
    for batch in batches:
        fp, node = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), ids_of(batch.column(1))
        for k in range(0, len(fp), 20_000):
            f, n = fp[k : k + 20_000], node[k : k + 20_000]
            rows = []
            for segment in range(2):
                value = (f >> np.uint64(32 * segment)) & np.uint64(0xFFFFFFFF)
                base = np.uint64(segment << 32)
                rows.append((value | base, f, n, np.ones(len(f), bool)))
                for bit in range(32):
                    has = (value >> np.uint64(bit)) & np.uint64(1) == 1
                    rows.append(((value[has] & ~np.uint64(1 << bit)) | base, f[has], n[has], np.zeros(has.sum(), bool)))
            key, f2, n2, own = (np.concatenate(x) for x in zip(*rows))
            yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(f2.view(np.int64)), pa.array(n2), pa.array(own)], names=["key", "fp", "node", "own"])


def _spanning(fp: np.ndarray, node: np.ndarray, most: int):
    """Edges of a spanning forest of the links among one key's fingerprints, by
    breadth-first search: memory in proportion to the group, no list of pairs."""
    left, u, v = np.arange(len(fp)), [], []
    while len(left):
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(fp[left] ^ fp[at]) <= most
            if near.any():
                new = left[near]
                u.append(np.full(len(new), node[at]))
                v.append(node[new])
                front.extend(new.tolist())
                left = left[~near]
    return (np.concatenate(u), np.concatenate(v)) if u else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def _link_batches(batches, most):
    parts = [(ids_of(b.column(0)), ids_of(b.column(1)).view(np.uint64), ids_of(b.column(2)), b.column(3).to_numpy(zero_copy_only=False)) for b in batches]
    if not parts:
        return
    key, fp, node, own = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.argsort(key, kind="stable")
    key, fp, node, own = key[order], fp[order], node[order], own[order]
    begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    size = np.diff(np.append(begin, len(key)))
    use = (size > 1) & np.logical_or.reduceat(own, begin)
    begin, size = begin[use], size[use]
    us, vs = [], []
    for n in range(2, 9):  # small groups, all of one size at once
        at = begin[size == n]
        for i in range(n):
            for j in range(i + 1, n):
                near = np.bitwise_count(fp[at + i] ^ fp[at + j]) <= most
                us.append(node[at + i][near])
                vs.append(node[at + j][near])
    for b, n in zip(begin[size > 8].tolist(), size[size > 8].tolist()):
        u, v = _spanning(fp[b : b + n], node[b : b + n], most)
        us.append(u)
        vs.append(v)
    if us:
        u, v = np.concatenate(us), np.concatenate(vs)
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _dealt(probes: DataFrame, nodes: DataFrame, hot_half: int) -> DataFrame:
    """`probes` with `deal`, the key to meet under: a hot key's rows get one per
    byte of the other segment, all others the key alone."""
    plain = F.lit(0)
    halves = nodes.select(F.explode(F.array(F.expr("fp & 4294967295L"), F.expr("shiftrightunsigned(fp, 32) | 4294967296L"))).alias("half"))
    hot = halves.groupBy("half").count().where(F.col("count") > hot_half).select("half")
    cleared = F.transform(F.sequence(F.lit(0), F.lit(31)), lambda b: F.col("half").bitwiseAND(F.bitwise_not(F.call_function("shiftleft", F.lit(1).cast("long"), b))))
    reach = staged(hot.select(F.explode(F.array_union(F.array("half"), cleared)).alias("hot")).distinct(), "simhash-hot")
    rows = reach.count()
    if rows:
        probes = probes.join(small_or_shuffled(reach, rows), F.col("key") == F.col("hot"), "left")
        other = F.expr("if(key < 4294967296L, shiftrightunsigned(fp, 32), fp & 4294967295L)")
        subs = F.array(*[F.lit(1 + 256 * j) + F.expr("shiftrightunsigned(_o, %d) & 255L" % (8 * j)).cast("int") for j in range(4)])
        probes = probes.withColumn("_o", other).withColumn("_s", F.explode(F.when(F.col("hot").isNull(), F.array(plain)).otherwise(subs)))
    else:
        probes = probes.withColumn("_s", plain)
    return probes.select((F.col("key") * 2048 + F.col("_s")).alias("deal"), "fp", "node", "own")


def linked(prints: DataFrame, most: int, hot_half: int = HOT_HALF) -> tuple[DataFrame, DataFrame]:
    """Of staged fingerprints (doc_id, fp): the smallest identifier of each, its node
    (fp, node), and links (u, v) between nodes that connect what `most` or fewer
    differing bits connect."""
    if most > 3:
        raise ValueError("two segments with balls of radius 1 find up to 3 differing bits")
    nodes = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    probes = _dealt(nodes.mapInArrow(_probe_batches, "key long, fp long, node long, own boolean"), nodes, hot_half)
    links = probes.repartition(partitions(prints.sparkSession), "deal").mapInArrow(lambda b: _link_batches(b, most), "u long, v long")
    return nodes, links


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3, hot_half: int = HOT_HALF) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id.

    Words are runs without ASCII white space, A-Z lower-cased; the fingerprint
    is over all `width`-word shingles (shorter texts: all words; empty or null
    ones: zero, linked like any other). Fingerprints link at `most` or fewer
    differing bits (at most 3); component_id is the smallest reachable doc_id.
    Equal fingerprints are one node, so copies are never paired. A row with a
    null identifier takes the component of its fingerprint, null if no other
    document is in it. Other columns are ignored; an empty table gives none.
    """
    prints = staged(id_and_bytes(docs, id_col, text_col).mapInArrow(lambda b: _fingerprint_batches(b, width), "doc_id long, fp long"), "simhash")
    nodes, links = linked(prints, most, hot_half)
    whole = components(links)
    named = nodes.join(whole, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return prints.join(named, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group: the one with the smallest id. Rows
    with a null identifier stay, and so do rows of an identifier that repeats."""
    found = simhash_groups(docs, id_col, text_col)
    gone = staged(found.where("doc_id <> component_id").select(F.col("doc_id").alias(id_col)).distinct(), "simhash-gone")
    return without(docs, sole(docs, gone, id_col), id_col)
