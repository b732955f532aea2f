"""Meeting places for equal windows of a fixed length.

Of each window of symbols (bytes or words) the leftmost least gram, by hash, is
its anchor. Anchors depend on a window's content alone, so equal windows have
equal anchor grams, wherever they stand. The windows of one anchor are
neighbours; the stretch that they cover is a fragment. Every window lies in
exactly one fragment.

Texts are dealt to blocks. Three exchanges of packed numpy arrays follow:
blocks send their anchor grams to buckets and learn which occur elsewhere;
they send the distinct fragments of those to buckets, where an operator
compares them; what it finds goes back to the blocks, which apply it. Text
crosses the network once, and equal fragments of a block count as one, so a
group of copies of any size sends no more than one fragment per block.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Powers, gather, id_and_bytes, mix, partitions

#: Symbols whose windows are looked at together; a longer text is cut at multiples of it.
SEGMENT = 1 << 16
#: Bytes of text in one block, on average; blocks grow in number with the corpus.
BLOCK_BYTES = 32 << 20
#: Buckets are written in 16 bits.
MOST_BUCKETS = (1 << 16) - 1
_LOW48 = np.uint64((1 << 48) - 1)


def _leftmost_least(values: np.ndarray, width: int) -> np.ndarray:
    """For each i, the position of the first minimum, by the upper 32 bits, of
    values[i : i + width]. The position rides in the lower bits."""
    low = values & np.uint64(0xFFFFFFFF00000000)
    low |= np.arange(len(values), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        low = np.minimum(low[span:], low[:-span])
        span *= 2
    if width > span:
        low = np.minimum(low[width - span :], low[: span - width])
    return low.astype(np.uint32)


def _segments(offsets: np.ndarray):
    """(begin, end) of stretches of window starts: whole texts, or pieces of a long one."""
    n, k = len(offsets) - 1, 0
    while k < n:
        begin = int(offsets[k])
        if offsets[k + 1] - begin > SEGMENT:
            for at in range(begin, int(offsets[k + 1]), SEGMENT):
                yield at, min(at + SEGMENT, int(offsets[k + 1]))
            k += 1
        else:
            k = max(k + 1, int(np.searchsorted(offsets, begin + SEGMENT, "right")) - 1)
            yield begin, int(offsets[k])


def fragments(symbols: np.ndarray, offsets: np.ndarray, window: int, gram: int, pw: Powers):
    """Arrays over the fragments of concatenated texts:

    first and last window start, distance from each of these to the anchor
    (far, near), hash of the anchor gram, hash of the fragment with its anchor.
    """
    out = []
    width = window - gram + 1
    for begin, end in _segments(offsets):
        stop = min(end + window - 1, len(symbols))
        n = stop - begin
        if n < window:
            continue
        up, down = pw.to(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((symbols[begin:stop].astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        grams = mix((sums[gram:] - sums[:-gram]) * down[: n - gram + 1])
        anchor = _leftmost_least(grams, width)
        count = min(len(anchor), end - begin)
        anchor = anchor[:count]
        valid = np.ones(count, bool)
        k = int(np.searchsorted(offsets, begin, "right"))
        while k < len(offsets) and offsets[k] - window < end:
            bound = int(offsets[k]) - begin
            valid[max(bound - window + 1, int(offsets[k - 1]) - begin, 0) : max(bound, 0)] = False
            k += 1
        starts = valid.copy()
        starts[1:] &= ~valid[:-1] | (anchor[1:] != anchor[:-1])
        ends = valid.copy()
        ends[:-1] &= ~valid[1:] | (anchor[1:] != anchor[:-1])
        p1, p2 = np.flatnonzero(starts), np.flatnonzero(ends)
        a = anchor[p1].astype(np.int64)
        h = grams[a]
        far, near = a - p1, a - p2
        key = mix(mix((sums[p2 + window] - sums[p1]) * down[p1]) + h * np.uint64(3) + (far * 1024 + near).astype(np.uint64))
        out.append((p1 + begin, p2 + begin, far, near, h, key))
    if not out:
        z, u = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        return z, z, z, z, u, u
    return tuple(np.concatenate(x) for x in zip(*out))


def bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64)


# -- packing arrays into binary cells -----------------------------------------


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays end to end, with their types and lengths, compressed."""
    head = ";".join(f"{a.dtype.str},{len(a)}" for a in arrays).encode()
    body = head + b"\n" + b"".join(np.ascontiguousarray(a).tobytes() for a in arrays)
    return len(body).to_bytes(8, "little") + pa.compress(body, codec="zstd", asbytes=True)


def unpacked(cell: bytes) -> list[np.ndarray]:
    body = pa.decompress(cell[8:], decompressed_size=int.from_bytes(cell[:8], "little"), codec="zstd", asbytes=True)
    at = body.index(b"\n")
    head, at = body[:at].decode(), at + 1
    out = []
    for part in head.split(";"):
        kind, n = part.split(",")
        out.append(np.frombuffer(body, np.dtype(kind), int(n), at))
        at += out[-1].nbytes
    return out


def _cells(rows, names) -> pa.Table:
    a, b, cells = zip(*rows) if rows else ((), (), ())
    return pa.table({names[0]: pa.array(a, pa.int32()), names[1]: pa.array(b, pa.int32()), "cell": pa.array(cells, pa.binary())})


def _six(values: np.ndarray) -> np.ndarray:
    """The low 48 bits of each value, as bytes."""
    return np.ascontiguousarray(np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8)[:, :6]).reshape(-1)


def _from_six(raw: np.ndarray) -> np.ndarray:
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = raw.reshape(-1, 6)
    return out.reshape(-1).view(np.uint64)


# -- the exchanges --------------------------------------------------------------


def _prints(h: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket (upper 16 bits) and 48 bits of each gram's hash; chance equals only
    let a fragment be compared in vain."""
    return bucket_of(h, buckets).astype(np.uint64) << np.uint64(48) | h & _LOW48


def _edges(prints: np.ndarray, buckets: int) -> np.ndarray:
    return np.searchsorted(prints, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(48))


def send_grams(block: int, h: np.ndarray, owner: np.ndarray, buckets: int) -> pa.Table:
    """Rows (bucket, block, cell): prints of the block's grams, and a bit for
    each that has more than one owner here."""
    every = _prints(h, buckets)
    order, group = distinct_keys(every)
    if not len(group):
        return _cells([], ("bucket", "block"))
    own, distinct = owner[order], every[order[group]]
    many = np.minimum.reduceat(own, group) != np.maximum.reduceat(own, group)
    begin = _edges(distinct, buckets)
    rows = []
    for b in np.flatnonzero(np.diff(begin)).tolist():
        part = slice(begin[b], begin[b + 1])
        rows.append((b, block, int(begin[b + 1] - begin[b]).to_bytes(4, "little") + _six(distinct[part]).tobytes() + np.packbits(many[part]).tobytes()))
    return _cells(rows, ("bucket", "block"))


def shared_grams(table: pa.Table) -> pa.Table:
    """Of one bucket: rows (block, bucket, cell) with a bit for each print that
    another block has too, or that has several owners."""
    bucket = table.column("bucket")[0].as_py()
    blocks, cells = table.column("block").to_pylist(), table.column("cell").to_pylist()
    prints, many = [], []
    for c in cells:
        n = int.from_bytes(c[:4], "little")
        prints.append(_from_six(np.frombuffer(c, np.uint8, 6 * n, 4)))
        many.append(np.unpackbits(np.frombuffer(c, np.uint8, -1, 4 + 6 * n), count=n).astype(bool))
    every = np.concatenate(prints)
    every.sort()
    twice = np.unique(np.concatenate([every[1:][every[1:] == every[:-1]], *(p[m] for p, m in zip(prints, many))]))
    rows = []
    for block, p in zip(blocks, prints):
        if len(twice):
            at = np.minimum(np.searchsorted(twice, p), len(twice) - 1)
            rows.append((block, bucket, np.packbits(twice[at] == p).tobytes()))
    return _cells(rows, ("block", "bucket"))


def wanted(h: np.ndarray, answers: pa.Table, buckets: int) -> np.ndarray:
    """For each fragment, whether its anchor gram was said to be shared."""
    every = _prints(h, buckets)
    order, group = distinct_keys(every)
    begin = _edges(every[order[group]], buckets)
    use = np.zeros(len(group), bool)
    for b, cell in zip(answers.column("bucket").to_pylist(), answers.column("cell").to_pylist()):
        n = int(begin[b + 1] - begin[b])
        use[begin[b] : begin[b + 1]] = np.unpackbits(np.frombuffer(cell, np.uint8), count=n).astype(bool)
    out = np.zeros(len(h), bool)
    out[order] = np.repeat(use, np.diff(np.append(group, len(h))))
    return out


def read_block(table: pa.Table) -> pa.Table:
    """A block's rows in one order, whatever order the exchange delivers them in,
    so that a fragment has the same number each time the block is read."""
    return table.sort_by([("doc_id", "ascending"), ("text", "ascending")])


def marked(found: pa.Table, key, far, p1, equal):
    """Pairs of a block's fragments and the ranges said of an equal one: (fragment,
    first and last window start, further arrays). Answers name a fragment by its
    number; those of the same key are compared with it in full."""
    cells = [unpacked(c) for c in found.column("cell").to_pylist()]
    if not cells or not len(key):
        return None
    said, a, b, *more = (np.concatenate(x) for x in zip(*cells))
    said = said.astype(np.int64)
    order = np.argsort(key[said], kind="stable")
    said, a, b, *more = (x[order] for x in (said, a, b, *more))
    keys = key[said]
    lo = np.searchsorted(keys, key)
    hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == key)
    lo = lo[hit]
    n = np.searchsorted(keys, key[hit], "right") - lo
    frag, pick = np.repeat(hit, n), gather(lo, n)
    same = frag == said[pick]
    check = np.flatnonzero(~same)
    same[check] = equal(frag[check], said[pick[check]])
    frag, pick = frag[same], pick[same]
    anchor = p1[frag] + far[frag]
    return frag, anchor - b[pick], anchor - a[pick], [x[pick] for x in more]


def distinct_keys(key: np.ndarray):
    """(order, begin): fragments in order of key, and where each key begins."""
    order = np.argsort(key, kind="stable")
    ks = key[order]
    return order, np.flatnonzero(np.concatenate([[True], ks[1:] != ks[:-1]])) if len(ks) else np.zeros(0, np.int64)


def exchange(docs: DataFrame, id_col: str, text_col: str, grams, pieces, compare, apply, schema: str) -> DataFrame:
    """Run the exchanges over a table of texts.

    grams(block, table, buckets) -> rows for shared_grams; pieces(block, table,
    answers, buckets) -> rows (bucket, block, cell); compare(table) -> rows
    (block, bucket, cell); apply(table, found) -> rows of `schema`. The table
    of texts is dealt out once: its exchange is reused by the three readers.
    There are two blocks per shuffle partition, or more if the texts' counted
    bytes need them.
    """
    text = id_and_bytes(docs, id_col, text_col)
    size = text.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    blocks = max(2 * partitions(docs.sparkSession), -(-size // BLOCK_BYTES))
    n = min(blocks, MOST_BUCKETS)
    text = text.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    to_bucket, to_block = "bucket int, block int, cell binary", "block int, bucket int, cell binary"
    sent = text.groupBy("block").applyInArrow(lambda key, t: grams(key[0].as_py(), t, n), to_bucket)
    answers = sent.groupBy("bucket").applyInArrow(shared_grams, to_block)
    parts = text.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(lambda key, t, a: pieces(key[0].as_py(), t, a, n), to_bucket)
    found = parts.groupBy("bucket").applyInArrow(compare, to_block)
    return text.groupBy("block").cogroup(found.groupBy("block")).applyInArrow(lambda t, f: apply(t, f), schema)
