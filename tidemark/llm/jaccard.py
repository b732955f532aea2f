"""Near-duplicates by SimHash, with links confirmed by exact Jaccard similarity and
completed by a prefix filter (the pipeline's near stage).

Multi-index hashing over fingerprints of five-word shingles proposes pairs; what
a pair's similarity really is, is told by its texts. Texts of similarity 4/5 may
differ in a dozen bits of 64, more than balls in segments can reach, so a second
search makes the result whole. Prefix filter: with the shingles of every text in
one common order, two texts of similarity 4/5 or more share one among the first
n - ceil(4n/5) + 1 of each. So only these prefixes meet, and no pair is lost.
Frequent shingles come last in the order; a bounded sample tells which they are,
and since any common order is exact, the sample bears on time alone.

In star rounds each text of a prefix shingle meets two texts of it only, others
in each round, so that a large group of copies becomes one component without its
pairs. When a round links few more, the texts of shingles whose components
still differ meet. Of all pairs, those are looked at more closely whose counts of
shingles by bucket of their hash leave room for the similarity: an upper bound, so
no pair is lost. A text has the more buckets the more shingles it has, since in few
of them any two long texts look alike.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import configured, flat, id_and_bytes, ids_of, mix, partitions, portions, same_words, slices, small_or_shuffled, sole, staged, without, word_hashes, words_of
from tidemark.llm.components import components
from tidemark.llm.simhash import linked, majorities

WIDTH = 5
#: Similarity that links, as a fraction.
NUM, DEN = 4, 5
#: Bits in which the fingerprints of a pair that multi-index hashing proposes may differ.
BITS = 3
#: Texts whose shingles are counted for the order, and the counts from which a shingle
#: is frequent (it comes later in the order) and hot (its rows are spread over tasks).
SAMPLE, FREQUENT, HOT = 20_000, 8, 100
#: Parts of a hot shingle's rows.
PARTS = 64
#: Buckets of a text's sketch; a count that reaches FULL may be any larger one. With
#: over LOAD shingles a bucket the fine sketch has twice the buckets, and so on.
BUCKETS, FULL, LOAD = 128, 255, 8
#: Bytes of text that are taken apart at once (a longer text, alone), and rows of
#: pairs with both texts in one Arrow batch.
PIECE, PAIR_ROWS = 1 << 21, 200
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


_PREFIX = "shingle long, node long, n int, at int, part int"
_SHARED = "shingle long, node long, n int, at int, low long, low_n int, high long, high_n int"
_PREFIX_NAMES, _SHARED_NAMES = ([c.split()[0] for c in x.split(", ")] for x in (_PREFIX, _SHARED))


@dataclass
class Shingles:
    """Distinct shingles of several texts, by text and hash: hash, text and first
    word of each; of a text of fewer than WIDTH words, one of all. `words` holds
    the texts' bytes, where words start and end, and how many a text has."""

    hash: np.ndarray
    text: np.ndarray
    at: np.ndarray
    words: tuple

    def size(self, k: np.ndarray) -> np.ndarray:
        """Words of some shingles."""
        return np.minimum(self.words[3][self.text[k]], WIDTH)


def shingles_of(column) -> Shingles:
    data, offsets = flat(column)
    data = _LOWER[data]
    starts, ends, first = words_of(data, offsets)
    words, count = word_hashes(data, starts, ends), np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    whole = np.flatnonzero(first[text + 1] - np.arange(len(words)) >= WIDTH)  # where a whole shingle starts
    h = np.full(len(whole), WIDTH, np.uint64)
    for j in range(WIDTH):
        h = mix(h + words[whole + j])
    short = np.flatnonzero(count < WIDTH)
    few = np.zeros(len(short), np.uint64)
    for j in range(WIDTH - 1):
        more = count[short] > j
        few[more] = mix(few[more] + words[first[short[more]] + j] + np.uint64(1))
    h, text, at = np.concatenate([h, few]), np.concatenate([text[whole], short]), np.concatenate([whole, first[short]])
    order = np.lexsort((h, text))
    h, text, at = h[order], text[order], at[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (text[1:] != text[:-1])]) if len(h) else np.zeros(0, bool)
    return Shingles(h[new], text[new], at[new], (data, starts, ends, count))


def _exact_set(text: bytes) -> set:
    words = text.translate(_LOWER.tobytes()).split()
    return {tuple(words[k : k + WIDTH]) for k in range(max(len(words) - WIDTH, 0) + 1)}


def _sketches(s: Shingles, n: np.ndarray, level: np.ndarray) -> pa.Array:
    """Per text of n shingles, how many of them fall into each of BUCKETS << level buckets."""
    ends = np.cumsum(BUCKETS << level)
    shift = (64 - BUCKETS.bit_length() + 1 - level).astype(np.uint64)
    at = (ends - (BUCKETS << level))[s.text] + (s.hash >> shift[s.text]).astype(np.int64)
    counts = np.minimum(np.bincount(at, minlength=int(ends[-1]) if len(n) else 0), FULL).astype(np.uint8)
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(counts.tobytes())])


def _levels(n: np.ndarray) -> np.ndarray:
    """How often the buckets are doubled for texts of n shingles."""
    return np.ceil(np.log2(np.maximum(n / (BUCKETS * LOAD), 1))).astype(np.int64)


def _pieces(batches, *columns: int):
    """Batches cut so that the texts in some columns have at most PIECE bytes, or one row."""
    for part in slices(batches, 200):
        sizes = sum(np.diff(flat(part.column(k))[1]) for k in columns)
        for rows in portions(sizes, PIECE):
            yield part.slice(rows.start, rows.stop - rows.start)


def _print_batches(batches):
    """(doc_id, fp, n, sketch, fine): fingerprint, number of shingles and sketches of each text."""
    for part in _pieces(batches, 1):
        s, rows = shingles_of(part.column(1)), part.num_rows
        n = np.bincount(s.text, minlength=rows).astype(np.int32)
        sketch, fine = _sketches(s, n, np.zeros(rows, np.int64)), _sketches(s, n, _levels(n))
        yield pa.RecordBatch.from_arrays([part.column(0), pa.array(majorities(s.hash, s.text, rows).view(np.int64)), pa.array(n), sketch, fine], names=["doc_id", "fp", "n", "sketch", "fine"])


def _may_be_similar(a: np.ndarray, b: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Whether rows of sketches a and b, of texts with `both` shingles together, leave
    room for the similarity."""
    least = np.minimum(a, b)
    return (least.sum(axis=1, dtype=np.int64) * (NUM + DEN) >= NUM * both) | (least == FULL).any(axis=1)


def _rows_of(column, wide: int = BUCKETS) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, wide)


def _folded(sketch: np.ndarray, wide: int) -> np.ndarray:
    """Sketches with neighbouring buckets put together, so that `wide` are left."""
    if sketch.shape[1] == wide:
        return sketch
    parts = sketch.reshape(len(sketch), wide, -1)
    return np.where((parts == FULL).any(axis=2), FULL, np.minimum(parts.sum(axis=2, dtype=np.int64), FULL)).astype(np.uint8)


def _possible_batches(batches):
    """Pairs (u, v, n, m, a, b) whose sizes and fine sketches leave room for the similarity."""
    for part in slices(batches, 500):
        n, m = (part.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (2, 3))
        keep = DEN * np.minimum(n, m) >= NUM * np.maximum(n, m)
        wide = np.stack([BUCKETS << _levels(x) for x in (n, m)], 1)
        for x, y in np.unique(wide[keep], axis=0).tolist():
            at = np.flatnonzero(keep & (wide[:, 0] == x) & (wide[:, 1] == y))
            a, b = (_folded(_rows_of(part.column(k).take(pa.array(at)), w), min(x, y)) for k, w in ((4, x), (5, y)))
            keep[at] = _may_be_similar(a, b, n[at] + m[at])
        yield pa.RecordBatch.from_arrays([part.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["u", "v"])


def _shingle_batches(batches):
    for part in _pieces(batches, 1):
        yield pa.RecordBatch.from_arrays([pa.array(shingles_of(part.column(1)).hash.view(np.int64))], names=["shingle"])


def _prefix_batches(batches, frequent):
    """(shingle, node, n, at, part): each text's prefix, with its number of shingles
    and the place among them; part is 0, or from 1 on for rows of a hot shingle."""
    known, counts = frequent.value
    for part in _pieces(batches, 1):
        s = shingles_of(part.column(1))
        h, text = s.hash, s.text
        rank = np.zeros(len(h), np.int64)
        if len(known):
            at = np.minimum(np.searchsorted(known, h), len(known) - 1)
            rank = np.where(known[at] == h, counts[at], 0)
        order = np.lexsort((h, rank, text))
        h, text, rank = h[order], text[order], rank[order]
        n = np.bincount(text, minlength=part.num_rows)
        at = np.arange(len(h)) - np.repeat(np.cumsum(n) - n, n)
        n = n[text]
        use = at < n - -(-NUM * n // DEN) + 1
        node = ids_of(part.column(0))[text[use]]
        salt = np.where(rank[use] >= HOT, 1 + mix(node.view(np.uint64)) % np.uint64(PARTS), 0)
        yield pa.RecordBatch.from_arrays([pa.array(h[use].view(np.int64)), pa.array(node), pa.array(n[use].astype(np.int32)), pa.array(at[use].astype(np.int32)), pa.array(salt.astype(np.int32))], names=_PREFIX_NAMES)


def _shared_batches(batches):
    """Of rows that one task has by shingle and part: those of a shingle with
    several nodes, with its first and last node and their sizes; of hot shingles
    all, without these, since other tasks have more of them."""
    parts = [[b.column(i).to_numpy(zero_copy_only=False) for i in range(5)] for b in batches]
    if not parts:
        return
    shingle, node, n, at, salt = (np.concatenate(x) for x in zip(*parts))
    del parts
    order = np.lexsort((n, node, shingle))
    new = np.concatenate([[True], shingle[order[1:]] != shingle[order[:-1]]])
    begin = np.flatnonzero(new)
    size = np.diff(np.append(begin, len(order)))
    low, high = order[begin], order[begin + size - 1]
    hot = np.repeat(salt[low] > 0, size)
    use = np.flatnonzero(np.repeat(node[low] != node[high], size) | hot)
    for k in range(0, len(use), 50_000):
        u = use[k : k + 50_000]
        row, a, b, mask = order[u], np.repeat(low, size)[u], np.repeat(high, size)[u], hot[u]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (shingle[row], node[row], n[row], at[row])] + [pa.array(x, mask=mask) for x in (node[a], n[a], node[b], n[b])], names=_SHARED_NAMES)


def _candidate_batches(batches):
    """Pairs that meet under a shingle, are of different components and can be
    similar by number, place and sketch."""
    parts = list(batches)
    if not parts:
        return
    shingle, node, n, at, whole = (np.concatenate([b.column(i).to_numpy(zero_copy_only=False) for b in parts]) for i in range(5))
    sketch = np.concatenate([_rows_of(b.column(5)) for b in parts])
    del parts
    order = np.lexsort((node, n, shingle))
    shingle, node, n, at, whole, sketch = (x[order] for x in (shingle, node, n.astype(np.int64), at.astype(np.int64), whole, sketch))
    begin = np.flatnonzero(np.concatenate([[True], shingle[1:] != shingle[:-1]]))
    size = np.diff(np.append(begin, len(shingle)))
    group_end = np.repeat(begin + size, size)
    found, held = [], 0

    def pairs():
        both = np.unique(np.concatenate(found), axis=0)
        return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], names=["u", "v"])

    rows = np.arange(len(shingle))
    step, left = 1, rows[rows + 1 < group_end]
    while len(left):  # each row with the one `step` behind it; n grows, so what is too long ends a row's turn
        i, j = left, left + step
        use = (whole[i] != whole[j]) & (DEN * n[i] >= NUM * n[j]) & (np.minimum(n[i] - at[i], n[j] - at[j]) * (NUM + DEN) >= NUM * (n[i] + n[j]))
        i, j = i[use], j[use]
        for k in range(0, len(i), 50_000):
            x, y = i[k : k + 50_000], j[k : k + 50_000]
            good = _may_be_similar(sketch[x], sketch[y], n[x] + n[y])
            u, v = node[x[good]], node[y[good]]
            found.append(np.stack([np.minimum(u, v), np.maximum(u, v)], 1))
            held += len(u)
        if held > 100_000:
            yield pairs()
            found, held = [], 0
        step += 1
        left = left[left + step < group_end[left]]
        left = left[DEN * n[left] >= NUM * n[left + step]]
    if found:
        yield pairs()


def _verified_batches(batches):
    """Pairs (u, v, a, b) whose texts a and b are similar. Shingles meet by hash and
    are compared as bytes; where that disagrees, the sets of shingles decide."""
    for part in _pieces(batches, 2, 3):
        rows = part.num_rows
        s = shingles_of(pa.concat_arrays([part.column(2).cast(pa.binary()), part.column(3).cast(pa.binary())]))
        n, pair = np.bincount(s.text, minlength=2 * rows), s.text % rows
        order = np.lexsort((s.text, s.hash, pair))
        met = np.flatnonzero((s.hash[order[1:]] == s.hash[order[:-1]]) & (pair[order[1:]] == pair[order[:-1]]))
        x, y = order[met], order[met + 1]
        near = np.bincount(pair[x], minlength=rows) * (NUM + DEN) >= NUM * (n[:rows] + n[rows:])
        use = near[pair[x]]
        x, y = x[use], y[use]
        data, starts, ends, count = s.words
        wide = s.size(x)
        same = (wide == s.size(y)) & ((wide == 0) | _equal_words(data, starts, ends, s.at[x], s.at[y], wide))
        for k in np.unique(pair[x[~same]]).tolist():
            a, b = (_exact_set(part.column(c)[k].as_py()) for c in (2, 3))
            near[k] = len(a & b) * (NUM + DEN) >= NUM * (len(a) + len(b))
        keep = pa.array(near)
        yield pa.RecordBatch.from_arrays([part.column(0).filter(keep), part.column(1).filter(keep)], names=["u", "v"])


def _equal_words(data, starts, ends, a, b, size) -> np.ndarray:
    out = np.ones(len(a), bool)
    some = np.flatnonzero(size)
    out[some] = same_words(data, starts, ends, a[some], b[some], size[some])
    return out


def _frequent(texts: DataFrame, rows: int):
    """Broadcast (hashes, counts) of the sample's frequent shingles."""
    spark = texts.sparkSession
    sample = texts if rows <= SAMPLE else texts.where(f"pmod(xxhash64(doc_id), {-(-rows // SAMPLE)}) = 0")
    counts = sample.mapInArrow(_shingle_batches, "shingle long").groupBy("shingle").count().where(f"count >= {FREQUENT}").toArrow()
    h, c = counts.column(0).to_numpy().view(np.uint64), counts.column(1).to_numpy()
    order = np.argsort(h)
    return spark.sparkContext.broadcast((h[order], c[order]))


def _verified(pairs: DataFrame, texts: DataFrame, prints: DataFrame, tag: str) -> DataFrame:
    """The similar ones among candidate pairs (u, v). Texts are moved for those
    alone that the sketches leave room for."""
    pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
    a, b = prints.select(F.col("doc_id").alias("u"), "n", F.col("fine").alias("a")), prints.select(F.col("doc_id").alias("v"), F.col("n").alias("m"), F.col("fine").alias("b"))
    bounded = pairs.join(a, "u").join(b, "v").select("u", "v", "n", "m", "a", "b")
    pairs = staged(bounded.mapInArrow(_possible_batches, "u long, v long").distinct(), f"{tag}-pairs")
    ids = staged(pairs.select(F.explode(F.array("u", "v")).alias("doc_id")).distinct(), f"{tag}-ids")
    some = staged(texts.join(small_or_shuffled(ids, ids.count()), "doc_id", "left_semi"), f"{tag}-texts")
    a, b = some.select(F.col("doc_id").alias("u"), F.col("text").alias("a")), some.select(F.col("doc_id").alias("v"), F.col("text").alias("b"))
    joined = pairs.join(a, "u").join(b, "v").select("u", "v", "a", "b")
    with configured(texts.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(PAIR_ROWS)}):
        return staged(joined.mapInArrow(_verified_batches, "u long, v long").distinct(), f"{tag}-edges")


def _ends(rows: DataFrame, turn: int) -> DataFrame:
    """Each row of a shingle with two rows of it, chosen by a hash that differs from
    turn to turn: pairs of different components and similar size."""
    kept, by = F.struct("node", "n", "whole"), F.xxhash64("node", F.lit(turn))
    ends = rows.groupBy("shingle").agg(F.min_by(kept, by).alias("a"), F.max_by(kept, by).alias("b"))
    met = rows.join(ends, "shingle").select("node", "n", "whole", F.explode(F.array("a", "b")).alias("end"))
    met = met.where(f"whole <> end.whole and {DEN} * least(n, end.n) >= {NUM} * greatest(n, end.n)")
    return met.select(F.col("node").alias("u"), F.col("end.node").alias("v"))


def similar_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(node, component) of each document that is similar to another one.

    Words are runs without ASCII white space, A-Z lower-cased; documents link at
    a Jaccard similarity of NUM / DEN or more of their sets of WIDTH-word shingles
    (shorter texts: all words; empty or null ones are equal). component is the
    smallest reachable identifier. Null identifiers are left out; rows that
    repeat an identifier are one document, similar to whatever one of its texts
    is; an empty table gives none.
    """
    spark = docs.sparkSession
    texts = id_and_bytes(docs, id_col, text_col).where("doc_id is not null")
    prints = staged(texts.mapInArrow(_print_batches, "doc_id long, fp long, n int, sketch binary, fine binary"), "near-prints")
    nodes, links = linked(prints.select("doc_id", "fp"), BITS)
    named = prints.join(nodes, "fp").select(F.col("node").alias("u"), F.col("doc_id").alias("v"))
    proposed = links.union(named.where("u <> v"))
    frequent = _frequent(texts, texts.count())
    prefixes = texts.mapInArrow(lambda b: _prefix_batches(b, frequent), _PREFIX).repartition(partitions(spark), "shingle", "part")
    shared = staged(prefixes.mapInArrow(_shared_batches, _SHARED), "near-shared")
    hot, cold = shared.where("low is null"), shared.where("low is not null")
    met = cold.select("node", "n", F.explode(F.array(F.struct(F.col("low").alias("node"), F.col("low_n").alias("n")), F.struct(F.col("high").alias("node"), F.col("high_n").alias("n")))).alias("end"))
    met = met.where(f"node <> end.node and {DEN} * least(n, end.n) >= {NUM} * greatest(n, end.n)").select(F.col("node").alias("u"), F.col("end.node").alias("v"))
    met = met.union(_ends(hot.withColumn("whole", F.col("node")), 0))
    edges, turn = _verified(proposed.union(met), texts, prints, "near-first"), 0
    while True:
        known, turn = staged(components(edges), "near-known"), turn + 1
        nodes_known = known.count()
        placed = shared.select("shingle", "node", "n", "at").join(small_or_shuffled(known, nodes_known), "node", "left").withColumn("whole", F.coalesce("component", "node"))
        several = placed.groupBy("shingle").agg(F.min("whole").alias("low"), F.max("whole").alias("high")).where("low <> high").select("shingle")
        mixed = staged(placed.join(several, "shingle").select("shingle", "node", "n", "at", "whole"), "near-mixed")
        more = _verified(_ends(mixed, turn), texts, prints, "near-more")
        edges = known.select(F.col("node").alias("u"), F.col("component").alias("v")).union(more)
        if more.count() * 100 <= nodes_known:
            break
    rows = mixed.join(prints.select(F.col("doc_id").alias("node"), "sketch"), "node").select("shingle", "node", "n", "at", "whole", "sketch").repartition(partitions(spark), "shingle")
    rest = _verified(rows.mapInArrow(_candidate_batches, "u long, v long"), texts, prints, "near-rest")
    return components(edges.union(rest))


def similar_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with one document of each group: the one with the smallest id. Rows
    with a null identifier stay, and so do rows of an identifier that repeats:
    which of its texts is meant could not be told."""
    gone = staged(similar_groups(docs, id_col, text_col).where("node <> component").select(F.col("node").alias(id_col)), "near-gone")
    return without(docs, sole(docs, gone, id_col), id_col)
