"""Suffix-array deduplication of byte strings (operator 1).

Suffixes are sorted where equal ones meet (see anchors). Prefix sums of a
polynomial hash make any two stretches comparable in constant time; binary
search over lengths finds the common extension of two suffixes, and one byte
beyond it decides their order, so a mergesort needs a logarithm of the length
per comparison. Neighbours that the hashes call equal are verified byte by byte,
and so is every fragment before it counts as a copy of another.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.anchors import _cells, bucket_of, distinct_keys, exchange, fragments, marked, packed, read_block, send_grams, unpacked, wanted
from tidemark.llm.common import Powers, classes, flat, gather, ids_of, same_stretches

WINDOW, GRAM = 50, 20
#: Fragments whose hashes are summed at once.
_PART = 1 << 14
#: Windows of one bucket that are sorted at once; those of one gram stay together.
_WINDOWS = 1 << 18


class Suffixes:
    """Suffixes of fragments that lie end to end in a buffer of bytes."""

    def __init__(self, buf: np.ndarray, begin: np.ndarray, lengths: np.ndarray):
        self.buf = buf
        self.up, self.down = Powers().to(2 * WINDOW)
        self.sums = np.zeros(len(buf) + 1, np.uint64)
        for k in range(0, len(begin), _PART):  # parts keep the temporary arrays small
            b, n = begin[k : k + _PART], lengths[k : k + _PART]
            lo, hi = int(b[0]), int(b[-1] + n[-1])
            inner = np.arange(lo, hi) - np.repeat(b, n)
            sums = self.sums[lo + 1 : hi + 1]
            np.cumsum((buf[lo:hi].astype(np.uint64) + np.uint64(1)) * self.up[inner], out=sums)
            sums += self.sums[lo]

    def stretch(self, at, inner, size):
        """Hash of `size` bytes from `at`, which is `inner` bytes into its fragment."""
        return (self.sums[at + size] - self.sums[at]) * self.down[inner]

    def common(self, x, xi, y, yi, limit):
        """Length of the common extension of suffixes x and y, up to `limit`: binary search on hashes."""
        sums, dx, dy = self.sums, self.down[xi], self.down[yi]
        cx, cy = sums[x] * dx, sums[y] * dy
        same = sums[x + limit] * dx - cx == sums[y + limit] * dy - cy
        got = np.where(same, limit, 0)
        rest = np.flatnonzero(~same)  # these differ before the limit
        if len(rest):
            x, y, dx, dy, cx, cy, limit = (v[rest] for v in (x, y, dx, dy, cx, cy, limit))
            at, step = np.zeros(len(rest), np.int64), 1 << max((int(limit.max()) - 1).bit_length() - 1, 0)
            while step:
                to = np.minimum(at + step, limit)
                same = sums[x + to] * dx - cx == sums[y + to] * dy - cy
                at = np.where(same, to, at)
                step //= 2
            got[rest] = at
        return got

    def less(self, x, xi, y, yi, limit):
        """Whether suffix x comes before y; equal up to `limit`: not."""
        got = self.common(x, xi, y, yi, limit)
        end = len(self.buf) - 1
        return (got < limit) & (self.buf[np.minimum(x + got, end)] < self.buf[np.minimum(y + got, end)])

    def sort(self, at, inner, limit, group):
        """Mergesort of suffixes within groups (neighbours; equal limits). Returns
        the order and, for each place, whether it equals the place before."""
        n = len(at)
        order = np.arange(n)
        new = np.concatenate([[True], group[1:] != group[:-1]]) if n else np.zeros(0, bool)
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, n))
        base, room = np.repeat(begin, size), np.repeat(size, size)
        run, largest = 1, int(size.max(initial=0))
        while run < largest:
            place = np.flatnonzero(room > run)
            b, m = base[place], room[place]
            local = place - b
            mine = local // run * run
            left = (local // run) % 2 == 0
            other = np.where(left, mine + run, mine - run)
            lo, hi = np.zeros(len(place), np.int64), np.clip(m - other, 0, run)
            me = order[place]
            act = np.flatnonzero(lo < hi)
            while len(act):  # place of each suffix in the sibling run
                mid = (lo[act] + hi[act]) // 2
                it, own = order[b[act] + other[act] + mid], me[act]
                from_left = left[act]
                x, y = np.where(from_left, it, own), np.where(from_left, own, it)
                before = self.less(at[x], inner[x], at[y], inner[y], limit[own])
                goes = np.where(from_left, before, ~before)  # sibling < me, or sibling <= me
                lo[act] = np.where(goes, mid + 1, lo[act])
                hi[act] = np.where(goes, hi[act], mid)
                act = act[lo[act] < hi[act]]
            moved = order.copy()
            moved[b + np.minimum(mine, np.where(m > other, other, mine)) + (local - mine) + lo] = me
            order = moved
            run *= 2
        same = np.zeros(n, bool)
        pairs = np.flatnonzero(~new)
        if len(pairs):
            x, y = order[pairs - 1], order[pairs]
            same[pairs] = self.common(at[x], inner[x], at[y], inner[y], limit[x]) >= limit[x]
            self._verify(at, limit, order, same, begin, size)
        return order, same

    def _verify(self, at, limit, order, same, begin, size):
        """Compare claimed equals byte by byte; a group with a collision is sorted by its bytes."""
        claimed = np.flatnonzero(same)
        for k in range(0, len(claimed), 1 << 15):
            c = claimed[k : k + (1 << 15)]
            x, y = order[c - 1], order[c]
            reach = np.arange(int(limit[x].max()))
            within = reach < limit[x][:, None]
            end = len(self.buf) - 1
            differ = (self.buf[np.minimum(at[x][:, None] + reach, end)] != self.buf[np.minimum(at[y][:, None] + reach, end)]) & within
            for bad in c[differ.any(axis=1)].tolist():
                g = int(np.searchsorted(begin, bad, "right")) - 1
                b, n = int(begin[g]), int(size[g])
                texts = {i: self.buf[at[i] : at[i] + limit[i]].tobytes() for i in order[b : b + n].tolist()}
                order[b : b + n] = sorted(texts, key=texts.get)
                same[b + 1 : b + n] = [texts[i] == texts[j] for i, j in zip(order[b : b + n - 1].tolist(), order[b + 1 : b + n].tolist())]


def _least_of_equals(order, same, values):
    """For each item, the least value among the items equal to it."""
    begin = np.flatnonzero(~same)
    low = np.minimum.reduceat(values[order], begin) if len(begin) else values[:0]
    out = np.empty(len(order), values.dtype)
    out[order] = np.repeat(low, np.diff(np.append(begin, len(order))))
    return out


def smallest_owner(buf, far, near, low):
    """For fragments of a bucket: ranges of windows with the least document that has them.

    far and near are the distances of the first and last window to the anchor,
    low the least document of each fragment. Yields arrays (fragment, from
    distance, to distance, least document); each window is in one range.
    """
    lengths = far - near + WINDOW
    begin = np.cumsum(lengths) - lengths
    suffixes = Suffixes(buf, begin, lengths)
    gram = suffixes.stretch(begin + far, far, GRAM)
    # whole fragments, among those with the same gram and reach
    order = np.lexsort((near, far, gram))
    shape = np.concatenate([[0], np.cumsum((gram[order][1:] != gram[order][:-1]) | (far[order][1:] != far[order][:-1]) | (near[order][1:] != near[order][:-1]))])
    place, same = suffixes.sort(begin[order], np.zeros(len(order), np.int64), lengths[order], shape)
    kind_of = np.empty(len(order), np.int64)  # number of each fragment's content
    kind_of[order[place]] = np.cumsum(~same) - 1
    whole = np.empty_like(low)
    whole[order] = _least_of_equals(place, same, low[order])
    # contents that share their gram with another one are compared window by window
    kinds = np.empty(kind_of.max(initial=-1) + 1, np.int64)
    kinds[kind_of] = np.arange(len(kind_of))  # one fragment for each content
    _, by_gram, per_gram = np.unique(gram[kinds], return_inverse=True, return_counts=True)
    mixed = per_gram[by_gram] > 1
    plain = np.flatnonzero(~mixed[kind_of])
    yield plain, near[plain], far[plain], whole[plain]
    # by gram, so many windows at a time
    rep = np.flatnonzero(mixed)
    rep = rep[np.argsort(by_gram[rep], kind="stable")]
    grams, ends = by_gram[rep], np.cumsum((far - near + 1)[kinds[rep]])
    rank = np.zeros(len(kinds), np.int64)
    rank[rep] = np.arange(len(rep))
    members = np.flatnonzero(mixed[kind_of])
    members = members[np.argsort(rank[kind_of[members]], kind="stable")]
    ranks = rank[kind_of[members]]
    k = 0
    while k < len(rep):
        to = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + _WINDOWS)))
        to = int(np.searchsorted(grams, grams[to - 1], "right"))
        m = slice(*np.searchsorted(ranks, [k, to]))
        yield _window_owners(suffixes, begin, far, near, whole, kinds[rep[k:to]], grams[k:to] - grams[k], members[m], ranks[m] - k)
        k = to


def _window_owners(suffixes, begin, far, near, whole, f, group, members, rank):
    """Ranges as in smallest_owner for contents that may share windows: fragments
    f, one for each content, with the number of their gram, and all fragments of
    these contents (`members`) with the number of theirs."""
    count = far[f] - near[f] + 1
    owner = np.repeat(np.arange(len(f)), count)
    distance = far[f][owner] - (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count))
    at = begin[f][owner] + far[f][owner] - distance
    group = group[owner] * WINDOW + distance
    order = np.argsort(group, kind="stable")
    place, same = suffixes.sort(at[order], (far[f][owner] - distance)[order], np.full(len(order), WINDOW), group[order])
    least = np.empty(len(owner), whole.dtype)
    least[order] = _least_of_equals(place, same, whole[f][owner][order])
    # neighbouring windows with the same answer are one range
    cut = np.concatenate([[True], (owner[1:] != owner[:-1]) | (least[1:] != least[:-1])])
    first = np.flatnonzero(cut)
    last = np.append(first[1:], len(owner)) - 1
    # the answer for a content holds for all its fragments
    by_rep = owner[first]
    start, n = np.searchsorted(by_rep, rank, "left"), np.searchsorted(by_rep, rank, "right")
    pick = gather(start, n - start)
    return np.repeat(members, n - start), distance[last][pick], distance[first][pick], least[first][pick]


# -- the steps of anchors.exchange ------------------------------------------------


def _read(table):
    table = read_block(table)
    data, offsets = flat(table.column("text"))
    return data, offsets, ids_of(table.column("doc_id")), table.column("doc_id")


def _equal(data, p1, far, near):
    """Whether fragments, by number, reach equally far and hold equal bytes."""

    def equal(x, y):
        ok = (far[x] == far[y]) & (near[x] == near[y])
        i = np.flatnonzero(ok)
        ok[i] = same_stretches(data, p1[x[i]], p1[y[i]], far[x[i]] - near[x[i]] + WINDOW)
        return ok

    return equal


def _grams(block, table, buckets):
    data, offsets, ids, _ = _read(table)
    p1, _, _, _, h, _ = fragments(data, offsets, WINDOW, GRAM, Powers())
    return send_grams(block, h, ids[np.searchsorted(offsets, p1, "right") - 1], buckets)


def _pieces(block, table, answers, buckets):
    """Distinct fragments with a shared gram, with the least and largest document of each."""
    data, offsets, ids, _ = _read(table)
    p1, p2, far, near, h, key = fragments(data, offsets, WINDOW, GRAM, Powers())
    number = np.flatnonzero(wanted(h, answers, buckets))
    p1, p2, far, near, h, key = (x[number] for x in (p1, p2, far, near, h, key))
    own = ids[np.searchsorted(offsets, p1, "right") - 1]
    order, begin = distinct_keys(classes(key, _equal(data, p1, far, near)))
    rows = []
    if len(begin):
        low, high = np.minimum.reduceat(own[order], begin), np.maximum.reduceat(own[order], begin)
        rep = order[begin]
        where = bucket_of(h[rep], buckets)
        by = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            s = by[edges[b] : edges[b + 1]]
            r = rep[s]
            bytes_ = data[gather(p1[r], p2[r] - p1[r] + WINDOW)]
            rows.append((b, block, packed(far[r].astype(np.uint8), near[r].astype(np.uint8), number[r].astype(np.uint32), low[s], high[s] - low[s], bytes_)))
    return _cells(rows, ("bucket", "block"))


def _compare(table):
    bucket = table.column("bucket")[0].as_py()
    blocks = table.column("block").to_pylist()
    cells = [unpacked(c) for c in table.column("cell").to_pylist()]
    far, near, number, low, more, buf = (np.concatenate(x) for x in zip(*cells))
    which = np.repeat(np.arange(len(cells)), [len(c[0]) for c in cells])
    far, near = far.astype(np.int64), near.astype(np.int64)
    parts = list(zip(*smallest_owner(buf, far, near, low)))
    f, a, b, least = (np.concatenate(x) for x in parts)
    use = least < (low + more)[f]  # someone in the block has a smaller document elsewhere
    f, a, b, least = f[use], a[use], b[use], least[use]
    order = np.argsort(which[f], kind="stable")
    f, a, b, least = f[order], a[order], b[order], least[order]
    edges = np.searchsorted(which[f], np.arange(len(cells) + 1))
    rows = []
    for k in np.flatnonzero(np.diff(edges)).tolist():
        s = slice(edges[k], edges[k + 1])
        rows.append((blocks[k], bucket, packed(number[f[s]], a[s].astype(np.uint8), b[s].astype(np.uint8), least[s])))
    return _cells(rows, ("block", "bucket"))


def _apply(table, found):
    data, offsets, ids, named = _read(table)
    p1, _, far, near, _, key = fragments(data, offsets, WINDOW, GRAM, Powers())
    hit = marked(found, key, far, p1, _equal(data, p1, far, near))
    gone = np.zeros(len(data), bool)
    if hit is not None:
        frag, first, last, (least,) = hit
        own = ids[np.searchsorted(offsets, p1, "right") - 1]
        use = least < own[frag]
        turns = np.zeros(len(data) + 1, np.int32)
        np.add.at(turns, first[use], 1)
        np.add.at(turns, last[use] + WINDOW, -1)
        gone = np.cumsum(turns, out=turns)[:-1] > 0
    opens = gone.copy()
    opens[1:] &= ~gone[:-1]
    heads = offsets[:-1][offsets[:-1] < len(data)]
    opens[heads] = gone[heads]
    ends = list(zip(offsets[:-1].tolist(), offsets[1:].tolist()))
    count = lambda mask: np.array([np.count_nonzero(mask[a:b]) for a, b in ends], np.int64)
    removed = count(gone)
    kept = data[~gone].tobytes()
    at = np.concatenate([[0], np.cumsum(np.diff(offsets) - removed)]).tolist()
    digests = [hashlib.sha256(kept[a:b]).hexdigest() for a, b in zip(at[:-1], at[1:])]
    return pa.table({"doc_id": named, "n_bytes": pa.array(np.diff(offsets)), "n_removed": pa.array(removed), "n_spans": pa.array(count(opens)), "kept_sha256": pa.array(digests, pa.string())})


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Removed is each byte covered by a 50-byte string that also starts in a
    document with a smaller doc_id; strings are judged on the input. Null text
    is empty; texts under 50 bytes lose nothing. A null identifier counts as
    2**63 - 1 and comes back null; rows that repeat an identifier
    are one document to each other and so take nothing from each other. Other
    columns are ignored; an empty table gives none.
    """
    return exchange(docs, id_col, text_col, _grams, _pieces, _compare, _apply, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
