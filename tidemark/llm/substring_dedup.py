"""Substring deduplication of word sequences by suffix automata (operator 8).

Reference shards are the distinct repeated candidates of a bucket (see
anchors), bounded in words. A generalised suffix automaton of a shard knows how
often each of its substrings occurs in the corpus; texts are streamed through
it for matching statistics, capped at the window's length, and every window
whose state counts more than one occurrence is repeated. Maximal runs of such
windows are removed. Shards grow in number with the corpus, so an automaton is
not broadcast to all: the fragments that can match it are sent where it is.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.anchors import _cells, bucket_of, distinct_keys, exchange, fragments, marked, packed, read_block, send_grams, unpacked, wanted
from tidemark.llm.common import Powers, classes, flat, gather, mix, same_stretches, same_words, word_hashes, words_of

WINDOW, GRAM = 35, 8
#: Words of the fragments that one automaton holds; fragments with one anchor stay together.
SHARD_WORDS = 60_000


class Automaton:
    """Suffix automaton of several sequences, with the number of occurrences of
    each state's substrings (a sequence may count more than once)."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.count = [-1], [0], [0]

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        self.count.append(0)
        return len(self.link) - 1

    def add(self, sequence, times: int) -> None:
        nxt, link, length, count = self.next, self.link, self.length, self.count
        last = 0
        for c in sequence:
            known = nxt[last].get(c)
            if known is not None and length[known] == length[last] + 1:
                last = known
                count[last] += times
                continue
            if known is None:
                cur = self._state(length[last] + 1, 0, {})
                p = last
                while p >= 0 and c not in nxt[p]:
                    nxt[p][c] = cur
                    p = link[p]
            else:
                cur, p = -1, last
            if p >= 0:
                q = nxt[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = self._state(length[p] + 1, link[q], nxt[q].copy())
                    while p >= 0 and nxt[p].get(c) == q:
                        nxt[p][c] = clone
                        p = link[p]
                    link[q] = clone
                    if cur < 0:
                        cur = clone
                    else:
                        link[cur] = clone
            last = cur
            count[last] += times

    def settle(self) -> None:
        """Pass occurrences on to suffixes."""
        for s in np.argsort(-np.array(self.length), kind="stable").tolist():
            if self.link[s] > 0:
                self.count[self.link[s]] += self.count[s]

    def repeated(self, sequence, window: int):
        """For each window of the sequence, whether it occurs more than once."""
        nxt, link, length, count = self.next, self.link, self.length, self.count
        state, got, out = 0, 0, []
        for c in sequence:
            while state and c not in nxt[state]:
                state = link[state]
                got = length[state]
            if c in nxt[state]:
                state = nxt[state][c]
                got += 1
            if got >= window:
                while length[link[state]] >= window:
                    state = link[state]
                got = window
                out.append(count[state] > 1)
            else:
                out.append(False)
        return out[window - 1 :]


def repeated_ranges(sequences, times, anchor):
    """For distinct sequences with the times each occurs, and the anchor gram of
    each: (sequence, first and last window that occur more than once in all)."""
    order = np.argsort(anchor, kind="stable")
    sizes = np.array([len(s) for s in sequences])
    k = 0
    while k < len(order):
        # a shard: whole anchors up to SHARD_WORDS
        to, words = k, 0
        while to < len(order) and (words < SHARD_WORDS or anchor[order[to]] == anchor[order[to - 1]]):
            words += int(sizes[order[to]])
            to += 1
        shard = Automaton()
        for i in order[k:to].tolist():
            shard.add(sequences[i], int(times[i]))
        shard.settle()
        for i in order[k:to].tolist():
            flags = np.concatenate([[False], shard.repeated(sequences[i], WINDOW), [False]])
            turns = np.flatnonzero(flags[1:] != flags[:-1])
            for a, b in zip(turns[::2].tolist(), turns[1::2].tolist()):
                yield i, a, b - 1
        k = to


def _read(table):
    table = read_block(table)
    data, offsets = flat(table.column("text"))
    return data, *words_of(data, offsets), table.column("doc_id")


def _equal(data, starts, ends, p1, far, near):
    """Whether fragments, by number, reach equally far and hold equal words."""

    def equal(x, y):
        ok = (far[x] == far[y]) & (near[x] == near[y])
        i = np.flatnonzero(ok)
        ok[i] = same_words(data, starts, ends, p1[x[i]], p1[y[i]], far[x[i]] - near[x[i]] + WINDOW)
        return ok

    return equal


def _grams(block, table, buckets):
    data, starts, ends, first, _ = _read(table)
    p1, _, _, _, h, _ = fragments(word_hashes(data, starts, ends), first, WINDOW, GRAM, Powers())
    return send_grams(block, h, p1, buckets)  # a window's place is its owner: repeats within a text count


def _pieces(block, table, answers, buckets):
    """Distinct fragments with a shared gram, the times each occurs, and their words."""
    data, starts, ends, first, _ = _read(table)
    p1, p2, far, near, h, key = fragments(word_hashes(data, starts, ends), first, WINDOW, GRAM, Powers())
    number = np.flatnonzero(wanted(h, answers, buckets))
    p1, p2, far, near, h, key = (x[number] for x in (p1, p2, far, near, h, key))
    order, begin = distinct_keys(classes(key, _equal(data, starts, ends, p1, far, near)))
    rows = []
    if len(begin):
        times = np.diff(np.append(begin, len(order)))
        rep = order[begin]
        where = bucket_of(h[rep], buckets)
        by = np.argsort(where, kind="stable")
        edges = np.searchsorted(where[by], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(edges)).tolist():
            s = by[edges[b] : edges[b + 1]]
            r = rep[s]
            low, high = starts[p1[r]], ends[p2[r] + WINDOW - 1]
            rows.append((b, block, packed(far[r].astype(np.uint8), near[r].astype(np.uint8), number[r].astype(np.uint32), times[s].astype(np.uint32), (high - low).astype(np.uint32), data[gather(low, high - low)])))
    return _cells(rows, ("bucket", "block"))


def _compare(table):
    bucket = table.column("bucket")[0].as_py()
    blocks = table.column("block").to_pylist()
    cells = [unpacked(c) for c in table.column("cell").to_pylist()]
    far, near, number, times, sizes, data = (np.concatenate(x) for x in zip(*cells))
    which = np.repeat(np.arange(len(cells)), [len(c[0]) for c in cells])
    far, near = far.astype(np.int64), near.astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    starts, ends, first = words_of(data, offsets)
    # words as numbers by their bytes: equal numbers, equal words
    hashes = word_hashes(data, starts, ends)
    word = classes(hashes, lambda x, y: (ends[x] - starts[x] == ends[y] - starts[y]) & same_stretches(data, starts[x], starts[y], np.minimum(ends[x] - starts[x], ends[y] - starts[y])))
    gram = hashes[first[:-1] + far]
    for k in range(1, GRAM):
        gram = mix(gram * np.uint64(3) + hashes[first[:-1] + far + k])
    # equal fragments of different blocks are one sequence
    n = np.diff(first)
    place = np.arange(len(word)) - np.repeat(first[:-1], n)
    key = np.add.reduceat(mix(hashes + place.astype(np.uint64)), first[:-1]) + gram
    order, begin = distinct_keys(classes(key, lambda x, y: (n[x] == n[y]) & same_stretches(word, first[x], first[y], np.minimum(n[x], n[y]))))
    total = np.add.reduceat(times[order].astype(np.int64), begin)
    reps = order[begin]
    sequences = [word[first[r] : first[r + 1]].tolist() for r in reps.tolist()]
    hits = list(repeated_ranges(sequences, total, gram[reps]))
    rows = []
    if hits:
        seq, a, b = np.array(hits).T
        begin = np.append(begin, len(order))
        n = begin[seq + 1] - begin[seq]
        frag = order[gather(begin[seq], n)]
        a, b = np.repeat(a, n), np.repeat(b, n)
        by = np.argsort(which[frag], kind="stable")
        edges = np.searchsorted(which[frag][by], np.arange(len(cells) + 1))
        for k in np.flatnonzero(np.diff(edges)).tolist():
            s = by[edges[k] : edges[k + 1]]
            f = frag[s]
            rows.append((blocks[k], bucket, packed(number[f], (far[f] - b[s]).astype(np.uint8), (far[f] - a[s]).astype(np.uint8))))
    return _cells(rows, ("block", "bucket"))


def _apply(table, found):
    data, starts, ends, first, named = _read(table)
    p1, _, far, near, _, key = fragments(word_hashes(data, starts, ends), first, WINDOW, GRAM, Powers())
    hit = marked(found, key, far, p1, _equal(data, starts, ends, p1, far, near))
    gone = np.zeros(len(starts), bool)
    if hit is not None:
        _, a, b, _ = hit
        turns = np.zeros(len(starts) + 1, np.int32)
        np.add.at(turns, a, 1)
        np.add.at(turns, b + WINDOW, -1)
        gone = np.cumsum(turns)[:-1] > 0
    removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[first])
    # kept words, each followed by one space
    s, size = starts[~gone], (ends - starts)[~gone]
    at = np.cumsum(size + 1) - (size + 1)
    out = np.full(int((size + 1).sum()), 32, np.uint8)
    if len(s):
        out[gather(at, size)] = data[gather(s, size)]
    raw = out.tobytes()
    n = np.concatenate([[0], np.cumsum(np.diff(first) - removed)])
    edges = np.append(at, len(out))[n].tolist()
    digests = [hashlib.sha256(raw[a : max(a, b - 1)]).hexdigest() for a, b in zip(edges[:-1], edges[1:])]
    return pa.table({"doc_id": named, "n_words": pa.array(np.diff(first)), "n_removed": pa.array(removed.astype(np.int64)), "kept_sha256": pa.array(digests, pa.string())})


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    Removed is each word covered by 35 consecutive words whose sequence also
    starts anywhere else, in the same document too; windows are judged on the
    input. Words are compared as bytes. Null text has no
    words; texts under 35 words lose nothing; a null identifier is kept; rows
    that repeat an identifier count as separate texts. Other columns are
    ignored; an empty table gives none.
    """
    return exchange(docs, id_col, text_col, _grams, _pieces, _compare, _apply, "doc_id long, n_words long, n_removed long, kept_sha256 string")
