"""Benchmark decontamination by templates (operator 3).

Texts become template tokens: lower-cased words, with numbers, units and names
replaced by typed placeholders. Windows of template tokens of a document are
looked up in a hash table of the benchmark's; hits on one alignment are joined,
compared byte by byte, and the values in the placeholders must correspond one
to one, so that a question with other numbers or names is found and a chance
hit is not. A capital at the start of a sentence may or may not be a name, so
windows with one are looked up both ways.

Items that are one question with other values are one class: they share their
windows, and a document meets the class, not each of its items.
"""

from __future__ import annotations

import hashlib
import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Powers, bounded_batches, flat, gather, id_and_bytes, mix, slices, staged, word_hashes

WINDOW = 8
#: A window needs so many tokens that are no placeholders.
LITERALS = 3
#: Share of an item's tokens, or tokens in one run, that make a document contaminated.
COVERAGE, RUN = 0.6, 13
#: Bytes of benchmark text that one pass over the documents holds in each worker, on average.
PASS_BYTES = 8 << 20

# Words that are units, numbers and given names wherever they stand.
_UNITS = "km m cm mm mile miles meter meters metre metres foot feet inch inches yard yards kg g mg gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks month months year years dollar dollars cent cents euro euros mph kmh degree degrees celsius fahrenheit percent watt watts volt volts"
_NUMBERS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion half"
_NAMES = "alice bob carol dave david emma eva frank grace henry ivan jack james jane jean john julia karl kate laura linda lisa lucy maria mark martin mary michael mike natalia nina oliver olivia paul peter robert sam sarah sophia susan thomas tom weng william"

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_STOP = np.zeros(256, bool)
_STOP[[10, 33, 46, 63]] = True
#: Template values of the placeholders.
NUM, UNIT, NAME = np.uint64(11), np.uint64(13), np.uint64(17)


def _listed(words: str) -> np.ndarray:
    data = np.frombuffer(words.encode(), np.uint8)
    ends = np.append(np.flatnonzero(data == 32), len(data))
    starts = np.concatenate([[0], ends[:-1] + 1])
    return np.sort(word_hashes(data, starts, ends))


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


@dataclass
class Tokens:
    """Tokens of concatenated texts. `template` has hashes of words and numbers
    below 256 for placeholders; in `loose` capitals that start a sentence are
    names too. first[i] is the index of text i's first token."""

    template: np.ndarray
    loose: np.ndarray
    literal: np.ndarray
    first: np.ndarray
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    def word(self, k: int) -> bytes:
        return self.data[self.starts[k] : self.ends[k]].tobytes()


class Canon:
    """Turns concatenated texts into template tokens."""

    def __init__(self):
        self.pw = Powers()
        self.units, self.numbers, self.names = (_listed(x) for x in (_UNITS, _NUMBERS, _NAMES))

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> Tokens:
        if not len(data):
            none, zero = np.zeros(0, np.uint64), np.zeros(0, np.int64)
            return Tokens(none, none, none, np.zeros(len(offsets), np.int64), data, zero, zero)
        inside = _LETTER[data]
        point = (data[1:-1] == 46) | (data[1:-1] == 44)
        inside[1:-1] |= point & _DIGIT[data[:-2]] & _DIGIT[data[2:]]  # 3.14 and 1,000
        edge = offsets[1:-1]
        begin, stop = inside.copy(), inside.copy()
        begin[1:] &= ~inside[:-1]
        stop[:-1] &= ~inside[1:]
        b = edge[edge < len(data)]
        begin[b] = inside[b]
        e = edge[edge > 0] - 1
        stop[e] = inside[e]
        starts, ends = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        first = np.searchsorted(starts, offsets)
        lower = _LOWER[data]
        literal = word_hashes(lower, starts, ends) | np.uint64(256)
        if not len(starts):
            return Tokens(literal, literal, literal, first, lower, starts, ends)
        # a sentence begins a text or follows a stop
        stops = np.concatenate([[0], np.cumsum(_STOP[data])])
        opens = np.ones(len(starts), bool)
        opens[1:] = stops[starts[1:]] > stops[ends[:-1]]
        opens[first[:-1][first[:-1] < len(starts)]] = True
        head = data[starts]
        second = data[np.minimum(starts + 1, len(data) - 1)]
        capital = (head >= 65) & (head <= 90) & (ends - starts > 1) & (second >= 97)
        both = []
        for name in (capital & ~opens, capital):
            template = literal.copy()
            template[name | _among(literal, self.names)] = NAME
            template[_DIGIT[head] | _among(literal, self.numbers)] = NUM
            template[_among(literal, self.units)] = UNIT
            both.append(template)
        return Tokens(*both, literal, first, lower, starts, ends)


def _window_hashes(template: np.ndarray, first: np.ndarray, size: int, pw: Powers):
    """Start and hash of each window of `size` tokens inside one text that has enough literals."""
    n = len(template) - size + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    up, down = pw.to(len(template) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(template * up[: len(template)])])
    words = np.concatenate([[0], np.cumsum(template > 255)])
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    use = (text[:n] == text[size - 1 :]) & (words[size:] - words[:n] >= min(LITERALS, size))
    at = np.flatnonzero(use)
    return at, mix((sums[at + size] - sums[at]) * down[at] + np.uint64(size))


def _both_windows(tokens: Tokens, size: int, pw: Powers):
    """Windows of the template, and those of the loose one that differ."""
    at, h = _window_hashes(tokens.template, tokens.first, size, pw)
    differ = np.concatenate([[0], np.cumsum(tokens.template != tokens.loose)])
    if not differ[-1]:
        return at, h
    at2, h2 = _window_hashes(tokens.loose, tokens.first, size, pw)
    use = differ[at2 + size] > differ[at2]
    return np.concatenate([at, at2[use]]), np.concatenate([h, h2[use]])


@dataclass
class Index:
    """Classes of benchmark items, each by the tokens of one item, and their
    windows by size: sorted hashes, and for each its class and place."""

    items: list  # smallest item of each class
    members: list  # per class: values of the placeholders -> smallest item that has them
    tokens: Tokens
    tables: dict

    def slots(self, a: int, b: int) -> np.ndarray:
        return self.tokens.loose[a:b] < 256


def _pattern(values: list) -> tuple:
    """Which values are equal to which: the number of each by first occurrence."""
    seen: dict = {}
    return tuple(seen.setdefault(v, len(seen)) for v in values)


def build_index(item_ids: list, texts: list[bytes]) -> Index:
    """Items shorter than WINDOW tokens are looked up whole; those of fewer than
    LITERALS words that are no placeholders can't be recognised and are left out."""
    canon = Canon()
    one: dict = {}  # template and pattern -> item that stands for the class, values of its items
    lined = [canon(np.frombuffer(t, np.uint8), np.array([0, len(t)])) for t in texts]
    for k, t in sorted(enumerate(lined), key=lambda x: (item_ids[x[0]] is None, item_ids[x[0]])):
        values = tuple(t.word(i) for i in np.flatnonzero(t.loose < 256).tolist())
        rep, members = one.setdefault((t.template.tobytes(), t.loose.tobytes(), _pattern(values)), (k, {}))
        members.setdefault(values, item_ids[k])
    chosen = [texts[k] for k, _ in one.values()]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in chosen])]).astype(np.int64)
    tokens = canon(np.frombuffer(b"".join(chosen), np.uint8), offsets)
    tables: dict = {}
    sizes = np.minimum(np.diff(tokens.first), WINDOW)
    for size in np.unique(sizes[sizes >= LITERALS]).tolist():
        at, h = _both_windows(tokens, size, canon.pw)
        owner = np.searchsorted(tokens.first, at, "right") - 1
        use = sizes[owner] == size
        at, h, owner = at[use], h[use], owner[use]
        order = np.argsort(h, kind="stable")
        tables[size] = (h[order], owner[order].astype(np.int32), (at - tokens.first[owner])[order].astype(np.int32))
    return Index([item_ids[k] for k, _ in one.values()], [m for _, m in one.values()], tokens, tables)


def _consistent(a, b) -> bool:
    """Whether the values in paired slots correspond one to one."""
    pairs = set(zip(a, b))
    return len(pairs) == len({x for x, _ in pairs}) == len({y for _, y in pairs})


def _conforming(theirs: list, ours: list) -> np.ndarray:
    """Which paired slot values keep to one correspondence: the commonest pairs
    first, of equally common ones those of equal values."""
    if _consistent(theirs, ours):
        return np.ones(len(theirs), bool)
    paired = list(zip(theirs, ours))
    counts: dict = {}
    for x in paired:
        counts[x] = counts.get(x, 0) + 1
    left, right, kept = set(), set(), set()
    for x, y in sorted(counts, key=lambda x: (-counts[x], x[0] != x[1])):
        if x not in left and y not in right:
            left.add(x)
            right.add(y)
            kept.add((x, y))
    return np.array([x in kept for x in paired])


def _runs(flags: np.ndarray) -> list:
    turns = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return list(zip(turns[::2].tolist(), turns[1::2].tolist()))


def _judge(index: Index, item: int, alignments: dict, doc: Tokens, base: int, stop: int):
    """(item id, windows, covered, run, same, total) of one class in a document,
    tokens base to stop, or None. `alignments` has per shift the (place, size) of
    its hits. A hit goes on over equal tokens of its alignment; slots that break
    the correspondence are left out."""
    own = index.tokens
    start, total = int(own.first[item]), int(own.first[item + 1] - own.first[item])
    covered, run, windows, same, who = np.zeros(total, bool), 0, 0, True, index.items[item]
    for shift, places in alignments.items():
        low, high = max(0, -shift), min(total, stop - base - shift)
        here, there = base + shift, start  # place 0 of the item in the document and in the index
        theirs, ours = [own.word(there + i) for i in range(low, high)], [doc.word(here + i) for i in range(low, high)]
        equal, slot = np.zeros(total, bool), index.slots(start, start + total)
        equal[low:high] = [x == y for x, y in zip(theirs, ours)]
        mark = equal.copy()  # equal words, or placeholders of one type
        for a, b in ((own.template, doc.template), (own.loose, doc.loose)):
            a, b = a[there + low : there + high], b[here + low : here + high]
            mark[low:high] |= (a == b) & (a < 256)
        value = lambda a, b: ([theirs[i - low] for i in range(a, b) if slot[i]], [ours[i - low] for i in range(a, b) if slot[i]])
        hit = np.zeros(total, bool)
        for place, size in places:
            hit[place : place + size] = mark[place : place + size].all()  # a chance hit of a hash covers nothing
        sound = set()
        for a, b in _runs(hit):  # hits alone
            if _consistent(*value(a, b)):
                covered[a:b] = True
                run = max(run, b - a)
                same &= bool(equal[a:b].all())
                sound |= {(p, size) for p, size in places if a <= p and p + size <= b}
        for a, b in _runs(mark):  # and what they reach
            inner = [(p, size) for p, size in places if a <= p and p + size <= b]
            if not inner:
                continue
            good = np.ones(b - a, bool)
            good[slot[a:b]] = _conforming(*value(a, b))
            whole = {(p, size) for p, size in inner if good[p - a : p - a + size].all()}
            if not whole and int(equal[a:b].sum()) < WINDOW:
                continue
            covered[a:b] |= good
            run = max(run, *(y - x for x, y in _runs(good)))
            sound |= whole
            same &= bool(equal[a:b].all())
        windows += len(sound)
        if (low, high) == (0, total) and mark.all():
            known = index.members[item].get(tuple(value(0, total)[1]))
            if known is not None or tuple(value(0, total)[1]) in index.members[item]:
                who, same = known, True
    return (who, windows, int(covered.sum()), run, same, total) if run else None


def _found(texts, index: Index, canon: Canon):
    """(place, item, classes, windows, covered, run, share, same, contaminated) of
    each text, by its place, that shares windows with the benchmark: of all
    classes the one that it has most of."""
    data, offsets = flat(texts)
    n, at = len(offsets) - 1, 0
    while at < n:  # pieces of bounded size; a text stays whole
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + (1 << 20), "right")) - 1)
        doc = canon(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at])
        parts = []
        for size, (hashes, owner, place) in index.tables.items():
            pos, h = _both_windows(doc, size, canon.pw)
            lo = np.searchsorted(hashes, h, "left")
            hit = np.flatnonzero((lo < len(hashes)) & (hashes[np.minimum(lo, len(hashes) - 1)] == h))
            times = np.searchsorted(hashes, h[hit], "right") - lo[hit]
            k, pos = gather(lo[hit], times), np.repeat(pos[hit], times)
            text = np.searchsorted(doc.first, pos, "right") - 1
            parts.append(np.stack([text, owner[k], pos - doc.first[text] - place[k], place[k], np.full(len(k), size)]))
        hits = np.concatenate(parts, axis=1) if parts else np.zeros((5, 0), np.int64)
        hits = hits[:, np.lexsort(hits[::-1])]
        edges = np.flatnonzero(np.concatenate([[True], (hits[:2, 1:] != hits[:2, :-1]).any(axis=0), [True]])) if hits.shape[1] else np.zeros(1, np.int64)
        best: dict = {}
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            alignments: dict = {}
            for shift, place, size in hits[2:, a:b].T.tolist():
                alignments.setdefault(shift, []).append((place, size))
            text, item = hits[:2, a].tolist()
            seen = _judge(index, item, alignments, doc, int(doc.first[text]), int(doc.first[text + 1]))
            if seen:
                who, windows, covered, run, same, total = seen
                share = covered / total
                now = (share >= COVERAGE or run >= RUN, share, run, same, -item)
                before, count = best.get(text, (None, 0))
                best[text] = ((now, who, windows, covered) if before is None or now > before[0] else before, count + 1)
        for text, ((now, who, windows, covered), count) in best.items():
            yield at + text, who, count, windows, covered, now[2], now[1], now[3], now[0]
        at = to


_ROW = "item_id long, n_classes long, n_windows long, n_covered long, run long, coverage double, same_slots boolean, contaminated boolean"
_TYPES = [pa.int64()] * 5 + [pa.float64(), pa.bool_(), pa.bool_()]


def _leak_batches(batches, index):
    canon, index = Canon(), pickle.loads(index.value)
    for batch in slices(batches):
        rows = list(_found(batch.column(1), index, canon))
        if rows:
            place, *columns = zip(*rows)
            of = [hashlib.blake2b(batch.column(1)[k].as_py() or b"", digest_size=16).digest() for k in place]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(place)), pa.array(of, pa.binary()), *(pa.array(c, t) for c, t in zip(columns, _TYPES))], names=["doc_id", "_of", *(c.split()[0] for c in _ROW.split(", "))])


def _keep_batches(batches, index, column):
    """A batch's rows that hold no contaminated passage."""
    canon, index = Canon(), pickle.loads(index.value)
    for batch in slices(batches):
        keep = np.ones(batch.num_rows, bool)
        keep[[r[0] for r in _found(batch.column(column).cast(pa.binary()), index, canon) if r[-1]]] = False
        yield batch.filter(pa.array(keep))


def _passes(benchmark: DataFrame, item_col: str, text_col: str):
    """(broadcast index, whether it is the only one), one at a time: all items are
    used, in as many passes as their bytes take."""
    spark = benchmark.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(text_col).cast("string").cast("binary").alias("text")).where("text is not null").dropDuplicates()
    size = items.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(1, -(-size // PASS_BYTES))
    for k in range(n):
        table = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).toArrow().sort_by([("item_id", "ascending"), ("text", "ascending")])
        # pickled here, by value: a worker needs no copy of this package to read it
        index = spark.sparkContext.broadcast(cloudpickle.dumps(build_index(table.column("item_id").to_pylist(), table.column("text").to_pylist())))
        yield index, n == 1
        if n > 1:
            index.destroy()


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """A row for each document that shares consistent template windows with the
    benchmark: doc_id, item_id, n_classes, n_windows, n_covered, run, coverage,
    same_slots, contaminated.

    item_id is the item that the document has most of, of items that differ in
    placeholder values alone the one with the document's values, else the
    smallest; n_classes counts the classes of items with a shared window;
    same_slots tells whether all placeholder values of the passage are the item's.
    contaminated documents have COVERAGE of an item's tokens or RUN in a row.

    Null and empty texts have no windows; null identifiers on either side stay
    null; rows that repeat a document, identifier and text, count once, and so
    do repeated items; other columns are ignored; either table empty gives none.
    """
    narrow, out = id_and_bytes(docs, id_col, text_col), None
    for k, (index, only) in enumerate(_passes(benchmark, item_col, item_text_col)):
        part = narrow.mapInArrow(lambda b, i=index: _leak_batches(b, i), f"doc_id long, _of binary, {_ROW}").dropDuplicates(["doc_id", "_of"])
        part = part if only else staged(part, f"leaks-{k}")
        out = part if out is None else out.unionByName(part)
    if only:
        return out.drop("_of")
    best = F.max(F.struct("contaminated", "coverage", "run", "same_slots", (-F.col("item_id")).alias("_least"), "item_id", "n_windows", "n_covered"))
    found = out.groupBy("doc_id", "_of").agg(best.alias("b"), F.sum("n_classes").alias("n_classes"))
    return found.select("doc_id", "b.item_id", "n_classes", *(f"b.{c}" for c in ("n_windows", "n_covered", "run", "coverage", "same_slots", "contaminated")))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` less the contaminated ones; every other row stays as it is."""
    bounded_batches(docs.sparkSession)
    column = docs.columns.index(text_col)
    for k, (index, only) in enumerate(_passes(benchmark, "item_id", "text")):
        docs = docs.mapInArrow(lambda b, i=index: _keep_batches(b, i, column), docs.schema)
        docs = docs if only else staged(docs, f"clean-{k}")
    return docs
