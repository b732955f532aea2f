"""Training-data operators against brute force on small tables."""

import hashlib
import re
import string
import time

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
import xxhash
from pyspark.sql import functions as F

from tidemark.llm import decontam, packing, substring_dedup
from tidemark.llm.common import gather, word_hashes
from tidemark.llm.components import components
from tidemark.llm.exact_dedup import drop_copies, exact_dedup
from tidemark.llm.html_extract import Chain, extract_main_text, features, labelled_pages, leaf_blocks, main_text, trained
from tidemark.llm.pii import find_pii
from tidemark.llm.secrets import find_secrets
from tidemark.llm.simhash import near_dedup, simhash_groups
from tidemark.llm.suffix_dedup import Suffixes, suffix_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, digest string, key string, block int, _gone int, hit int, salt int"
RNG = np.random.default_rng(4)
WORDS = ["".join(RNG.choice(list("abcdeéß日"), int(RNG.integers(1, 9)))) for _ in range(400)]


def prose(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(WORDS, n))


def corpus():
    shared, other = prose(60, 100), prose(45, 101)
    texts = {
        1: prose(80, 1),
        2: prose(80, 1),
        3: prose(80, 1).upper(),
        4: None,
        5: "",
        6: prose(30, 2) + " " + shared + "\n" + prose(30, 3),
        7: prose(40, 4) + "\t" + shared.replace(" ", "  ") + " " + prose(20, 5),
        8: shared + " " + prose(10, 6) + " " + shared + " " + other,
        9: other + other,
        10: "a" * 400,
        11: "b" + "a" * 300 + "b",
        12: prose(6000, 7),
        13: prose(3000, 7) + " x " + prose(200, 8),
        14: "one two",
        15: prose(80, 1).replace("a", "b", 1),
        16: "x" * 49,
        17: "x" * 50,
        18: "x" * 51,
        19: "\x1f\x85   word \x0b\x0c next",
    }
    rows = [(i, t) for i, t in texts.items()]
    return [*rows, rows[0], rows[5], (None, prose(80, 1)), (None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(i, t, "en", f"s{(i or 0) % 3}", len(t or ""), 1, "d", "k", 2, 3, 4, 5) for i, t in corpus()], SCHEMA)


def by_row(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v) for v in r))


def words(t):
    return re.findall(rb"[^\x20\x09-\x0d]+", (t or "").encode())


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_exact(docs):
    low = lambda t: (t or "").encode().lower()
    groups = {}
    for i, t in corpus():
        groups.setdefault(low(t), []).append(i)
    keep = {k: max((i for i in v if i is not None), default=None) for k, v in groups.items()}
    want = [(i, keep[low(t)], len(groups[low(t)]), i == keep[low(t)], sha(low(t))) for i, t in corpus()]
    assert by_row(map(tuple, exact_dedup(docs).collect())) == by_row(want)


def fingerprint(t):
    w = words("".join(c.lower() if c in string.ascii_uppercase else c for c in t or ""))
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), seed=42) for k in range(max(len(w) - 2, 1))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash(docs):
    rows = [(i, fingerprint(t)) for i, t in corpus()]
    label = list(range(len(rows)))
    for _ in rows:
        for a in range(len(rows)):
            for b in range(a):
                if (rows[a][1] ^ rows[b][1]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    least = {x: min((rows[k][0] for k in range(len(rows)) if label[k] == x and rows[k][0] is not None), default=None) for x in set(label)}
    want = [(i, format(f, "016x"), least[label[k]]) for k, (i, f) in enumerate(rows)]
    assert by_row(map(tuple, simhash_groups(docs).collect())) == by_row(want)
    assert by_row(map(tuple, simhash_groups(docs, hot_half=1).collect())) == by_row(want)
    left = near_dedup(docs)
    assert left.columns == docs.columns
    assert {r.doc_id for r in left.collect()} == {x for i, _, x in want if i is not None} | {None}


@pytest.mark.parametrize("hot_half", [0, 3, 1024])
def test_hot_segments_lose_no_link(spark, hot_half):
    """Many fingerprints that share a segment or nearly do; every linked pair meets under some key."""
    from tidemark.llm.simhash import _dealt, _probe_batches

    rng = np.random.default_rng(8)
    low = rng.integers(0, 2**32, 4).astype(np.uint64)
    high = rng.integers(0, 2**32, 6).astype(np.uint64)
    fp = [int(h) << 32 | int(l) for h in high for l in low]
    fp += [f ^ sum(1 << int(x) for x in rng.choice(64, k, replace=False)) for f in fp for k in (1, 2, 3, 3, 4)]
    fp = sorted(set(fp))
    nodes = spark.createDataFrame([(int(np.uint64(f).view(np.int64)), i) for i, f in enumerate(fp)], "fp long, node long")
    probes = nodes.mapInArrow(_probe_batches, "key long, fp long, node long, own boolean")
    met = {}
    for r in _dealt(probes, nodes, hot_half).collect():
        met.setdefault(r.deal, []).append((r.node, r.own))
    together = {(min(a, b), max(a, b)) for g in met.values() for a, own in g if own for b, _ in g if a != b}
    want = {(i, j) for i in range(len(fp)) for j in range(i + 1, len(fp)) if (fp[i] ^ fp[j]).bit_count() <= 3}
    assert want and want <= together


def test_fingerprints_at_a_distance(spark):
    """All pairs of planted fingerprints at up to 3 bits are linked, others not."""
    from tidemark.llm.simhash import _link_batches, _probe_batches

    import pyarrow as pa

    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 60).astype(np.uint64)
    more = [b ^ np.uint64(sum(1 << int(x) for x in rng.choice(64, k, replace=False))) for b in base for k in (1, 2, 3, 4)]
    fp = np.unique(np.concatenate([base, np.array(more, np.uint64), np.arange(40, dtype=np.uint64)]))
    node = np.arange(len(fp))
    probes = list(_probe_batches([pa.RecordBatch.from_arrays([pa.array(fp.view(np.int64)), pa.array(node)], names=["fp", "node"])]))
    links = list(_link_batches(iter(probes), 3))
    u, v = np.concatenate([b.column(0).to_numpy() for b in links]), np.concatenate([b.column(1).to_numpy() for b in links])
    assert (np.bitwise_count(fp[u] ^ fp[v]) <= 3).all()
    got = {(r.node): r.component for r in components(spark.createDataFrame([(int(a), int(b)) for a, b in zip(u, v)], "u long, v long")).collect()}
    label = node.copy()
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    for _ in range(20):
        label = np.array([label[near[k]].min() for k in node])
    assert all(got.get(int(k), int(k)) == label[k] for k in node)


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 40)] + [(100, 50), (50, 100), (7, 7), (None, 3), (60, 61), (61, 62), (62, 60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(1, 41), 1), 50: 50, 100: 50, 60: 60, 61: 60, 62: 60}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute_suffix(rows):
    first = {}
    big = 2**63 - 1
    for i, t in rows:
        b, i = (t or "").encode(), big if i is None else i
        for p in range(len(b) - 49):
            first[b[p : p + 50]] = min(first.get(b[p : p + 50], big), i)
    for i, t in rows:
        b, own = (t or "").encode(), big if i is None else i
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < own:
                gone[p : p + 50] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        yield i, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())


def test_suffix(docs):
    assert by_row(map(tuple, suffix_dedup(docs).collect())) == by_row(brute_suffix(corpus()))


def test_many_blocks_few_buckets(docs, monkeypatch):
    """More blocks than buckets, as for large inputs."""
    from tidemark.llm import anchors

    monkeypatch.setattr(anchors, "BLOCK_BYTES", 3000)
    monkeypatch.setattr(anchors, "MOST_BUCKETS", 3)
    assert by_row(map(tuple, suffix_dedup(docs).collect())) == by_row(brute_suffix(corpus()))
    assert by_row(map(tuple, substring_dedup.substring_dedup(docs).collect())) == by_row(brute_substring(corpus()))


def test_suffix_random(spark):
    """Few letters, many repeats, ties and overlaps."""
    rng = np.random.default_rng(6)
    pool = ["".join(rng.choice(list("ab"), 70)) for _ in range(4)] + ["a" * 130, "ab" * 80]
    rows = [(int(rng.integers(0, 30)), "".join(pool[k] if rng.random() < 0.7 else pool[k][: int(rng.integers(1, 60))] for k in rng.integers(0, len(pool), 3))) for _ in range(60)]
    got = suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_row(map(tuple, got)) == by_row(brute_suffix(rows))


@pytest.mark.parametrize("windows, part", [(1 << 18, 1 << 14), (20, 2)])
def test_window_owners_in_portions(monkeypatch, windows, part):
    """Each window's least document, whatever number of windows is sorted at once."""
    from tidemark.llm import anchors, suffix_dedup as module

    monkeypatch.setattr(module, "_WINDOWS", windows)
    monkeypatch.setattr(module, "_PART", part)
    rng = np.random.default_rng(12)
    pool = ["".join(rng.choice(list("abc"), 90)).encode() for _ in range(5)]
    texts = [b"".join(pool[k] for k in rng.integers(0, 5, 3)) for _ in range(40)]
    offsets = np.cumsum([0, *map(len, texts)])
    data = np.frombuffer(b"".join(texts), np.uint8)
    p1, p2, far, near, _, _ = anchors.fragments(data, offsets, 50, 20, anchors.Powers())
    low = rng.integers(0, 30, len(p1))
    buf = data[gather(p1, p2 - p1 + 50)]
    want, got = {}, {}
    for f in range(len(p1)):
        for w in range(int(p1[f]), int(p2[f]) + 1):
            text = data[w : w + 50].tobytes()
            want[text] = min(want.get(text, 99), int(low[f]))
    for f, a, b, least in (x for group in module.smallest_owner(buf, far, near, low) for x in zip(*(v.tolist() for v in group))):
        for d in range(a, b + 1):
            assert (f, d) not in got
            got[f, d] = least
    assert got == {(f, int(p1[f] + far[f] - w)): want[data[w : w + 50].tobytes()] for f in range(len(p1)) for w in range(int(p1[f]), int(p2[f]) + 1)}


def test_suffix_collision():
    """Claims of equality are verified: with hashes that all agree the order still holds."""
    texts = [b"m" * 50 + b"z", b"a" * 51, b"m" * 50 + b"a", b"a" * 51]
    buf = np.frombuffer(b"".join(texts), np.uint8)
    begin, size = np.arange(4) * 51, np.full(4, 51)
    s = Suffixes(buf, begin, size)
    s.sums = np.zeros_like(s.sums)
    order, same = s.sort(begin, np.zeros(4, np.int64), size, np.zeros(4, np.int64))
    assert [texts[i] for i in order] == sorted(texts) and same.tolist() == [False, True, False, False]


def brute_substring(rows):
    count = {}
    for _, t in rows:
        w = words(t)
        for p in range(len(w) - 34):
            count[tuple(w[p : p + 35])] = count.get(tuple(w[p : p + 35]), 0) + 1
    for i, t in rows:
        w = words(t)
        gone = np.zeros(len(w), bool)
        for p in range(len(w) - 34):
            if count[tuple(w[p : p + 35])] > 1:
                gone[p : p + 35] = True
        yield i, len(w), int(gone.sum()), sha(b" ".join(x for x, g in zip(w, gone) if not g))


def test_substring(docs):
    assert by_row(map(tuple, substring_dedup.substring_dedup(docs).collect())) == by_row(brute_substring(corpus()))


def test_substring_random(spark, monkeypatch):
    rng = np.random.default_rng(8)
    pool = [list(rng.choice(["x", "y"], 50)) for _ in range(3)] + [["x"] * 90]
    rows = [(k, " ".join(w for j in rng.integers(0, len(pool), 2) for w in pool[j][int(rng.integers(0, 12)) :])) for k in range(40)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_row(map(tuple, got)) == by_row(brute_substring(rows))


def test_automaton_counts():
    rng = np.random.default_rng(9)
    seqs, times = [rng.integers(0, 3, int(rng.integers(1, 30))).tolist() for _ in range(25)], rng.integers(1, 3, 25).tolist()
    auto = substring_dedup.Automaton()
    for s, t in zip(seqs, times):
        auto.add(s, t)
    auto.settle()
    count = {}
    for s, t in zip(seqs, times):
        for p in range(len(s) - 3):
            count[tuple(s[p : p + 4])] = count.get(tuple(s[p : p + 4]), 0) + t
    probe = rng.integers(0, 3, 200).tolist()
    assert auto.repeated(probe, 4) == [count.get(tuple(probe[p : p + 4]), 0) > 1 for p in range(197)]


def luhn(d):
    return sum(x if k % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for k, x in enumerate(int(c) for c in reversed(d))) % 10 == 0


def brute_pii(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]
    return out


def pii_texts():
    rng = np.random.default_rng(10)
    parts = ["a.b@c.d", "@", "a@b", "x@y.z.w_q@e.f", "1.2.3.4", "999.1.1.1", "001.002.003.004", "1.2.3.4.5.6.7.8", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1112", "é日", " ", "  ", "-", "+1 (606) 555-7814", "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6", "0", "12", ".", "x", "\n", "+", "49927398716", "6011000990139424"]
    return ["".join(rng.choice(parts, int(rng.integers(1, 14)))) for _ in range(400)] + [None, "", "a" * 5000 + "@", "1 " * 4000, "9" * 5000]


def test_pii(spark):
    texts = pii_texts()
    df = spark.createDataFrame([(k if k % 50 else None, t, k, "e", 1) for k, t in enumerate(texts)], "doc_id long, text string, row int, email string, ip int")
    got = {r.base_sha256 + str((r.n_email, r.n_ip, r.n_card, r.n_phone)) for r in find_pii(df).collect()}
    want = set()
    for t in texts:
        spans = brute_pii(t or "")
        want.add(sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()) + str(tuple(sum(s[0] == k for s in spans) for k in ("email", "ip", "card", "phone"))))
    assert got == want
    assert find_pii(df.limit(0)).count() == 0


def test_pii_added(spark):
    texts = ["my IBAN is DE89 3704 0044 0532 0130 00 ok", "DE88 3704 0044 0532 0130 00", "credit card 378282246310005 thanks", "number 378282246310005", "call me at (606) 555-7814 today", "order (606) 555-7814"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.spans for r in rows] == ["iban:11:38", "", "short_card:12:27", "", "local_phone:11:25", ""]


def test_pii_iban_before_capitals_and_digits(spark):
    texts = ["DE89370400440532013000 Please", "DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89 3704 0044 0532 0130 00 2024", "DE89 3704 0044 0532 0130 00", "DE893704004405320130007", "DE88 3704 0044 0532 0130 00 Please"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [[x for x in r.spans.split(",") if x.startswith("iban")] for r in rows] == [["iban:0:22"], ["iban:0:27"], ["iban:0:27"], ["iban:0:27"], [], []]


def brute_secrets(t):
    out = [(m.start(), 0, "assign", m.end()) for m in re.finditer(r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[1]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 16]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def test_secrets(spark):
    rng = np.random.default_rng(11)
    parts = ["password", "PassWord", "api_key", "APIKEY", "token", "=", ":", " ", '"', "'", "abcdef0123456789", "0123456789abcde", "AKIA", "AKIAABCDEFGHIJ1234", "é", "Zz9+/_.=-", "\n", "secret=", "x", "hunter2hunter2"]
    texts = ["".join(rng.choice(parts, int(rng.integers(1, 14)))) for _ in range(400)] + [None, "", "a" * 3000, "token=" * 300]
    df = spark.createDataFrame([(k, t, "h") for k, t in enumerate(texts)], "doc_id long, text string, hex string")
    for r in find_secrets(df).collect():
        spans = brute_secrets(texts[r.doc_id] or "")
        assert r.base_sha256 == sha(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()), texts[r.doc_id]
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(s[0] == k for s in spans) for k in ("assign", "access", "hex"))
    assert find_secrets(df.limit(0)).count() == 0


def test_random_strings(spark):
    texts = ["key Xk9vQ2mPz7LrT4wYbN8sHd3J end", "internationalisation_of_everything", "550e8400-e29b-41d4-a716-446655440000", "thequickbrownfoxjumpsoverthelazydog", "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"]
    rows = find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_random for r in rows] == [1, 0, 0, 0, 1]
    assert rows[0].spans == "random:4:28"


def test_leaks(spark):
    items = [(0, "A train leaves Boston at 40 miles per hour and Anna waits 3 hours for it to come back to the old station"), (1, None), (2, "tiny one"), (3, "Why does the moon of a small planet seem to follow every car that drives along the coast at night?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = [
        "Intro words. A train leaves Denver at 75 km per hour and Maria waits 9 hours for it to come back to the old station! More.",
        "They said: why does the MOON of a small planet seem to follow every car, that drives along the coast at night. End",
        "the moon of a small planet is nice and every car that drives is red",
        None,
        "",
        prose(300, 50),
        "1 2 3 4 5 6 7 8 9 10 11 12 13 14 15 16 17 18 19 20",
    ]
    docs = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, item_id long")
    rows = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(docs, bench).collect() if r.contaminated}
    assert set(rows) == {(0, 0), (1, 3)}
    assert not rows[0, 0].same_slots and rows[1, 3].same_slots
    assert sorted(r.doc_id for r in decontam.drop_leaks(docs, bench).collect()) == [2, 3, 4, 5, 6]
    assert decontam.find_leaks(docs, bench.limit(0)).count() == 0 and decontam.find_leaks(docs.limit(0), bench).count() == 0


def test_leaks_need_consistent_slots():
    assert decontam._consistent(np.array([1, 2, 1]), np.array([5, 6, 5]))
    assert not decontam._consistent(np.array([1, 2, 1]), np.array([5, 6, 7]))
    assert not decontam._consistent(np.array([1, 2]), np.array([5, 5]))


def test_leaks_of_many_numbers_and_one_edited(spark):
    many = "Sort these numbers from low to high: 4, 8, 15, 16, 23, 42, 7, 9, 11, 13, 5, 6, 31, 27"
    twice = "the cook puts 3 red apples in the old basket and 3 green pears beside it"
    bench = spark.createDataFrame([(0, many), (1, twice)], "item_id long, text string")
    docs = spark.createDataFrame([(0, f"First. {many}. Last."), (1, twice.replace("3 green", "4 green")), (2, "Sort these numbers from low to high by hand")], "doc_id long, text string")
    rows = {(r.doc_id, r.item_id): r for r in decontam.find_leaks(docs, bench).collect() if r.contaminated}
    assert set(rows) == {(0, 0), (1, 1)} and rows[0, 0].coverage == 1.0 and rows[0, 0].same_slots
    assert rows[1, 1].n_covered == 15 and not rows[1, 1].same_slots


def test_leaks_in_passes(spark, monkeypatch):
    bench = spark.createDataFrame([(k, prose(20, 200 + k)) for k in range(30)], "item_id long, text string")
    docs = spark.createDataFrame([(k, prose(10, 300 + k) + " " + prose(20, 200 + k) + " " + prose(5, 400)) for k in range(30)], "doc_id long, text string")
    monkeypatch.setattr(decontam, "PASS_BYTES", 700)
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(docs, bench).collect() if r.contaminated} == {(k, k) for k in range(30)}


def test_html_accuracy():
    chain, wrong, total = trained(), 0, 0
    for page, labels in labelled_pages(150, seed=77):
        got = chain.decode(chain.lean(features(leaf_blocks(page))))
        total += len(labels)
        wrong += sum(a != b for a, b in zip(got, labels))
    assert total > 1000 and wrong < 0.01 * total


def test_html_text(spark):
    body = "<p>First  line &amp; more&nbsp;text of the story here.<br>Still first.</p><script>if (a<b) '</p>'</script><p>Second &lt;b&gt; line é of the same story.</p>"
    page = f'<!DOCTYPE html><html><head><title>T</title></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav><article><h1>Title of it</h1>{body}</article><footer>&copy; x</footer>'
    rows = [(1, "u", page), (2, None, None), (3, "v", ""), (4, "w", "<" * 3000 + "<p" * 3000), (5, "x", "<div>" * 20000 + "deep")]
    df = spark.createDataFrame([(*r, "t", 1) for r in rows], "page_id long, url string, html string, text string, n_chars int")
    got = {r.page_id: r for r in extract_main_text(df).collect()}
    want = "Title of it\nFirst line & more text of the story here. Still first.\nSecond <b> line é of the same story."
    assert got[1].text == want and got[1].n_chars == len(want)
    assert (got[2].text, got[2].n_chars, got[2].url) == ("", 0, None) and got[3].text == "" and set(got) == {1, 2, 3, 4, 5}


def simple_best_fit(lengths, sources, clusters, capacity):
    bins, out = [], []
    for n, s, c in zip(lengths, sources, clusters):
        fits = [k for k, b in enumerate(bins) if b[0] >= n and not (s >= 0 and s in b[1]) and not (c >= 0 and c in b[2])]
        k = min(fits, key=lambda k: (bins[k][0], k), default=None)
        if k is None:
            bins.append([capacity, set(), set()])
            k = len(bins) - 1
        bins[k][0] -= n
        bins[k][1].add(s)
        bins[k][2].add(c)
        out.append(k)
    return out


def test_best_fit_model():
    rng = np.random.default_rng(12)
    for trial in range(20):
        n = int(rng.integers(1, 300))
        lengths, sources, clusters = np.sort(rng.integers(0, 60, n))[::-1], rng.integers(-1, 90 if trial % 2 else 6, n), rng.integers(-1, 100, n)
        got, start = packing.best_fit(lengths, sources, clusters, 100)
        assert got.tolist() == simple_best_fit(lengths, sources, clusters, 100)
        for b in set(got.tolist()):
            own = sorted((int(start[k]), int(lengths[k])) for k in range(n) if got[k] == b)
            assert [a for a, _ in own] == np.concatenate([[0], np.cumsum([x for _, x in own])[:-1]]).tolist()


def test_pack(docs, spark):
    rows = packing.pack(docs, capacity=500).collect()
    size = {}
    for i, t in corpus():
        size.setdefault(i, []).append(len(words(t)))
    got = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + r.n_tokens
    assert got == {i: sum(v) for i, v in size.items()}
    bins = {}
    for r in rows:
        bins.setdefault(r.bin_id, []).append(r)
    for b in bins.values():
        assert sum(r.n_tokens for r in b) <= 500
        assert len({r.source for r in b}) == len(b)
        assert len({(r.doc_id, r.piece) for r in b}) == len(b)
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(spark.createDataFrame([(1, "a b", None), (2, "c", None)], "doc_id long, text string, source string")).select("bin_id").distinct().count() == 1


@pytest.mark.parametrize("operator", [exact_dedup, simhash_groups, suffix_dedup, substring_dedup.substring_dedup, find_pii, find_secrets])
def test_empty_tables(operator, docs):
    out = operator(docs.limit(0))
    assert out.count() == 0 and "doc_id" in out.columns


def test_all_null(spark):
    df = spark.createDataFrame([(None, None), (None, None)], "doc_id long, text string")
    for operator in (exact_dedup, simhash_groups, suffix_dedup, substring_dedup.substring_dedup, find_pii, find_secrets):
        assert [r.doc_id for r in operator(df).collect()] == [None, None]
    assert [r.keep_id for r in exact_dedup(df.select(F.lit(3).cast("long").alias("doc_id"), "text")).collect()] == [3, 3]


def thue_morse(n):
    """Two different words whose polynomial hashes modulo 2**64 agree for every base."""
    a = "a"
    for _ in range(n):
        a += a.translate(str.maketrans("ab", "ba"))
    return a, a.translate(str.maketrans("ab", "ba"))


def test_substring_keeps_colliding_words(spark):
    a, b = thue_morse(11)
    rows = [(1, prose(34, 60) + " " + a), (2, prose(34, 60) + " " + b), (3, prose(40, 61) + " " + a), (4, prose(40, 61) + " " + a)]
    got = substring_dedup.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert by_row(map(tuple, got)) == by_row(brute_substring(rows))


def test_hashes_without_use(docs, spark, monkeypatch):
    """Every hash that fragments or words meet by says the same; bytes decide."""
    from tidemark.llm import anchors, suffix_dedup as module

    def blunt(*args):
        *rest, key = anchors.fragments(*args)
        return *rest, np.zeros_like(key)

    rng = np.random.default_rng(3)
    pool = [" ".join(rng.choice(["x", "yy", "z"], 60)) for _ in range(3)]
    rows = [(k, " ".join(pool[j] for j in rng.integers(0, 3, 2))) for k in range(12)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(module, "fragments", blunt)
    monkeypatch.setattr(substring_dedup, "fragments", blunt)
    table = df.select("doc_id", F.col("text").cast("binary")).toArrow()
    # the steps in one process, so that the stand-ins hold
    for operator, brute in ((module, brute_suffix), (substring_dedup, brute_substring)):
        sent = operator._grams(0, table, 2)
        answers = [anchors.shared_grams(sent.filter(pc.equal(sent["bucket"], b))) for b in sorted(set(sent["bucket"].to_pylist()))]
        parts = operator._pieces(0, table, pa.concat_tables(answers), 2)
        found = [operator._compare(parts.filter(pc.equal(parts["bucket"], b))) for b in sorted(set(parts["bucket"].to_pylist()))]
        got = operator._apply(table, pa.concat_tables(found)).to_pylist()
        assert by_row(tuple(r.values()) for r in got) == by_row(brute(rows))


def test_word_hashes():
    texts = [b"", b"a", b"ab", b"abcdefgh", b"abcdefghi", b"x" * 64, b"x" * 65, b"x" * 66, *(x.encode() for x in thue_morse(10))]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    data = np.frombuffer(b"".join(texts), np.uint8)
    h = word_hashes(data, offsets[:-1], offsets[1:])
    assert len(set(h.tolist())) == len(texts)
    again = word_hashes(np.concatenate([data, data]), offsets[:-1] + len(data), offsets[1:] + len(data))
    assert again.tolist() == h.tolist()


def test_largest_identifier(spark):
    top = 2**63 - 1
    rows = [(top, prose(60, 62)), (None, "x"), (5, prose(60, 62))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for operator in (suffix_dedup, substring_dedup.substring_dedup, exact_dedup, find_pii, find_secrets, simhash_groups):
        assert by_row((r.doc_id,) for r in operator(df).collect()) == by_row((i,) for i, _ in rows)
    bench = spark.createDataFrame([(None, prose(40, 62))], "item_id long, text string")
    assert {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, bench).collect()} == {(top, None), (5, None)}


def test_exact_repeated_identifiers(spark, docs):
    rows = [(5, "a"), (5, "z"), (9, "a"), (9, "A"), (None, "z"), (None, "q"), (None, "Q"), (9, "b"), (9, "b"), (2, "")]
    df = spark.createDataFrame([(i, t, f"s{k}") for k, (i, t) in enumerate(rows)], "doc_id long, text string, kept string")
    groups = {}
    for i, t in rows:
        groups.setdefault(t.lower(), []).append(i)
    keep = {t: max((i for i in v if i is not None), default=None) for t, v in groups.items()}
    want = [(i, keep[t.lower()], len(groups[t.lower()]), i == keep[t.lower()], sha(t.lower().encode())) for i, t in rows]
    assert by_row(map(tuple, exact_dedup(df).collect())) == by_row(want)
    left = drop_copies(df)
    assert left.columns == df.columns
    assert by_row((r.doc_id, r.text.lower()) for r in left.collect()) == by_row((i, t) for t, i in keep.items())
    assert drop_copies(docs.limit(0)).count() == 0 and drop_copies(docs).columns == docs.columns


@pytest.mark.parametrize("key_bytes", [0, 1])
def test_exact_with_clashing_keys(docs, key_bytes):
    assert by_row(map(tuple, exact_dedup(docs, key_bytes=key_bytes).collect())) == by_row(map(tuple, exact_dedup(docs).collect()))


def test_settings_stay(spark, docs):
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.streaming.stateStore.providerClass", "spark.sql.streaming.stateStore.rocksdb.allowFAllocate")}
    for operator in (exact_dedup, simhash_groups, find_secrets):
        operator(docs).count()
    assert before == {k: spark.conf.get(k, None) for k in before}


def test_pii_many_matches(spark):
    """Time grows with the matches, not with their square."""
    took = []
    for n in (5_000, 100_000):
        df = spark.createDataFrame([(1, " ".join(f"user{k}@host{k}.example.org (606) 555-{k % 10000:04d}" for k in range(n)))], "doc_id long, text string")
        began = time.time()
        row = find_pii(df).first()
        took.append(time.time() - began)
        assert row.n_email == n
    assert took[1] < 60


def test_pii_nearby_words(spark):
    texts = ["call " + "(606) 555-7814 " * 3 + "x" * 50 + " (606) 555-7815", "é" * 38 + " tel (606) 555-7814", "tel " + "é" * 37 + "(606) 555-7814", "(606) 555-7814" + "é" * 35 + " fax", "(606) 555-7814" + "é" * 37 + " fax"]
    rows = find_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_added for r in rows] == [1, 1, 0, 1, 0]


def test_html_long_attributes_and_deep_pages(spark):
    chain = Chain(*trained().whole())
    for n in (100, 5_000, 200_000):
        page = f'<html><body><article><h1>The title of it</h1><p data-state="a > {"x" * n} <p>">The first line of a story that goes on.</p><p>And this is the second line of that story.</p></article></body></html>'
        assert main_text(page, chain) == "The title of it\nThe first line of a story that goes on.\nAnd this is the second line of that story."
    assert [b[0] for b in leaf_blocks("<p title='it>one</p><p>two</p>")] == ["one", "two"]
    assert [b[0] for b in leaf_blocks("<p>Energy is <math><mi>E</mi><annotation>E=</annotation></math> always.</p><noscript><p>Kept too.</p></noscript>")] == ["Energy is E always.", "Kept too."]
    took = []
    for n in (5_000, 50_000):
        page = "".join(f'<div class="n{chr(97 + k % 26)}{chr(97 + k // 26 % 26)}{chr(97 + k // 676 % 26)}x">text {k} ' for k in range(n))
        began = time.time()
        main_text(page, chain)
        took.append(time.time() - began)
    assert took[1] < 40 * took[0] + 1
    for page in ("<b>" * 50_000 + "x<div>y</div>" * 20_000, "<ul><li><ul>" + "<b>" * 30_000 + "<li>x</li>" * 30_000, "<p '" * 50_000, '<p a="' * 50_000):
        began = time.time()
        main_text(page, chain)
        assert time.time() - began < 20
    df = spark.createDataFrame([(1, "u", "<p>a</p>"), (1, "u", "<p>a</p>")], "page_id long, url string, html string")
    a, b = extract_main_text(df).collect()
    assert a == b and extract_main_text(df.limit(0)).count() == 0


def test_running_scores_are_the_features(spark):
    chain = Chain(*trained().whole())
    for page, _ in labelled_pages(20, seed=5):
        rows = features(leaf_blocks(page))
        want = "\n".join(b[0] for b, label in zip(leaf_blocks(page), chain.decode(chain.lean(rows))) if label)
        assert main_text(page, chain) == want


def test_secrets_of_one_case_and_beyond_base_spans(spark):
    texts = ["key qzxwvkjhgfdplmnbtrcy end", "password=Xk9vQ2mPz7LrT4wYbN8sHd3J", "Xk9vQ2mPz7_0123456789abcdef_T4wYbN8sHd3J", "internationalisation nationalisations"]
    rows = find_secrets(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).orderBy("doc_id").collect()
    assert [r.n_random for r in rows] == [1, 0, 1, 0]


def test_leaks_of_other_names_and_numbers(spark):
    """Questions with other values, names at the start of a sentence too, and classes of them."""
    names, other = ["Natalia", "Weng", "Betty", "Julia", "Alice", "Ken"], ["Priya", "Omar", "Chen", "Lucia", "Bjorn", "Zola"]
    forms = [
        "{0} sold {2} clips in April, and then sold half as many clips in May. How many clips did {0} sell altogether?",
        "{0} earns {2} dollars an hour for babysitting. Yesterday {0} and {1} did {3} minutes of babysitting. How much did they earn?",
        "A farmer has {2} cows in the old barn and {3} sheep on the hill. {0} buys {3} more. How many animals are there now?",
        "If {0} walks {2} km to the lake and {1} drives {3} km to the same place, who needs more time at an equal pace?",
    ]
    rng = np.random.default_rng(2)
    bench, docs = [], []
    for k in range(200):
        pick = lambda xs: [xs[j] for j in rng.choice(len(xs), 2, replace=False)]
        bench.append((k, forms[k % 4].format(*pick(names), *rng.choice(90, 2, replace=False) + 3)))
        docs.append((k, prose(30, 500 + k) + ". " + forms[k % 4].format(*pick(other), *rng.choice(900, 2, replace=False) + 100) + " " + prose(30, 800 + k)))
    docs += [(1000 + k, prose(200, 900 + k)) for k in range(50)]
    got = {r.doc_id for r in decontam.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(bench, "item_id long, text string")).collect() if r.contaminated}
    assert len(got & set(range(200))) >= 190 and not got - set(range(200))


def test_leak_windows_are_compared_in_full(monkeypatch):
    """A chance hit of the window's hash covers nothing."""
    monkeypatch.setattr(decontam, "mix", lambda x: np.zeros_like(x))
    index = decontam.build_index([7], [b"why does the moon of a small planet seem to follow every car"])
    texts = pa.array([prose(40, 70).encode(), b"so why does the moon of a small planet seem to follow every car", b"", None], pa.binary())
    assert [(r[0], r[1], r[-1]) for r in decontam._found(texts, index, decontam.Canon())] == [(1, 7, True)]


def test_leak_classes(spark):
    bench = spark.createDataFrame([(k, f"the cook puts {k + 3} red apples in the old basket and {k + 90} green pears beside it") for k in range(50)], "item_id long, text string")
    docs = spark.createDataFrame([(1, "the cook puts 13 red apples in the old basket and 100 green pears beside it"), (1, "the cook puts 13 red apples in the old basket and 100 green pears beside it"), (2, "the cook puts 5 red apples in the old basket and 1 green pears beside it")], "doc_id long, text string")
    rows = {r.doc_id: r for r in decontam.find_leaks(docs, bench).collect()}
    assert (rows[1].item_id, rows[1].same_slots, rows[1].n_classes) == (10, True, 1) and (rows[2].item_id, rows[2].same_slots) == (0, False)


def test_pack_spreads_equal_rows(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 50)
    rows = packing.pack(spark.createDataFrame([(1, "a b c", "s")] * 400 + [(2, "d", None)], "doc_id long, text string, source string")).collect()
    shards = {}
    for r in rows:
        shards.setdefault(r.bin_id.split("-")[0], []).append(r)
    assert len(rows) == 401 and max(len(v) for v in shards.values()) <= 250 and len(shards) > 2
