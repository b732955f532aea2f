"""The near stage against brute-force Jaccard similarity."""

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tidemark.llm import jaccard


def shingles(t):
    w = (t or "").encode().lower().split()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) > 5 else {tuple(w)}


def brute(rows):
    """Smallest identifier of each group."""
    sets, label = [shingles(t) for _, t in rows], [i for i, _ in rows]
    for a in range(len(rows)):
        for b in range(a):
            if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]) and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = [low if x == high else x for x in label]
    return set(label)


def edited():
    rng, rows = np.random.default_rng(5), []
    for k in range(25):
        base = [f"w{x}" for x in rng.integers(0, 900, int(rng.integers(3, 150)))]
        for _ in range(4):
            t = list(base)
            for at in rng.integers(0, len(t), int(rng.integers(0, 4))):
                t[at] = f"x{rng.integers(0, 9)}"
            rows.append((len(rows), "a line that all of the texts have in common " * int(rng.integers(0, 2)) + " ".join(t)))
    return [*rows, (len(rows), ""), (len(rows) + 1, None), (len(rows) + 2, "  ")]


@pytest.mark.parametrize("frequent, hot", [(2, 3), (8, 100)])
def test_near_stage_finds_all(spark, sf_dir, monkeypatch, frequent, hot):
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "HOT", hot)
    rows = edited()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, sf_dir).collect()} == brute(rows)
    assert corpus_pipeline.near(spark, docs.limit(0), sf_dir).count() == 0


def test_near_stage_on_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, sf_dir).collect()} == brute([tuple(r) for r in docs.collect()])


def varied(rng, size, edits=0, base=None):
    """A long text of few different words, or `base` with some words replaced."""
    words = list(base) if base else [f"w{x}" for x in rng.integers(0, 60, size)]
    for at in rng.choice(len(words), edits, replace=False):
        words[at] = f"x{at}"
    return words


def test_long_unlike_texts_are_not_moved(spark, sf_dir, monkeypatch):
    rng, rows, moved = np.random.default_rng(7), [], {}
    base = varied(rng, 6000)
    for k in range(12):  # all of them share shingles that a prefix holds
        rows.append((k, " ".join(varied(rng, 6000) + [f"same{x}" for x in range(600)])))
    rows += [(20, " ".join(base)), (21, " ".join(varied(rng, 0, 100, base)))]
    staged = jaccard.staged

    def counted(df, tag, path=None):
        out = staged(df, tag, path)
        if tag.endswith("-ids"):
            moved[tag] = {r.doc_id for r in out.collect()}
        return out

    monkeypatch.setattr(jaccard, "staged", counted)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id for r in corpus_pipeline.near(spark, docs, sf_dir).collect()} == brute(rows) == {*range(12), 20}
    assert set().union(*moved.values()) == {20, 21}


def test_sketches_lose_no_similar_pair():
    rng, texts = np.random.default_rng(11), []
    for size in (3, 900, 1020, 1100, 2040, 2100, 5000, 9000):
        base = varied(rng, size)
        texts += [" ".join(base)] + [" ".join(varied(rng, 0, edits, base)) for edits in (0, size // 50, size // 45, size // 40, size // 30)]
        texts += [" ".join(base[: size - size // 6]), " ".join(base[: size - size // 5])]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array([t.encode() for t in texts])], names=["doc_id", "text"])
    prints = pa.Table.from_batches(list(jaccard._print_batches([batch]))).combine_chunks()
    u, v = np.triu_indices(len(texts), 1)
    columns = [prints[c].chunk(0).take(pa.array(x)) for c in ("n", "fine") for x in (u, v)]
    kept = pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), *columns], names=["u", "v", "n", "m", "a", "b"])
    kept = {(r["u"], r["v"]) for b in jaccard._possible_batches([kept]) for r in b.to_pylist()}
    sets = [shingles(t) for t in texts]
    similar = {(a, b) for a, b in zip(u.tolist(), v.tolist()) if 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b])}
    assert len(similar) > 60 and similar <= kept


def test_texts_are_taken_apart_in_bounded_pieces(monkeypatch):
    rng, sizes, found = np.random.default_rng(3), [], jaccard.shingles_of
    monkeypatch.setattr(jaccard, "shingles_of", lambda column: sizes.append((sum(map(len, column.to_pylist())), len(column))) or found(column))
    text = [" ".join(varied(rng, 30_000)).encode() for _ in range(40)] + [" ".join(varied(rng, 900_000)).encode()]
    ids = pa.array(range(len(text)))
    for batches in (
        jaccard._verified_batches([pa.RecordBatch.from_arrays([ids, ids, pa.array(text), pa.array(text)], names=["u", "v", "a", "b"])]),
        jaccard._print_batches([pa.RecordBatch.from_arrays([ids, pa.array(text)], names=["doc_id", "text"])]),
    ):
        assert sum(b.num_rows for b in batches) == len(text)
    assert all(size <= 1 << 21 or rows <= 2 for size, rows in sizes)
