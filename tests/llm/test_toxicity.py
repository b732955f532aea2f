"""Toxicity: held-out accuracy and misspellings on made-up texts."""

import zlib

import numpy as np
import pytest

from tidemark.llm import toxicity as T

BAD = ["idiot", "moron", "worthless", "disgusting", "pathetic"]


@pytest.fixture(scope="module")
def made():
    rng = np.random.default_rng(0)
    plain = ["".join(rng.choice(list("aeioulnrstdm"), int(rng.integers(2, 9)))) for _ in range(600)]
    rows = []
    for k in range(2400):
        w = list(rng.choice(plain, int(rng.integers(5, 200))))
        toxic = k % 6 == 0
        for _ in range(int(rng.integers(1, 4)) if toxic else 0):
            w.insert(int(rng.integers(0, len(w))), str(rng.choice(BAD)))
        rows.append((k, " ".join(w), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def tables(spark, made):
    docs = spark.createDataFrame([(i, t, "en", "s", 0.5, 1) for i, t, _ in made] + [(9000, "", "en", "s", 0.1, 1), (9001, None, None, None, None, None), (None, "you idiot", "en", "s", 0.1, 1), (5, made[5][1], "en", "s", 0.1, 1)], "doc_id long, text string, lang string, source string, _score double, predicted int")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in made] + [(None, 1, 1), (3, 0, None)], "doc_id long, quality int, toxic int")
    return docs, labels


def test_scores(tables, made):
    docs, labels = tables
    rows = T.score_toxicity(docs, labels).collect()
    assert len(rows) == len(made) + 4 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    truth = {i: y for i, _, y in made}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows if r.doc_id is not None)
    hit = sum(r.predicted for r in held if truth[r.doc_id])
    assert hit >= 0.9 * sum(truth[r.doc_id] for r in held) and sum(r.predicted for r in held if not truth[r.doc_id]) <= 0.03 * len(held)
    by = {r.doc_id: r for r in rows}
    assert by[9000].predicted == by[9001].predicted == 0 and by[None].predicted == 1


def test_misspellings(made):
    """Clean texts with misspelt insults score above almost all clean texts."""
    model = T.fit([t.encode() for _, t, _ in made], np.array([y for *_, y in made]))
    rng = np.random.default_rng(1)
    clean = [t.split() for _, t, y in made if not y][:400]
    bad = ["idiiot", "worthles", "disgustng", "patheticc", "morron"]
    spoilt = []
    for w in clean:
        w = list(w)
        for x in rng.choice(bad, 3):
            w.insert(int(rng.integers(0, len(w))), str(x))
        spoilt.append(w)
    texts = [" ".join(w).encode() for w in clean + spoilt]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    scores = T.predict(np.frombuffer(b"".join(texts), np.uint8), offsets, model)
    assert np.mean(scores[400:] > np.quantile(scores[:400], 0.95)) > 0.6


def test_drop_keeps_columns(tables):
    docs, labels = tables
    left = T.drop_toxic(docs, labels)
    assert left.columns == docs.columns
    assert 0.75 * docs.count() < left.count() < docs.count()


def test_without_labels(spark, tables):
    docs, labels = tables
    rows = T.score_toxicity(docs.limit(5), labels.limit(0)).collect()
    assert len(rows) == 5 and {round(r.score, 6) for r in rows} == {0.01}
    assert T.score_toxicity(docs.limit(0), labels).count() == 0


def test_very_long_texts():
    """The worst passage decides, wherever it stands; pieces don't change a score."""
    model = T.fit([b"you stupid idiot go away now", b"what a lovely day it is"] * 40, np.array([1, 0] * 40), steps=50)
    clean, rude = b"what a lovely day it is " * 20_000, b"you stupid idiot go away now "
    texts = [clean, clean + rude + clean, rude, b"x" * 300_000, b""]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    scores = T.predict(np.frombuffer(b"".join(texts), np.uint8), offsets, model)
    assert len(scores) == 5 and ((scores >= 0) & (scores <= 1)).all() and scores[1] >= scores[0]
    alone = [T.predict(np.frombuffer(t, np.uint8), np.array([0, len(t)]), model)[0] for t in texts]
    assert np.allclose(alone, scores)
