"""Toxicity by subword-bag embeddings (operator 2).

A word is the bag of its character n-grams (3 to 5, with end marks) and itself,
hashed into buckets; a passage is the average of its words' averages; a linear
softmax over two classes reads it. Embeddings and softmax are trained jointly
in numpy. A document's score is that of its worst passage, so a short insult in
a long text is not averaged away. Misspellings share most n-grams of the words
they come from.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from tidemark.llm.common import bounded_batches, flat, id_and_bytes, slices, unused, word_hashes, words_of

BUCKETS, DIM = 1 << 16, 12
#: Words in a passage, and from one passage's start to the next.
PASSAGE, STRIDE = 12, 6
#: Bounds of the training sample: labelled rows of either class, bytes of one text.
MAX_POSITIVE, MAX_NEGATIVE, MAX_TEXT = 3000, 6000, 200_000
THRESHOLD = 0.3
#: Step of the embeddings.
RATE = 1.5
#: Share of words misspelt in training, ways in which a telling one is, and how
#: many of these are kept for setting slope and shift.
MISSPELT, TWINS, HELD_TWINS = 0.1, 32, 8

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Model:
    """`scores` holds, per bucket, how far its vector leans to the toxic class;
    `empty` stands for the worst passage of a text without words."""

    scores: np.ndarray
    bias: float
    slope: float
    shift: float
    empty: float = 0.0
    vectors: np.ndarray | None = None
    softmax: np.ndarray | None = None


def _marked(data: np.ndarray, starts: np.ndarray, ends: np.ndarray):
    """Lower-cased words with `<` before and `>` after, end to end, and where each starts."""
    sizes = ends - starts + 2
    at = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.empty(at[-1] + 5, np.uint8)
    buf[at[-1] :] = 0
    inner = np.ones(at[-1], bool)
    inner[at[:-1]] = False
    inner[at[1:] - 1] = False
    source = np.ones(int((ends - starts).sum()), np.int64)
    first = np.concatenate([[0], np.cumsum(ends - starts)[:-1]])
    source[first[1:]] = starts[1:] - ends[:-1] + 1
    source[0] = starts[0]
    body = buf[: at[-1]]
    body[inner] = _LOWER[data[np.cumsum(source)]]
    body[at[:-1]] = 60
    body[at[1:] - 1] = 62
    return buf, at, sizes


def _gram_ids(buf: np.ndarray, at: np.ndarray, sizes: np.ndarray):
    """For n = 3, 4, 5: bucket of the n-gram at each byte, and whether it lies in one word."""
    total = int(at[-1])
    left = np.repeat(at[1:], sizes) - np.arange(total)  # bytes from here to the word's end
    packed = buf[:total].astype(np.uint64) | buf[1 : total + 1].astype(np.uint64) << np.uint64(8)
    for n in (3, 4, 5):
        packed = packed | buf[n - 1 : total + n - 1].astype(np.uint64) << np.uint64(8 * (n - 1))
        yield ((packed * np.uint64(0x9E3779B97F4A7C15 + 2 * n)) >> np.uint64(48)).astype(np.int64), left >= n


def _word_sums(data, starts, ends, scores: np.ndarray) -> np.ndarray:
    """Average lean of each word's n-grams and itself."""
    if not len(starts):
        return np.zeros(0, np.float64)
    buf, at, sizes = _marked(data, starts, ends)
    value = np.zeros(int(at[-1]), np.float32)
    for ids, valid in _gram_ids(buf, at, sizes):
        value += np.where(valid, scores[ids], np.float32(0))
    total = np.add.reduceat(value, at[:-1], dtype=np.float64)
    low = word_hashes(buf, at[:-1], at[1:])
    total += scores[(low >> np.uint64(48)).astype(np.int64)]
    grams = np.maximum(sizes - 2, 0) + np.maximum(sizes - 3, 0) + np.maximum(sizes - 4, 0) + 1
    return total / grams


def _passages(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends, in words, of a text's passages; the last may be shorter."""
    starts = np.arange(0, max(n - PASSAGE + STRIDE, 1), STRIDE)
    return starts, np.minimum(starts + PASSAGE, n)


def _worst(word_scores: np.ndarray, begin: np.ndarray, empty: float) -> np.ndarray:
    """For each text (words begin[i] to begin[i+1]) the largest passage average."""
    sums = np.concatenate([[0.0], np.cumsum(word_scores)])
    out = np.full(len(begin) - 1, empty)
    for i, (a, b) in enumerate(zip(begin[:-1].tolist(), begin[1:].tolist())):
        if b > a:
            s, e = _passages(b - a)
            out[i] = ((sums[a + e] - sums[a + s]) / (e - s)).max()
    return out


def predict(data: np.ndarray, offsets: np.ndarray, model: Model) -> np.ndarray:
    """Score of each text, in pieces of bounded size (a text's words stay whole)."""
    starts, ends, begin = words_of(data, offsets)
    scores = np.empty(len(starts))
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(ends, starts[at] + (1 << 18))))
        low = int(starts[at])
        scores[at:to] = _word_sums(data[low : int(ends[to - 1])], starts[at:to] - low, ends[at:to] - low, model.scores)
        at = to
    logit = model.slope * (_worst(scores, begin, model.empty) + model.bias) + model.shift
    return 1 / (1 + np.exp(-np.clip(logit, -60, 60)))


# -- training ----------------------------------------------------------------


def _misspell(word: bytes, rng) -> bytes:
    """One letter swapped with the next, doubled, dropped or replaced."""
    if len(word) < 4:
        return word
    i, how = int(rng.integers(0, len(word))), int(rng.integers(4))
    if how == 0:
        return word[:i] + word[i + 1 : i + 2] + word[i : i + 1] + word[i + 2 :]
    if how == 1:
        return word[:i] + word[i : i + 1] * 2 + word[i + 1 :]
    if how == 2:
        return word[:i] + word[i + 1 :]
    return word[:i] + bytes([int(rng.choice(np.frombuffer(b"01345@*aeiou", np.uint8)))]) + word[i + 1 :]


def _word_odds(seqs, labels, n_types: int) -> np.ndarray:
    """Log odds of a word type in toxic over clean texts, zero below three toxic texts."""
    counts = np.zeros((2, n_types))
    for s, y in zip(seqs, labels):
        counts[int(y), np.unique(s)] += 1
    total = np.array([(labels == 0).sum(), (labels == 1).sum()])
    odds = np.log((counts[1] + 0.5) / (total[1] + 1)) - np.log((counts[0] + 0.5) / (total[0] + 1))
    return np.where(counts[1] >= 3, np.maximum(odds, 0), 0)


def _type_grams(words: list[bytes]):
    """Buckets of all words' n-grams and of the words themselves, in order of words,
    and the number of each word's."""
    data = np.frombuffer(b" ".join(words), np.uint8)
    starts, ends, _ = words_of(data, np.array([0, len(data)]))
    buf, at, sizes = _marked(data, starts, ends)
    owner = np.repeat(np.arange(len(words)), sizes)
    ids, of = [word_hashes(buf, at[:-1], at[1:]) >> np.uint64(48)], [np.arange(len(words))]
    for gram, valid in _gram_ids(buf, at, sizes):
        ids.append(gram[valid])
        of.append(owner[valid])
    of = np.concatenate(of)
    order = np.argsort(of, kind="stable")
    return np.concatenate([x.astype(np.uint16) for x in ids])[order], np.bincount(of, minlength=len(words))


def fit(texts: list[bytes], labels: np.ndarray, seed: int = 7, steps: int = 500) -> Model:
    """Train on whole texts. Of each text the passage that looks worst is read
    (and, of clean texts, two others): at first by the odds of its words, then
    by the model itself. Some words are misspelt on the way."""
    rng = np.random.default_rng(seed)
    labels = np.asarray(labels, np.float64)
    zero = Model(np.zeros(BUCKETS, np.float32), 0.0, 1.0, 0.0)
    if len(texts) == 0 or labels.min() == labels.max():
        p = float(np.clip(labels.mean(), 0.01, 0.99)) if len(texts) else 0.01
        zero.shift = float(np.log(p / (1 - p)))
        return zero
    # words as types, each with its buckets (of 16 bits)
    types: dict[bytes, int] = {}
    seqs = [np.array([types.setdefault(w, len(types)) for w in t.lower().split()], np.int32) for t in texts]
    seen = np.bincount(np.concatenate([*seqs, np.zeros(0, np.int32)]), minlength=len(types))
    vocab = list(types)
    check = rng.random(len(seqs)) < 0.2  # a fifth sets slope and shift only
    use = [i for i, s in enumerate(seqs) if len(s) and not check[i]]
    odds = _word_odds([seqs[i] for i in use], labels[use], len(vocab))
    # misspellings: one of words that occur again, several of telling ones
    twin = np.repeat(np.arange(len(vocab), dtype=np.int32)[:, None], TWINS, axis=1)
    for i in np.flatnonzero(seen > 1).tolist():
        twin[i] = types.setdefault(_misspell(vocab[i], rng), len(types))
    for i in np.argsort(-odds, kind="stable")[:200].tolist():
        if odds[i] > 1:
            twin[i] = [types.setdefault(_misspell(vocab[i], rng), len(types)) for _ in range(TWINS)]
    odds = np.concatenate([odds, np.zeros(len(types) - len(vocab))])
    words = list(types)
    del types, vocab, seen
    parts = [_type_grams(words[k : k + 20_000]) for k in range(0, len(words), 20_000)]
    ids, grams = (np.concatenate(x) for x in zip(*parts))
    n_words = len(words)
    del words, parts
    first = np.concatenate([[0], np.cumsum(grams)])

    emb = rng.normal(0, 0.05, (BUCKETS, DIM)).astype(np.float32)
    soft = rng.normal(0, 0.3, (DIM, 2))
    bias = np.zeros(2)
    seen_e, seen_s, seen_b = np.full(BUCKETS, 1e-6), np.full((DIM, 2), 1e-6), np.full(2, 1e-6)
    balance = np.where(labels == 1, 0.5 / labels.mean(), 0.5 / (1 - labels.mean()))
    epochs = max(9, -(-steps // -(-len(use) // 256)))

    def lean():
        t, out = (emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), []
        for k in range(0, n_words, 50_000):
            f = first[k : k + 50_001]
            out.append(np.add.reduceat(t[ids[f[0] : f[-1]]], f[:-1] - f[0]) / grams[k : k + 50_000])
        return np.concatenate(out)

    for epoch in range(epochs):
        rng.shuffle(use)
        worst = lean() if 3 * epoch >= epochs else odds
        for k in range(0, len(use), 256):
            cuts, y, weight = [], [], []
            for i in use[k : k + 256]:
                s, e = _passages(len(seqs[i]))
                sums = np.concatenate([[0.0], np.cumsum(worst[seqs[i]])])
                rank = np.argsort(-(sums[e] - sums[s]) / (e - s))
                pick = rank[:1] if labels[i] else np.concatenate([rank[:2], rng.choice(len(s), 1)])
                for p in pick:
                    cuts.append(seqs[i][s[p] : e[p]])
                    y.append(labels[i])
                    weight.append(balance[i] / len(pick))
            y, weight = np.array(y), np.array(weight)
            length = np.array([len(c) for c in cuts])
            word = np.concatenate(cuts)
            word = np.where(rng.random(len(word)) < MISSPELT, twin[word, rng.integers(0, TWINS - HELD_TWINS, len(word))], word)
            row = np.repeat(np.arange(len(cuts)), length)
            # the bag as (passage, bucket, share)
            n = grams[word]
            gram = ids[np.repeat(first[word] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())]
            share = np.repeat(1.0 / (n * length[row]), n)
            share[np.cumsum(n) - n] *= rng.random(len(n)) < 0.8  # a fifth of the words goes by n-grams alone
            begin = np.concatenate([[0], np.cumsum(np.add.reduceat(n, np.concatenate([[0], np.cumsum(length)[:-1]])))[:-1]])
            hidden = np.add.reduceat(emb[gram] * share[:, None].astype(np.float32), begin)
            logits = hidden @ soft + bias
            logits -= logits.max(axis=1, keepdims=True)
            prob = np.exp(logits)
            prob /= prob.sum(axis=1, keepdims=True)
            err = (prob - np.stack([1 - y, y], axis=1)) * weight[:, None] / len(y)
            # two classes: every vector moves along the softmax's difference
            way = soft[:, 1] - soft[:, 0]
            pull = np.bincount(gram, share * np.repeat(err[:, 1], np.diff(np.append(begin, len(gram)))), BUCKETS)
            grad_s, grad_b = hidden.T @ err + 1e-4 * soft, err.sum(axis=0)
            hot = np.flatnonzero(pull)
            seen_e[hot] += (pull[hot] ** 2) * (way @ way)
            seen_s += grad_s**2
            seen_b += grad_b**2
            emb[hot] -= np.outer(RATE * pull[hot] / np.sqrt(seen_e[hot]), way).astype(np.float32)
            soft -= 0.05 * grad_s / np.sqrt(seen_s)
            bias -= 0.05 * grad_b / np.sqrt(seen_b)
    model = Model((emb @ (soft[:, 1] - soft[:, 0])).astype(np.float32), float(bias[1] - bias[0]), 1.0, 0.0, vectors=emb, softmax=soft)
    # slope and shift of the worst passage's logit, by Newton steps on whole texts
    typed = lean()
    kept = np.flatnonzero(check) if 0 < labels[check].sum() < check.sum() else np.arange(len(seqs))
    telling = np.zeros(len(twin), bool)
    telling[twin[:, 0] != twin[:, -1]] = True
    seqs, labels = [seqs[i] for i in kept], labels[kept]
    spelt = [np.where(rng.random(len(s)) < np.where(telling[s], 0.8, 0.05), twin[s, rng.integers(TWINS - HELD_TWINS, TWINS, len(s))], s) for s in seqs]
    seqs, labels = seqs + spelt, np.concatenate([labels, labels])
    begin = np.concatenate([[0], np.cumsum([len(s) for s in seqs])])
    x = _worst(typed[np.concatenate(seqs)] if begin[-1] else np.zeros(0), begin, 0.0)
    model.empty = float(np.median(x[labels == 0]))
    x = x + model.bias
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -30, 30)))
        w = p * (1 - p) + 1e-6
        g = np.array([((p - labels) * x).sum() + 0.1 * (a - 1), (p - labels).sum()])
        h = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
    model.slope, model.shift = float(max(a, 0.05)), float(b)
    return model


def training_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text"):
    """Texts and labels for `fit`: rows whose crc32(id as text) mod 4 is not 2,
    at most MAX_POSITIVE and MAX_NEGATIVE of them in hash order, whole texts of
    up to MAX_TEXT bytes. An identifier labelled both ways counts as toxic."""
    own = labels.select(F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("int").alias("y")).where("label_id is not null and y in (0, 1) and crc32(cast(cast(label_id as string) as binary)) % 4 <> 2")
    own = own.groupBy("label_id").agg(F.max("y").alias("y"))
    picked = own.where("y = 1").orderBy(F.xxhash64("label_id"), "label_id").limit(MAX_POSITIVE).union(own.where("y = 0").orderBy(F.xxhash64("label_id"), "label_id").limit(MAX_NEGATIVE))
    texts = id_and_bytes(docs, id_col, text_col).join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")).where(f"octet_length(text) <= {MAX_TEXT}")
    rows = texts.select("doc_id", "y", "text").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    return rows.column("text").to_pylist(), np.array(rows.column("y").to_pylist(), np.int64)


def train(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Fit on the driver: the sample is bounded, see training_sample."""
    return fit(*training_sample(docs, labels, label_col, id_col, text_col))


def _score_batches(batches, column, model, name):
    for batch in slices(batches):
        data, offsets = flat(batch.column(column).cast(pa.binary()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(predict(data, offsets, model))], names=[*batch.schema.names, name])


def with_score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "_score") -> DataFrame:
    """`docs` with a column of scores, row by row; null text scores as empty."""
    bounded_batches(docs.sparkSession)
    slim = Model(model.scores, model.bias, model.slope, model.shift, model.empty)
    column = docs.columns.index(text_col)
    schema = StructType([*docs.schema.fields, StructField(name, DoubleType())])
    return docs.mapInArrow(lambda b: _score_batches(b, column, slim, name), schema)


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    held_out marks the fold that training never reads. Only the text enters a
    score; empty and null texts get that of a middling clean text. A null identifier is kept (its
    held_out is null); repeated rows give equal rows; other columns are ignored;
    without labels of both classes every score is the labelled share of toxic
    rows (0.01 if there is none); an empty table gives none.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col)
    scored = with_score(id_and_bytes(docs, id_col, text_col), model)
    return scored.select("doc_id", (F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` less those that the model rejects."""
    name = unused(docs, "_score")
    return with_score(docs, train(docs, labels, text_col=text_col), text_col, name).where(F.col(name) < THRESHOLD).drop(name)
