"""Secrets by patterns and by token efficiency (operator 9).

Natural words need few tokens of a byte-pair vocabulary, random strings many.
Runs of key-like characters with few characters per token are reported, after
digests of known length, UUIDs and identifiers made of words are set aside.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tidemark.llm.common import flat, gather, id_and_bytes, slices, words_of

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How the vocabulary's public definition cuts text before merging.
PRETOKENS = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
KINDS = ("assign", "access", "hex")
#: Shortest run that is tested, and the characters per token under which it counts
#: as random; one of letters of one case alone has fewer ways to look like words.
MIN_RUN, MAX_RATIO, ONE_CASE_RATIO = 20, 2.0, 1.9

_ASSIGN = re.compile(rb"(?:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_UUID = re.compile(rb"[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}")
_HEXES = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
#: Hex digits of MD5, SHA-1, SHA-224, SHA-256, SHA-384 and SHA-512.
_DIGEST_LENGTHS = {32, 40, 56, 64, 96, 128}


_HEX_RUN = re.compile(rb"[0-9a-f]{16,}")
_KEY_RUN = re.compile(rb"[A-Za-z0-9+/_=-]{%d,}" % MIN_RUN)
#: Texts looked at together, in bytes; a text stays whole.
_PIECE = 1 << 20
_encoders: dict = {}


def _encoder(path: str):
    if path not in _encoders:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _encoders[path] = tiktoken.Encoding("own", pat_str=PRETOKENS, mergeable_ranks=ranks, special_tokens={})
    return _encoders[path]


def _runs(data: np.ndarray, offsets: np.ndarray, *patterns):
    """(start, end) of each pattern's matches. They hold no white space and have
    16 bytes at least, so only words of that length are searched."""
    starts, ends, _ = words_of(data, offsets)
    long = ends - starts >= 16
    starts, size = starts[long], (ends - starts)[long]
    at = np.cumsum(size + 1) - (size + 1)
    joined = np.full(int((size + 1).sum()), 32, np.uint8)
    joined[gather(at, size)] = data[gather(starts, size)]
    raw = joined.tobytes()
    for pattern in patterns:
        found = np.array([m.span() for m in pattern.finditer(raw)], np.int64).reshape(-1, 2)
        word = np.searchsorted(at, found[:, 0], "right") - 1
        yield found + (starts - at)[word][:, None] if len(found) else found


def _is_random(run: bytes, vocabulary: str, ratio: float) -> bool:
    """Few characters per token, and no digest, UUID or chain of words."""
    if _HEXES.fullmatch(run) and len(run) in _DIGEST_LENGTHS or _UUID.fullmatch(run):
        return False
    core = run.strip(b"-_=/+")
    if len(core) < MIN_RUN:
        return False
    if core.isalpha() and (core.islower() or core.isupper()):
        ratio = min(ratio, ONE_CASE_RATIO)
    return len(core) < ratio * len(_encoder(vocabulary).encode_ordinary(core.decode("ascii")))


def _secret_batches(batches, vocabulary, ratio):
    for batch in slices(batches):
        data, offsets = flat(batch.column(1))
        n, at, rows = batch.num_rows, 0, []
        while at < n:
            to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + _PIECE, "right")) - 1)
            rows.append(_secret_rows(data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at], vocabulary, ratio))
            at = to
        if n:
            counts, digests, spans = (np.concatenate([r[0] for r in rows]), sum((r[1] for r in rows), []), sum((r[2] for r in rows), []))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), *(pa.array(counts[:, k]) for k in range(3)), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(counts[:, 3])], names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_random"])


def _secret_rows(data: np.ndarray, offsets: np.ndarray, vocabulary: str, ratio: float):
    """(counts by kind, digests, spans) of concatenated texts."""
    raw = data.tobytes()
    low, offs = raw.lower(), offsets.tolist()
    found: dict[int, list] = {}
    for kind, runs in zip(("hex", "random"), _runs(data, offsets, _HEX_RUN, _KEY_RUN)):
        owner = np.searchsorted(offsets, runs[:, 0], "right") - 1
        for i, (a, b) in zip(owner.tolist(), runs.tolist()):
            found.setdefault(i, []).append((kind, a, b))
    for i, (a, b) in enumerate(zip(offs[:-1], offs[1:])):
        if (low.find(b":", a, b) >= 0 or low.find(b"=", a, b) >= 0) and any(low.find(k, a, b) >= 0 for k in _KEYS):
            for m in _ASSIGN.finditer(low, a, b):
                if m.end(1) - m.start(1) >= 12:
                    found.setdefault(i, []).append(("assign", *m.span()))
        if raw.find(b"AKIA", a, b) >= 0:
            for m in _ACCESS.finditer(raw, a, b):
                if m.end() - m.start() >= 18:
                    found.setdefault(i, []).append(("access", *m.span()))
    rank = {k: j for j, k in enumerate((*KINDS, "random"))}
    counts = np.zeros((len(offs) - 1, 4), np.int64)
    digests, spans = [hashlib.sha256(b"").hexdigest()] * (len(offs) - 1), [""] * (len(offs) - 1)
    for i, hits in found.items():
        base = [h for h in hits if h[0] != "random"]
        last = 0
        taken = []  # disjoint stretches of base spans, in order
        for a, b in sorted((a, b) for _, a, b in base):
            if taken and a < taken[-1][1]:
                taken[-1][1] = max(taken[-1][1], b)
            else:
                taken.append([a, b])
        for _, a, b in sorted(h for h in hits if h[0] == "random"):
            while last < len(taken) and taken[last][1] <= a:
                last += 1
            if not (last < len(taken) and taken[last][0] <= a and b <= taken[last][1]) and _is_random(raw[a:b], vocabulary, ratio):
                base.append(("random", a, b))
        if not base:
            continue
        at = offs[i]
        heads = np.concatenate([[0], np.cumsum((data[at : offs[i + 1]] & 0xC0) != 0x80)])  # code points before each byte
        named = [(k, f"{k}:{s}:{e}") for s, _, k, e in sorted((int(heads[a - at]), rank[k], k, int(heads[b - at])) for k, a, b in base)]
        for k, _ in named:
            counts[i, rank[k]] += 1
        digests[i] = hashlib.sha256(",".join(x for k, x in named if k != "random").encode()).hexdigest()
        spans[i] = ",".join(x for _, x in named)
    return counts, digests, spans


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY, ratio: float = MAX_RATIO) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256,
    spans, n_random.

    Base spans are matches of the three patterns that are long enough; `random`
    spans are runs that fail the token-efficiency test and lie in no base span.
    Positions are code points, end exclusive; spans are ordered by start, then
    kind. `vocabulary` names a rank file that every executor can read. Null text
    is empty; a null identifier is kept; repeated rows give equal rows; other
    columns are ignored; an empty table gives none.
    """
    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_random long"
    return id_and_bytes(docs, id_col, text_col).mapInArrow(lambda b: _secret_batches(b, vocabulary, ratio), schema)
