"""Main text of web pages by a linear-chain CRF over leaf blocks (operator 4).

A page is cut into leaf blocks: stretches of text between block-level tags. Each
has features of its ancestors (tags, classes, ids, roles) and of its text
(length, links, punctuation, phrases). A chain with two labels, trained on
labelled pages, is decoded by Viterbi; blocks labelled as main text are kept.
"""

from __future__ import annotations

import html
import math
import re
from collections import defaultdict
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, slices

# Kinds of HTML elements.
_VOID = set("area base br col embed hr img input link meta param source track wbr".split())
#: What lies between these tags is no text of the page: code and styles, form
#: controls, the title in the head, drawings, inert or embedded documents,
#: formula sources, and what only browsers without the element would show.
_RAW = set("script style textarea select title svg template iframe annotation annotation-xml canvas audio video".split())
#: Of these, the ones whose text goes on to the page's end if nothing ends it.
_CODE = set("script style textarea title iframe".split())
_BLOCK = set("address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html label legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split())
#: A start tag of the key ends open elements of the value.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "body": {"head"}}
#: Elements beyond which an implied end does not reach.
_SCOPE = {"ul", "ol", "table", "div", "section", "article", "aside", "nav", "main", "body", "html", "dl", "td", "th"}

_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_STOP = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""([^\s=>"'/]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_TOKEN = re.compile(r"[A-Za-z]+")
_PHRASES = [(name, re.compile(rx, re.I)) for name, rx in (
    ("rights", r"©|\(c\)|copyright|all rights reserved"),
    ("cookie", r"\bcookies?\b|\bconsent\b|privacy policy|terms of (?:use|service)"),
    ("sign", r"\b(?:subscribe|sign up|sign in|log ?in|newsletter|register)\b"),
    ("reply", r"\b(?:reply|replies|comments?|commented|says:|wrote:|upvote)\b"),
    ("share", r"\b(?:share|tweet|facebook|pinterest|whatsapp|follow us)\b"),
    ("more", r"\b(?:read more|related|you may also like|recommended|trending|advertisement|sponsored)\b"),
)]
#: Scores are whole multiples of 1 / UNIT, so that sums don't depend on their order.
UNIT = 1 << 24


def _tag_end(page: str, at: int, last: dict) -> int:
    """Where the tag whose name ends at `at` ends: the first > that is not inside
    a quoted value. A quote without its like behind it opens no value; `last`
    remembers where on the page each kind of quote stands last."""
    k = at
    while m := _STOP.search(page, k):
        k = m.start()
        c = page[k]
        if c == ">":
            return k
        if c not in last:
            last[c] = page.rfind(c)
        before = k - 1
        while before > at and page[before].isspace():
            before -= 1
        if page[before] == "=" and last[c] > k:
            k = page.find(c, k + 1)
        k += 1
    return len(page)


def _marks_of(tag: str, attributes: str) -> tuple[str, ...]:
    """Features that an element gives to all blocks below it."""
    out = [f"in:{tag}"]
    for name, *values in _ATTR.findall(attributes):
        name = name.lower()
        if name in ("class", "id", "role"):
            for token in _TOKEN.findall("".join(values)):
                out.append(f"{'role' if name == 'role' else 'name'}:{token.lower()}")
    return tuple(dict.fromkeys(out))


def leaf_blocks(page: str, lean: dict | None = None, marks_of=_marks_of) -> list[tuple]:
    """Leaf blocks in page order: (text, characters inside links, block element
    around it, features of ancestors). With `lean`, scores of features in
    multiples of 1 / UNIT, the last is their sum, kept up to date as elements
    open and close; time is then in proportion to the page however deep it nests.
    `marks_of` may be a cached one; it is asked about short attributes alone."""
    blocks: list = []
    stack: list = []  # (tag, marks)
    places: dict = defaultdict(list)  # tag -> its places on the stack
    around: list = [""]  # open block elements
    held: dict = {}  # mark -> open elements that give it
    score = 0
    parts: list = []
    last: dict = {}
    linked, at, n = 0, 0, len(page)
    lower = page.lower()
    if len(lower) != n:  # a letter whose lower case is longer
        lower = "".join(c.lower() if c < "\x80" else c for c in page)

    def flush():
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text and not places["head"]:
                blocks.append((text, linked, around[-1], tuple(held) if lean is None else score))
            parts.clear()
        linked = 0

    def push(tag, marks):
        nonlocal score
        places[tag].append(len(stack))
        stack.append((tag, marks))
        if tag in _BLOCK:
            around.append(tag)
        for m in marks:
            held[m] = held.get(m, 0) + 1
            if lean is not None and held[m] == 1:
                score += lean.get(m, 0)

    def close(names, scope):
        """End the innermost element of `names`, and all in it, unless one of `scope` stands between."""
        nonlocal score
        to = max((places[t][-1] for t in names if places[t]), default=-1)
        if to < 0 or any(places[t] and places[t][-1] > to for t in scope):
            return
        while len(stack) > to:
            tag, marks = stack.pop()
            places[tag].pop()
            if tag in _BLOCK:
                around.pop()
            for m in marks:
                held[m] -= 1
                if not held[m]:
                    del held[m]
                    if lean is not None:
                        score -= lean.get(m, 0)

    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            lt = n
        if lt > at:
            parts.append(page[at:lt])
            if places["a"]:
                linked += lt - at
        if lt >= n:
            break
        if page.startswith("<!--", lt):
            end = page.find("-->", lt + 4)
            at = n if end < 0 else end + 3
            continue
        if page[lt + 1 : lt + 2] in ("!", "?"):
            end = page.find(">", lt)
            at = n if end < 0 else end + 1
            continue
        m = _TAG.match(page, lt + 1)
        if not m:
            parts.append("<")
            at = lt + 1
            continue
        tag = m[2].lower()
        end = _tag_end(page, m.end(), last)
        at = min(end + 1, n)
        if tag in _BLOCK:
            flush()
        elif tag == "br":
            parts.append(" ")
        if m[1]:
            close({tag}, ())
            continue
        if tag in _RAW:
            if page[end - 1 : end] == "/" and tag not in _CODE:
                continue
            stop = lower.find(f"</{tag}", at)
            if stop >= 0 or tag in _CODE:
                at = n if stop < 0 else stop
            continue
        if tag in _VOID or page[end - 1 : end] == "/":
            continue
        if tag in _BLOCK:
            close({"p"}, _SCOPE)
        if tag in _ENDS:
            close(_ENDS[tag], _SCOPE - _ENDS[tag])
        attributes = page[m.end() : end]
        push(tag, (marks_of if len(attributes) < 500 else _marks_of)(tag, attributes))
    flush()
    return blocks


def _own(blocks):
    """Features of each block beside those of its ancestors."""
    for k, (text, linked, parent, _) in enumerate(blocks):
        size = len(text)
        own = ["1", f"at:{parent}", f"size:{min(int(math.log2(size + 1)), 10)}", f"link:{min(int(4 * linked / size), 4)}", "ends" if text[-1] in ".!?…»\"'”" else "open"]
        if size < 400:
            own += [f"says:{name}" for name, rx in _PHRASES if rx.search(text)]
        if k == 0:
            own.append("first")
        if k == len(blocks) - 1:
            own.append("last")
        yield own


def features(blocks) -> list[list[str]]:
    """All features of the blocks of leaf_blocks(page)."""
    return [[*own, *block[3]] for own, block in zip(_own(blocks), blocks)]


class Chain:
    """A linear-chain CRF with labels 0 (page furniture) and 1 (main text)."""

    def __init__(self, weights: dict | None = None, moves: list | None = None):
        #: weights: feature -> score of label 1 over label 0; moves[a][b]: from a to b.
        self.weights, self.moves = weights or {}, moves or [[0.0, 0.0], [0.0, 0.0]]

    def lean(self, rows) -> list[float]:
        w = self.weights
        return [sum(w.get(f, 0.0) for f in row) for row in rows]

    def whole(self) -> tuple[dict, list]:
        """Weights and moves in multiples of 1 / UNIT."""
        return {f: round(w * UNIT) for f, w in self.weights.items()}, [[round(m * UNIT) for m in row] for row in self.moves]

    def decode(self, lean) -> list[int]:
        """Viterbi over the scores of blocks."""
        if not lean:
            return []
        (m00, m01), (m10, m11) = self.moves
        zero, one, back = 0.0, lean[0], []
        for x in lean[1:]:
            to0, to1 = one + m10 > zero + m00, one + m11 >= zero + m01
            zero, one = (one + m10 if to0 else zero + m00), x + (one + m11 if to1 else zero + m01)
            back.append((to0, to1))
        label = int(one >= zero)
        out = [label]
        for to0, to1 in reversed(back):
            label = int(to1 if label else to0)
            out.append(label)
        return out[::-1]

    def marginals(self, rows):
        """Probability of label 1 per block, and of each move per step (forward-backward)."""
        lean, n = np.array(self.lean(rows)), len(rows)
        move = np.array(self.moves)
        score = np.stack([np.zeros(n), lean], axis=1)
        fore, aft = np.zeros((n, 2)), np.zeros((n, 2))
        fore[0] = score[0]
        for k in range(1, n):
            fore[k] = np.logaddexp(fore[k - 1, 0] + move[0], fore[k - 1, 1] + move[1]) + score[k]
        for k in range(n - 2, -1, -1):
            t = move + score[k + 1] + aft[k + 1]
            aft[k] = np.logaddexp(t[:, 0], t[:, 1])
        total = np.logaddexp(*fore[-1])
        one = np.exp(fore[:, 1] + aft[:, 1] - total)
        steps = np.exp(fore[:-1, :, None] + move + (score + aft)[1:, None, :] - total)
        return one, steps

    def fit(self, pages, epochs: int = 8, rate: float = 0.4, decay: float = 1e-3, seed: int = 3) -> "Chain":
        """Maximise the penalised log-likelihood of (rows, labels) by adaptive gradient steps."""
        rng, seen, seen_m = np.random.default_rng(seed), {}, np.full((2, 2), 1e-2)
        move = np.array(self.moves)
        for _ in range(epochs):
            for k in rng.permutation(len(pages)):
                rows, y = pages[k]
                if not rows:
                    continue
                one, steps = self.marginals(rows)
                for row, e in zip(rows, (np.array(y) - one).tolist()):
                    if abs(e) < 1e-3:
                        continue
                    for f in row:
                        g = e - decay * self.weights.get(f, 0.0)
                        seen[f] = seen.get(f, 1e-2) + g * g
                        self.weights[f] = self.weights.get(f, 0.0) + rate * g / math.sqrt(seen[f])
                told = np.zeros((2, 2))
                np.add.at(told, (y[:-1], y[1:]), 1)
                g = told - steps.sum(axis=0) - decay * move
                seen_m += g * g
                move += rate * g / np.sqrt(seen_m)
                self.moves = move.tolist()
        return self


# -- labelled pages ------------------------------------------------------------


def labelled_pages(count: int = 700, seed: int = 11):
    """(html, labels of its leaf blocks) of made-up pages: main text in many
    kinds of containers, with the usual furniture around and inside it."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    syllables = "ka lo mi ter an den sur pol gra vi ne tion ment ra es bu quo shi zen or um lat fe".split()

    def word():
        return "".join(pick(syllables) for _ in range(int(rng.integers(1, 4))))

    def words(a, b):
        return " ".join(word() for _ in range(int(rng.integers(a, b))))

    def sentence(a=4, b=22):
        return words(a, b).capitalize() + pick([".", ".", ".", "!", "?"])

    def prose():
        how = rng.random()
        if how < 0.1:
            return words(1, 6).capitalize() + pick(["", ".", ""])
        if how < 0.18:
            return pick([" | ", " $$$ ", "!! ", " *** "]).join(word() for _ in range(int(rng.integers(3, 60))))
        if how < 0.23:
            return words(3, 60).upper()
        if how < 0.28:
            return pick(["Licensed under the terms of the licence.", "In reply, " + sentence(), "They share a border. " + sentence(), "The cookie was sweet. " + sentence(), "Read more books. " + sentence()])
        return " ".join(sentence() for _ in range(int(rng.integers(1, 9))))

    def links(tag="li", a=2, b=8):
        return "".join(f'<{tag}><a href="/{word()}">{words(1, 4)}</a></{tag}>' for _ in range(int(rng.integers(a, b))))

    def furniture():
        """Page furniture: every block is label 0."""
        kinds = [
            lambda: f"<nav><ul>{links()}</ul></nav>",
            lambda: f'<div class="{pick(["menu", "nav", "navbar", "top-nav", "main-menu", "breadcrumb", "breadcrumbs", "pagination", "toc"])}">{links(pick(["li", "span", "div"]))}</div>',
            lambda: f'<header><div class="logo">{words(1, 3)}</div>{links("span")}</header>',
            lambda: f'<div id="{pick(["header", "masthead", "banner", "site-header"])}"><h1>{words(1, 4)}</h1><p>{sentence()}</p></div>',
            lambda: f"<aside><h3>{words(1, 3)}</h3><ul>{links()}</ul><p>{sentence()}</p></aside>",
            lambda: f'<div class="{pick(["sidebar", "side-bar", "widget", "related", "recommended", "popular", "rail"])}"><h4>{words(1, 4)}</h4>{pick([f"<p>{sentence()}</p>", f"<ul>{links()}</ul>"])}</div>',
            lambda: f'<div class="{pick(["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-box", "banner-ad"])}">{pick(["", "Advertisement "])}{sentence()}</div>',
            lambda: f'<div class="{pick(["cookie", "cookie-notice", "notice", "consent", "gdpr", "alert", "popup", "modal"])}" role="{pick(["alert", "dialog", ""])}"><p>{pick(["We use cookies. ", "Please accept our privacy policy. ", ""])}{sentence()}</p><button>Accept</button></div>',
            lambda: f'<form action="/{word()}"><label>{words(1, 3)}</label><input name="q"><button>{pick(["Search", "Subscribe", "Sign up"])}</button><p>{sentence()}</p></form>',
            lambda: f'<div class="{pick(["share", "social", "share-buttons", "follow"])}"><span>Share</span> {links("span", 2, 4)}</div>',
            lambda: f'<div class="{pick(["newsletter", "subscribe", "signup"])}"><h3>Subscribe</h3><p>{sentence()}</p></div>',
        ]
        return pick(kinds)()

    def comments():
        one = lambda: f'<{pick(["div", "li"])} class="{pick(["comment", "comment-body", "reply", "response"])}"><b>{words(1, 3)}</b> {pick(["says:", "wrote:", ""])}<p>{prose()}</p></div>'
        body = "".join(one() for _ in range(int(rng.integers(1, 5))))
        return pick([f'<section class="comments"><h3>Comments</h3>{body}</section>', f'<div id="{pick(["comments", "disqus", "discussion", "responses"])}">{body}</div>', f'<ol class="commentlist">{body}</ol>'])

    def footer():
        text = pick([f"&copy; {word()}.example.com &middot; {sentence()}", f"Copyright {words(1, 3)}. All rights reserved.", sentence(), f"<ul>{links()}</ul>"])
        return pick([f"<footer>{text}</footer>", f"<footer><p>{text}</p></footer>", f'<div class="{pick(["footer", "site-footer", "copyright", "bottom"])}">{text}</div>'])

    for _ in range(count):
        out, mark = [], []

        def add(text, label):
            out.append(text)
            mark.append((text, label))

        for _ in range(int(rng.integers(0, 4))):
            add(furniture(), 0)
        head, tail = pick([("<article>", "</article>")] * 3 + [("<main>", "</main>"), ('<main role="main"><article>', "</article></main>"), ('<div role="main">', "</div>"), ("", ""), ("<div>", "</div>"), *[(f'<div class="{c}">', "</div>") for c in ("content", "post", "post-content", "entry", "entry-content", "article-body", "story", "text", "main", "body")], ('<div id="content">', "</div>"), ('<section class="article">', "</section>")])
        out.append(head)
        if rng.random() < 0.8:
            add(f"<h1>{prose()[:80]}</h1>", 1)
        for k in range(int(rng.integers(1, 9))):
            how = rng.random()
            if how < 0.7:
                add(pick(["<p>{}</p>", "<p>{}</p>", "<p>{}", "<p><b>{}<br>", "<p>{} <a href='/x'>link</a> more.</p>", "<div>{}</div>"]).format(prose()), 1)
            elif how < 0.8:
                add(pick([f"<ul><li>{prose()}</li><li>{words(2, 9)}</li></ul>", f"<blockquote>{prose()}</blockquote>", f"<table><tr><td>{words(1, 4)}</td><td>{words(1, 9)}</td></tr></table>", f"<pre>{prose()}</pre>", f"<h2>{words(2, 7)}</h2>", f"<figure><img src=x><figcaption>{sentence()}</figcaption></figure>", f"<dl><dt>{word()}</dt><dd>{sentence()}</dd></dl>"]), 1)
            elif how < 0.9:
                add(furniture(), 0)
            else:
                add(f"<p>{prose()}</p>", 1)
        if rng.random() < 0.25:
            add(comments(), 0)
        out.append(tail)
        if rng.random() < 0.25:
            add(comments(), 0)
        for _ in range(int(rng.integers(0, 3))):
            add(furniture(), 0)
        if rng.random() < 0.8:
            add(footer(), 0)
        # labels: the number of blocks each part adds
        page, labels, done = '<!DOCTYPE html><html><head><title>t</title></head><body>', [], 0
        known = iter(mark)
        for part in out:
            page += part
            if part in (head, tail):
                continue
            _, label = next(known)
            now = len(leaf_blocks(page))
            labels += [label] * (now - done)
            done = now
        yield page + "</body></html>", labels


@lru_cache(maxsize=1)
def trained() -> Chain:
    """The chain, trained once per process on labelled_pages()."""
    pages = []
    for page, labels in labelled_pages():
        blocks = leaf_blocks(page)
        if len(blocks) == len(labels):
            pages.append((features(blocks), labels))
    return Chain().fit(pages)


def main_text(page: str, chain: Chain, marks_of=_marks_of) -> str:
    """`chain` holds whole multiples of 1 / UNIT, see Chain.whole."""
    blocks, weights = leaf_blocks(page, chain.weights, marks_of), chain.weights
    lean = [block[3] + sum(weights.get(f, 0) for f in own) for own, block in zip(_own(blocks), blocks)]
    return "\n".join(b[0] for b, label in zip(blocks, chain.decode(lean)) if label)


def _extract_batches(batches, weights, moves):
    chain, marks_of = Chain(weights, moves), lru_cache(maxsize=20_000)(_marks_of)
    for batch in slices(batches, 500):
        texts = [main_text(h, chain, marks_of) if h else "" for h in batch.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", chain: Chain | None = None) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Blocks of main text are joined by one line break; white space inside a block
    becomes one space, character references are decoded. Null and empty pages
    give an empty text; null identifiers and urls are kept; repeated rows give
    equal rows; other columns are ignored; an empty table gives none.
    """
    bounded_batches(pages.sparkSession)
    weights, moves = (chain or trained()).whole()
    narrow = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    return narrow.mapInArrow(lambda b: _extract_batches(b, weights, moves), "page_id long, url string, text string, n_chars long")
