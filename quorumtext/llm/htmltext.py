"""Main text of web pages: a linear-chain conditional random field over the leaf blocks of the DOM.

A page is read once into leaf blocks: the text between block-level tags, with the tags and class words above it. Each block has
binary features (its tag, tags and class words of its ancestors, length, share of linked text, how it ends), and the chain has weights for
main text and boilerplate after one another. Weights are trained by gradient steps on the exact likelihood over labelled pages that
this module lays out itself, in many ways to mark up the same parts; Viterbi then labels the blocks of a page together.

Defined cases: null and empty html give an empty text; a page without main blocks an empty text; unclosed and stray tags are read as
browsers do where it matters (a block closes an open paragraph, a list item the one before); whole pages of any length; repeated rows are
read each; other columns are ignored.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quorumtext.llm.common import map_frames

# Element names of the HTML standard.
BLOCKS = frozenset(
    "address article aside blockquote body button center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html "
    "label legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul caption".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template svg iframe object math head".split())
#: An opening tag closes what is open of these, up to the named parents.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
}
_name = re.compile(r"</?([a-zA-Z][^\s/>]*+)")
_edge = re.compile(r"""[>"']""")
_long_number = re.compile(r"&#(x?)(?:0{8,}(?=[0-9a-f])|(?=0*+[1-9a-f][0-9a-f]{7}))0*+([0-9a-f]*+;?)", re.I)
_named = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.I)
_word = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass
class Block:
    text: str
    features: frozenset[str]
    linked: int


class Tags:
    """Finds the tags of a page, one after the other. Every character is looked at a bounded number of times, however malformed the page is."""

    def __init__(self, page: str):
        self.page, self.last = page, page.rfind(">")
        self.quoted = True

    def end(self, at: int) -> int:
        """The place of the > that ends a tag whose attributes begin at `at`: the first that isn't in quotes. Where a page ends within
        quotes, they count for nothing from there on."""
        page, k = self.page, at
        while self.quoted:
            found = _edge.search(page, k)
            if not found:
                self.quoted = False
            elif found[0] == ">":
                return found.start()
            elif (k := page.find(found[0], found.end()) + 1) == 0:
                self.quoted = False
        return page.find(">", at)

    def __iter__(self) -> Iterator[tuple[int, int, bool, str, str]]:
        """(start, end, whether it closes, name, attributes) of each tag; comments and declarations have no name. The reader may move on
        by setting `at`."""
        page, self.at, seek = self.page, 0, 0
        while (start := page.find("<", max(self.at, seek))) >= 0:
            if page.startswith("<!--", start):
                stop = page.find("-->", start + 4)
                self.at = stop + 3 if stop >= 0 else len(page)
                yield start, self.at, False, "", ""
            elif page.startswith(("<!", "<?"), start):
                self.at = page.find(">", start) + 1 if start < self.last else len(page)
                yield start, self.at, False, "", ""
            elif start < self.last and (name := _name.match(page, start)):
                stop = self.end(name.end())
                self.at = stop + 1
                yield start, self.at, page[start + 1] == "/", name[1].lower(), page[name.end() : stop]
            else:
                seek = start + 1


def unescape(text: str) -> str:
    """html.unescape for numbers of any length."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _long_number.sub(lambda m: f"&#{m[1]}{m[2]}" if len(m[2].rstrip(";")) < 8 else "\ufffd", text)
    return html.unescape(text)


class Open:
    """The open elements, with the features that they give to what they hold; each question takes constant time."""

    def __init__(self, known: frozenset[str] | None):
        self.stack: list[tuple[str, list[str]]] = []
        self.places: dict[str, list[int]] = {}
        self.blocks: list[str] = []
        self.active: dict[str, int] = {}
        self.known, self.set = known, frozenset()

    def push(self, name: str, given: list[str]) -> None:
        given = [g for g in given if self.known is None or g in self.known]
        self.places.setdefault(name, []).append(len(self.stack))
        self.stack.append((name, given))
        if name in BLOCKS:
            self.blocks.append(name)
        for g in given:
            self.active[g] = self.active.get(g, 0) + 1
        if given:
            self.set = None

    def last(self, names) -> int:
        return max((self.places[n][-1] for n in names if self.places.get(n)), default=-1)

    def cut(self, place: int) -> None:
        """Close what has been opened since, and at, a place."""
        while len(self.stack) > place:
            name, given = self.stack.pop()
            self.places[name].pop()
            if name in BLOCKS:
                self.blocks.pop()
            for g in given:
                self.active[g] -= 1
                if not self.active[g]:
                    del self.active[g]
            if given:
                self.set = None

    def close(self, names, until) -> None:
        """Close the last opened of names, unless one of until was opened after it."""
        at = self.last(names)
        if at >= 0 and at > self.last(until - names):
            self.cut(at)

    def features(self) -> frozenset[str]:
        if self.set is None:
            self.set = frozenset(self.active)
        return self.set


CELLS, WHOLE = frozenset({"td", "th", "body"}), frozenset({"table", "tr", "body", "html", "tbody", "thead", "tfoot"})
HOLDERS = frozenset({"button", "td", "th", "li", "div", "section", "article", "blockquote", "body"})


def blocks(page: str | None, known: frozenset[str] | None = None) -> list[Block]:
    """The leaf blocks of a page, in order, with white space folded. Of the features of ancestors only those known are kept, which a
    model names: so a block's are bounded however deep it lies."""
    out: list[Block] = []
    page = page or ""
    tags, opened = Tags(page), Open(known)
    text: list[str] = []
    linked, links, done = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if text:
            joined = " ".join("".join(text).split())
            text.clear()
            if joined:
                out.append(Block(joined, opened.features() | {f"in {opened.blocks[-1] if opened.blocks else ''}"}, linked))
        linked = 0

    def said(to: int) -> None:
        nonlocal linked
        if to > done:
            piece = unescape(page[done:to])
            text.append(piece)
            if links:
                linked += len(piece.strip())

    for start, done_at, end, name, rest in tags:
        said(start)
        done = done_at
        if not name:
            continue
        if name in RAW and name != "head":
            if not end and not rest.endswith("/"):
                closing = re.compile(rf"</{re.escape(name)}\b", re.I).search(page, done)
                done = tags.at = page.find(">", closing.end()) + 1 or len(page) if closing else len(page)
            continue
        if name == "a":
            links = max(0, links + (-1 if end else 1)) if end or not links else links
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCKS:
            flush()
        if end:
            at = opened.last((name,))
            if at >= 0 and (name in WHOLE or at >= opened.last(CELLS)):
                opened.cut(at)
        elif name not in VOID:
            if name in BLOCKS and name not in ("button", "label", "option", "select"):
                opened.close({"p"}, HOLDERS)
                links = 0
            if name in CLOSES:
                opened.close(*CLOSES[name])
            words = {w.lower() for value in _named.findall(rest) for w in _word.findall(value)} if rest else set()
            opened.push(name, [f"under {name}", *(f"word {w}" for w in sorted(words))])
    said(len(page))
    flush()
    return out


def features(found: list[Block]) -> list[list[str]]:
    rows = []
    for i, b in enumerate(found):
        share, n = b.linked / max(1, len(b.text)), len(b.text)
        rows.append([
            *b.features,
            f"length {min(10, n.bit_length())}",
            "links " + ("none" if share == 0 else "few" if share < 0.5 else "most"),
            "ends " + ("sentence" if b.text[-1] in ".!?…\"”»。" else "open"),
            "mark" if b.text[0] in "©®" or "©" in b.text[:40] else "no mark",
            "first" if i == 0 else "last" if i == len(found) - 1 else "inside",
        ])
    return rows


class Chain:
    """A two-label chain: weights of features (width, 2), of label pairs (2, 2) and of the first label."""

    def __init__(self, width: int):
        self.emit, self.move, self.start = np.zeros((width, 2)), np.zeros((2, 2)), np.zeros(2)

    def scores(self, rows: list[list[int]]) -> np.ndarray:
        of = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        emit = self.emit[np.fromiter((x for r in rows for x in r), "int64", len(of))]
        return np.stack([np.bincount(of, emit[:, k], len(rows)) for k in range(2)], axis=1)

    def step(self, rows: list[list[int]], labels: list[int], rate: float, sums: list[np.ndarray]) -> None:
        """One AdaGrad step on the log-likelihood of a page, by forward-backward."""
        e, n = self.scores(rows), len(rows)
        forward, backward = np.empty((n, 2)), np.zeros((n, 2))
        forward[0] = self.start + e[0]
        for i in range(1, n):
            forward[i] = np.logaddexp(forward[i - 1, 0] + self.move[0], forward[i - 1, 1] + self.move[1]) + e[i]
        for i in range(n - 2, -1, -1):
            after = e[i + 1] + backward[i + 1]
            backward[i] = np.logaddexp(self.move[:, 0] + after[0], self.move[:, 1] + after[1])
        total = np.logaddexp(*forward[-1])
        p = np.exp(forward + backward - total)
        gold = np.eye(2)[labels]
        move = np.zeros((2, 2))
        for i in range(1, n):
            move -= np.exp(forward[i - 1][:, None] + self.move + e[i] + backward[i] - total)
            move[labels[i - 1], labels[i]] += 1
        emit = np.zeros_like(self.emit)
        for r, d in zip(rows, gold - p):
            emit[r] += d
        for weights, grad, seen in zip((self.emit, self.move, self.start), (emit, move, gold[0] - p[0]), sums):
            grad = grad - 1e-4 * weights
            seen += grad**2
            weights += rate * grad / np.sqrt(seen + 1e-8)

    def decode(self, rows: list[list[int]]) -> list[int]:
        """The likeliest labels (Viterbi); ties go to main text."""
        (a, b), (c, d) = self.move.tolist()
        emit, back = self.scores(rows).tolist(), []
        x, y = self.start[0] + emit[0][0], self.start[1] + emit[0][1]
        for p, q in emit[1:]:
            back.append((y + c >= x + a, y + d >= x + b))
            x, y = max(x + a, y + c) + p, max(x + b, y + d) + q
        label = int(y >= x)
        out = [label]
        for take in reversed(back):
            label = int(take[label])
            out.append(label)
        return out[::-1]


class Extractor:
    def __init__(self, index: dict[str, int], chain: Chain):
        self.index, self.chain, self.known = index, chain, frozenset(index)

    def rows(self, found: list[Block]) -> list[list[int]]:
        return [sorted(self.index[f] for f in r if f in self.index) for r in features(found)]

    def __call__(self, page: str | None) -> str:
        found = blocks(page, self.known)
        if not found:
            return ""
        labels = self.chain.decode(self.rows(found))
        return "\n".join(b.text for b, main in zip(found, labels) if main)


def labelled_pages(n: int, seed: int = 7) -> Iterator[tuple[str, list[str]]]:
    """Made-up pages and their main blocks, in page order. Main text holds ~, boilerplate ^, so that blocks can be labelled."""
    rng = random.Random(seed)
    pick, chance = rng.choice, lambda p: rng.random() < p

    def words(low: int, high: int, mark: str, stop: str = "") -> str:
        said = ["".join(rng.choice("bcdfglmnprstv") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
        return mark + " ".join(said).capitalize() + stop

    def named(*kinds: str) -> str:
        kind = pick(kinds)
        return f' {pick(("class", "class", "id"))}="{kind}"' if kind else ""

    def links(count: int, mark: str = "^") -> str:
        return "".join(f'<li><a href="/{i}">{words(1, 4, mark)}</a></li>' for i in range(count))

    def menu() -> str:
        inner = f"<ul{named('', 'menu', 'nav-list')}>{links(rng.randint(3, 9))}</ul>"
        return pick((f"<nav{named('', 'main-nav', 'navbar')}>{inner}</nav>", f"<div{named('menu', 'navigation', 'navbar', 'breadcrumbs', 'toc-menu')}>{inner}</div>", f"<nav>{words(1, 2, '^')}</nav>" + inner if chance(0.3) else f"<nav>{inner}</nav>"))

    def top() -> str:
        title = words(1, 5, "^")
        inside = pick((f"<h1>{title}</h1>", f"<h2>{title}</h2>", f"<p>{title}</p>", f'<a href="/">{title}</a>', f"<div{named('logo', 'tagline', 'site-title')}>{title}</div>", title))
        return pick((f"<header{named('', 'site-header', 'page-header')}>{inside}</header>", f"<div{named('header', 'top-bar', 'masthead', 'banner')}>{inside}</div>"))

    def advert() -> str:
        said = words(2, 25, "^", pick(("", ".", "!")))
        return pick((f"<div{named('ad', 'ads', 'advert', 'ad-slot', 'sponsored', 'advertisement', 'promo', 'promoted')}>{said}</div>", f"<aside{named('ad', 'sponsor', 'promo')}><p>{said}</p></aside>"))

    def side() -> str:
        inside = f"<h3>{words(1, 3, '^')}</h3>" + pick((f"<ul>{links(rng.randint(2, 6))}</ul>", f"<p>{words(5, 30, '^', '.')}</p>", f"<div>{words(3, 12, '^')}</div>"))
        return pick((f"<aside{named('', 'sidebar', 'related')}>{inside}</aside>", f"<div{named('sidebar', 'side-bar', 'widget', 'related-posts', 'recommended', 'trending', 'share', 'social')}>{inside}</div>"))

    def notice() -> str:
        said = f"<p>{words(6, 30, '^', '.')}</p>" + (f"<button>{words(1, 2, '^')}</button>" if chance(0.6) else "")
        return f"<div{pick((named('cookie-notice', 'cookie-banner', 'notice', 'consent', 'gdpr', 'alert', 'popup', 'modal', 'newsletter', 'subscribe', 'paywall', 'disclaimer'), ' role=\"dialog\"', ' role=\"alert\"'))}>{said}</div>"

    def form() -> str:
        return f"<form{named('', 'search', 'login', 'signup', 'contact')}>" + (f"<p>{words(3, 15, '^', '.')}</p>" if chance(0.5) else "") + f"<label>{words(1, 3, '^')}</label><input name=q>" + (f"<select><option>{words(1, 2, '^')}</option></select>" if chance(0.3) else "") + f"<button>{words(1, 2, '^')}</button></form>"

    def comments() -> str:
        said = [f"<p>{words(4, 40, '^', pick(('.', '!', '')))}</p>" for _ in range(rng.randint(1, 5))]
        each = pick(("<li{}>{}</li>", "<div{}>{}</div>", "<article{}>{}</article>"))
        inside = "".join(each.format(named("comment", "comment-body", "reply"), f"<span>{words(1, 2, '^')}</span> " + s if chance(0.5) else s) for s in said)
        return pick((f"<section{named('comments', 'comment-list', 'discussion', 'responses')}><h2>{words(1, 3, '^')}</h2>{inside}</section>", f"<div{named('comments', 'disqus', 'user-comments', 'replies')}>{inside}</div>", f"<ol{named('commentlist', 'comments')}>{inside}</ol>"))

    def bottom() -> str:
        said = pick((f"&copy; {words(1, 4, '^')} &middot; {words(2, 12, '', pick(('', '.')))}", f"<p>{words(3, 20, '^', '.')}</p>", f"<ul>{links(rng.randint(2, 6))}</ul>"))
        return pick((f"<footer{named('', 'site-footer')}>{said}</footer>", f"<div{named('footer', 'copyright', 'bottom', 'site-info')}>{said}</div>"))

    def story() -> str:
        parts = []
        for _ in range(rng.randint(1, 12)):
            long = lambda: words(*pick(((1, 3), (4, 20), (20, 120))), "~", pick((".", ".", ".", "", "!", "?")))
            inline = lambda: (long() + f' <a href="#">{words(1, 5, "")}</a> ' + words(1, 15, "", ".") if chance(0.15) else f"<b>{long()}</b>" if chance(0.1) else long())
            parts.append(pick((
                *[lambda: f"<p>{inline()}</p>"] * 8, lambda: f"<p>{inline()}<br>", lambda: f"<p><b>{inline()}<br>", lambda: f"<h2>{words(1, 8, '~')}</h2>", lambda: f"<h3>{words(1, 6, '~')}</h3>", lambda: f"<blockquote>{inline()}</blockquote>",
                lambda: f"<ul><li>{inline()}</li><li>{inline()}</li></ul>", lambda: f"<figure><img src=x><figcaption>{words(2, 12, '~', '.')}</figcaption></figure>", lambda: f"<table><tr><td>{words(1, 3, '~')}</td><td>{words(1, 3, '~')}</td></tr></table>",
                lambda: f"<pre>{words(3, 20, '~')}</pre>", lambda: f"<div>{inline()}</div>", lambda: f"<section><h2>{words(1, 5, '~')}</h2><p>{inline()}</p></section>",
            ))())
            if chance(0.08):
                parts.append(pick((advert, form, side, notice))())
        head = f"<h1{named('', '', 'title', 'headline', 'entry-title')}>{words(2, 12, '~', pick(('', '.')))}</h1>"
        if chance(0.15):
            head = f"<header>{head}<p>{words(2, 6, '~')}</p></header>"
        body = (head if chance(0.9) else "") + "".join(parts) + (comments() if chance(0.15) else "")
        shape = pick(("article", "article", "article", "main", "div", "section", "bare"))
        if shape == "bare":
            return body
        inner = f"<{shape}{named('content', 'post', 'article', 'entry-content', 'story', 'main', 'post-body', 'article-body') if shape in ('div', 'section') or chance(0.4) else ''}>{body}</{shape}>"
        return f"<main>{inner}</main>" if chance(0.2) and shape != "main" else f"<div{named('container', 'wrapper', 'page', 'row')}>{inner}</div>" if chance(0.3) else inner

    for _ in range(n):
        before = [f() for f in rng.sample([menu, top, advert, notice, form, side, menu, advert], rng.randint(0, 5))]
        after = [f() for f in rng.sample([side, comments, advert, form, menu, notice], rng.randint(0, 4))] + ([bottom()] if chance(0.9) else [])
        page = "<!DOCTYPE html><html><head><title>x</title></head><body>" + "".join(before) + story() + "".join(after) + "</body></html>"
        yield page, [b.text for b in blocks(page) if "~" in b.text]


@lru_cache(1)
def trained(pages: int = 600, rounds: int = 8) -> Extractor:
    """The extractor trained on made-up pages; the same on every run."""
    found = [f for f in (blocks(page) for page, _ in labelled_pages(pages)) if f]
    labels = [[int("~" in b.text) for b in f] for f in found]
    for f in found:
        for b in f:
            b.text = b.text.replace("~", "").replace("^", "") or "-"
    counts: dict[str, int] = {}
    for f in found:
        for r in features(f):
            for x in r:
                counts[x] = counts.get(x, 0) + 1
    index = {x: i for i, x in enumerate(sorted(x for x, n in counts.items() if n >= 3))}
    out = Extractor(index, Chain(len(index)))
    sums = [np.zeros_like(x) for x in (out.chain.emit, out.chain.move, out.chain.start)]
    order, rng = list(zip([out.rows(f) for f in found], labels)), random.Random(1)
    for k in range(rounds):
        rng.shuffle(order)
        for rows, gold in order:
            out.chain.step(rows, gold, 0.3 / (1 + k) ** 0.5, sums)
    return out


def main_text(pages: DataFrame, extractor: Extractor | None = None) -> DataFrame:
    """page_id, url, text, n_chars for every row of pages (page_id, url, html)."""
    shared = pages.sparkSession.sparkContext.broadcast(extractor or trained())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = [shared.value(page) for page in batch.html]
            yield pd.DataFrame({"id": batch["id"], "url": batch.url, "text": texts, "n_chars": [len(t) for t in texts]})

    out = map_frames(pages.select(F.col("page_id").cast("string").alias("id"), "url", "html"), run, "id string, url string, text string, n_chars long")
    return out.select(F.col("id").cast(pages.schema["page_id"].dataType).alias("page_id"), "url", "text", "n_chars")
