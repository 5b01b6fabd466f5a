"""Main text of web pages: boosted trees over DOM nodes, decoded along the tree.

A page is read into its elements. Each has features: its tag, what the words of its class, id and role, of its
parent's and of its ancestors' tell, depth, text and link density of its subtree, sentences, place in the page, and
how it compares with its siblings. What a word tells is learned: hashed into `BUCKETS`, its log odds to lie in an
article, by the training pages that it is on; a page's own share is left out while the trees are fitted, so they
learn what a word is worth that other pages have shown, and go by structure where none have shown it.
Gradient-boosted trees give the chance that an element belongs to the article.
Decoding picks the most likely state of every element at once: `out` (around the article), `in` and `cut`;
below `in` only `in` or `cut` may follow, below `cut` only `cut`, so no kept element lies under a cut one.

The trees are fitted on at most `TRAINING_PAGES` pages that mark their article (<article>, <main>), on the first
`MAX_TRAINING_CHARS` characters of each, and on variants of them with other markup, with few blocks, with other
pages' furniture and with menus, forms, comments and the like put in, part of them under made-up words, or with no
markup at all, so that the model does not hang on one template or list of words. Extraction covers every page as a
whole.

Markup is read as browsers do where it matters: a quote opens a value only behind an equals sign, so an odd one
ends with its tag; only script, style, textarea, iframe and noscript hold raw text; a block element ends an open
select or svg; text outside all elements is in an implied body.

Defined results: a null page is empty; a page without an article gives an empty text; a page without tags is text
as a whole; a table of pages none of which marks its article raises ValueError, as nothing could be learned; rows
that repeat are extracted each; white space inside a block becomes one space; an empty table gives no rows; further
columns are not read. Memory in a task follows the longest page.
"""

from __future__ import annotations

import html
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.batches import slices
from daybook.llm.sampling import among_lowest, order
from daybook.llm.scratch import fresh, shared

TRAINING_PAGES = 120
MAX_TRAINING_CHARS = 100_000
VARIANTS = 3
BUCKETS = 1 << 14
FOLDS = 4
TREES = 40
DEPTH = 4
BINS = 24

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript textarea iframe".split())
#: Elements that a block element does not lie in.
NARROW = {"select", "svg", "math"}
BLOCK = frozenset(
    "address article aside blockquote body dd details div dl dt fieldset figcaption figure footer form h1 h2 "
    "h3 h4 h5 h6 head header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead "
    "title tr ul".split()
)
#: A start tag of the first kind ends open elements of the second one.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "option": {"option"}}
SCOPES = frozenset("html body article main section div td th table ul ol dl aside nav header footer form blockquote figure".split())
TAGS = (
    "html head title body main article section div p h1 h2 h3 h4 h5 h6 ul ol li a b i em strong span nav header "
    "footer aside form table tr td th blockquote pre code figure figcaption button label img".split()
)
#: Words of the furniture that variants get, beside that of the corpus's own pages and made-up words. Extraction
#: itself has no list of words.
WORDS = {
    "menu": "nav navbar navigation menu breadcrumb breadcrumbs toc tabs pagination pager",
    "head": "header masthead topbar banner hero logo",
    "foot": "footer foot copyright legal colophon",
    "side": "sidebar aside rail widget related recommended trending popular",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay paywall",
    "advert": "ad ads advert advertisement adsense sponsor sponsored promo promotion outbrain taboola",
    "form": "form search login signup subscribe newsletter register input",
    "comment": "comment comments reply replies discussion disqus respond responses thread reader",
    "share": "share sharing social follow tags meta byline author date",
    "main": "article content main post entry story text body prose page",
}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</([a-zA-Z][^\s/>]*)[^>]*(?:>|\Z)|<([a-zA-Z][^\s/>]*)((?:=\s*(?:\"[^\"]*\"|'[^']*')|[^>])*)(?:>|\Z)|[^<]+|<",
    re.DOTALL,
)
_NAMED = re.compile(r"""(?:^|\s)(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)


@dataclass
class Page:
    """Elements in page order, and pieces of text with the element and the block that they are in."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    words: list[list[str]] = field(default_factory=list)
    pieces: list[tuple[int, int, str]] = field(default_factory=list)


def read(source: str | None) -> Page:
    page, stack, block = Page(), [], 0
    text = source or ""
    at, size = 0, len(text)
    while at < size:
        m = _TOKEN.match(text, at)
        at = m.end()
        closing, tag = m[1], m[2]
        if tag is None and closing is None:
            piece = m[0]
            if not piece.startswith(("<!", "<?")):
                if not stack and not piece.isspace():
                    _open(page, stack, "body", "")
                    stack.append(len(page.tags) - 1)
                page.pieces.append((stack[-1] if stack else -1, block, html.unescape(piece)))
            continue
        if closing:
            closing = closing.lower()
            if closing in BLOCK:
                block += 1
            for k in range(len(stack) - 1, -1, -1):
                name = page.tags[stack[k]]
                if name == closing:
                    del stack[k:]
                    break
                if name in SCOPES and closing not in SCOPES:
                    break
            continue
        tag = tag.lower()
        if tag in BLOCK:
            block += 1
            _end(page, stack, NARROW)
            _end(page, stack, {"p"} | ENDS.get(tag, set()))
        elif tag in ENDS:
            _end(page, stack, ENDS[tag])
        named = " ".join(x.strip("\"'") for x in _NAMED.findall(m[3]))
        _open(page, stack, tag, named)
        if tag == "br":
            page.pieces.append((stack[-1] if stack else -1, block, " "))
        if tag in RAW:
            if not m[0].endswith("/>"):
                end = re.compile(f"</{tag}[^>]*>", re.IGNORECASE).search(text, at)
                at = end.end() if end else size
        elif tag not in VOID and not m[0].endswith("/>"):
            stack.append(len(page.tags) - 1)
    return page


def _open(page: Page, stack: list[int], tag: str, named: str) -> None:
    page.tags.append(tag)
    page.parents.append(stack[-1] if stack else -1)
    page.words.append(re.split(r"[^a-z0-9]+", re.sub("([a-z])([A-Z])", r"\1 \2", named).lower()) if named else [])


def _end(page: Page, stack: list[int], names: set[str]) -> None:
    """Closes the innermost open element of these names, if no other scope lies in between."""
    for k in range(len(stack) - 1, -1, -1):
        name = page.tags[stack[k]]
        if name in names:
            del stack[k:]
            return
        if name in SCOPES:
            return


N_TAGS = len(TAGS)
_TAG = {t: i for i, t in enumerate(TAGS)}
_HEADINGS = [_TAG[f"h{i}"] for i in range(1, 7)]


@lru_cache(maxsize=1 << 16)
def _bucket(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % BUCKETS


def _buckets(words: list[str]) -> list[int]:
    """Numbers alone tell nothing: they number elements."""
    return list({_bucket(w) for w in words if w and not w.isdigit()})


def shown(pages: list[tuple[Page, np.ndarray]]) -> np.ndarray:
    """For each bucket the pages that have it on an element inside the article, and outside."""
    seen = np.zeros((BUCKETS, 2))
    for page, inside in pages:
        found = {(b, int(not inside[i])) for i, words in enumerate(page.words) if words for b in _buckets(words)}
        for b, side in found:
            seen[b, side] += 1
    return seen


def leaning(seen: np.ndarray) -> np.ndarray:
    """Log odds of each bucket to lie inside; 0 for one that no page has shown."""
    return np.log((seen[:, 0] + 1) / (seen[:, 1] + 1))


NO_WORDS = np.zeros(BUCKETS)


def features(page: Page, lean: np.ndarray = NO_WORDS) -> np.ndarray:
    """One row for each element; `lean` has what each bucket of words tells."""
    n = len(page.tags)
    parent = np.array(page.parents, np.int64)
    tag = np.array([_TAG.get(t, N_TAGS) for t in page.tags], np.int64)
    own = np.zeros((n, 4))  # characters, those in links, sentence signs, words
    for i, _, piece in page.pieces:
        if i >= 0:
            words = piece.split()
            own[i, 0] += sum(map(len, words))
            own[i, 2] += piece.count(".") + piece.count(",")
            own[i, 3] += len(words)
    depth = np.zeros(n, np.int64)
    linked = tag == _TAG["a"]
    told = np.zeros((n, 2))  # the least and the most that one of its words tells
    for i, words in enumerate(page.words):
        if words:
            values = lean[_buckets(words)]
            if len(values):
                told[i] = min(0, values.min()), max(0, values.max())
    above = np.zeros((n, 2))
    under = np.zeros((n, 4), bool)  # article or main, menu or foot or side, form, link
    kind = np.column_stack([
        np.isin(tag, [_TAG["article"], _TAG["main"]]),
        np.isin(tag, [_TAG["nav"], _TAG["footer"], _TAG["aside"]]),
        np.isin(tag, [_TAG["form"], _TAG["button"], _TAG["label"]]),
        linked,
    ])
    for i in range(n):
        p = parent[i]
        if p >= 0:
            depth[i] = depth[p] + 1
            above[i] = min(above[p, 0], told[p, 0]), max(above[p, 1], told[p, 1])
            under[i] = under[p] | kind[p]
    own[:, 1] = np.where(linked | under[:, 3], own[:, 0], 0)
    total = np.column_stack([own, np.ones(n), tag == _TAG["p"], np.isin(tag, _HEADINGS), tag == _TAG["li"]])
    for i in range(n - 1, 0, -1):
        if parent[i] >= 0:
            total[parent[i]] += total[i]
    whole = max(1.0, own[:, 0].sum())
    siblings = np.ones(n)
    place = np.zeros(n)
    around = np.zeros(n)
    count: dict[int, int] = {}
    for i in range(n):
        place[i] = count.get(page.parents[i], 0)
        count[page.parents[i]] = count.get(page.parents[i], 0) + 1
    for i in range(n):
        p = page.parents[i]
        siblings[i] = count[p]
        around[i] = (total[p, 0] - total[i, 0]) / max(1, count[p] - 1) if p >= 0 else 0
    before = np.concatenate(([0], np.cumsum(own[:, 0])[:-1])) if n else np.zeros(0)
    chars = total[:, 0]
    return np.column_stack([
        tag, np.where(parent >= 0, tag[parent], N_TAGS), depth, np.log1p(chars), np.log1p(own[:, 0]),
        total[:, 1] / np.maximum(1, chars), chars / total[:, 4], total[:, 2] / np.maximum(1, total[:, 3]),
        np.log1p(total[:, 5]), np.log1p(total[:, 6]), np.log1p(total[:, 7]), chars / whole,
        before / whole, (before + chars) / whole, np.log1p(siblings), place / siblings,
        np.log1p(around), np.log1p(chars) - np.log1p(around), under,
        [bool(w) for w in page.words], told, np.where(parent[:, None] >= 0, told[parent], 0), above,
    ]).astype(np.float32)


@dataclass
class Trees:
    """Boosted trees of fixed depth, as arrays: node k of a tree has children 2k + 1 and 2k + 2."""

    base: float
    columns: np.ndarray
    cuts: np.ndarray
    leaves: np.ndarray
    lean: np.ndarray = field(default_factory=lambda: NO_WORDS)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for columns, cuts, leaves in zip(self.columns, self.cuts, self.leaves):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, columns[at]] > cuts[at])
            out += leaves[at - (2**DEPTH - 1)]
        return out


def boost(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = TREES, rate: float = 0.2) -> Trees:
    """Gradient boosting for the logistic loss, with histograms of at most BINS bins a column."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) if len(np.unique(x[:, j])) > BINS
             else np.unique(x[:, j])[:-1] for j in range(width)]
    bins = np.column_stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)])
    most = max(2, max(len(e) for e in edges) + 1)
    share = np.clip(np.average(y, weights=weight), 0.01, 0.99)
    base = float(np.log(share / (1 - share)))
    score = np.full(n, base)
    inner, end = 2**DEPTH - 1, 2**DEPTH
    columns = np.zeros((trees, inner), np.int64)
    cuts = np.full((trees, inner), np.inf)
    leaves = np.zeros((trees, end))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = weight * (p - y), weight * np.maximum(p * (1 - p), 1e-6)
        at = np.zeros(n, np.int64)
        for level in range(DEPTH):
            first, nodes = 2**level - 1, 2**level
            best = np.full(nodes, 1e-3)
            for j in range(width):
                if not len(edges[j]):
                    continue
                cell = (at - first) * most + bins[:, j]
                gs = np.bincount(cell, g, nodes * most).reshape(nodes, most).cumsum(1)
                hs = np.bincount(cell, h, nodes * most).reshape(nodes, most).cumsum(1)
                gt, ht = gs[:, -1:], hs[:, -1:]
                gain = gs**2 / (hs + 1) + (gt - gs) ** 2 / (ht - hs + 1) - gt**2 / (ht + 1)
                gain = np.where((hs > 0.5) & (ht - hs > 0.5), gain, 0)[:, : len(edges[j])]
                k = gain.argmax(1)
                top = gain[np.arange(nodes), k]
                better = np.flatnonzero(top > best)
                best[better] = top[better]
                columns[t, first + better] = j
                cuts[t, first + better] = edges[j][k[better]]
            at = 2 * at + 1 + (x[np.arange(n), columns[t, at]] > cuts[t, at])
        place = at - inner
        gs, hs = np.bincount(place, g, end), np.bincount(place, h, end)
        leaves[t] = -rate * gs / (hs + 1)
        score += leaves[t, place]
    return Trees(base, columns, cuts, leaves)


OUT, IN, CUT = 0, 1, 2
_SWITCH = 1.8
_NEVER = frozenset("head title script style noscript template form button select option textarea svg math canvas iframe".split())


def decode(page: Page, chance: np.ndarray) -> list[int]:
    """The most likely state of each element, under the rules of which state may follow below which."""
    n = len(page.tags)
    size = np.zeros(n)
    for i, _, piece in page.pieces:
        if i >= 0:
            size[i] += len(piece.strip())
    chance = np.clip(chance, 0.01, 0.99)
    weight = 1 + size / 40
    yes, no = weight * np.log(chance), weight * np.log(1 - chance)
    best = np.column_stack([no, yes, no])
    for i, tag in enumerate(page.tags):
        if tag in _NEVER:
            best[i, IN] = -np.inf
    best = best.tolist()
    for i in range(n - 1, -1, -1):
        p = page.parents[i]
        if p >= 0:
            o, k, c = best[i]
            up = best[p]
            up[OUT] += max(o, k - _SWITCH, c)
            up[IN] += max(k, c - _SWITCH)
            up[CUT] += c
    states = [CUT] * n
    for i in range(n):
        o, k, c = best[i]
        above = states[page.parents[i]] if page.parents[i] >= 0 else OUT
        if above == OUT:
            states[i] = max(((o, OUT), (k - _SWITCH, IN), (c, CUT)), key=lambda x: x[0])[1]
        elif above == IN:
            states[i] = IN if k >= c - _SWITCH else CUT
    return states


def text_of(page: Page, states: list[int]) -> str:
    """The blocks of the kept elements' text, in page order."""
    out: list[str] = []
    held: list[str] = []
    now = None
    for i, block, piece in page.pieces:
        if i < 0 or states[i] != IN:
            continue
        if block != now:
            out.append(" ".join("".join(held).split()))
            held, now = [], block
        held.append(piece)
    out.append(" ".join("".join(held).split()))
    return "\n".join(x for x in out if x)


def extract(pages: list[str | None], model: Trees) -> list[str]:
    """The main text of each page."""
    read_pages = [read(p) for p in pages]
    rows = [features(p, model.lean) for p in read_pages if p.tags]
    chance = 1 / (1 + np.exp(-model.score(np.concatenate(rows)))) if rows else np.zeros(0)
    out, at = [], 0
    for page in read_pages:
        n = len(page.tags)
        out.append(text_of(page, decode(page, chance[at : at + n])) if n else "")
        at += n
    return out


# ---- training ----------------------------------------------------------------------------

_MARK = "data-boiler"


def _made_up(rng: np.random.Generator) -> str:
    return "".join(rng.choice(list("abcdefghiklmnoprstuvwxy"), rng.integers(2, 9)))


def rendered(page: Page, root: int) -> str:
    """Markup of a subtree: of each element its own text, then its children."""
    text: dict[int, list[str]] = {}
    for i, _, piece in page.pieces:
        text.setdefault(i, []).append(html.escape(piece, quote=False))
    made: dict[int, list[str]] = {}
    for i in range(len(page.tags) - 1, root - 1, -1):
        tag, above = page.tags[i], i
        while above > root:
            above = page.parents[above]
        if above != root or tag in RAW:
            continue
        named = f' class="{" ".join(page.words[i])}"' if page.words[i] else ""
        body = "".join(text.get(i, [])) + "".join(reversed(made.get(i, [])))
        whole = f"<{tag}{named}>" + ("" if tag in VOID else f"{body}</{tag}>")
        if i == root:
            return whole
        made.setdefault(page.parents[i], []).append(whole)
    return ""


def furniture(page: Page, inside: np.ndarray) -> list[str]:
    """Markup of the outermost elements with text that neither lie in the article nor hold it."""
    n = len(page.tags)
    holds, has_text = inside > 0, np.zeros(n, bool)
    for i, _, piece in page.pieces:
        if i >= 0 and not piece.isspace():
            has_text[i] = True
    for i in range(n - 1, 0, -1):
        p = page.parents[i]
        if p >= 0:
            holds[p] |= holds[i]
            has_text[p] |= has_text[i]
    out = []
    for i in range(n):
        p = page.parents[i]
        if p >= 0 and holds[p] and inside[p] <= 0 and not holds[i] and has_text[i] and page.tags[i] not in _NEVER:
            out.append(re.sub("(?=[ >])", f" {_MARK}", rendered(page, i), count=1))
    return out


def _chrome(rng: np.random.Generator, text: np.ndarray, own: list[str] = ()) -> str:
    """A piece of page furniture, marked as such: one of another page, or one with words of the corpus in it."""
    if len(own) and rng.random() < 0.3:
        return own[rng.integers(len(own))]
    some = lambda k: " ".join(rng.choice(text, k))
    links = "".join(f'<li><a href="/x">{some(rng.integers(1, 4))}</a></li>' for _ in range(rng.integers(2, 7)))
    word = lambda group: rng.choice(WORDS[group].split())
    many = "".join(f'<div class="{word("comment")}"><b>{some(2)}</b><p>{some(rng.integers(4, 40))}</p></div>' for _ in range(rng.integers(1, 5)))
    made = [
        f"<nav {_MARK}><ul>{links}</ul></nav>",
        f'<div {_MARK} class="{word("menu")}"><ul>{links}</ul></div>',
        f'<header {_MARK} class="site-{word("head")}"><a href="/">{some(2)}</a></header>',
        f'<div {_MARK} class="{word("head")}"><span>{some(3)}</span></div>',
        f'<footer {_MARK}>&copy; {some(rng.integers(3, 20))}</footer>',
        f'<div {_MARK} id="{word("foot")}"><p>{some(rng.integers(3, 20))}</p></div>',
        f'<aside {_MARK}><h3>{some(2)}</h3><ul>{links}</ul></aside>',
        f'<aside {_MARK} class="{word("side")}"><p>{some(rng.integers(5, 40))}</p></aside>',
        f'<div {_MARK} class="{word("side")}"><h3>{some(2)}</h3><p>{some(rng.integers(5, 30))}</p></div>',
        f'<div {_MARK} class="{word("notice")}-{word("notice")}"><p>{some(rng.integers(5, 30))}</p></div>',
        f'<div {_MARK} class="{word("advert")}">{some(rng.integers(3, 30))}</div>',
        f'<p {_MARK} class="{word("advert")}">{some(rng.integers(3, 30))}</p>',
        f'<form {_MARK} action="/x"><label>{some(2)}</label><p>{some(rng.integers(2, 12))}</p></form>',
        f'<div {_MARK} class="{word("form")}"><p>{some(rng.integers(3, 12))}</p></div>',
        f'<section {_MARK} class="{word("comment")}"><h2>{some(1)}</h2>{many}</section>',
        f'<div {_MARK} id="{word("comment")}">{many}</div>',
        f'<div {_MARK} class="{word("share")}"><a href="/x">{some(1)}</a> <a href="/y">{some(1)}</a></div>',
    ]
    one = made[rng.integers(len(made))]
    if ("<a " in one or "<form" in one) and rng.random() < 0.4:  # told by its structure alone
        one = re.sub('(class|id)="[^"]*"', lambda m: f'{m[1]}="{_made_up(rng)}-{_made_up(rng)}"', one, count=1)
    return one


def _variant(source: str, rng: np.random.Generator, text: np.ndarray, own: list[str] = ()) -> str:
    """The page with other markup around its article and furniture put in around and inside it."""
    name = _made_up(rng) if rng.random() < 0.3 else rng.choice(WORDS["main"].split())
    opening, closing = [
        ("<article>", "</article>"), ("<main>", "</main>"), (f'<div class="{name}">', "</div>"),
        (f'<main><div class="{name}-{rng.choice(WORDS["main"].split())}">', "</div></main>"),
        ("<main><article>", "</article></main>"), (f'<section id="{name}">', "</section>"), ("<div>", "</div>"),
    ][rng.integers(7)]
    m = re.search(r"<(article|main)\b[^>]*>(.*)</\1>", source, re.DOTALL | re.IGNORECASE)
    if not m:
        return source
    inside = m[2]
    blocks = re.split(r"(?=<p>)", inside)
    if rng.random() < 0.3:
        blocks = blocks[: rng.integers(1, 5)]
    for _ in range(rng.integers(0, 3)):
        blocks.insert(rng.integers(1, len(blocks) + 1), _chrome(rng, text, own))
    if rng.random() < 0.3:
        blocks = [re.sub("<(/?)p>", r"<\1li>", b) if rng.random() < 0.3 else b for b in blocks]
    for i, b in enumerate(blocks):
        if b.startswith("<p>") and rng.random() < 0.12:
            words = re.sub("<[^>]*>", " ", b).split()
            blocks[i] = f"<pre>{' '.join(words[: rng.integers(2, 60)])}</pre>"
    if rng.random() < 0.2:
        words = " ".join(rng.choice(text, rng.integers(3, 15)))
        blocks.insert(rng.integers(1, len(blocks) + 1), f'<figure><img src="x.png"><figcaption>{words}</figcaption></figure>')
    if rng.random() < 0.3:
        blocks[0] = f"<header>{blocks[0]}</header>" if "<p" not in blocks[0] and "<li" not in blocks[0] else blocks[0]
    if rng.random() < 0.3:
        blocks.insert(rng.integers(1, len(blocks) + 1), f"<blockquote><p>{' '.join(rng.choice(text, 12))}</p></blockquote>")
    around = [_chrome(rng, text, own) for _ in range(rng.integers(0, 4))]
    cut = rng.integers(0, len(around) + 1)
    wrap = rng.random() < 0.4
    article = opening.replace(">", " data-main>", 1) + "".join(blocks) + closing
    body = "".join(around[:cut]) + article + "".join(around[cut:])
    if wrap:
        body = f'<div class="{rng.choice(["wrapper", "container", "page", "layout"])}">{body}</div>'
    return source[: m.start()] + body + source[m.end() :]


def _bare(source: str, rng: np.random.Generator) -> str:
    """The text of the page's article without markup, or with line breaks alone."""
    m = re.search(r"<(article|main)\b[^>]*>(.*)</\1>", source, re.DOTALL | re.IGNORECASE)
    parts = [re.sub("<[^>]*>", " ", p) for p in re.split("</?(?:p|h1)>", m[2])] if m else []
    return ["\n", "<br>", "<br><br>\n"][rng.integers(3)].join(p for p in parts if p.strip())


def fit(pages: list[str], seed: int = 11, variants: int = VARIANTS) -> Trees:
    """Fits the trees on pages that mark their article."""
    rng = np.random.default_rng(seed)
    text = np.array(sorted({w for p in pages[:50] for w in re.sub("<[^>]*>", " ", p).split() if "&" not in w and "<" not in w})[:5000] or ["-"])
    own = sorted({x for p in pages for x in furniture(*_labelled(p))}) if variants else []
    made: list[list[tuple[Page, np.ndarray]]] = [[] for _ in range(FOLDS)]
    for i, source in enumerate(pages):
        for k in range(variants + 1):
            page, inside = _labelled(_variant(source, rng, text, own) if k else source)
            if page.tags and inside.any():
                made[i % FOLDS].append((page, inside))
        page = read(_bare(source, rng))
        if page.tags:
            made[i % FOLDS].append((page, np.ones(len(page.tags))))
    if not any(made):
        return Trees(-4.0, np.zeros((0, 1), np.int64), np.zeros((0, 1)), np.zeros((0, 1)))
    seen = [shown(fold) for fold in made]
    every = sum(seen)
    xs = [features(page, leaning(every - seen[f])) for f, fold in enumerate(made) for page, _ in fold]
    y = np.concatenate([inside for fold in made for _, inside in fold])
    x = np.concatenate(xs)
    trees = boost(x, y, 1 + np.expm1(x[:, 4]) / 100)
    trees.lean = leaning(every)
    return trees


def _labelled(source: str) -> tuple[Page, np.ndarray]:
    """The page and which of its elements belong to the marked article. Marks are not seen as features."""
    page = read(re.sub(rf" (data-main|{_MARK})(?=[\s>])", r' itemprop="zz\1"', source))
    n = len(page.tags)
    inside = np.zeros(n)
    marked = any("zzdata" in w and "main" in w for w in page.words)
    for i in range(n):
        words = page.words[i]
        own_mark = "zzdata" in words
        above = inside[page.parents[i]] if page.parents[i] >= 0 else 0
        if own_mark and "boiler" in words:
            inside[i] = -1
        elif above < 0 or (above > 0 and page.tags[i] in _NEVER):
            inside[i] = -1
        elif marked and own_mark and "main" in words:
            inside[i] = 1
        elif not marked and page.tags[i] in ("article", "main"):
            inside[i] = 1
        else:
            inside[i] = above
        if own_mark:
            page.words[i] = [w for w in words if w not in ("zzdata", "main", "boiler")] + (
                ["main"] if words.count("main") > 1 else []
            )
    return page, (inside > 0).astype(float)


def sample(frame: DataFrame, id_column: str = "page_id", html_column: str = "html",
           pages: int = TRAINING_PAGES) -> list[str]:
    """At most `pages` pages with a marked article, cut to MAX_TRAINING_CHARS: those with the smallest id hashes."""
    source = F.substring(html_column, 1, MAX_TRAINING_CHARS)
    marked = frame.where(F.col(id_column).isNotNull()).select(F.col(id_column).alias("id"), source.alias("html")).where(
        F.col("html").rlike("(?i)<(article|main)[ >]")
    )
    few = marked.where(among_lowest("id", pages, marked.agg(F.approx_count_distinct("id")).first()[0]))
    found = few.select(order("id").alias("order"), "html").distinct().orderBy("order", "html").limit(pages).collect()
    if not found and not frame.isEmpty():
        raise ValueError("no page marks its article")
    return [r.html for r in found]


def main_text(frame: DataFrame, model: Trees, id_column: str = "page_id", html_column: str = "html",
              also: tuple[str, ...] = ()) -> DataFrame:
    """id, the given columns, text and its code points of each page; one pass, no shuffle."""
    held = shared(frame.sparkSession, model)
    kept = list(dict.fromkeys((id_column, *also)))
    page = fresh(frame, "__html")
    source = frame.select(*kept, F.col(html_column).alias(page))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in slices(batch, page, 1 << 20):
                texts = extract(rows.column(page).to_pylist(), held.value)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(c) for c in kept), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())],
                    [*kept, "text", "n_chars"],
                )

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema if f.name != page)
    return source.mapInArrow(run, f"{schema}, text string, n_chars long")
