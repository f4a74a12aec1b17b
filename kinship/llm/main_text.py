"""Main text of web pages from flat text blocks.

The markup is read once, tag by tag, into a flat list of text blocks: what
stands between two block-level tags, with its words and how many of them are
links. Each block is described by shallow numbers, its own and its neighbours'
words and link density, and by what encloses it (landmark elements, words of
class names). A decision tree over these numbers tells text from the rest. It is
grown here from ``labelled_blocks()``, a small table of blocks of made-up pages,
and checks nothing but the numbers.

Nulls and ties: a null page is the empty string and has the empty text; rows
are independent of each other, so repeated rows give repeated results. An empty
table gives no rows. Other columns are ignored. Unclosed elements end with what
encloses them or with the page; a tag, comment or script that never ends swallows
the rest, as browsers do.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinship.llm.common import lean, whole_text

# --- text blocks ------------------------------------------------------------

#: Elements that end a block, besides those below.
BLOCK = frozenset("address blockquote body caption center dd details dialog div dl dt fieldset figure figcaption h1 h2 h3 h4 h5 h6 "
                  "hr html legend li main menu ol option p pre section summary table tbody td tfoot th thead tr ul article".split())
#: Elements whose content is never text of the page.
HIDDEN = frozenset("script style head template noscript iframe object svg math canvas select textarea button audio video map "
                   "datalist".split())
#: Raw text: nothing in it is a tag until its own end tag.
RAW = frozenset("script style textarea title iframe noframes xmp".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that stand beside the text.
ASIDE = frozenset("nav footer aside form header dialog menu search".split())
ROOM = frozenset(("article", "main"))
#: Words in class, id and role that name what stands beside the text.
BESIDE = frozenset("ad ads adv advert advertisement advertising banner sponsor sponsored promo promotion promoted nav navbar navigation menu "
                   "breadcrumb breadcrumbs sidebar aside footer masthead cookie cookies consent gdpr notice popup modal overlay "
                   "newsletter subscribe subscription signup login share sharing social comment comments reply replies respond disqus discussion "
                   "related recommended recommendations widget toolbar pagination pager copyright legal disclaimer search "
                   "complementary contentinfo alert topbar toplinks".split())
HEADING = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))

_TAG = re.compile(r"""<(?:!--(?:>|->|.*?(?:-->|--!>|\Z))|(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*)(?P<attrs>(?:=\s*"[^"]*"|=\s*'[^']*'|[^>])*+)(?:>|\Z)|[!?/][^>]*(?:>|\Z))""", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_GONE = re.compile(r"""\bhidden\b(?!\s*=\s*["']?false)|display\s*:\s*none|aria-hidden\s*=\s*["']?true""", re.I)
_WORDS = re.compile(r"[^A-Za-z]+|(?<=[a-z])(?=[A-Z])")
_QUOTED = re.compile(r""""[^"]*"|'[^']*'""")
_SPACE = re.compile(r"\s+")


@dataclass
class Block:
    text: str
    tag: str                    # the block element around it
    words: int
    linked: int                 # words within links
    beside: int                 # enclosing elements that name something beside the text
    room: int                   # enclosing article or main elements
    heading: bool


@dataclass
class _Open:
    """One element that is not closed yet."""
    name: str
    beside: bool = False
    hidden: bool = False


@dataclass
class _Reader:
    """Reads a page; ``open`` are the enclosing elements."""
    open: list[_Open] = field(default_factory=list)
    parts: list[tuple[str, bool]] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    links: int = 0
    hidden: int = 0

    def end_block(self) -> None:
        if not self.parts:
            return
        raw, self.parts = self.parts, []
        text = _SPACE.sub(" ", "".join(p for p, _ in raw)).strip()
        if not text:
            return
        words, linked = text.count(" ") + 1, 0
        if any(is_link for _, is_link in raw):          # a link's share of the words by its characters
            size = [len(_SPACE.sub("", p)) for p, _ in raw]
            linked = round(words * sum(n for n, (_, is_link) in zip(size, raw) if is_link) / sum(size))
        names = [o.name for o in self.open]
        self.blocks.append(Block(text, next((x for x in reversed(names) if x in BLOCK or x in ASIDE), ""), words, linked,
                                 sum([o.beside for o in self.open]), sum([x in ROOM for x in names]), not HEADING.isdisjoint(names)))

    def say(self, raw: str) -> None:
        if raw and not self.hidden:
            self.parts.append((html.unescape(raw), self.links > 0))

    def start(self, name: str, attrs: str) -> None:
        if name in BLOCK or name in ASIDE:
            self.leave("p", within=True)
            if name in ("li", "dt", "dd", "tr", "td", "th", "option"):
                self.leave(name, within=True)
            self.end_block()
        elif name == "br":
            self.say(" ")
        if name in VOID or attrs.rstrip().endswith("/") and name in HIDDEN:
            return
        # a page's header stands beside the text, an article's own does not
        beside = name in ASIDE and not (name == "header" and any(o.name in ROOM for o in self.open))
        hidden = name in HIDDEN
        if attrs:
            if name not in ("html", "body", "main"):
                beside = beside or not BESIDE.isdisjoint(w.lower() for m in _NAMES.finditer(attrs) for w in _WORDS.split(m[1] or m[2] or m[3] or ""))
            hidden = hidden or bool(_GONE.search(_QUOTED.sub(lambda m: m[0] if "none" in m[0] or "true" in m[0] else '""', attrs)))
        self.open.append(_Open(name, beside, hidden))
        self.hidden += hidden
        self.links += name == "a"

    def leave(self, name: str, within: bool = False) -> None:
        """Close the innermost open ``name`` and all in it. ``within``: only inside
        the innermost element that such an end tag may not leave."""
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k].name == name:
                if name in BLOCK or name in ASIDE:
                    self.end_block()
                for o in self.open[k:]:
                    self.hidden -= o.hidden
                    self.links -= o.name == "a"
                del self.open[k:]
                return
            if within and self.open[k].name in ("div", "section", "article", "table", "ul", "ol", "dl", "td", "blockquote", "body", "main", *ASIDE):
                return


def blocks_of(page: str) -> list[Block]:
    """The text blocks of a page in its order."""
    r, at = _Reader(), 0
    while True:
        m = _TAG.search(page, at)
        if not m:
            r.say(page[at:])
            r.end_block()
            return r.blocks
        r.say(page[at:m.start()])
        at = m.end()
        if not m["name"]:
            continue
        name = m["name"].lower()
        if m["close"]:
            r.leave(name)
            continue
        r.start(name, m["attrs"])
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            if not end:
                at = len(page)
            else:
                if name not in HIDDEN and name != "title":
                    r.say(page[at:end.start()])
                at = end.start()


# --- numbers of a block -----------------------------------------------------

FEATURES = ("words", "links", "words_before", "links_before", "words_after", "links_after", "beside", "place", "heading", "from_start",
            "to_end", "long_near", "listed", "sentence")
_LONG = 15


def features(blocks: list[Block]) -> np.ndarray:
    """A row of numbers for every block. ``from_start`` and ``to_end`` count the
    blocks to the page's first and last long text block without many links. A
    name that encloses all blocks but links tells nothing and does not count.
    ``place`` is 2 within an article or main element, 0 outside of the page's, 1 where it has none."""
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    links = np.array([b.linked / b.words for b in blocks], float)
    at = np.arange(n)
    beside = np.array([b.beside for b in blocks])
    beside = np.maximum(beside - beside[links < 0.34].min(initial=99), 0) if (links < 0.34).any() else beside
    long = np.flatnonzero((words >= _LONG) & (links < 0.34) & (beside == 0))
    first, last = (long[0], long[-1]) if len(long) else (0, n - 1)
    near = np.full(n, 99.0)
    if len(long):
        k = np.searchsorted(long, at)
        near = np.minimum(np.abs(long[np.minimum(k, len(long) - 1)] - at), np.abs(long[np.maximum(k - 1, 0)] - at)).astype(float)
    room = np.array([b.room > 0 for b in blocks])
    return np.column_stack([
        words, links, np.append(0, words[:-1]), np.append(0, links[:-1]), np.append(words[1:], 0), np.append(links[1:], 0),
        beside, np.where(room, 2, 0 if room.any() else 1), [b.heading for b in blocks], np.maximum(first - at, 0),
        np.maximum(at - last, 0), np.minimum(near, 99), [b.tag in ("li", "td", "option", "dd", "dt") for b in blocks],
        [bool(re.search(r"[.!?:;…。！？]['\"”’)\]]*$", b.text)) for b in blocks]]).astype(float)


# --- the tree ----------------------------------------------------------------

@dataclass
class Leaf:
    share: float                # of text among the labelled blocks that come here
    rows: int


@dataclass
class Node:
    feature: int
    bound: float                # to the left up to and with it
    left: Node | Leaf
    right: Node | Leaf


def grow(x: np.ndarray, y: np.ndarray, depth: int = 12, least: int = 3) -> Node | Leaf:
    """A binary tree of the splits that lower Gini impurity most; ``least`` rows to a leaf."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return Leaf(share, len(y))
    best = (2 * share * (1 - share) * len(y) - 1e-9, -1, 0.0)
    for f in range(x.shape[1]):
        by = np.argsort(x[:, f], kind="stable")
        v, t = x[by, f], np.cumsum(y[by])
        cut = np.flatnonzero(v[1:] > v[:-1]) + 1
        cut = cut[(cut >= least) & (cut <= len(y) - least)]
        if len(cut):
            a, b = t[cut - 1], t[-1] - t[cut - 1]
            loss = 2 * a * (1 - a / cut) + 2 * b * (1 - b / (len(y) - cut))
            k = int(loss.argmin())
            if loss[k] < best[0]:
                best = (float(loss[k]), f, float(v[cut[k] - 1] + v[cut[k]]) / 2)
    if best[1] < 0:
        return Leaf(share, len(y))
    go = x[:, best[1]] <= best[2]
    return Node(best[1], best[2], grow(x[go], y[go], depth - 1, least), grow(x[~go], y[~go], depth - 1, least))


def shares(tree: Node | Leaf, x: np.ndarray) -> np.ndarray:
    """The share of text in the leaf of every row."""
    if isinstance(tree, Leaf):
        return np.full(len(x), tree.share)
    out = np.empty(len(x))
    go = x[:, tree.feature] <= tree.bound
    out[go], out[~go] = shares(tree.left, x[go]), shares(tree.right, x[~go])
    return out


# --- the labelled table -------------------------------------------------------

def _prose(rng: np.random.Generator, words: int) -> str:
    """So many words, of which only number and length count."""
    return " ".join(["x" * k for k in rng.integers(2, 9, words)]) + rng.choice([".", ".", ".", "!", "?", ""], p=[.3, .2, .2, .05, .05, .2])


def _page(rng: np.random.Generator) -> list[tuple[str, bool | None]]:
    """One made-up page as pieces of markup: with text of the article (true), with
    text beside it (false), or with none."""
    marked = rng.random() < 0.7                    # landmark elements, or only divs
    named = rng.random() < 0.6                     # telling class names
    out: list[tuple[str, bool | None]] = []

    def wrap(element: str, name: str, inner: list[tuple[str, bool | None]]) -> None:
        tag = element if marked else "div"
        attr = f' class="{name}"' if named else ""
        out.extend([(f"<{tag}{attr}>", None), *inner, (f"</{tag}>", None)])

    def links(n: int, element: str = "li") -> list[tuple[str, bool | None]]:
        return [(f'<{element}><a href="/x">{_prose(rng, int(rng.integers(1, 4)))}</a></{element}>', False) for _ in range(n)]

    def some(low: int, high: int) -> str:
        return _prose(rng, int(rng.integers(low, high)))

    out.append(("<html><head><title>t</title><style>p{}</style></head><body>", None))
    if rng.random() < 0.4:
        wrap("header", "masthead", [(f"<div>{some(1, 6)}</div>", False), *links(int(rng.integers(0, 3)))])
    if rng.random() < 0.85:
        wrap("nav", "menu", links(int(rng.integers(2, 9))))
    for _ in range(int(rng.integers(0, 3))):
        kind = rng.choice(["ad", "cookie-notice", "newsletter", "banner"])
        name = f' class="{kind}"' if rng.random() < 0.8 else ""
        out.append((f"<div{name}>{some(2, 25)}</div>", False))
    if rng.random() < 0.3:
        wrap("form", "search", [(f"<label>{some(1, 4)}</label><input>", False)])
    out.append(("<article>" if marked else '<div class="content">' if named else "<div>", None))
    if rng.random() < 0.8:
        out.append((f"<h1>{some(1, 12)}</h1>", True))
    for _ in range(int(rng.integers(1, 9))):
        kind = rng.random()
        if kind < 0.45:
            out.append((f"<p>{some(20, 90)}</p>", True))
        elif kind < 0.6:
            out.append((f"<p>{some(1, 12)}</p>", True))
        elif kind < 0.7:
            out.append((f"<p><b>{some(1, 8)}<br>", True))
        elif kind < 0.78:
            out.append((f'<p>{some(15, 50)} <a href="/y">{some(1, 4)}</a> {some(5, 30)}</p>', True))
        elif kind < 0.85:
            out.append((f"<h2>{some(1, 8)}</h2>", True))
        elif kind < 0.93:
            out.extend([("<ul>", None), *((f"<li>{some(2, 20)}</li>", True) for _ in range(int(rng.integers(2, 5)))), ("</ul>", None)])
        else:
            out.append((f'<div class="{rng.choice(["ad", "related", "share"])}">{some(2, 15)}</div>', False))
    out.append(("</article>" if marked else "</div>", None))
    if rng.random() < 0.3:
        wrap("nav", "pager", links(int(rng.integers(1, 5))))
    if rng.random() < 0.35:
        out.append((f'<section class="comments"><h3>{some(1, 3)}</h3>', False))
        out.extend((f'<div class="comment"><p>{some(3, 40)}</p></div>', False) for _ in range(int(rng.integers(1, 5))))
        out.append(("</section>", None))
    if rng.random() < 0.4:
        wrap("aside", "sidebar", [(f"<h3>{some(1, 4)}</h3>", False), *links(int(rng.integers(1, 6))), (f"<p>{some(3, 25)}</p>", False)])
    if rng.random() < 0.65:
        tag, name = ("footer", "footer") if marked else ("div", "footer" if named else "")
        out.append((f'<{tag} class="{name}">&copy; {some(2, 14)}</{tag}>', False))
    return out


def labelled_blocks(pages: int = 480, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """The labelled table: numbers and labels of the blocks of ``pages`` made-up
    pages. A block's label is that of the piece of markup its words come from."""
    rng = np.random.default_rng(seed)
    xs, ys = [], []
    for _ in range(pages):
        pieces = _page(rng)
        blocks = blocks_of("".join(p for p, _ in pieces))
        told = [label for piece, label in pieces if label is not None for _ in blocks_of(piece)]
        assert len(told) == len(blocks)
        xs.append(features(blocks))
        ys.append(np.array(told, float))
    return np.concatenate(xs), np.concatenate(ys)


def fit(pages: int = 480, seed: int = 11) -> Node | Leaf:
    """The tree grown from the blocks of ``pages`` labelled pages."""
    return grow(*labelled_blocks(pages, seed))


# --- Spark -------------------------------------------------------------------

def text_of(page: str, tree: Node | Leaf) -> str:
    """The blocks that the tree takes for text, one to a line."""
    blocks = blocks_of(page)
    if not blocks:
        return ""
    return "\n".join(b.text for b, s in zip(blocks, shares(tree, features(blocks))) if s >= 0.5)


def extract(pages: DataFrame, tree: Node | Leaf) -> DataFrame:
    """``page_id, url, text, n_chars`` of every page, where it was read: nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [text_of(page, tree) for page in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", whole_text("html").alias("html"))
    kinds = dict(rows.dtypes)
    return rows.mapInArrow(lean(run), f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long").select(
        F.col("page_id"), F.col("url"), F.col("text"), F.col("n_chars"))
