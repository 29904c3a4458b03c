"""Main-text extraction: a linear-chain conditional random field over the leaf blocks of a page.

A page is cut at block-level tags into leaf blocks: text with one space for
white space and character references decoded, and the features of its place
(every ancestor's tag and class, id and role words, those of the nearest
section or named element marked) and
of its text (length, links, sentence marks). The random field labels the blocks
of a page as main or other, with weights for features, for neighbouring labels
and for the first label; Viterbi decoding gives the best labelling, and the main
blocks in page order are the text.

Training takes labelled pages: a bounded sample of ``PAGES`` pages (the smallest
hashes, up to ``MAX_TRAIN_CHARS`` long). A page with semantic markup labels
itself (main: inside ``article`` or ``main`` and not inside a marked aside).
Its blocks are also set anew into ``VARIANTS`` page layouts drawn from
``LAYOUTS``, whose container of every block is known, so the field learns other
markup than the sample's. Weights are fitted by gradient steps on the exact
conditional likelihood; all pages are then decoded, whole.

Null and empty html: no text. Scripts, styles, comments and other markup are
never text; cut-off tags at a page's end are dropped. Repeated rows are decoded
each by itself. Without a labelled page the layouts are filled with fixed words.
"""

from __future__ import annotations

import html
import random
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import map_batches, smallest_hashes

PAGES, MAX_TRAIN_CHARS, VARIANTS = 150, 100_000, 5
STEPS, RATE, RIDGE = 200, 0.4, 1e-5

# fixed values: elements of HTML
BLOCK_TAGS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html label legend li main menu nav ol optgroup option p pre search section select summary table tbody td textarea tfoot th thead title tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW_TAGS = frozenset("iframe noembed noframes noscript object script style svg template textarea title xmp".split())
SECTION_TAGS = frozenset("article aside blockquote body dialog footer form header main menu nav section".split())
# elements that end when one of the same kind begins
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
SIBLING_SCOPE = frozenset("ul ol menu dl select table".split())

_MARKUP = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)>|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^>]*\Z""", re.S)
_ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")


# ---- leaf blocks ------------------------------------------------------------------


class Block:
    __slots__ = ("text", "places", "near", "link_chars")

    def __init__(self, text: str, places: frozenset[str], near: tuple[str, ...], link_chars: int):
        self.text, self.places, self.near, self.link_chars = text, places, near, link_chars


def leaf_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    blocks: list[Block] = []
    # an open element: (tag, features of it and its ancestors, features of it or the nearest section or named element around it)
    stack: list[tuple[str, frozenset[str], tuple[str, ...]]] = [("", frozenset(), ())]
    open_at: dict[str, list[int]] = {}  # places of the open elements by tag, so that an end tag without a partner costs nothing
    blocks_at: list[int] = []  # places of the open block elements
    parts: list[str] = []
    links, link_chars = 0, 0

    def flush() -> None:
        nonlocal link_chars
        text = " ".join("".join(parts).split())
        if text:
            near = blocks_at[-1] if blocks_at else 0
            blocks.append(Block(text, stack[near][1], stack[near][2], link_chars))
        parts.clear()
        link_chars = 0

    def words(raw: str) -> None:
        nonlocal link_chars
        if raw:
            text = html.unescape(raw) if "&" in raw else raw
            parts.append(text)
            if links:
                link_chars += len(text.strip())

    def close(i: int) -> None:
        nonlocal links
        links -= sum(x[0] == "a" for x in stack[i:])
        for x in reversed(stack[i:]):
            open_at[x[0]].pop()
        del stack[i:]
        while blocks_at and blocks_at[-1] >= i:
            blocks_at.pop()

    at, end = 0, len(page)
    while at < end:
        m = _MARKUP.search(page, at)
        if m is None:
            words(page[at:])
            break
        words(page[at : m.start()])
        at = m.end()
        tag = (m[2] or m[5] or "").lower()
        if not tag:
            continue
        closing, attributes = m[1] or m[4], m[3] or m[6] or ""
        if closing:
            i = open_at[tag][-1] if open_at.get(tag) else 0
            if tag in BLOCK_TAGS:
                flush()
            if i:
                if tag not in BLOCK_TAGS and blocks_at and blocks_at[-1] >= i:
                    continue  # an inline end tag does not close blocks
                close(i)
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in BLOCK_TAGS:
            flush()
            i = blocks_at[-1] if blocks_at else 0
            if stack[i][0] == "p":  # a paragraph ends where a block begins
                close(i)
            kin = SIBLINGS.get(tag)
            if kin:
                last = lambda tags: max((open_at[x][-1] for x in tags if open_at.get(x)), default=0)
                if (i := last(kin)) > last(SIBLING_SCOPE - kin):
                    close(i)
        if tag in RAW_TAGS and not attributes.endswith("/"):
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID_TAGS or attributes.endswith("/"):
            continue
        own = [f"tag={tag}"]
        if "=" in attributes:
            for a in _ATTRIBUTE.finditer(attributes):
                own += [f"word={w}" for w in _WORD.findall((a[2] or a[3] or a[4] or "").lower())]
        links += tag == "a"
        places = stack[-1][1] | frozenset(own) if len(own) > 1 or tag in BLOCK_TAGS else stack[-1][1]
        open_at.setdefault(tag, []).append(len(stack))
        if tag in BLOCK_TAGS:
            blocks_at.append(len(stack))
        stack.append((tag, places, tuple(own) if len(own) > 1 or tag in SECTION_TAGS else stack[-1][2]))
    flush()
    return blocks


def _text_features(b: Block) -> list[str]:
    n = len(b.text)
    words = b.text.count(" ") + 1
    out = ["bias", f"size={min(n.bit_length(), 10)}", f"links={min(4, 5 * b.link_chars // max(n, 1))}"]
    if b.text[-1] in ".!?…。\"'”»":
        out.append("stop")
    if words >= 20:
        out.append("long")
    if "©" in b.text:
        out.append("copyright")
    return out


def features(b: Block) -> list[str]:
    return [*b.places, *(f"near:{x}" for x in b.near), *_text_features(b)]


# ---- the random field --------------------------------------------------------------


class Field:
    """Weights: per feature (for label main against other), per pair of neighbouring labels, per first label."""

    def __init__(self, weights: dict[str, float], steps: list[list[float]], first: list[float]):
        self.weights, self.steps, self.first = weights, steps, first

    def scores(self, blocks: list[Block]) -> list[float]:
        get = self.weights.get
        known: dict[tuple, float] = {}
        out = []
        for b in blocks:
            place = known.get((b.places, b.near))
            if place is None:
                place = known[b.places, b.near] = sum(get(f, 0.0) for f in b.places) + sum(get(f"near:{f}", 0.0) for f in b.near)
            out.append(place + sum(get(f, 0.0) for f in _text_features(b)))
        return out

    def viterbi(self, blocks: list[Block]) -> list[int]:
        """The likeliest labels; a tie goes to other."""
        if not blocks:
            return []
        (a, b), (c, d) = self.steps
        back = []
        s0 = s1 = 0.0
        for i, x in enumerate(self.scores(blocks)):
            if i == 0:
                s0, s1 = self.first[0], self.first[1] + x
                continue
            from0, from1 = int(s1 + c > s0 + a), int(s1 + d > s0 + b)
            back.append((from0, from1))
            s0, s1 = max(s0 + a, s1 + c), max(s0 + b, s1 + d) + x
        out = [int(s1 > s0)]
        for step in reversed(back):
            out.append(step[out[-1]])
        return out[::-1]


def train(pages: list[tuple[list[Block], list[int]]]) -> Field:
    """Maximum conditional likelihood with a ridge, all pages at once."""
    names = sorted({f for blocks, _ in pages for b in blocks for f in features(b)})
    number = {f: i for i, f in enumerate(names)}
    n_pages, longest = len(pages), max(len(b) for b, _ in pages)
    rows, cols, page_of, place = [], [], [], []
    gold = np.zeros((n_pages, longest), np.int64)
    inside = np.zeros((n_pages, longest), bool)
    for p, (blocks, labels) in enumerate(pages):
        for t, (b, y) in enumerate(zip(blocks, labels)):
            ids = {number[f] for f in features(b)}
            rows += [len(page_of)] * len(ids)
            cols += sorted(ids)
            page_of.append(p)
            place.append(t)
            gold[p, t], inside[p, t] = y, True
    rows, cols, page_of, place = (np.array(x) for x in (rows, cols, page_of, place))
    last = inside.sum(axis=1) - 1
    w, steps, first = np.zeros(len(names)), np.zeros((2, 2)), np.zeros(2)
    seen = [np.zeros_like(x) for x in (w, steps, first)]  # sums of squared gradients
    pairs = inside[:, 1:]
    gold_steps = np.array([[((gold[:, :-1] == a) & (gold[:, 1:] == b) & pairs).sum() for b in (0, 1)] for a in (0, 1)], float)
    n_blocks = len(page_of)
    for _ in range(STEPS):
        x = np.zeros((n_pages, longest))
        x[page_of, place] = np.bincount(rows, w[cols], minlength=n_blocks)
        emit = np.stack([np.zeros_like(x), x], axis=2)
        ahead = np.empty((n_pages, longest, 2))
        ahead[:, 0] = first + emit[:, 0]
        for t in range(1, longest):
            ahead[:, t] = np.logaddexp(ahead[:, t - 1, :1] + steps[0], ahead[:, t - 1, 1:] + steps[1]) + emit[:, t]
        behind = np.zeros((n_pages, longest, 2))
        for t in range(longest - 2, -1, -1):
            nxt = behind[:, t + 1] + emit[:, t + 1]
            value = np.logaddexp(steps[:, 0] + nxt[:, :1], steps[:, 1] + nxt[:, 1:])
            behind[:, t] = np.where((t < last)[:, None], value, 0.0)
        total = np.logaddexp(*ahead[np.arange(n_pages), last].T)
        main = np.exp(ahead[:, :, 1] + behind[:, :, 1] - total[:, None])
        gap = (gold - main)[page_of, place]
        joint = ahead[:, :-1, :, None] + steps + (behind + emit)[:, 1:, None, :] - total[:, None, None, None]
        expected = np.exp(np.where(pairs[:, :, None, None], joint, -np.inf)).sum(axis=(0, 1))
        start = np.array([(gold[:, 0] == y).sum() for y in (0, 1)]) - np.array([(1 - main[:, 0]).sum(), main[:, 0].sum()])
        gradients = (np.bincount(cols, gap[rows], minlength=len(names)) / n_blocks - RIDGE * w, (gold_steps - expected) / n_blocks - RIDGE * steps, start / n_blocks - RIDGE * first)
        for value, g, s in zip((w, steps, first), gradients, seen):
            s += g * g
            value += RATE * g / np.sqrt(s + 1e-12)
    return Field(dict(zip(names, w.tolist())), steps.tolist(), first.tolist())


# ---- labelled pages ------------------------------------------------------------------

MAIN_PLACES = frozenset(("tag=article", "tag=main"))
OTHER_PLACES = frozenset(f"tag={t}" for t in "nav aside footer form dialog menu button select label".split())
#: containers (opening tag, closing tag) by what they hold
MAIN_BOXES = [
    ("<article>", "</article>"), ("<main>", "</main>"), ("<main><article>", "</article></main>"), ('<article class="post">', "</article>"), ('<div class="content">', "</div>"),
    ('<div id="content"><div class="article-body">', "</div></div>"), ('<div class="post-content entry">', "</div>"), ('<section class="main-content">', "</section>"), ('<div id="main" role="main">', "</div>"),
    ('<div class="story-text">', "</div>"), ('<article><div class="body">', "</div></article>"),
]
OTHER_BOXES = [
    ("<nav><ul>", "</ul></nav>", "list"), ('<div class="menu"><ul>', "</ul></div>", "list"), ('<ul class="nav navigation">', "</ul>", "list"), ('<div class="breadcrumbs">', "</div>", "links"), ("<header>", "</header>", "short"),
    ('<div class="header banner" id="header">', "</div>", "short"), ("<footer>", "</footer>", "short"), ('<div class="footer" id="footer">', "</div>", "short"), ("<aside>", "</aside>", "long"), ('<div class="sidebar widget">', "</div>", "long"),
    ('<div id="sidebar"><ul>', "</ul></div>", "list"), ('<div class="ad">', "</div>", "short"), ('<div class="ads advert advertisement">', "</div>", "short"), ('<div class="promo sponsored sponsor">', "</div>", "long"), ('<div class="banner">', "</div>", "short"),
    ('<div class="cookie-notice consent">', "</div>", "long"), ('<div class="notice alert" role="alert">', "</div>", "short"), ('<p class="notice">', "</p>", "bare"), ('<div id="cookie-banner" class="popup modal">', "</div>", "short"), ("<form>", "</form>", "form"),
    ('<form class="search" role="search">', "</form>", "form"), ('<div class="newsletter subscribe signup">', "</div>", "form"), ('<div class="related more recommended">', "</div>", "links"), ('<div class="share social">', "</div>", "links"), ('<div class="login">', "</div>", "form"),
]
COMMENT_BOXES = [
    ('<section class="comments" id="comments">', "</section>"), ('<div class="comment-list">', "</div>"), ('<ol class="commentlist">', "</ol>"), ('<div id="disqus_thread" class="replies responses discussion">', "</div>"), ('<aside class="comments">', "</aside>"),
]
ONE_COMMENT = [('<div class="comment"><p>', "</p></div>"), ('<li class="comment reply"><p>', "</p></li>"), ('<article class="comment"><p>', "</p></article>"), ("<p>", "</p>")]
FIXED_WORDS = "One plain sentence stands here. Another one follows it, a little longer than the first one was, so that it reads like text.".split()
_MARK = ""  # private use: stands before every main block while a layout is parsed


def own_labels(blocks: list[Block]) -> list[int] | None:
    """Labels of a page that marks its main text by article or main; None for another page."""
    labels = [int(bool(b.places & MAIN_PLACES) and not b.places & OTHER_PLACES and not any(p.startswith("word=comment") for p in b.places)) for b in blocks]
    return labels if any(labels) else None


def variant(main: list[str], other: list[str], prose: list[str], rng: random.Random) -> tuple[list[Block], list[int]]:
    """A page that holds ``main`` in a drawn container amid drawn others, and its labels."""
    esc = html.escape

    def box(kind: tuple[str, str, str]) -> str:
        begin, end, what = kind
        few = [esc(rng.choice(other)) for _ in range(rng.randint(1, 5))]
        if what == "list":
            body = "".join(f'<li><a href="/x">{t}</a></li>' for t in few)
        elif what == "links":
            body = " ".join(f'<a href="/x">{t}</a>' for t in few)
        elif what == "form":
            body = f"<label>{few[0]}</label><input name=q><button>{few[-1]}</button>" + f"<p>{esc(rng.choice(prose))}</p>" * rng.randint(0, 1)
        elif what == "long":
            body = "".join(f"<p>{esc(rng.choice(prose))}</p>" for _ in range(rng.randint(1, 3)))
        else:
            body = few[0] if what == "bare" or rng.random() < 0.6 else f"<p>{few[0]}</p>"
        return begin + body + end

    def comments() -> str:
        begin, end = rng.choice(COMMENT_BOXES)
        one = rng.choice(ONE_COMMENT)
        return begin + (f"<h3>{esc(rng.choice(other))}</h3>" if rng.random() < 0.5 else "") + "".join(one[0] + esc(rng.choice(prose)) + one[1] for _ in range(rng.randint(1, 4))) + end

    begin, end = rng.choice(MAIN_BOXES)
    inner = []
    for i, t in enumerate(main):
        tag = rng.choice(("h1", "h2")) if i == 0 and rng.random() < 0.7 else rng.choices(("p", "h2", "blockquote", "li", "div"), (16, 1, 1, 1, 1))[0]
        wrap = ("<ul>", "</ul>") if tag == "li" else ("", "")
        if i == 0 and tag[0] == "h" and rng.random() < 0.2:
            wrap = ("<header>", "</header>")  # the text's own head
        inner.append(f"{wrap[0]}<{tag}>{_MARK}{esc(t)}</{tag}>{wrap[1]}")
        if rng.random() < 0.15:
            inner.append(box(rng.choice(OTHER_BOXES)))
    if rng.random() < 0.25:
        inner.append(comments())
    before = [box(rng.choice(OTHER_BOXES)) for _ in range(rng.randint(0, 4))]
    after = [box(rng.choice(OTHER_BOXES)) for _ in range(rng.randint(0, 4))]
    if rng.random() < 0.4:
        after.insert(0, comments())
    wrap = rng.choice((("", ""), ('<div class="page wrapper container">', "</div>"), ('<div id="page"><div class="row">', "</div></div>")))
    blocks = leaf_blocks(f"<html><head><title>x</title></head><body>{wrap[0]}{''.join(before)}{begin}{''.join(inner)}{end}{''.join(after)}{wrap[1]}</body></html>")
    labels = [int(b.text.startswith(_MARK)) for b in blocks]
    for b in blocks:
        b.text = b.text.removeprefix(_MARK)
    return blocks, labels


def labelled(pages: list[str], seed: int = 11) -> list[tuple[list[Block], list[int]]]:
    """Training pages from a sample of raw ones."""
    rng = random.Random(seed)
    own = [(blocks, labels) for blocks in map(leaf_blocks, pages) if (labels := own_labels(blocks))]
    prose = [b.text for blocks, labels in own for b, y in zip(blocks, labels) if y and len(b.text) > 60] or [" ".join(FIXED_WORDS)]
    other = [b.text for blocks, labels in own for b, y in zip(blocks, labels) if not y] or FIXED_WORDS
    mains = [[b.text for b, y in zip(blocks, labels) if y] for blocks, labels in own] or [[" ".join(FIXED_WORDS)] * 3] * 20
    return own + [variant(main, other, prose, rng) for main in mains for _ in range(VARIANTS)]


# ---- extraction ----------------------------------------------------------------------


def extract(field: Field, page: str) -> str:
    blocks = leaf_blocks(page)
    return "\n".join(b.text for b, y in zip(blocks, field.viterbi(blocks)) if y)


def fit(pages: DataFrame, id: str = "page_id", page: str = "html") -> Field:
    """The field trained on a bounded sample of the pages."""
    rows = pages.select(F.col(id).cast("string").alias("_id"), F.col(page).cast("string").alias("_html")).where(F.length("_html").between(1, MAX_TRAIN_CHARS))
    sample = smallest_hashes(rows, PAGES, rows.count(), "_id", "_html").collect()
    return train(labelled([r["_html"] for r in sample]))


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", page: str = "html") -> DataFrame:
    """Per row: id, url, text, n_chars (code points)."""
    field = fit(pages, id, page)
    schema = T.StructType([T.StructField(id, pages.schema[id].dataType), T.StructField(url, pages.schema[url].dataType), T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        texts = [extract(field, x.as_py() or "") for x in b.column(2)]
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=schema.names)

    return map_batches(pages.select(F.col(id), F.col(url), F.col(page).cast("string").alias("_html")), one, schema)
