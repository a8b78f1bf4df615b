"""HTML extraction: gradient-boosted trees over DOM nodes, decoded along the tree.

A page becomes its block elements in document order. Each has features: its depth,
tag, tokens of class, id and role (its own and its ancestors'), text, link and
punctuation density of its subtree, its share of the page, and how it compares to its
siblings and parent. Boosted trees tell how likely a node is part of the main text
or holds some. Decoding then picks the best set of nodes in which every chosen
node's parent is chosen too, so no descendant of a rejected node is kept and no node
is kept without its ancestors.

Training: no page is labelled, so labels come from pages that say themselves which
element is the article; what lies outside is not. At most `max_pages` such pages, those
whose hashed id is smallest, are used as they are and in disguises, where articles,
menus and footers are plain `div`s under usual class names, and sidebars,
notices, forms and comments, made of other pages' words, are put around and into the
article. So trees cannot lean on one template. This bounded sample is one task's
work; everything else covers all pages.

The text of a page is that of its chosen nodes, a line per block in page order.

Cases: null and empty html, and pages without text, give empty text. Broken markup is
read as far as it goes: end tags that are missing are implied, those that match
nothing are skipped. Rows that repeat each get a row, null ids and urls too.
Without a page to train on, nodes that hold a sentence outside links are chosen. Other
columns are not looked at.
"""

from __future__ import annotations

import html
import pickle
import random
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vidlake.llm.common import slices, text_of

MAX_PAGES = 300
DISGUISES = 3
TREES, DEPTH, BINS, RATE, LEAST_ROWS = 40, 4, 32, 0.3, 10
TOKEN_BUCKETS = 64

# Fixed values of HTML: block elements, those without content, those whose content is
# not text for reading, and which open ones a start tag ends.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer "
    "h1 h2 h3 h4 h5 h6 header html li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
_EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_UNREAD = frozenset(
    "script style noscript template title textarea select button label legend datalist svg iframe object form head".split()
)
_IN_HEAD = frozenset("head title meta link script style base noscript template".split())
_RAW = frozenset("script style textarea title".split())
_CLOSED_BY = {
    **{t: ("p",) for t in _BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}},
    "li": ("li", "p"),
    "dt": ("dt", "dd", "p"),
    "dd": ("dt", "dd", "p"),
    "tr": ("tr", "td", "th", "p"),
    "td": ("td", "th", "p"),
    "th": ("td", "th", "p"),
}
# An implied end does not reach beyond these.
_SCOPE = frozenset("table ul ol dl div section article main body html".split())
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>", re.DOTALL
)
# A form that holds any of these, or several paragraphs, is put around the page.
_PAGE_PART = re.compile(r"<(?:article|main|nav|header|footer|h1)[\s/>]|(?:<p[\s>].*?){3}", re.IGNORECASE | re.DOTALL)
_FORM_END = re.compile(r"</form[\s/>]", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))", re.IGNORECASE)
_WORD = re.compile(r"[a-z]+")
_KINDS = [
    {"p"}, {"h1", "h2", "h3", "h4", "h5", "h6"}, {"li", "dt", "dd"}, {"div", "center"}, {"section"}, {"article", "main"},
    {"nav"}, {"header"}, {"footer"}, {"aside"}, {"table", "tbody", "thead", "tfoot", "tr", "td", "th", "caption"},
    {"ul", "ol", "dl"}, {"blockquote", "pre", "figure", "figcaption"},
]
_KIND = {tag: at for at, tags in enumerate(_KINDS) for tag in tags}


@dataclass
class Page:
    """Block elements in document order, and runs of text that belong to them."""

    tags: list[str] = field(default_factory=list)
    parents: list[int] = field(default_factory=list)
    ends: list[int] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    elements: list[int] = field(default_factory=list)
    runs: list[tuple[int, str, int]] = field(default_factory=list)  # node, text, characters in links


def _end(start_tag: str) -> re.Pattern:
    return re.compile(rf"</{start_tag}[\s/>]", re.IGNORECASE)


_ENDS = {tag: _end(tag) for tag in _RAW}


def parse(source: str) -> Page:
    """The page's block elements and runs of text. Forms, scripts and other elements
    that are not for reading are left out with all they hold; of a form around the page or
    the article, only its fields, labels and buttons are. A head without an end ends at
    the first element or text that cannot be in it."""
    page = Page()
    open_: list[tuple[str, int]] = []  # tag, and its node or that of the block around it
    opened: Counter[str] = Counter()
    held: list[str] = []
    linked = links = unread = 0

    def add(tag: str, tokens: tuple[str, ...], parent: int) -> int:
        page.tags.append(tag)
        page.parents.append(parent)
        page.ends.append(-1)
        page.tokens.append(tokens)
        page.elements.append(0)
        return len(page.tags) - 1

    root = add("html", (), -1)

    def node() -> int:
        return open_[-1][1] if open_ else root

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                page.runs.append((node(), text, linked))
            held.clear()
        linked = 0

    def close(to: int) -> None:
        nonlocal links, unread
        while len(open_) > to:
            tag, at = open_[-1]
            if tag in _BLOCKS:
                flush()
                page.ends[at] = len(page.tags)
            links -= tag == "a"
            unread -= tag in _UNREAD
            opened[tag] -= 1
            open_.pop()

    def take(text: str) -> None:
        nonlocal linked
        if unread and open_[-1][0] == "head" and text.strip():
            close(0)
        if text and not unread:
            if "&" in text:
                text = html.unescape(text)
            held.append(text)
            if links:
                linked += len(text.strip())

    at = 0
    size = len(source)
    while at < size:
        start = source.find("<", at)
        if start < 0:
            take(source[at:])
            break
        if start > at:
            take(source[at:start])
        found = _MARKUP.match(source, start)
        if not found:
            take("<")
            at = start + 1
            continue
        at = found.end()
        closing, tag = found[1], found[2]
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            for place in range(len(open_) - 1, -1, -1) if opened[tag] else ():
                if open_[place][0] == tag:
                    close(place)
                    break
                if open_[place][0] in ("table", "body") and tag not in ("body", "html"):
                    break
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in _EMPTY or tag == "html":
            continue
        if tag in _RAW:
            end = _ENDS[tag].search(source, at)
            at = end.start() if end else size
        for ended in _CLOSED_BY.get(tag, ()):
            for place in range(len(open_) - 1, -1, -1) if opened[ended] else ():
                if open_[place][0] == ended:
                    close(place)
                    break
                if open_[place][0] in _SCOPE:
                    break
        if open_ and open_[0][0] == "head" and (tag == "body" or open_[-1][0] == "head" and tag not in _IN_HEAD):
            close(0)
        if tag == "form" and not unread:
            end = _FORM_END.search(source, at)
            if _PAGE_PART.search(source, at, end.start() if end else size):
                # What it holds is read; its end tag will match nothing.
                continue
        around = node()
        if tag in _BLOCKS and not unread:
            flush()
            tokens = tuple(
                word
                for _, *values in _ATTRIBUTE.findall(found[3])
                for word in _WORD.findall("".join(values).lower())
            ) if found[3] else ()
            around = add(tag, tokens, around)
        else:
            page.elements[around] += 1
        if not (found[3] or "").rstrip().endswith("/") or tag in _BLOCKS:
            open_.append((tag, around))
            opened[tag] += 1
            links += tag == "a"
            unread += tag in _UNREAD
    close(0)
    flush()
    page.ends = [len(page.tags) if e < 0 else e for e in page.ends]
    return page


def features(page: Page) -> np.ndarray:
    """A row per node of the page."""
    n = len(page.tags)
    parent = np.maximum(np.array(page.parents), 0)
    end = np.array(page.ends)
    own = np.zeros((n, 7))  # characters, in links, stops, capitals, digits, runs, inline elements
    begin = np.zeros(n)
    total = 0
    seen = 0
    for at, text, linked in page.runs:
        stops = text.count(".") + text.count(",") + text.count("!") + text.count("?")
        own[at, :6] += len(text), min(linked, len(text)), stops, text[:1].isupper(), any(map(str.isdigit, text[:40])), 1
        # Nodes that start before this text have at most what came before it.
        begin[seen : at + 1] = total
        seen = max(seen, at + 1)
        total += len(text)
    begin[seen:] = total
    own[:, 6] = page.elements
    sums = np.vstack([np.zeros(8), np.cumsum(np.hstack([own, np.ones((n, 1))]), axis=0)])
    tree = sums[end] - sums[:-1]
    chars = tree[:, 0]
    link_share = tree[:, 1] / np.maximum(chars, 1)
    depth = np.zeros(n)
    tagged = np.zeros((n, len(_KINDS)))
    hashed = np.zeros((n, TOKEN_BUCKETS))
    for at, (tag, tokens) in enumerate(zip(page.tags, page.tokens)):
        if at:
            depth[at] = depth[parent[at]] + 1
        if tag in _KIND:
            tagged[at, _KIND[tag]] = 1
        for token in tokens:
            hashed[at, zlib.crc32(token.encode()) % TOKEN_BUCKETS] = 1
    above, above_hashed = tagged.copy(), hashed.copy()
    for at in range(1, n):  # parents come first
        above[at] += above[parent[at]]
        if page.tokens[at] or above_hashed[parent[at]].any():
            above_hashed[at] = np.maximum(above_hashed[at], above_hashed[parent[at]])
    count = np.bincount(parent[1:], minlength=n).astype(float)
    mean = lambda values: np.bincount(parent[1:], values[1:], n) / np.maximum(count, 1)
    size = np.log1p(chars)
    order = np.zeros(n)
    nth: dict[int, int] = {}
    for at in range(1, n):
        order[at] = nth[parent[at]] = nth.get(parent[at], -1) + 1
    columns = [
        depth, count[parent], order / np.maximum(count[parent], 1), size, np.log1p(own[:, 0]), link_share,
        np.log1p(chars / (tree[:, 6] + tree[:, 7])), chars / max(1, total), begin / max(1, total),
        tree[:, 2] / np.maximum(chars, 1), tree[:, 3] / np.maximum(tree[:, 5], 1), tree[:, 4] / np.maximum(tree[:, 5], 1),
        np.log1p(tree[:, 7]), size[parent], link_share[parent], (chars / max(1, total))[parent],
        mean(size)[parent], mean(link_share)[parent], mean(tree[:, 2] / np.maximum(chars, 1))[parent],
        chars / np.maximum(chars[parent], 1),
    ]
    return np.hstack([np.column_stack(columns), tagged, above, hashed, above_hashed]).astype(np.float32)


@dataclass
class Trees:
    """Boosted trees of fixed depth; node k has children 2k+1 and 2k+2."""

    edges: list[np.ndarray]
    feature: np.ndarray
    bin: np.ndarray
    leaf: np.ndarray
    prior: float

    def binned(self, rows: np.ndarray) -> np.ndarray:
        out = np.zeros(rows.shape, np.uint8)
        for at, edges in enumerate(self.edges):
            if len(edges):
                out[:, at] = np.searchsorted(edges, rows[:, at], "left")
        return out

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Log odds of each row."""
        bins = self.binned(rows)
        every = np.arange(len(rows))
        out = np.full(len(rows), self.prior)
        for feature, limit, leaf in zip(self.feature, self.bin, self.leaf):
            at = np.zeros(len(rows), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (bins[every, feature[at]] > limit[at])
            out += leaf[at - (2**DEPTH - 1)]
        return out


def boost(rows: np.ndarray, labels: np.ndarray) -> Trees:
    """Gradient boosting of the logistic loss over histograms."""
    edges = []
    for column in rows.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1]).astype(np.float32))
            edges.append(values)
        else:
            edges.append(((values[1:] + values[:-1]) / 2).astype(np.float32))
    rate = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    trees = Trees(edges, *(np.zeros((TREES, 2**DEPTH - 1), np.int64) for _ in range(2)), np.zeros((TREES, 2**DEPTH)), 0.0)
    trees.prior = float(np.log(rate / (1 - rate)))
    bins = trees.binned(rows)
    useful = np.array([at for at, e in enumerate(edges) if len(e)])
    flat = (bins[:, useful].astype(np.int64) + np.arange(len(useful)) * BINS).T
    odds = np.full(len(rows), trees.prior)
    for tree in range(TREES):
        chance = 1 / (1 + np.exp(-odds))
        g, h = labels - chance, chance * (1 - chance)
        at = np.zeros(len(rows), np.int64)
        for level in range(DEPTH):
            for k in range(2**level - 1, 2 ** (level + 1) - 1):
                inside = np.flatnonzero(at == k)
                trees.bin[tree, k] = 255
                if len(inside) >= 2 * LEAST_ROWS:
                    cells = flat[:, inside].ravel()
                    shape = len(useful), BINS
                    sums = [
                        np.bincount(cells, None if w is None else np.tile(w[inside], len(useful)), shape[0] * BINS)
                        .reshape(shape).cumsum(axis=1)
                        for w in (g, h, None)
                    ]
                    (gl, hl, nl), (gt, ht, nt) = sums, (s[:, -1:] for s in sums)
                    gain = gl**2 / (hl + 1) + (gt - gl) ** 2 / (ht - hl + 1) - gt**2 / (ht + 1)
                    gain[(nl < LEAST_ROWS) | (nt - nl < LEAST_ROWS)] = 0
                    best = int(gain.argmax())
                    if gain.flat[best] > 1e-6:
                        trees.feature[tree, k], trees.bin[tree, k] = useful[best // BINS], best % BINS
                at[inside] = 2 * k + 1 + (bins[inside, trees.feature[tree, k]] > trees.bin[tree, k])
        at -= 2**DEPTH - 1
        trees.leaf[tree] = RATE * np.bincount(at, g, 2**DEPTH) / (np.bincount(at, h, 2**DEPTH) + 1)
        odds += trees.leaf[tree][at]
    return trees


def chosen(page: Page, odds: np.ndarray) -> np.ndarray:
    """The set of nodes with the greatest sum of log odds in which every node's
    parent is."""
    # Siblings of one tag without blocks of their own are judged half by what they
    # have in common: a single short paragraph tells little.
    groups: dict[tuple[int, str], list[int]] = {}
    for at in range(1, len(odds)):
        if page.ends[at] == at + 1:
            groups.setdefault((page.parents[at], page.tags[at]), []).append(at)
    gain = odds.astype(float)
    for alike in groups.values():
        gain[alike] = (gain[alike] + gain[alike].mean()) / 2
    gain[0] = max(gain[0], 0)
    for at in range(len(gain) - 1, 0, -1):
        if gain[at] > 0:
            gain[page.parents[at]] += gain[at]
    keep = gain > 0
    for at in range(1, len(gain)):
        keep[at] &= keep[page.parents[at]]
    return keep


def text_of_nodes(page: Page, keep: np.ndarray) -> str:
    return "\n".join(text for at, text, _ in page.runs if keep[at])


# Usual class names, for disguises.
_NAMES = {
    "article": "content post entry story article-body main-text post-content".split(),
    "nav": "menu navbar navigation topnav breadcrumbs".split(),
    "footer": "footer bottom site-footer copyright".split(),
    "header": "header masthead site-header banner".split(),
    "aside": "sidebar related widget recommended".split(),
    "ad": "ad advert sponsored promo adsbox".split(),
    "notice": "cookie-notice consent newsletter notice alert".split(),
    "comments": "comments discussion responses comment-list".split(),
}


def disguised(source: str, words: list[str], dice: random.Random) -> str:
    """The page with its semantic tags renamed and other parts put in."""

    def some(low: int, high: int) -> str:
        return html.escape(" ".join(dice.choices(words, k=dice.randint(low, high))))

    def part(kind: str, inner: str, tag: str) -> str:
        name = dice.choice(_NAMES[kind])
        opening = dice.choice([f'div class="{name}"', f'div id="{name}"', f'section class="{name}"'])
        if dice.random() < 0.4 and tag != "div":
            return f"<{tag}>{inner}</{tag}>"
        return f"<{opening}>{inner}</{opening.split()[0]}>"

    def list_() -> str:
        return "<ul>" + "".join(f'<li><a href="/x">{some(1, 5)}</a></li>' for _ in range(dice.randint(3, 9))) + "</ul>"

    def paragraphs(low: int, high: int) -> str:
        return "".join(f"<p>{some(5, 60)}.</p>" for _ in range(dice.randint(low, high)))

    out = source
    if dice.random() < 0.8:
        for kind in ("article", "nav", "footer"):
            name = dice.choice(_NAMES[kind])
            opening = "div data-main" if kind == "article" else "div"
            out = re.sub(rf"<{kind}\b[^>]*>", f'<{opening} class="{name}">', out, flags=re.IGNORECASE)
            out = re.sub(rf"</{kind}>", "</div>", out, flags=re.IGNORECASE)
    else:
        out = re.sub(r"<article\b", "<article data-main", out, flags=re.IGNORECASE)
    out = out.replace('class="ad"', f'class="{dice.choice(_NAMES["ad"])}"')
    before = [
        part("header", f"<h2>{some(2, 6)}</h2>{list_()}", "header") if dice.random() < 0.5 else "",
        part("notice", f"<p>{some(6, 30)}</p>", "aside") if dice.random() < 0.5 else "",
        part("aside", f"<h3>{some(1, 4)}</h3>{list_()}{paragraphs(0, 2)}", "aside") if dice.random() < 0.4 else "",
    ]
    after = [
        part("aside", f"<h3>{some(1, 4)}</h3>{list_()}", "aside") if dice.random() < 0.4 else "",
        part("comments", "".join(f'<div class="comment"><p>{some(4, 50)}</p></div>' for _ in range(dice.randint(1, 8))), "section")
        if dice.random() < 0.6 else "",
    ]
    inside = part("ad", f"<p>{some(4, 20)}</p>", "aside") if dice.random() < 0.3 else ""
    at = re.search(r"<(?:article|div) data-main[^>]*>", out)
    if at:
        out = _furnished(out, at.end(), some, dice)
    if at:
        stop = out.find('<div class="', at.end())
        tail = out.rfind("</article>") if "</article>" in out else stop
        middle = out.find("</p>", at.end())
        if inside and 0 <= middle < (tail if tail > 0 else len(out)):
            out = out[: middle + 4] + inside.replace("<", "<", 1) + out[middle + 4 :]
        # Comments may stand in the article, as its last part.
        wrap = dice.random() < 0.5
        front = "".join(before)
        out = out[: at.start()] + (f'<div class="wrap">{front}' if wrap else front) + out[at.start() :]
        foot = max(out.rfind("<footer"), *(out.rfind(f'class="{n}">') for n in _NAMES["footer"]))
        place = out.rfind("<", 0, foot + 1) if foot > 0 else out.rfind("</body>")
        if place > 0:
            out = out[:place] + "".join(after) + ("</div>" if wrap else "") + out[place:]
    return out


def _furnished(source: str, start: int, some: Callable[[int, int], str], dice: random.Random) -> str:
    """The page with a header in the article that begins at ``start``, and some of what
    articles hold besides paragraphs."""
    stop = source.find("</article>", start)
    if stop < 0:
        # A renamed article ends where the next renamed part begins, about.
        stop = source.find('<div class="', start)
    body = source[start:stop] if stop > 0 else source[start:]
    rest = source[stop:] if stop > 0 else ""
    extras = (
        lambda: f"<pre>{some(8, 60)}\n  {some(5, 40)}</pre>",
        lambda: f"<blockquote><p>{some(8, 50)}.</p></blockquote>",
        lambda: "<ul>" + "".join(f"<li>{some(4, 25)}</li>" for _ in range(dice.randint(2, 6))) + "</ul>",
        lambda: f"<h2>{some(2, 8)}</h2>",
        lambda: "<table>" + "".join(f"<tr><td>{some(1, 4)}</td><td>{some(1, 6)}</td></tr>" for _ in range(4)) + "</table>",
    )
    places = [found.end() for found in re.finditer("</p>", body)]
    for place in sorted(dice.sample(places, min(len(places), dice.randint(0, 2))), reverse=True):
        body = body[:place] + dice.choice(extras)() + body[place:]
    heading = re.match(r"\s*<(h[1-3])\b.*?</\1>", body, re.DOTALL | re.IGNORECASE)
    if heading and dice.random() < 0.5:
        line = f'<p class="{dice.choice(["byline", "meta", "date", "author"])}">{some(2, 8)}</p>' if dice.random() < 0.6 else ""
        body = f"<header>{heading[0]}{line}</header>{body[heading.end():]}"
    return source[:start] + body + rest


_OUTSIDE = frozenset(w for k, names in _NAMES.items() if k != "article" for n in names for w in n.split("-"))


def _labelled(source: str) -> tuple[Page, np.ndarray] | None:
    """A page and which nodes are, or hold, main text, if it says so itself."""
    marked = re.sub(r"<(article|div) data-main\b", r'<\1 id="zzmain"', source)
    page = parse(marked)
    main = [i for i, t in enumerate(page.tokens) if "zzmain" in t]
    if not main:
        main = [i for i, t in enumerate(page.tags) if t in ("article", "main")][:1]
    if len(main) != 1:
        return None
    inside = np.zeros(len(page.tags))
    inside[main[0] : page.ends[main[0]]] = 1
    for at in range(main[0] + 1, page.ends[main[0]]):
        if page.tags[at] in ("nav", "aside", "footer", "form") or _OUTSIDE & set(page.tokens[at]):
            inside[at : page.ends[at]] = 0
    at = main[0]
    while at >= 0:
        inside[at] = 1
        at = page.parents[at]
    page.tokens = [tuple(w for w in t if w != "zzmain") for t in page.tokens]
    return page, inside


def train(pages: DataFrame, *, max_pages: int = MAX_PAGES, seed: int = 6) -> Trees | None:
    """Trees from a bounded sample of pages that mark their article."""
    marked = pages.select("page_id", "html").filter(F.col("html").rlike("(?i)<(article|main)[ >]"))
    sample = marked.orderBy(F.xxhash64("page_id"), "page_id").limit(max_pages)

    def fit(table: pa.Table) -> pa.Table:
        table = table.sort_by([("page_id", "ascending"), ("html", "ascending")])
        dice = random.Random(seed)
        sources = table["html"].to_pylist()
        words = [w for s in sources for _, text, _ in parse(s).runs[:40] for w in text.split()[:80]]
        rows, labels = [], []
        for source in sources:
            for version in [source, *(disguised(source, words, dice) for _ in range(DISGUISES))] if words else []:
                found = _labelled(version)
                if found:
                    rows.append(features(found[0]))
                    labels.append(found[1])
        model = pickle.dumps(boost(np.vstack(rows), np.concatenate(labels))) if rows else b""
        return pa.table({"model": pa.array([model], pa.binary())})

    made = sample.groupBy().applyInArrow(fit, "model binary").collect()
    return pickle.loads(made[0]["model"]) if made and made[0]["model"] else None


def extract(pages: DataFrame, trees: Trees | None) -> DataFrame:
    """page_id, url, text, n_chars of every row."""
    shared = pages.sparkSession.sparkContext.broadcast(trees)

    def texts(sources: list[str]) -> list[str]:
        parsed = [parse(s) for s in sources]
        rows = [features(p) for p in parsed]
        if shared.value is None:
            odds = [np.where((r[:, 3] > 4) & (r[:, 5] < 0.5), 1.0, -1.0) for r in rows]
        else:
            odds = np.split(shared.value.score(np.vstack(rows)), np.cumsum([len(r) for r in rows])[:-1])
        return [text_of_nodes(p, chosen(p, o)) for p, o in zip(parsed, odds)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            found = []
            sources = [text_of(s) for s in batch.column("html").to_pylist()]
            for start in range(0, len(sources), 200):
                found += texts(sources[start : start + 200])
            yield pa.RecordBatch.from_pydict(
                {
                    "page_id": batch.column("page_id"),
                    "url": batch.column("url"),
                    "text": pa.array(found, pa.string()),
                    "n_chars": pa.array([len(t) for t in found], pa.int64()),
                }
            )

    return pages.select("page_id", "url", "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def main_text(pages: DataFrame) -> DataFrame:
    """Trees from the pages, and the main text of each of them."""
    return extract(pages, train(pages))
