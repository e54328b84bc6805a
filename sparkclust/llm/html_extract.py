"""HTML main-text extraction with a tree-structured graphical model over the DOM.

Every element is a node with a hidden label, content or not.  Unary potentials
are log-linear in features of the node (tag, words of class, id and role, link
share and amount of text); parent-child potentials connect it to its parent,
with one table for children that are text-level or block text and one for
containers.  The tree is solved exactly by sum-product messages, upward level
by level and downward again, for all pages of a batch at once; an element is
content where its marginal reaches one half.  Weights follow the gradient of
the conditional likelihood, whose expectations are the same marginals.

Labelled pages: a set composed from the templates in ``labelled_pages`` (every
part of a page is labelled as main text or not), and a bounded sample of at
most ``FIT_PAGES`` pages of the table whose markup labels them itself, by one
``article`` or ``main`` element.

Text: blocks in page order, character references decoded, white space inside a
block turned into one space, joined by newlines; scripts, styles, comments and
the like are never text.  Null and empty html, and pages without content, give
the empty text.  Unclosed and misnested tags are closed as browsers do for
paragraphs, list items and table cells.  Pages never meet; repeated rows give
repeated results.
"""

from __future__ import annotations

import html as htmllib
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkclust.llm.common import drawn

FIT_PAGES = 200
FIT_CHARS = 50_000
TEMPLATE_PAGES = 160
STEPS = 300
BATCH_CHARS = 4 << 20

HEAD = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
MARK = re.compile(r"[>\"']")
NAMES = re.compile(r"\b(?:class|id|role|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
PART = re.compile(r"[a-z]+")
#: Fixed values of HTML.
RAW = {"script", "style", "textarea", "title", "noscript", "template", "svg", "iframe", "xmp", "noframes", "select", "object", "math", "canvas"}
#: Raw elements that reach to the end of the page if nothing ends them; of the others only the tag goes then.
TO_THE_END = {"script", "style", "textarea", "title", "xmp", "noframes", "iframe"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
TEXT_BLOCKS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "dt", "dd", "figcaption"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": set()}
KNOWN = ["#root", "html", "body", "head", "div", "section", "article", "main", "nav", "header", "footer", "aside", "form", "ul",
         "ol", "li", "p", "h1", "h2", "h3", "h4", "h5", "h6", "table", "tr", "td", "th", "blockquote", "pre", "a", "span",
         "b", "em", "i", "strong", "button", "figure", "figcaption", "dl", "dt", "dd", "fieldset", "dialog", "details", "hgroup", "address", "menu"]
#: Words in class, id and role that hint at the purpose of an element.
HINTS = {
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs pagination pager tabs toc sitemap",
    "header": "header masthead banner topbar logo branding",
    "footer": "footer foot bottom copyright legal colophon contentinfo",
    "side": "sidebar side aside rail widget widgets related recommended recommendations trending popular more also complementary",
    "advert": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion promoted",
    "notice": "cookie cookies consent notice notices alert alerts popup modal overlay newsletter subscribe subscription gdpr announcement dialog",
    "form": "form search login signin signup register input",
    "comment": "comment comments reply replies respond discussion disqus feedback reviews",
    "share": "share sharing social follow tags meta byline",
    "content": "content article post entry story main body text page",
}
HINT_OF = {w: k for k, ws in HINTS.items() for w in ws.split()}
FEATURES = (
    ["bias", "tag=other", "header in article", "footer in article", "article in article", "links=0", "links<.4", "links<.8", "links>=.8"]
    + [f"chars{i}" for i in range(5)]
    + [f"tag={t}" for t in KNOWN]
    + [f"hint={h}" for h in HINTS]
)
NUMBER = {f: i for i, f in enumerate(FEATURES)}


@dataclass
class Page:
    """Nodes in document order and the text blocks: (node, raw text)."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    hints: list[tuple[str, ...]] = field(default_factory=list)
    chars: list[int] = field(default_factory=list)
    linked: list[int] = field(default_factory=list)
    blocks: list[tuple[int, str]] = field(default_factory=list)
    content: list[bool] = field(default_factory=list)  # labels, where the page has a data-main attribute


class Scanner:
    """Finds where tags end, in time linear in the text however many quotes stay open.

    The place where a tag ends depends only on the first mark (``>`` or a quote)
    after its name, so every mark is followed once.
    """

    def __init__(self, text: str):
        self.text, self.ends, self.missing = text, {}, set()
        self.last = {c: text.rfind(c) for c in ">\"'"}

    def tag_end(self, at: int) -> int:
        """Place of the ``>`` that ends a tag whose name ends at ``at``; -1 if none does."""
        path = []
        while True:
            m = MARK.search(self.text, at) if at <= max(self.last.values()) else None
            if m is None:
                end = -1
                break
            mark, place = m.group(), m.start()
            if mark == ">":
                end = place
                break
            if place in self.ends:
                end = self.ends[place]
                break
            path.append(place)
            if place >= self.last[mark]:
                end = -1
                break
            at = self.text.index(mark, place + 1) + 1
        for place in path:
            self.ends[place] = end
        return end

    def raw_end(self, tag: str, at: int) -> int:
        """Where the text goes on after a raw element whose tag ends at ``at``."""
        if tag not in self.missing:
            end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(self.text, at)
            if end:
                return end.end()
            self.missing.add(tag)  # there is none further on either
        return len(self.text) if tag in TO_THE_END else at


def parse(text: str) -> Page:
    """The element tree and blocks of one page."""
    page = Page()
    stack: list[int] = []
    blocks: list[int] = []  # for every open element the block that its text belongs to
    count: dict[str, int] = {}  # open elements by tag
    buffer: list[str] = []
    holder = -1  # the block element that the buffer belongs to
    tags = page.tag
    scan = Scanner(text)

    def push(tag: str, attributes: str) -> int:
        hints: tuple[str, ...] = ()
        if "=" in attributes:
            words = [w for m in NAMES.finditer(attributes) for w in PART.findall((m.group(1) or m.group(2) or m.group(3) or "").lower())]
            hints = tuple({HINT_OF[w] for w in words if w in HINT_OF})
        page.parent.append(stack[-1] if stack else -1)
        tags.append(tag)
        page.hints.append(hints)
        page.chars.append(0)
        page.linked.append(0)
        page.content.append('data-main="1"' in attributes)
        stack.append(len(tags) - 1)
        blocks.append(blocks[-1] if tag in INLINE and blocks else stack[-1])
        count[tag] = count.get(tag, 0) + 1
        return stack[-1]

    def flush() -> None:
        if buffer:
            page.blocks.append((holder, "".join(buffer)))
            buffer.clear()

    def pop_to(depth: int) -> None:
        for node in stack[depth:]:
            count[tags[node]] -= 1
        del stack[depth:], blocks[depth:]

    def written(piece: str) -> None:
        nonlocal holder
        if blocks[-1] != holder:
            flush()
            holder = blocks[-1]
        buffer.append(piece)
        size = len(piece.strip())
        page.chars[stack[-1]] += size
        if count.get("a"):
            page.linked[stack[-1]] += size

    at, n = 0, len(text)
    push("#root", "")
    while at < n:
        if text[at] != "<":
            end = text.find("<", at)
            end = n if end < 0 else end
            written(text[at:end])
            at = end
            continue
        if text.startswith("<!--", at):
            end = text.find("-->", at + 4)
            at = n if end < 0 else end + 3
            continue
        if text.startswith(("<!", "<?"), at) and at < scan.last[">"]:
            at = text.index(">", at) + 1
            continue
        m = HEAD.match(text, at)
        end = scan.tag_end(m.end()) if m else -1
        if end < 0:  # a "<" that opens no complete tag
            written("<")
            at += 1
            continue
        at, tag, attributes = end + 1, m.group(2).lower(), text[m.end() : end]
        if m.group(1):
            if tag not in INLINE:
                flush()
            if count.get(tag):
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] == tag:
                        pop_to(depth)
                        break
            continue
        if tag in RAW:
            flush()
            if not (tag in ("svg", "math") and attributes.endswith("/")):
                at = scan.raw_end(tag, at)
            continue
        if tag in VOID:
            if tag == "br":
                buffer.append(" ")
                continue
            if tag == "hr":
                flush()
            continue
        if tag not in INLINE:
            flush()
            if count.get("p"):
                for depth in range(len(stack) - 1, 0, -1):  # a block ends an open paragraph
                    if tags[stack[depth]] == "p":
                        pop_to(depth)
                        break
                    if tags[stack[depth]] in ("div", "section", "article", "td", "li", "body", "button"):
                        break
            if any(count.get(t) for t in CLOSES.get(tag, ())):
                for depth in range(len(stack) - 1, 0, -1):
                    if tags[stack[depth]] in CLOSES[tag]:
                        pop_to(depth)
                        break
                    if tags[stack[depth]] in SCOPE[tag]:
                        break
        push(tag, attributes)
        if attributes.endswith("/") and tag in INLINE:
            pop_to(len(stack) - 1)
    flush()
    return page


class Forest:
    """All nodes of several pages: parents, levels, features."""

    def __init__(self, pages: list[Page]):
        parent, depth, node, feature, kind, self.first = [], [], [], [], [], []
        chars, linked = [], []
        for page in pages:
            base = len(parent)
            self.first.append(base)
            total, through = list(page.chars), list(page.linked)
            for i in range(len(total) - 1, 0, -1):
                total[page.parent[i]] += total[i]
                through[page.parent[i]] += through[i]
            inside = [False] * len(total)
            for i, (p, tag) in enumerate(zip(page.parent, page.tag, strict=True)):
                parent.append(base + p if p >= 0 else -1)
                depth.append(depth[base + p] + 1 if p >= 0 else 0)
                inside[i] = p >= 0 and (inside[p] or page.tag[p] in ("article", "main"))
                kind.append(int(tag in INLINE or tag in TEXT_BLOCKS))
                inner = inside[p] if p >= 0 else False
                if tag in ("header", "footer") and inside[i] or tag == "article" and inner and page.tag[p] != "main":
                    own = NUMBER[f"{tag} in article"]
                else:
                    own = NUMBER.get(f"tag={tag}", 1)
                mine = [0, own] + [NUMBER[f"hint={h}"] for h in page.hints[i]]
                t, k = total[i], through[i]
                mine.append(NUMBER["chars0"] + (t > 0) + (t > 20) + (t > 80) + (t > 400))
                if t:
                    mine.append(NUMBER["links=0"] + (0 if not k else 1 if k < 0.4 * t else 2 if k < 0.8 * t else 3))
                node += [base + i] * len(mine)
                feature += mine
            chars += total
            linked += through
        self.parent, self.depth = np.array(parent, np.int64), np.array(depth, np.int64)
        self.node, self.feature, self.kind = np.array(node, np.int64), np.array(feature, np.int64), np.array(kind, np.int64)
        order = np.argsort(self.depth, kind="stable")
        cuts = np.searchsorted(self.depth[order], np.arange(1, (self.depth.max() if depth else 0) + 2))
        self.levels = np.split(order, cuts)[:-1] if depth else []

    def marginals(self, weight: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Node marginals (n x 2), and pair marginals (n x 2 x 2: parent's label, own label) of nodes with a parent."""
        n = self.parent.size
        up = np.zeros((n, 2))
        up[:, 1] = np.bincount(self.node, weight[self.feature], n)
        message = np.zeros((n, 2))
        table = edge[self.kind]  # n x parent's label x own label
        for level in reversed(self.levels[1:]):
            message[level] = np.logaddexp.reduce(up[level][:, None, :] + table[level], axis=2)
            np.add.at(up, self.parent[level], message[level])
        belief, pair = up.copy(), np.zeros((n, 2, 2))
        for level in self.levels[1:]:
            rest = belief[self.parent[level]] - message[level]
            joint = rest[:, :, None] + table[level] + up[level][:, None, :]
            belief[level] = np.logaddexp.reduce(joint, axis=1)
            joint -= np.logaddexp.reduce(joint.reshape(-1, 4), axis=1)[:, None, None]
            pair[level] = np.exp(joint)
        belief -= np.logaddexp.reduce(belief, axis=1)[:, None]
        return np.exp(belief), pair, message


@dataclass
class Model:
    weight: np.ndarray
    edge: np.ndarray

    def extract(self, texts: list[str]) -> list[str]:
        """Main texts of the pages."""
        pages = [parse(t) for t in texts]
        forest = Forest(pages)
        p = forest.marginals(self.weight, self.edge)[0][:, 1] if pages else np.empty(0)
        out = []
        for page, first in zip(pages, forest.first, strict=True):
            kept = (" ".join(htmllib.unescape(raw).split()) for node, raw in page.blocks if p[first + max(node, 0)] >= 0.5)
            out.append("\n".join(t for t in kept if t))
        return out


def fit(pages: list[Page], steps: int = STEPS) -> Model:
    """Maximum conditional likelihood with a small quadratic penalty (Adam)."""
    forest = Forest(pages)
    label = np.array([int(x) for page in pages for x in page.content], np.int64)
    n = label.size
    child = np.flatnonzero(forest.parent >= 0)
    seen_f = np.bincount(forest.feature, label[forest.node].astype(float), len(FEATURES))
    seen_e = np.zeros((2, 2, 2))
    np.add.at(seen_e, (forest.kind[child], label[forest.parent[child]], label[child]), 1)
    theta = np.zeros(len(FEATURES) + 8)
    m1, m2 = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        weight, edge = theta[:-8], theta[-8:].reshape(2, 2, 2)
        p, pair, _ = forest.marginals(weight, edge)
        g_f = seen_f - np.bincount(forest.feature, p[forest.node, 1], len(FEATURES))
        g_e = seen_e.copy()
        for k in (0, 1):
            g_e[k] -= pair[child[forest.kind[child] == k]].sum(axis=0)
        g = -np.concatenate((g_f, g_e.ravel())) / len(pages) + 0.002 * theta
        m1 += 0.1 * (g - m1)
        m2 += 0.01 * (g * g - m2)
        theta = theta - 0.15 * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.99**step)) + 1e-8)
    assert n == forest.parent.size
    return Model(theta[:-8], theta[-8:].reshape(2, 2, 2))


def _prose(rng: random.Random, low: int, high: int) -> str:
    words = ["".join(rng.choice(["ta", "re", "lo", "min", "es", "ka", "or", "den", "ul", "vi"]) for _ in range(rng.randint(1, 4))) for _ in range(rng.randint(low, high))]
    return " ".join(words).capitalize() + "."


def _page(rng: random.Random) -> str:
    """A page from the templates; main elements carry data-main="1"."""
    one = 'data-main="1"'
    prose = lambda a=8, b=60: _prose(rng, a, b)
    link = lambda: f'<a href="/{rng.randint(1, 99)}">{prose(1, 3)}</a>'
    some = lambda f, a=2, b=7: "".join(f() for _ in range(rng.randint(a, b)))
    pick = rng.choice
    links = lambda: "<ul>" + some(lambda: f"<li>{link()}</li>") + "</ul>"
    hint = lambda k: f'{pick(["class", "id"])}="{pick(HINTS[k].split())}{pick(["", "-box", " wide"])}"'
    named = lambda tag, k: f"<{tag} {hint(k)}>" if rng.random() < 0.5 else f"<{tag}>"
    side = {
        "nav": lambda: f"{named('nav', 'menu')}{links()}</nav>",
        "menu": lambda: f"<div {hint('menu')}>{links()}</div>",
        "header": lambda: f"{named('header', 'header')}{pick(['', f'<h1>{prose(1, 4)}</h1>', f'<p>{prose(2, 8)}</p>'])}{pick(['', links()])}</header>",
        "head": lambda: f"<div {hint('header')}><span>{prose(1, 4)}</span>{pick(['', links()])}</div>",
        "footer": lambda: f"{named('footer', 'footer')}{pick(['', '<p>'])}{prose(2, 14)}{pick(['', links()])}</footer>",
        "foot": lambda: f"<div {hint('footer')}><p>{prose(2, 14)}</p>{pick(['', links()])}</div>",
        "aside": lambda: f"{named('aside', 'side')}<h3>{prose(1, 3)}</h3>{pick([links(), f'<p>{prose(4, 30)}</p>'])}</aside>",
        "side": lambda: f"<div {hint('side')}><h3>{prose(1, 3)}</h3>{pick([links(), f'<p>{prose(4, 40)}</p>'])}</div>",
        "ad": lambda: f"<{(t := pick(['div', 'section', 'p', 'aside']))} {hint('advert')}>{prose(3, 25)}{pick(['', link()])}</{t}>",
        "notice": lambda: f"<{(t := pick(['div', 'section', 'aside']))} {hint('notice')}><p>{prose(4, 30)}</p>{pick(['', f'<button>{prose(1, 2)}</button>'])}</{t}>",
        "form": lambda: f"{named('form', 'form')}<label>{prose(1, 3)}</label><input name=q>{pick(['', f'<p>{prose(3, 12)}</p>'])}<button>{prose(1, 2)}</button></form>",
        "comments": lambda: f"<{(t := pick(['div', 'section', 'ol', 'aside']))} {hint('comment')}>{pick(['', f'<h2>{prose(1, 3)}</h2>'])}"
        + some(lambda: f"<{(u := pick(['div', 'article', 'li']))} {pick([hint('comment'), ''])}><p>{prose(4, 40)}</p></{u}>", 1, 4) + f"</{t}>",
        "share": lambda: f"<div {hint('share')}>{some(link, 1, 4)}</div>",
    }
    part = lambda: side[pick(list(side))]()
    before, after = some(part, 1, 4), some(part, 1, 4)
    inside = lambda: pick([
        lambda: f"<p {one}>{prose()}</p>", lambda: f"<p {one}>{prose()}<b {one}>{prose(1, 4)}</b> {prose(2, 9)}</p>",
        lambda: f"<p {one}>{prose()} <a {one} href='/x'>{prose(1, 3)}</a> {prose(3, 20)}</p>", lambda: f"<p {one}>{prose(1, 4)}</p>",
        lambda: f"<h{(k := rng.randint(2, 4))} {one}>{prose(1, 6)}</h{k}>", lambda: f"<blockquote {one}><p {one}>{prose(5, 30)}</p></blockquote>",
        lambda: f"<ul {one}>" + some(lambda: f"<li {one}>{prose(2, 20)}</li>", 2, 5) + "</ul>",
        lambda: f"<table {one}>" + some(lambda: f"<tr {one}><td {one}>{prose(1, 4)}</td><td {one}>{prose(1, 6)}</td></tr>", 1, 3) + "</table>",
        lambda: f"<div {one}><p {one}>{prose()}</p></div>", lambda: f"<section {one}><h2 {one}>{prose(1, 5)}</h2><p {one}>{prose()}</p></section>",
        lambda: f"<figure {one}><img src=x><figcaption {one}>{prose(2, 12)}</figcaption></figure>", lambda: f"<p {one}><b {one}>{prose(3, 30)}<br>",
    ])()
    odd = lambda: side[pick(["ad", "share", "aside", "comments", "notice", "nav", "form", "side"])]() if rng.random() < 0.35 else ""
    title = pick([f"<h1 {one}>{prose(2, 9)}</h1>", f"<h1 {one}>{prose(2, 9)}</h1>", f"<header {one}><h1 {one}>{prose(2, 9)}</h1></header>"])
    if rng.random() < 0.25:
        title = ""
    body = title + (some(lambda: inside() + odd(), 1, 9) if rng.random() < 0.8 else f"<p {one}>{prose(1, 6)}</p>")
    tail = pick(["", "", f"<footer>{prose(2, 9)}</footer>"])
    shell = pick(["article", "article", "main", "mainart", "content"])
    if shell in ("article", "main"):
        main = f"<{shell} {one}>{body}{tail}</{shell}>"
    elif shell == "mainart":
        main = f"<main {one}><article {one}>{body}</article>{odd()}</main>"
    else:
        main = f'<div {pick(["class", "id"])}="{pick(HINTS["content"].split())}" {one}>{body.replace("<header", "<div").replace("</header", "</div")}</div>'
    if rng.random() < 0.3:
        main = f'<div class="{pick(["wrap", "container", "row", "layout"])}" {one}>{main}</div>'
    if rng.random() < 0.15:  # a fragment
        return pick([main, before + main + after])
    return f"<html {one}><head><title>{prose(2, 5)}</title></head><body {one}>{before}{main}{after}</body></html>"


def labelled_pages(n: int = TEMPLATE_PAGES, seed: int = 11) -> list[Page]:
    rng = random.Random(seed)
    out = [parse(_page(rng)) for _ in range(n)]
    for page in out:
        page.content[0] = True
    return out


def self_labelled(texts: list[str]) -> list[Page]:
    """Pages with one article or main element: that subtree is content, and so are its ancestors.

    Inside it, navigation, asides, forms and hinted boilerplate are not.
    """
    out = []
    for text in texts:
        page = parse(text)
        roots = [i for i, t in enumerate(page.tag) if t in ("article", "main")]
        roots = [i for i in roots if page.parent[i] not in roots]
        if len(roots) != 1:
            continue
        content = [False] * len(page.tag)
        for i, (p, t) in enumerate(zip(page.parent, page.tag, strict=True)):
            bad = t in ("nav", "aside", "form", "footer", "button") or bool(set(page.hints[i]) - {"content", "header"})
            content[i] = i == roots[0] or (p >= roots[0] and content[p] and not bad)
        up = page.parent[roots[0]]
        while up >= 0:
            content[up] = True
            up = page.parent[up]
        page.content = content
        out.append(page)
    return out


def learn(pages: DataFrame, fit_pages: int = FIT_PAGES) -> Model:
    """Fit on the templates and on at most about ``fit_pages`` pages, chosen by a hash of their html."""
    rows = pages.select(F.col("html").cast("string").alias("h")).where(F.length("h").between(1, FIT_CHARS))
    n = rows.count()
    share = min(1.0, fit_pages / max(n, 1))
    rows = rows.where(drawn(F.xxhash64("h"), share)).distinct()
    return fit(labelled_pages() + self_labelled(sorted(r.h for r in rows.collect())))


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars for every row."""
    shared = pages.sparkSession.sparkContext.broadcast(model)  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("html").to_pylist()]
            first = 0
            while first < len(texts):
                end, size = first, 0
                while end < len(texts) and (end == first or size + len(texts[end]) <= BATCH_CHARS):
                    size += len(texts[end])
                    end += 1
                out = shared.value.extract(texts[first:end])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("page_id").slice(first, end - first),
                        batch.column("url").slice(first, end - first),
                        pa.array(out, pa.string()),
                        pa.array([len(t) for t in out], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars"],
                )
                first = end

    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")
    )
    return rows.mapInArrow(run, "page_id long, url string, text string, n_chars long")
