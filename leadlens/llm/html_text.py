"""Main text of web pages: boosted trees over DOM nodes, decoded so that no node is kept inside a rejected one.

A page becomes a tree of block elements. Each has features: subtree size, text density, link share, depth, places among
its siblings, and the learned weights of its tag and of the words of its class, id and role. The trees give each node
log-odds of being part of the article; decoding picks the set of nodes with the largest total in which every kept
node's ancestors are kept as well. The text of kept nodes, block by block, is the result.

The model is fitted on the driver on a bounded sample (``TRAIN_PAGES`` distinct pages drawn by hash). Their own markup labels them
weakly (article against navigation, footers and the like), and layouts made from their texts add what the sample may lack: pages without
an article element, sidebars, notices, forms, comments.

Null and empty pages have empty text; unclosed, crossed and truncated tags are repaired as browsers do, roughly; pages of any
length and nesting are read whole, in linear time; equal rows give equal text; input columns stay in ``row``.
"""

from __future__ import annotations

import html
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import boost
from .common import packed

TRAIN_PAGES = 150

# Element names of HTML by how they are laid out.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Their contents are no markup. Scripts, styles and titles are no page text; the others' contents are text as it stands.
RAW = frozenset("script style title textarea xmp".split())
NO_TEXT = frozenset("script style title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img "
    "math mi mo mn ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded mphantom msub msup msubsup munder mover munderover mmultiscripts mprescripts mtable mtr mtd maction "
    "semantics annotation annotation-xml "
    "svg g defs symbol use path rect circle ellipse line polyline polygon text tspan textpath lineargradient radialgradient stop clippath mask marker pattern filter desc foreignobject".split()
)
#: An open element of the key is closed by a start of one of these, up to the nearest of the stops.
CLOSED_BY = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"}, "option": {"option"}}
STOPS = {"ul", "ol", "dl", "table", "body", "article", "div", "section", "object", "template", "select", "noscript", "iframe", "noembed", "noframes", *RAW}

BOILERPLATE_TAGS = frozenset("nav header footer aside form button menu dialog figure".split())
BOILERPLATE_WORDS = frozenset(
    "ad ads advert advertisement banner breadcrumb breadcrumbs comment comments consent cookie cookies disqus footer gdpr header login masthead menu modal nav navbar navigation "
    "newsletter notice pagination popup promo recommended related reply replies respond search share sharing sidebar signup skip social sponsor sponsored subscribe tags toolbar widget".split()
)
ARTICLE_TAGS = frozenset(("article", "main"))

# Quoted values are read to their closing quote. A quote swaps "outside" with "inside" of its kind, so at any place at most three of the
# tags tried before it are still being read, each in another state: stray quotes cost no more looks than that.
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/><]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+|[^<>]*+)>|[^<]+|<",
    re.S,
)
_ATTR = re.compile(r"(class|id|role|itemprop|data-part)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORDS = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SPACE = re.compile(r"\s+")

#: Marks a part of a made-up layout as article (1) or not (0); never a feature.
MARK = "data-part"


@dataclass
class Page:
    tags: list[str]
    words: list[list[str]]  # of class, id, role
    parents: list[int]
    marks: list[str | None]
    blocks: list[tuple[int, str, int]]  # node, text, characters of it inside links


def parse(source: str) -> Page:
    """The block elements and text blocks of a page, in page order; node 0 is the page."""
    page = Page(["#page"], [[]], [-1], [None], [])
    stack = [0]
    run: list[str] = []
    linked, links = 0, 0
    unclosed: set[str] = set()  # raw elements without an end tag from here on

    def flush() -> None:
        nonlocal linked
        text = _SPACE.sub(" ", html.unescape("".join(run))).strip()
        if text:
            page.blocks.append((stack[-1], text, linked))
        run.clear()
        linked = 0

    def close(k: int) -> None:
        flush()
        del stack[k:]

    at, size = 0, len(source)
    while at < size:
        m = _TOKEN.match(source, at)
        at = m.end()
        if m[2] is None:
            if m[0][0] != "<" or m[0] == "<":
                run.append(m[0])
                if links:
                    linked += len(m[0].strip())
            continue
        tag = m[2].lower()
        if m[1]:
            if tag == "a":
                links = 0
            elif tag not in INLINE:
                for k in range(len(stack) - 1, 0, -1):
                    if page.tags[stack[k]] == tag:
                        close(k)
                        links = 0
                        break
            continue
        stop = None
        if tag in RAW and tag not in unclosed:
            stop = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(source, at)
            if stop is None:  # read on as in any element
                unclosed.add(tag)
        if stop and tag in NO_TEXT:
            at = stop.end()
            if tag not in ("script", "style"):
                run.append(" ")
            continue
        if tag in INLINE or tag in VOID:
            if tag in ("br", "hr", "img"):
                run.append(" ")
            if tag == "a":
                links = 1
            if tag == "hr":
                flush()
            continue
        flush()
        links = 0
        for k in range(len(stack) - 1, 0, -1):
            open_tag = page.tags[stack[k]]
            if open_tag == "p" or tag in CLOSED_BY.get(open_tag, ()):
                close(k)
                if open_tag != "p":
                    break
            elif open_tag in STOPS:
                break
        words, mark = [], None
        if m[3]:
            for a in _ATTR.finditer(m[3]):
                value = a[2] or a[3] or a[4] or ""
                if a[1].lower() == MARK:
                    mark = value
                else:
                    words += [w.lower() for w in _WORDS.findall(value)]
        page.tags.append(tag)
        page.words.append(words)
        page.parents.append(stack[-1])
        page.marks.append(mark)
        stack.append(len(page.tags) - 1)
        if stop:
            content = source[at : stop.start()]
            run.append(html.escape(content) if tag == "xmp" else content)
            at = stop.start()
    flush()
    return page


N_FEATURES = 19


def features(page: Page, weights: dict[str, float]) -> np.ndarray:
    """A row for each node of the page."""
    n = len(page.tags)
    own, chars, linked, blocks, commas, nodes, first = [0] * n, [0] * n, [0] * n, [0] * n, [0] * n, [1] * n, [-1] * n
    seen = 0
    for node, text, link in page.blocks:
        own[node] += len(text)
        chars[node] += len(text)
        linked[node] += min(link, len(text))
        blocks[node] += 1
        commas[node] += text.count(",") + text.count(". ") + text.endswith(".")
        if first[node] < 0:
            first[node] = seen
        seen += len(text)
    kids, same, place, depth = [0] * n, [0] * n, [0] * n, [0] * n
    by_tag: dict[tuple[int, str], int] = {}
    for k in range(1, n):
        p = page.parents[k]
        depth[k] = depth[p] + 1
        place[k] = kids[p]
        kids[p] += 1
        key = (p, page.tags[k])
        by_tag[key] = by_tag.get(key, 0) + 1
    for k in range(n - 1, 0, -1):
        p = page.parents[k]
        chars[p] += chars[k]
        linked[p] += linked[k]
        blocks[p] += blocks[k]
        commas[p] += commas[k]
        nodes[p] += nodes[k]
        if first[k] >= 0 and (first[p] < 0 or first[k] < first[p]):
            first[p] = first[k]
    total = max(chars[0], 1)
    out = np.zeros((n, N_FEATURES))
    for k in range(n):
        p = max(page.parents[k], 0)
        same[k] = by_tag.get((page.parents[k], page.tags[k]), 1)
        tag = weights.get("<" + page.tags[k], 0.0)
        said = [weights.get(w, 0.0) for w in page.words[k]]
        up = [weights.get(w, 0.0) for w in page.words[p]]
        out[k] = (
            chars[k], own[k], chars[k] / nodes[k], chars[k] / max(blocks[k], 1), linked[k] / max(chars[k], 1), commas[k] / max(chars[k], 1), chars[k] / total,
            max(first[k], 0) / total, depth[k], nodes[k], kids[k], kids[p], same[k], place[k] / max(kids[p], 1),
            tag, min(said, default=0.0), max(said, default=0.0), weights.get("<" + page.tags[p], 0.0), min(up, default=0.0),
        )
    return out


def decode(page: Page, odds: np.ndarray) -> list[bool]:
    """The consistent choice with the largest total log-odds: a kept node's ancestors are kept."""
    n = len(page.tags)
    keep, reject = odds.tolist(), (-odds).tolist()
    for k in range(n - 1, 0, -1):
        p = page.parents[k]
        keep[p] += max(keep[k], reject[k])
        reject[p] += reject[k]
    kept = [False] * n
    for k in range(n):
        kept[k] = (k == 0 or kept[page.parents[k]]) and keep[k] > reject[k]
    return kept


@dataclass(frozen=True)
class Model:
    trees: boost.Trees
    weights: dict[str, float]

    def texts(self, pages: list[Page]) -> list[str]:
        rows = [features(p, self.weights) for p in pages]
        odds = self.trees.margin(np.concatenate(rows)) if rows else np.zeros(0)
        out, at = [], 0
        for page, x in zip(pages, rows):
            kept = decode(page, odds[at : at + len(x)])
            at += len(x)
            out.append("\n\n".join(text for node, text, _ in page.blocks if kept[node]))
        return out


def _labels(page: Page) -> list[int]:
    """1 for nodes with article text inside: by marks where there are any, else by the page's own markup."""
    n, good = len(page.tags), [0] * len(page.tags)
    marked = any(m is not None for m in page.marks)
    for k in range(1, n):
        p = page.parents[k]
        if marked:
            good[k] = int(page.marks[k]) if page.marks[k] is not None else good[p]
        elif page.tags[k] in BOILERPLATE_TAGS or BOILERPLATE_WORDS.intersection(page.words[k]):
            good[k] = -1
        else:
            good[k] = good[p] if good[p] else int(page.tags[k] in ARTICLE_TAGS)
    label = [int(g > 0) for g in good]
    for k in range(n - 1, 0, -1):
        label[page.parents[k]] |= label[k]
    return label


def _layout(paragraphs: list[str], others: list[str], rng: random.Random) -> str:
    """A made-up page with the given article and other texts."""
    esc, pick = html.escape, rng.choice
    other = lambda: esc(pick(others))
    short = lambda: " ".join(other().split()[: rng.randint(1, 4)])
    links = lambda: "".join(f"<li><a href='/x'>{short()}</a></li>" for _ in range(rng.randint(3, 9)))
    a_class = lambda *names: f'{pick(["class", "id"])}="{pick(names)}"'
    extras = [
        lambda: f"<nav {MARK}='0'><ul>{links()}</ul></nav>",
        lambda: f"<div {a_class('menu', 'navbar', 'top-nav', 'navigation')} {MARK}='0'><ul>{links()}</ul></div>",
        lambda: f"<header {MARK}='0'><h1>{short()}</h1><p>{short()}</p></header>",
        lambda: f"<div {a_class('header', 'site-header', 'masthead')} {MARK}='0'><h2>{short()}</h2><p>{other()}</p></div>",
        lambda: f"<aside {MARK}='0'><h3>{short()}</h3><p>{other()}</p><ul>{links()}</ul></aside>",
        lambda: f"<div {a_class('sidebar', 'side-bar', 'widget', 'related-posts', 'related')} {MARK}='0'><h3>{short()}</h3><p>{other()}</p></div>",
        lambda: f"<div {a_class('cookie-notice', 'cookie', 'cookies', 'notice', 'consent-banner', 'gdpr', 'banner', 'popup', 'modal')} {MARK}='0'><p>{other()}</p><button>{short()}</button></div>",
        lambda: f"<div {a_class('ad', 'ads', 'advert', 'advertisement', 'sponsored', 'promo', 'ad-banner')} {MARK}='0'>{other()}</div>",
        lambda: f"<form {MARK}='0'><label>{short()}</label><input><p>{other()}</p><button>{short()}</button></form>",
        lambda: f"<div {a_class('newsletter', 'subscribe', 'signup', 'share', 'social', 'breadcrumb', 'pagination', 'tags')} {MARK}='0'><p>{short()}</p><a href='/y'>{short()}</a></div>",
        lambda: f"<{(t := pick(['section', 'div']))} {a_class('comments', 'comment-list', 'reader-comments', 'replies', 'responses', 'comment')} {MARK}='0'><h3>{short()}</h3>"
        + "".join(f"<div class='comment'><p>{other()}</p></div>" if rng.random() < 0.5 else f"<p>{other()}</p>" for _ in range(rng.randint(1, 5)))
        + f"</{t}>",
        lambda: f"<footer {MARK}='0'>&copy; {short()}<p>{other()}</p></footer>",
        lambda: f"<div {a_class('footer', 'site-footer', 'bottom')} {MARK}='0'><p>{other()}</p><ul>{links()}</ul></div>",
    ]
    some = lambda p, most: "".join(pick(extras)() for _ in range(rng.randint(1, most))) if rng.random() < p else ""
    body = [f"<h1>{esc(' '.join(paragraphs[0].split()[:8]))}</h1>"] if rng.random() < 0.7 else []
    for k, text in enumerate(paragraphs):
        kind = rng.random()
        tag = "h2" if kind < 0.06 and len(text) < 80 else "blockquote" if kind < 0.1 else "p"
        inner = esc(text)
        if kind > 0.9:
            words = inner.split()
            inner = " ".join([f"<a href='/z'>{words[0]}</a>", *words[1:]]) if words else inner
        body.append(f"<ul><li>{inner}</li></ul>" if 0.1 <= kind < 0.14 else f"<{tag}>{inner}</{tag}>")
        if rng.random() < 0.06:
            body.append(pick(extras)())
    holder = pick(
        ["<article {m}>|</article>"] * 4
        + ["<main {m}>|</main>", "<main {m}><article>|</article></main>", "<div {m}>|</div>", "<section {m}>|</section>"]
        + [f'<div {a_class("content", "post", "entry-content", "article-body", "story", "main-content", "text", "post-body")} {{m}}>|</div>'] * 2
    ).format(m=f"{MARK}='1'")
    before, after = holder.split("|")
    inside = before + some(0.15, 1) + "".join(body) + some(0.25, 2) + after
    wrap = rng.random()
    inside = f"<div class='{pick(['wrapper', 'container', 'page', 'layout'])}'>{inside}{some(0.4, 2)}</div>" if wrap < 0.4 else inside
    return f"<html><body {MARK}='0'>{some(0.8, 4)}{inside}{some(0.8, 4)}</body></html>"


def fit_on(sources: list[str], layouts: int = 3, seed: int = 7) -> Model:
    """A model from page sources, each with so many made-up layouts of its texts."""
    rng = random.Random(seed)
    pages = [parse(s) for s in sources]
    labels = [_labels(p) for p in pages]
    texts = [[t for node, t, _ in p.blocks if label[node]] for p, label in zip(pages, labels)]
    others = [t[:400] for p, label in zip(pages, labels) for node, t, _ in p.blocks if not label[node]]
    others += [t[:300] for found in texts for t in found[1:4]]  # comments and notices read like articles
    others = others or ["more about this site, and where to find it."]
    for found in texts:
        if found:
            for _ in range(layouts):
                first = rng.randrange(len(found))
                pages.append(parse(_layout(found[first : first + rng.randint(1, 14)], others, rng)))
                labels.append(_labels(pages[-1]))
    counts: dict[str, list[int]] = {}
    for page, label in zip(pages, labels):
        for k in range(1, len(page.tags)):
            for w in {"<" + page.tags[k], *page.words[k]}:
                counts.setdefault(w, [0, 0])[label[k]] += 1
    weights = {w: float(np.log((b + 1.0) / (a + 1.0))) for w, (a, b) in counts.items()}
    for w in BOILERPLATE_WORDS:
        weights.setdefault(w, -3.0)
    for t in BOILERPLATE_TAGS:
        weights.setdefault("<" + t, -3.0)
    rows = [features(p, weights) for p in pages]
    x = np.concatenate(rows) if rows else np.zeros((0, N_FEATURES))
    return Model(boost.fit(x, np.array([y for label in labels for y in label], float), trees=60, depth=4), weights)


def fit(pages: DataFrame, source: str = "html", sample: int = TRAIN_PAGES) -> Model:
    """A model from the ``sample`` distinct pages with the least hash of their source, or all if there are fewer."""
    some = pages.select(F.col(source).alias("source")).where("length(source) > 0").withColumn("hash", F.xxhash64("source"))
    drawn = [r["hash"] for r in some.select("hash").distinct().orderBy("hash").limit(sample).collect()]
    if not drawn:
        return fit_on([])
    # Only the drawn pages are dealt out, each task's copies once.
    return fit_on(sorted(r["source"] for r in some.where(F.col("hash").isin(drawn)).dropDuplicates(["hash"]).collect()))


def extract(pages: DataFrame, model: Model, source: str = "html", group: int = 128) -> DataFrame:
    """``row`` and ``text`` (blocks joined by two line ends, empty if none) of each row."""

    @F.pandas_udf(T.StringType())
    def text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out: list[str] = []
            for first in range(0, len(batch), group):
                out += model.texts([parse(s) for s in batch.iloc[first : first + group]])
            yield pd.Series(out, dtype=object)

    whole = F.coalesce(F.col("row")[source], F.lit(""))
    return packed(pages).select("row", text_of(whole).alias("text"))
