"""Main text of web pages by boosted trees over DOM nodes, decoded along the tree.

Every element of a page is a row of features: how dense its subtree is in text, what its tag,
class, id and role say (counts of words of two small vocabularies, its own and its ancestors'),
its depth, and how it compares with its siblings. Trees give the probability that it belongs to
the article. Decoding picks the likeliest labelling in which nothing below a dropped element is
kept, in one pass up and one down the tree.

Teachers are pages that mark their article: a bounded sample is labelled by that mark, and varied
by taking the mark's name away and by moving menus, adverts and comments into the article, so that
the trees learn from all kinds of features.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectable.llm.trees import Tree, fit_trees, log_odds
from vectable.llm.worker import kept_by_worker

SAMPLE = 300  # pages that the trees are fitted on
SAMPLE_CHARS = 200_000  # pages of more characters aren't used for fitting
AT_ONCE = 4_000_000  # characters of pages that are judged at once, and those of one more page

# Elements by kind, and words of attributes.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style title textarea noscript iframe xmp svg".split())
UNSEEN = set("select template".split())  # elements whose text is no page text
BLOCK = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer"
    " form frameset h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul caption".split()
)
CLOSES = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "td", "th"},
    "td": {"td", "th"},
    "th": {"td", "th"},
    "option": {"option"},
}
SCOPES = set("ul ol dl table td th div article section body html".split())
PROSE = set("p h1 h2 h3 h4 h5 h6 li blockquote pre td dd dt figcaption".split())
ASIDE_WORDS = set(
    "nav menu navbar navigation header footer aside sidebar ad ads advert advertisement advertising adverts banner"
    " sponsor sponsored promo promotion notice cookie cookies consent gdpr popup modal overlay newsletter subscribe"
    " subscription signup form login search comment comments discussion reply replies respond disqus share sharing"
    " social related recommended recommendations widget breadcrumb breadcrumbs pagination pager copyright legal"
    " disclaimer toolbar masthead topbar alert button complementary contentinfo dialog feedback".split()
)
ARTICLE_WORDS = set("article main content post entry story body text maintext articlebody prose".split())

# A quote opens a value only right after an equals sign, and only if it ends.
TAG = re.compile(
    r"<!--|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>",
)
ATTRIBUTE = re.compile(r"(?:^|\s)(?:class|id|role|itemprop)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
RAW_ENDS = {name: re.compile(rf"</{name}\b[^>]*+>", re.IGNORECASE) for name in RAW}
WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
UNENDED = re.compile(r"<[!?/]?[a-zA-Z!-][^<>]*\Z")


@dataclass
class Page:
    """Elements in document order with their parents, and pieces of text with element and block."""

    parent: list[int] = field(default_factory=lambda: [-1])
    tag: list[str] = field(default_factory=lambda: ["#page"])
    words: list[list[str]] = field(default_factory=lambda: [[]])
    texts: list[tuple[int, int, str]] = field(default_factory=list)


def parse(source: str) -> Page:
    """The page's elements; wrong nesting, missing ends and a cut page are taken as browsers roughly do.

    What follows the last ``>`` is text, but for a tag or comment cut by the page's end. Work grows in
    proportion to the page, whatever it holds.
    """
    page, open_, block, at = Page(), [0], 0, 0
    size, tags_end = len(source), source.rfind(">") + 1
    no_end: set[str] = set()  # raw elements that don't end in the rest of the page

    def text(until: int) -> None:
        piece = source[at:until]
        if until == size:
            piece = UNENDED.sub("", piece)
        if piece:
            page.texts.append((open_[-1], block, html.unescape(piece)))

    while at < tags_end:
        match = TAG.search(source, at, tags_end)
        if match is None:
            break
        text(match.start())
        at = match.end()
        name = match[2]
        if name is None:
            if match[0] == "<!--":
                end = source.find("-->", at)
                at = end + 3 if end >= 0 else size
            continue
        name = name.lower()
        ends = bool(match[1])
        if name in BLOCK:
            block += 1
            _close(page, open_, {"select"})
        if ends:
            for place in range(len(open_) - 1, 0, -1):
                if page.tag[open_[place]] == name:
                    del open_[place:]
                    break
            continue
        if name == "br":
            page.texts.append((open_[-1], block, " "))
        if name in BLOCK and name not in ("html", "body"):
            _close(page, open_, {"p"})
        if name in CLOSES:
            _close(page, open_, CLOSES[name])
        attributes = match[3]
        found = " ".join(x for m in ATTRIBUTE.findall(attributes) for x in m if x) if "=" in attributes else ""
        page.parent.append(open_[-1])
        page.tag.append(name)
        page.words.append([w.lower() for w in WORD.findall(found)])
        if name in RAW:
            if (name != "svg" or not attributes.endswith("/")) and name not in no_end:
                end = RAW_ENDS[name].search(source, at, tags_end)
                if end:
                    at = end.end()
                elif name in ("script", "style", "textarea", "xmp"):
                    at = size
                else:  # what never ends holds nothing
                    no_end.add(name)
        elif name not in VOID and not attributes.rstrip().endswith("/"):
            open_.append(len(page.tag) - 1)
        elif name not in VOID and name in BLOCK:
            open_.append(len(page.tag) - 1)
    text(size)
    return page


def _close(page: Page, open_: list[int], names: set[str]) -> None:
    for place in range(len(open_) - 1, 0, -1):
        tag = page.tag[open_[place]]
        if tag in names:
            del open_[place:]
            return
        if tag in SCOPES:
            return


def with_body(page: Page) -> Page:
    """``page`` with its page-level text under the body, as browsers put it; without a body it gets one.

    An implied body takes all that lies at page level or in ``html``, but for the head. Pages without
    such text, and those without any element, stay as they are.
    """
    count = len(page.tag)
    if count == 1 or all(node or piece.isspace() for node, _, piece in page.texts):
        return page
    if "body" in page.tag:
        body = page.tag.index("body")
        return Page(page.parent, page.tag, page.words, [(node or body, *rest) for node, *rest in page.texts])
    root = next((i for i in range(1, count) if page.tag[i] == "html" and page.parent[i] == 0), 0)
    top = [0, root] if root else [0]
    rest = [i for i in range(1, count) if i != root]
    body = len(top)
    place = {old: new + (new >= body) for new, old in enumerate([*top, *rest])}

    def above(i: int) -> int:
        up = page.parent[i]
        return place[up] if up not in top else body - 1 if page.tag[i] == "head" else body

    return Page(
        [*range(-1, body), *[above(i) for i in rest]],
        [*[page.tag[i] for i in top], "body", *[page.tag[i] for i in rest]],
        [*[page.words[i] for i in top], [], *[page.words[i] for i in rest]],
        [(body if node in top else place[node], block, piece) for node, block, piece in page.texts],
    )


FEATURES = 24


def features(page: Page) -> np.ndarray:
    """One row of ``FEATURES`` numbers per element."""
    n = len(page.tag)
    parent = np.array(page.parent)
    order = range(n - 1, 0, -1)  # children before parents
    chars, links, marks = np.zeros(n), np.zeros(n), np.zeros(n)
    start = np.full(n, -1.0)
    seen = 0
    inside_link = np.zeros(n, bool)
    depth = np.zeros(n)
    own_aside, own_article = np.zeros(n), np.zeros(n)
    up_aside, up_article = np.zeros(n), np.zeros(n)
    for i in range(n):
        tag, words = page.tag[i], page.words[i]
        own_aside[i] = (tag in ASIDE_WORDS) + sum(w in ASIDE_WORDS for w in words)
        own_article[i] = (tag in ("article", "main")) + sum(w in ARTICLE_WORDS for w in words)
        if i:
            up = parent[i]
            inside_link[i] = inside_link[up] or tag == "a"
            depth[i] = depth[up] + 1
            up_aside[i] = up_aside[up] + own_aside[up]
            up_article[i] = up_article[up] + own_article[up]
    for i, _, piece in page.texts:
        length = len(piece) - piece.count(" ")
        chars[i] += length
        marks[i] += piece.count(".") + piece.count(",")
        if inside_link[i]:
            links[i] += length
        if start[i] < 0:
            start[i] = seen
        seen += length
    tags, children, below_aside, below_article = np.ones(n), np.zeros(n), own_aside.copy(), own_article.copy()
    place = np.zeros(n)
    for i in range(1, n):
        place[i] = children[parent[i]]
        children[parent[i]] += 1
    own_chars = chars.copy()
    for i in order:
        up = parent[i]
        chars[up] += chars[i]
        links[up] += links[i]
        marks[up] += marks[i]
        tags[up] += tags[i]
        below_aside[up] += below_aside[i]
        below_article[up] += below_article[i]
        if start[i] >= 0 and (start[up] < 0 or start[i] < start[up]):
            start[up] = start[i]
    before, after, last = np.zeros(n), np.zeros(n), {}
    for i in range(1, n):
        sibling = last.get(parent[i])
        if sibling is not None:
            before[i], after[sibling] = chars[sibling], chars[i]
        last[parent[i]] = i
    whole = max(chars[0], 1.0)
    up = np.maximum(parent, 0)
    tag = page.tag
    return np.stack(
        [
            np.log1p(chars),
            np.log1p(own_chars),
            links / np.maximum(chars, 1),
            np.log1p(chars / tags),
            chars / whole,
            np.maximum(start, 0) / whole,
            depth,
            np.log1p(children),
            np.log1p(children[up]),
            place / np.maximum(children[up], 1),
            np.log1p(before),
            np.log1p(after),
            chars / np.maximum(chars[up], 1),
            np.log1p(chars[up] / tags[up]),
            marks / np.maximum(chars, 1),
            np.minimum(own_aside, 3),
            np.minimum(up_aside, 3),
            np.minimum(below_aside - own_aside, 9),
            np.minimum(own_article, 3),
            np.minimum(up_article, 3),
            np.minimum(below_article - own_article, 9),
            np.array([t in PROSE for t in tag], float),
            np.array([t not in BLOCK for t in tag], float),
            np.array([t in ("ul", "ol", "li", "dl", "a") for t in tag], float),
        ],
        1,
    )


def decode(page: Page, odds: np.ndarray) -> np.ndarray:
    """Which elements are kept: the likeliest labelling without a kept element below a dropped one."""
    n = len(page.tag)
    keep = -np.logaddexp(0, -odds)
    drop = -np.logaddexp(0, odds)
    unseen = [i for i, tag in enumerate(page.tag) if tag in UNSEEN]
    keep[unseen], drop[unseen] = -np.inf, 0.0
    keep[0], drop[0] = 0.0, -np.inf  # the page itself
    for i in range(n - 1, 0, -1):
        up = page.parent[i]
        keep[up] += max(keep[i], drop[i])
        drop[up] += drop[i]
    kept = np.zeros(n, bool)
    kept[0] = True
    for i in range(1, n):
        kept[i] = kept[page.parent[i]] and keep[i] >= drop[i]
    return kept


def blocks_of(page: Page, kept: np.ndarray) -> list[str]:
    """The kept text, block by block, with single blanks.

    Text outside every element is kept only where a page has no element (``with_body`` leaves none
    in other pages); blanks there part words.
    """
    blocks: list[str] = []
    last, pieces = None, []
    for node, block, piece in [*page.texts, (0, -1, "")]:
        if block != last:
            words = "".join(pieces).split()
            if words:
                blocks.append(" ".join(words))
            last, pieces = block, []
        if kept[node] and (node or len(page.tag) == 1 or piece.isspace()):
            pieces.append(piece)
    return blocks


# Teaching


def teacher_labels(page: Page) -> np.ndarray | None:
    """1 for elements of the one marked article, 0 for others; None if the page marks none or several.

    Inside the article, elements named like something aside and all below them are 0; elements around
    the article are 1.
    """
    marked = [i for i, t in enumerate(page.tag) if t == "article" or "teacher" in page.words[i]]
    if len(marked) != 1:
        return None
    label = np.zeros(len(page.tag))
    for i in range(marked[0], len(page.tag)):
        inside = i == marked[0] or label[page.parent[i]] == 1
        named = page.tag[i] in ASIDE_WORDS or any(w in ASIDE_WORDS for w in page.words[i])
        label[i] = inside and (i == marked[0] or (page.parent[i] >= marked[0] and not named))
    around = page.parent[marked[0]]
    while around >= 0:
        label[around] = 1
        around = page.parent[around]
    return label


def variants(source: str) -> list[str]:
    """The page, and the page with its article's mark renamed and things aside moved into the article."""
    start, end = re.search(r"<article\b[^>]*>", source), source.rfind("</article>")
    if start is None or end < start.end():
        return [source]
    head, body, tail = source[: start.start()], source[start.end() : end], source[end + 10 :]
    pick = sum(map(ord, body[:200]))
    paragraphs = re.findall(r"<p>([^<]+)", body) or ["-"]
    said, more = paragraphs[pick % len(paragraphs)], paragraphs[(pick // 7) % len(paragraphs)]
    asides = [
        f'<div class="comments"><h3>Comments</h3><div class="comment"><p>{said}</p></div><p>{more}</p></div>',
        f'<section id="comments"><p>{more}</p><ul><li>{said}</li></ul></section>',
        f'<aside class="sidebar"><h2>Related</h2><p>{said}</p><a href="#">{more[:40]}</a></aside>',
        f'<div class="cookie-notice">{said[:120]} <button>OK</button></div>',
        f'<form action="/s"><label>{said[:30]}</label><input name="q"><p>{more[:80]}</p></form>',
        f'<div class="ad-banner"><p>{said}</p></div>',
        f'<ul class="share"><li><a href="#">{more[:12]}</a></li><li><a href="#">{said[:12]}</a></li></ul>',
        f'<header class="site-header"><p>{said[:90]}</p></header>',
    ]
    first, second = asides[pick % len(asides)], asides[(pick // 3 + 1) % len(asides)]
    parts = re.split(r"(?=<p>)", body)
    middle = max(1, len(parts) // 2)
    mixed = "".join(parts[:middle]) + first + "".join(parts[middle:])
    name = ("post-content", "entry", "", "story")[pick % 4]
    return [
        source,
        f"{head}{first}<article>{mixed}{second}</article>{second}{tail}",
        f'{head}{second}<div class="teacher {name}">{body}</div>{first}{tail}',
        f'{head}<div><div class="teacher">{mixed}</div></div>{second}{tail}',
        f'<main class="teacher">{mixed}{second}</main>{first}',
    ]


def fit_extractor(
    pages: DataFrame,
    id_column: str = "page_id",
    html_column: str = "html",
    sample: int = SAMPLE,
    sample_chars: int = SAMPLE_CHARS,
) -> str:
    """Trees as JSON from the ``sample`` pages with the smallest hashes of their ids that mark one article.

    Pages of more than ``sample_chars`` characters don't teach, and of a repeated id only one row does. Without such a page the trees are none, and elements named like something aside are dropped.
    """
    source = F.col(html_column)
    marked = source.isNotNull() & source.contains("<article") & (F.length(source) <= sample_chars)
    ids = pages.where(marked).select(F.col(id_column).alias("id")).where("id IS NOT NULL").distinct()
    chosen = ids.orderBy(F.xxhash64("id"), "id").limit(sample)
    given = pages.where(marked).select(F.col(id_column).alias("id"), source.alias("html"))
    known = given.join(F.broadcast(chosen), "id", "left_semi").groupBy("id")  # at most ``sample`` ids
    known = known.agg(F.min_by("html", F.xxhash64("html")).alias("html"))

    def rows_of(batches):
        for batch in batches:
            rows, labels = [], []
            for source in batch.column(0).to_pylist():
                for variant in variants(source):
                    page = with_body(parse(variant))
                    label = teacher_labels(page)
                    if label is not None:
                        page.words = [[w for w in words if w != "teacher"] for words in page.words]
                        rows.append(features(page)[1:].astype(np.float32).tobytes())
                        labels.append(label[1:].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.binary()), pa.array(labels, pa.binary())], ["rows", "labels"]
            )

    def learn(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table.column("rows").to_pylist(), table.column("labels").to_pylist(), strict=True))
        rows = np.frombuffer(b"".join(p[0] for p in parts), np.float32).reshape(-1, FEATURES).astype(float)
        label = np.frombuffer(b"".join(p[1] for p in parts), np.float32).astype(float)
        trees, start = fit_trees(rows, label, rounds=40, depth=4, rate=0.3)
        model = [start, [[t.feature.tolist(), t.threshold.tolist(), t.value.tolist()] for t in trees]]
        return pa.table({"model": [json.dumps(model)]})

    taught = known.select("html").mapInArrow(rows_of, "rows binary, labels binary")
    fitted = taught.groupBy(F.lit(0).alias("all")).applyInArrow(learn, "model string").first()
    return fitted["model"] if fitted else ""


def _trees(model: str) -> tuple[list[Tree], float] | None:
    if not model:
        return None
    start, parts = json.loads(model)
    return [Tree(np.array(f), np.array(t), np.array(v)) for f, t, v in parts], start


def extract(sources: list[str], trees: tuple[list[Tree], float] | None) -> list[str]:
    """The main texts of some pages, all of whose elements are judged at once."""
    pages = [with_body(parse(source)) for source in sources]
    if not pages:
        return []
    rows = [features(page) for page in pages]
    every = np.concatenate(rows)
    odds = log_odds(*trees, every) if trees else np.where(every[:, 15] > 0, -4.0, 1.0)
    ends = np.cumsum([len(r) for r in rows])
    parts = np.split(odds, ends[:-1])
    return ["\n\n".join(blocks_of(page, decode(page, own))) for page, own in zip(pages, parts, strict=True)]


def _runs(sources: list[str]) -> Iterator[list[str]]:
    """The pages in runs of about ``AT_ONCE`` characters."""
    run, size = [], 0
    for source in sources:
        run.append(source)
        size += len(source)
        if size >= AT_ONCE:
            yield run
            run, size = [], 0
    yield run


def main_text(model: str, column: Column) -> Column:
    """The main text of a column of pages: its blocks joined by an empty line, empty if there are none.

    Null pages are empty. Nothing is cut or capped: a page is read whole, and every kept block whole.
    """

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        trees = kept_by_worker(("trees", model), lambda: _trees(model))
        sources = [source or "" for source in pages.to_pylist()]
        return pa.array([text for run in _runs(sources) for text in extract(run, trees)], pa.string())

    return run(column)
