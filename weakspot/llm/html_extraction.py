"""HTML extraction: a tree-structured model over the nodes of a page tells the article from the rest.

Each node of a page's tree (block elements and runs of text, `page_tree`) is content or
not.  A node has a potential by its hashed features, each edge between parent and
child a table of potentials by the kind of the child.  Sum-product messages go
from the leaves to the root and back, level by level for all pages of a batch at once,
and give exact marginals; runs whose marginal is at least one half are the text.

The model is trained by the likelihood of labelled pages (gradient: observed less
expected features, from the same messages).  Labels come from pages that mark their one
article themselves (`article` or `main`).  To learn what pages without such marks
look like, each is composed anew in several layouts: its article under other elements
and names, with menus, headers, footers, sidebars, notices, adverts, forms and reader
comments whose texts come from other pages.  At most `most` pages of at most `longest`
characters, drawn by a hash of url and html, are read by the driver for it.

Null and empty pages give an empty text.  Repeated rows are worked off one by one, other
columns are kept; one that is called like a result column moves aside (`room_for`).
A table without pages that mark an article is read with a model of built-in layouts.
"""

from __future__ import annotations

import html as references
import random
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from weakspot.llm.common import draw_of, read, room_for, smallest
from weakspot.llm.page_tree import DIM, EDGES, Page

MOST, LONGEST = 240, 40_000
LAYOUTS = 3
#: characters of markup worked off together
BATCH = 2_000_000

# fixed values: how pages call their parts, and sentences where no page gives any
ARTICLES = ["article", "main", 'div class="content"', 'div id="post"', 'div class="entry-content"', 'section class="story"',
            'div class="article-body"', 'div role="main"', "div", "section", "body"]
MENUS = ["nav", 'div class="menu"', 'div id="navigation"', 'div class="nav-bar"', 'div class="breadcrumbs"', 'div class="top-links"']
HEADERS = ["header", 'div class="header"', 'div id="masthead"', 'div class="site-header"', 'div class="banner"']
FOOTERS = ["footer", 'div class="footer"', 'div id="site-footer"', 'div class="copyright"']
SIDEBARS = ["aside", 'div class="sidebar"', 'div id="side"', 'div class="widget"', 'div class="related"', 'section class="recommended"']
NOTICES = ['div class="notice"', 'div class="cookie-banner"', 'div id="consent"', 'div class="alert"', 'div class="popup"',
           'div class="newsletter"', 'p class="notice"', 'div role="alert"']
ADVERTS = ['div class="ad"', 'div class="advert"', 'div class="ads sponsored"', 'aside class="promo"', 'div id="advertisement"']
COMMENTS = ['section class="comments"', 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"',
            'div class="discussion"', 'section id="replies"', 'div class="reader-comments"', 'div class="responses"']
COMMENT = ['div class="comment"', "article", 'li class="reply"', "p", 'div class="post"', "blockquote"]
SENTENCES = [
    "The committee met on Tuesday and put off its decision on the bridge until spring.",
    "Two of the three engines had been taken apart, and no one could say where their parts were.",
    "When the rain stopped, the river had risen by a metre, and the lower road was closed.",
    "Her second book sold fewer copies, but it is the one that teachers still ask for.",
    "They counted the birds each morning for a year and found that most had gone by June.",
    "Prices rose a little in the first half of the year and then stayed where they were.",
    "He left the letter on the table, where it lay unopened for a week.",
    "A smaller group went on to the lake, set up camp, and waited for the others.",
]


@dataclass
class Model:
    """Potential of each hashed feature, and per kind of edge a table (parent's state, child's state)."""

    weights: np.ndarray
    pairs: np.ndarray


class Forest:
    """The trees of many pages in flat arrays, with the nodes of each level together."""

    def __init__(self, pages: list[Page]):
        starts = np.cumsum([0] + [len(p.parent) for p in pages])
        self.parent = np.concatenate([np.where(np.array(p.parent) < 0, -1, np.array(p.parent) + s) for p, s in zip(pages, starts)])
        self.kind = np.concatenate([np.array(p.edges()) for p in pages])
        features = [f for p in pages for f in p.features()]
        self.feature = np.concatenate([np.array(f) for f in features])
        self.owner = np.repeat(np.arange(len(features)), [len(f) for f in features])
        depth = np.zeros(len(self.parent), np.int64)
        for k, up in enumerate(self.parent.tolist()):
            if up >= 0:
                depth[k] = depth[up] + 1
        order = np.argsort(depth, kind="stable")
        self.levels = np.split(order, np.cumsum(np.bincount(depth))[:-1])

    def marginals(self, model: Model) -> tuple[np.ndarray, np.ndarray]:
        """Probability of each node's states, and of the states of each edge (zero for roots)."""
        n = len(self.parent)
        up, down, sent = np.zeros((n, 2)), np.zeros((n, 2)), np.zeros((n, 2))
        up[:, 1] = np.bincount(self.owner, model.weights[self.feature], n)
        both = np.zeros((n, 2, 2))
        for level in self.levels[:0:-1]:
            sent[level] = added(model.pairs[self.kind[level]] + up[level][:, None, :], 2)
            np.add.at(up, self.parent[level], sent[level])
        for level in self.levels[1:]:
            above = self.parent[level]
            others = (up[above] + down[above] - sent[level])[:, :, None] + model.pairs[self.kind[level]]
            message = added(others, 1)
            down[level] = message - message.max(1, keepdims=True)
            joint = others + up[level][:, None, :]
            joint = np.exp(joint - joint.max((1, 2), keepdims=True))
            both[level] = joint / joint.sum((1, 2), keepdims=True)
        belief = up + down
        belief = np.exp(belief - belief.max(1, keepdims=True))
        return belief / belief.sum(1, keepdims=True), both


def added(scores: np.ndarray, axis: int) -> np.ndarray:
    """Logarithm of the sum of exponentials."""
    top = scores.max(axis, keepdims=True)
    return (top + np.log(np.exp(scores - top).sum(axis, keepdims=True))).squeeze(axis)


def labels_of(page: Page) -> np.ndarray | None:
    """Whether each node is content: runs by the nearest label above, elements by most of their characters."""
    n, own = len(page.parent), list(page.label)
    marked = [k for k, tag in enumerate(page.tag) if tag in ("article", "main")]
    if all(label is None for label in own):
        if len(marked) != 1:
            return None
        own = [1 if k in marked else 0 if tag in ("nav", "aside", "footer", "form") or "name=comments" in page.names[k] else None
               for k, tag in enumerate(page.tag)]
    chars, kept = np.array([len(t) for t in page.text]), np.zeros(n, np.int64)
    for k in range(1, n):
        own[k] = own[page.parent[k]] if own[k] is None else own[k]
        kept[k] = chars[k] if own[k] else 0
    for k in range(n - 1, 0, -1):
        chars[page.parent[k]] += chars[k]
        kept[page.parent[k]] += kept[k]
    return np.where(chars > 0, 2 * kept > chars, np.array([bool(x) for x in own])).astype(np.int64)


def composed(blocks: list[tuple[str, str]], others: list[str], draw: random.Random) -> str:
    """A labelled page: these blocks (tag, text) as the article of a new layout, other texts around it."""

    def wrapped(opening: str, inner: str, label: int) -> str:
        return f'<{opening} data-label="{label}">{inner}</{opening.split()[0]}>'

    def words(least: int, most: int) -> str:
        text = draw.choice(others).split()
        at = draw.randrange(max(1, len(text) - most))
        return references.escape(" ".join(text[at : at + draw.randint(least, most)]))

    def links(least: int, most: int) -> str:
        item = draw.choice(["<li><a href=/>{}</a></li>", "<a href=/>{}</a> ", "<li><a href=/>{}</a>", "<p><a href=/>{}</a></p>"])
        inner = "".join(item.format(words(1, 3)) for _ in range(draw.randint(least, most)))
        return f"<ul>{inner}</ul>" if item.startswith("<li") else inner

    def prose(least: int, most: int) -> str:
        return "".join(f"<p>{words(4, 40)}" + draw.choice(["</p>", ""]) for _ in range(draw.randint(least, most)))

    def aside(kinds: list[str]) -> str:
        return wrapped(draw.choice(kinds), draw.choice([words(3, 30), prose(1, 2), f"<h3>{words(1, 3)}</h3>{links(2, 6)}", links(2, 6)]), 0)

    def form() -> str:
        inner = f"<label>{words(1, 3)}</label><input name=q>" * draw.randint(1, 3) + f"<p>{words(2, 12)}</p><button>Go</button>"
        return wrapped(draw.choice(["form", 'form class="search"', 'div class="form"']), inner, 0)

    def comments() -> str:
        kind = draw.choice(COMMENT)
        each = "".join(
            f"<{kind}>" + draw.choice(["", f"<span class=author>{words(1, 2)}</span>", f"<h4>{words(1, 3)}</h4>"])
            + draw.choice([words(3, 40), prose(1, 2)]) + f"</{kind.split()[0]}>" for _ in range(draw.randint(1, 5))
        )
        return wrapped(draw.choice(COMMENTS), draw.choice(["", f"<h3>{words(1, 3)}</h3>"]) + each + (form() if draw.random() < 0.3 else ""), 0)

    def menu() -> str:
        return wrapped(draw.choice(MENUS), links(2, 8), 0)

    def footer() -> str:
        return wrapped(draw.choice(FOOTERS), draw.choice(["&copy; ", "Copyright 2020 ", ""]) + draw.choice([words(2, 20), links(1, 5), prose(1, 1)]), 0)

    def header() -> str:
        return wrapped(draw.choice(HEADERS), draw.choice([f"<h1>{words(1, 3)}</h1>", words(1, 6), f"<p>{words(2, 10)}</p>"]) + (menu() if draw.random() < 0.5 else ""), 0)

    def some(*parts: tuple[float, object]) -> list[str]:
        return [make() for chance, make in parts if draw.random() < chance]

    sides = (0.4, lambda: aside(SIDEBARS)), (0.4, lambda: aside(NOTICES)), (0.4, lambda: aside(ADVERTS)), (0.25, form)
    inner = [f"<{tag}>{references.escape(text)}</{tag}>" for tag, text in blocks]
    for part in some(*((chance / 2, make) for chance, make in sides), (0.2, comments)):
        inner.insert(draw.randint(0, len(inner)), part)
    opening = draw.choice(ARTICLES)
    before, after = some((0.5, header), (0.6, menu), *sides), some((0.4, comments), *sides, (0.7, footer))
    draw.shuffle(before)
    if opening == "body":
        return f'<body data-label="1">{"".join(before + inner + after)}</body>'
    page = "".join([*before, wrapped(opening, "".join(inner), 1), *after])
    return f'<body data-label="0">{wrapped(draw.choice(["div", "div id=page", "main"]), page, 0) if draw.random() < 0.4 else page}</body>'


def labelled_pages(sources: list[str], layouts: int = LAYOUTS, seed: int = 7) -> list[tuple[Page, np.ndarray]]:
    """Pages that mark their article, and each in other layouts; built-in sentences where there are none."""
    draw, result, articles = random.Random(seed), [], []
    for source in sources:
        page = Page(source)
        labels = labels_of(page)
        if labels is None or not labels.any():
            continue
        result.append((page, labels))
        articles.append([
            (tag if tag in ("h1", "h2", "h3", "li", "blockquote", "pre", "p") else "p", text)
            for tag, text in ((page.tag[page.parent[k]], page.text[k]) for k in np.flatnonzero(labels)) if text
        ])
    made = [[("h1", s.rstrip(".")), *(("p", " ".join(draw.choices(SENTENCES, k=draw.randint(1, 4)))) for _ in range(draw.randint(1, 5)))] for s in SENTENCES]
    articles += made * (1 if articles else 12)
    texts = [text for article in articles for _, text in article]
    for article in articles:
        for _ in range(layouts):
            page = Page(composed(article, texts, draw))
            result.append((page, labels_of(page)))
    return result


def fitted(labelled: list[tuple[Page, np.ndarray]], rounds: int = 120, rate: float = 0.1, penalty: float = 0.02) -> Model:
    """Likelihood of the labels, less a penalty on large potentials, climbed by scaled gradients."""
    forest = Forest([page for page, _ in labelled])
    truth = np.concatenate([labels for _, labels in labelled])
    inner = np.flatnonzero(forest.parent >= 0)
    seen = np.zeros((len(truth), 2, 2))
    seen[inner, truth[forest.parent[inner]], truth[inner]] = 1
    model = Model(np.zeros(DIM), np.zeros((len(EDGES), 2, 2)))
    squares = Model(np.zeros(DIM), np.zeros((len(EDGES), 2, 2)))
    for _ in range(rounds):
        nodes, edges = forest.marginals(model)
        slopes = Model(
            np.bincount(forest.feature, (truth - nodes[:, 1])[forest.owner], DIM) - penalty * model.weights,
            np.zeros((len(EDGES), 2, 2)),
        )
        np.add.at(slopes.pairs, forest.kind[inner], seen[inner] - edges[inner])
        slopes.pairs -= penalty * model.pairs
        for part in ("weights", "pairs"):
            slope, square = getattr(slopes, part), getattr(squares, part)
            square += slope**2
            setattr(model, part, getattr(model, part) + rate * 4 * slope / np.sqrt(square + 1e-8))
    return model


def train(pages: DataFrame, most: int = MOST, longest: int = LONGEST, url: str = "url", html: str = "html") -> Model:
    """A model from a sample of pages that mark an article."""
    marks = F.col(html).rlike("(?i)<(article|main)\\b") & (F.length(html) <= longest)
    drawn = pages.filter(marks).select(draw_of(F.col(url), F.col(html)).alias("draw"), F.col(html).alias("html"))
    return fitted(labelled_pages([row.html for row in smallest(drawn, "draw", most).collect()]))


def texts_of(sources: list[str | None], model: Model) -> list[tuple[str, float | None]]:
    """Text of each page, and the marginal of its least certain run."""
    pages, results = [Page(source) for source in sources], []
    if not pages:
        return []
    content = Forest(pages).marginals(model)[0][:, 1]
    at = 0
    for page in pages:
        mine, at = content[at : at + len(page.parent)], at + len(page.parent)
        runs = [k for k, text in enumerate(page.text) if text]
        sure = min((max(mine[k], 1 - mine[k]) for k in runs), default=None)
        results.append(("\n\n".join(page.text[k] for k in runs if mine[k] >= 0.5), sure))
    return results


def main_text(pages: DataFrame, model: Model, html: str = "html") -> DataFrame:
    """Add text, n_chars (code points) and certainty (0.5 to 1; null for a page without text)."""
    results = ["text", "n_chars", "certainty"]
    if html.lower() in results:
        raise ValueError("the column of pages can't be called like a result")
    pages = room_for(pages, results)

    def extracted(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            sizes = batch[html].str.len().fillna(0).cumsum() // BATCH
            for _, part in batch.groupby(sizes.to_numpy(), sort=False):
                found = texts_of([None if pd.isna(s) else s for s in part[html]], model)
                texts = [text for text, _ in found]
                yield part.assign(text=texts, n_chars=[len(t) for t in texts], certainty=pd.Series([c for _, c in found], part.index, dtype="float64"))

    schema = T.StructType(list(pages.schema)).add("text", "string").add("n_chars", "long").add("certainty", "double")
    return pages.mapInPandas(extracted, schema)


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return main_text(pages, train(pages)).select("page_id", "url", "text", "n_chars", "certainty")
