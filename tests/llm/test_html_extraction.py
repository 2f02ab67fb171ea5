import html as references
import itertools
import random
import re

import numpy as np
import pytest

from weakspot.llm import html_extraction
from weakspot.llm.html_extraction import Forest, Model, composed, fitted, labelled_pages, labels_of, main_text, op11_html_extraction, texts_of, train
from weakspot.llm.page_tree import DIM, EDGES, Page

SF = "/root/testdata/sf0.001"


def runs(source):
    page = Page(source)
    return [(page.tag[page.parent[k]], text) for k, text in enumerate(page.text) if text]


@pytest.mark.parametrize("source, want", [
    (None, []),
    ("", []),
    (" \n ", []),
    ("plain &amp; text", [("#page", "plain & text")]),
    ("<p>one<p>two</p>three", [("p", "one"), ("p", "two"), ("#page", "three")]),
    ("<p><b>one<br><p>two <i>x</i>y", [("p", "one"), ("p", "two xy")]),
    ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", [("li", "a"), ("li", "b"), ("li", "c"), ("li", "d"), ("#page", "e")]),
    ("<table><tr><td>a<td>b<tr><td><p>c</table>", [("td", "a"), ("td", "b"), ("p", "c")]),
    ("<script>var t='</p>';</script><style>p{}</style><p>x</p>", [("p", "x")]),
    ("<script>never closed <p>x</p>", []),
    ("<head><title>t</title><p>x", [("p", "x")]),
    ("<!-- <p>a</p> --><p>b</p><!-- open <p>c", [("p", "b")]),
    ("<p title='a > b'>x < y</p><p it's>z</p>", [("p", "x < y"), ("p", "z")]),
    ("<div>a</span></p></section>b</div>", [("div", "a"), ("div", "b")]),
    ("<DIV>A&nbsp;&#233;\n\t b</DIV><p>c <p", [("div", "A é b"), ("p", "c")]),
    ("<div>a<hr>b<select><option>no</select><button>no</button> c</div>", [("div", "a"), ("div", "b c")]),
])
def test_runs_of_text(source, want):
    assert runs(source) == want


def test_deep_and_broken_pages_end():
    deep = Page("<div>" * 3000 + "x" + "</p></b>" * 3000)
    assert deep.text[-1] == "x" and len(deep.parent) == 3002
    assert len(Page("<ul><li>" * 2000 + "<p>a" * 2000).parent) == 1 + 4000 + 4000
    assert texts_of(["<div>" * 3000 + "x"], Model(np.zeros(DIM), np.zeros((len(EDGES), 2, 2))))[0][1] == 0.5


def test_messages_give_the_marginals_of_all_assignments():
    draw = np.random.default_rng(4)
    model = Model(draw.normal(size=DIM), draw.normal(size=(len(EDGES), 2, 2)) * 2)
    pages = [Page("<div><p>a b</p><ul><li>c</li><li>d, e.</li></ul></div>"), Page("x"), Page(""), Page("<nav><a>m</a></nav><p>t")]
    forest = Forest(pages)
    nodes, edges = forest.marginals(model)
    at = 0
    for page in pages:
        n, single = len(page.parent), Forest([page])
        scores = np.bincount(single.owner, model.weights[single.feature], n)
        one, both, total = np.zeros(n), np.zeros((n, 2, 2)), 0.0
        for states in itertools.product((0, 1), repeat=n):
            score = sum(scores[k] for k in range(n) if states[k])
            score += sum(model.pairs[single.kind[k], states[page.parent[k]], states[k]] for k in range(1, n))
            weight = np.exp(score)
            total += weight
            one += weight * np.array(states)
            for k in range(1, n):
                both[k, states[page.parent[k]], states[k]] += weight
        assert np.allclose(nodes[at : at + n, 1], one / total) and np.allclose(edges[at : at + n], both / total)
        at += n


def marked(source):
    """What stands in the article of a page of the tables."""
    inner = re.search("(?s)<article>(.*?)</article>", source)[1].replace("<br>", " ")
    blocks = (" ".join(references.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:h1|p)>", inner))
    return "\n\n".join(b for b in blocks if b)


@pytest.fixture(scope="module")
def model(spark):
    return train(spark.read.parquet(f"{SF}/pages.parquet"))


def test_every_page_gives_its_article(spark):
    rows = op11_html_extraction(spark, SF).collect()
    sources = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(rows) == len(sources)
    for row in rows:
        assert (row.url, row.text, row.n_chars) == (sources[row.page_id].url, marked(sources[row.page_id].html), len(row.text))


def test_layouts_not_trained_on():
    draw = random.Random(17)
    pool = ["he went to the river", "Nothing was said of it; she left, and he stayed."] + html_extraction.SENTENCES
    made = fitted(labelled_pages([]))
    articles = [[("h1", draw.choice(pool)), *(("p", " ".join(draw.choices(pool, k=3))) for _ in range(4))] for _ in range(60)]
    pages = [Page(composed(a, pool, draw)) for a in articles]
    right = total = 0
    for page in pages:
        truth, found = labels_of(page), Forest([page]).marginals(made)[0][:, 1] >= 0.5
        text = np.array([t > "" for t in page.text])
        right, total = right + ((truth == found) & text).sum(), total + text.sum()
    assert right >= 0.97 * total


def test_parts_around_an_article_without_marks(model):
    paragraphs = ["The first day was cold, and the boats stayed in the harbour until noon.",
                  "On the second day they went out, but <a href=x>the nets</a> came back empty &amp; torn.",
                  "By the end of the week nobody spoke of fish any more; they mended what they had."]
    page = (
        "<html><body><header class=site-header><p>The Daily Fish</p></header><div class=menu><a href=/>Home</a> <a href=/a>About</a></div>"
        "<div class='cookie-banner'><p>We use cookies, as everyone does.</p></div>"
        f"<div class=content><h1>A week at sea</h1>{''.join(f'<p>{p}</p>' for p in paragraphs)}</div>"
        "<aside><h3>More</h3><ul><li><a href=/b>Boats</a></li></ul></aside>"
        "<form action=/s><label>Your address</label><input name=m><p>Write to us.</p></form>"
        "<section class=comments><h3>Comments</h3><div class=comment><p>I was there, and it was not like this at all.</p></div></section>"
        "<footer>&copy; 2020 The Daily Fish</footer></body></html>"
    )
    want = ["A week at sea", *(references.unescape(re.sub("<[^>]*>", "", p)) for p in paragraphs)]
    assert texts_of([page], model)[0][0].split("\n\n") == want


def test_odd_rows(spark, model):
    long = "<article>" + "<p>word, word.</p>" * 20_000 + "</article><footer>end</footer>"
    rows = [(1, None, None, "a", 5), (2, "u", "", "b", 6), (None, "u", "<p>", "c", 7), (4, "u", long, "d", 8), (4, "u", long, "d", 8)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars long")
    found = main_text(table, model)
    assert found.columns == ["page_id", "url", "html", "_text", "_n_chars", "text", "n_chars", "certainty"]
    got = sorted(((r["_text"], r.text, r.n_chars, r.certainty is None) for r in found.collect()))
    whole = "\n\n".join(["word, word."] * 20_000)
    assert got == [("a", "", 0, True), ("b", "", 0, True), ("c", "", 0, True)] + [("d", whole, len(whole), False)] * 2
    nothing = spark.createDataFrame([(None,), (None,)], "html string")
    assert [r.text for r in main_text(nothing, model).collect()] == ["", ""]
    assert main_text(table.limit(0), model).collect() == []
    assert train(table.limit(0)).weights.any()
