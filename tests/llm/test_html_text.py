from __future__ import annotations

import html as entities
import random
import re
import time

import numpy as np
import pytest
from cases import DATA

from postflow.llm.html_text import (
    Model, Node, extracted, fitted, main_text, marginals, sample)

PAGES = [None, "", "plain text", "<p>a<p>b", "<body><nav>m</nav><article><p>x &lt;b&gt; y</p></article>",
         "<div><div><div>" * 2000 + "deep", "<p>" + "long word " * 30_000, "<", "&#0; &#xD800;", "<!-- x"]


def table(spark, pages):
    rows = [(i, f"http://a.net/en/{i}", p, "clash", "t") for i, p in enumerate(pages)]
    rows += rows[-1:]
    return spark.createDataFrame(
        rows, "page_id long, url string, html string, text string, order string")


def test_messages_equal_sums_over_all_states():
    """Marginals of small random trees, against every assignment of states."""
    draw = random.Random(1)
    for _ in range(40):
        tags = ["#page"] + [draw.choice("abc") for _ in range(draw.randint(1, 6))]
        nodes = [Node(t, -1 if i == 0 else draw.randrange(i), (f"tag:{t}",))
                 for i, t in enumerate(tags)]
        model = Model({f"tag:{t}": draw.uniform(-2, 2) for t in tags},
                      {t: (draw.uniform(-4, 1), draw.uniform(-1, 4)) for t in tags})
        weight = np.zeros((len(nodes), 2))
        for bits in range(1 << len(nodes)):
            state = [bits >> i & 1 for i in range(len(nodes))]
            log = sum(model.node(n) for n, s in zip(nodes, state) if s)
            for node, own in zip(nodes[1:], state[1:]):
                odds = model.edge(node_tag := nodes[node.parent].tag)[state[node.parent]]
                assert node_tag
                log += (odds if own else 0) - np.logaddexp(0, odds)
            for i, s in enumerate(state):
                weight[i, s] += np.exp(log)
        assert np.allclose(marginals(model, nodes), np.log(weight[:, 1] / weight[:, 0]))


@pytest.mark.parametrize("trained", [True, False])
def test_articles_of_all_pages(spark, trained):
    """The test pages mark their articles; the answer is what lies between those marks."""
    pages = spark.read.parquet(str(DATA / "sf0.01/pages.parquet"))
    docs = spark.read.parquet(str(DATA / "sf0.01/documents.parquet"))
    model = fitted(sample(pages, docs) if trained else [])
    source = {r.page_id: r.html for r in pages.collect()}
    rows = extracted(pages, model).collect()
    assert len(rows) == len(source)
    for r in rows:
        article = source[r.page_id].split("<article>")[1].split("</article>")[0]
        blocks = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", b)).split())
                  for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def test_parts_around_and_inside_an_article(spark):
    page = """<body><header>Site</header><div class="cookie-notice">We use cookies</div><article>
      <p>Hello <a href=x>link</a> world,<br>this is text.</p><ul><li>one<li>two</ul>
      <div class="ad">Buy</div><section id="comments"><p>I agree</p><p>So do I</p></section>
      <script>p("</p>")</script><p hidden>unseen</p></article><aside>More</aside>
      <form><label>Name</label></form><footer>&copy;</footer></body>"""
    assert main_text(fitted([]), page) == "Hello link world, this is text.\none\ntwo"


LINE = "This is a long line of the text that the page shows to its readers, in words. " * 4
NAV = "<nav><ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul></nav>"


@pytest.fixture(scope="module")
def labelled(spark):
    return sample(spark.read.parquet(str(DATA / "sf0.01/pages.parquet")),
                  spark.read.parquet(str(DATA / "sf0.01/documents.parquet")))


@pytest.mark.parametrize("begin, end", [
    ('<html><body class="has-sidebar">', "</body></html>"), ("<body><form action=x>", "</form></body>"),
    ('<body id="page-with-sidebar"><form class="search" action=x>', "</form></body>")])
def test_wrappers_of_whole_pages(labelled, begin, end):
    """A tag or class word of what wraps the page does not hide its text."""
    lines = [f"{i} {LINE.strip()}" for i in range(4)]
    text = "".join(f"<p>{x}</p>" for x in lines)
    assert main_text(fitted([]), begin + text + end) == "\n".join(lines)
    page = f"{begin}{NAV}{text}<footer>&copy; site</footer>{end}"
    assert main_text(fitted(labelled), page) == "\n".join(lines)
    small = f"<body><article>{text}</article><form><label>Name</label><p>{LINE}</p></form></body>"
    assert main_text(fitted(labelled), small) == "\n".join(lines)


def test_labelled_pages_overrule_the_word_lists(labelled):
    """Pages whose text lies in an element with a listed word, and say so by their labels."""
    pages = []
    for i in range(40):
        lines = [f"Paragraph {i} {j} {LINE.strip()}" for j in range(3)]
        pages.append((f"<body>{NAV}<div class='comment-layout'>"
                      + "".join(f"<p>{x}</p>" for x in lines)
                      + f"</div><footer>foot {i}</footer></body>", "\n".join(lines)))
    for known in (pages, labelled + pages):
        model = fitted(known)
        assert all(main_text(model, html) == text for html, text in pages)


def test_a_few_wrong_labels_overrule_nothing(labelled):
    page = f"<body><article><p>{LINE}</p><div class='ad'>Buy {LINE}</div></article></body>"
    assert main_text(fitted(labelled), page) == LINE.strip()


def test_sample_of_few_labelled_pages_among_many(spark):
    """Every labelled page is drawn, however many pages have none; repeated rows count once."""
    rows = [(i, f"http://a.net/en/{i}", f"<p>{i}</p>") for i in [*range(20_000), *[1] * 900]]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(0, 50)], "doc_id long, text string")
    found = sample(pages, docs)
    assert sorted(found) == sorted((f"<p>{i}</p>", f"text {i}") for i in range(50))


def test_every_kind_of_page(spark):
    rows = {r.page_id: r for r in extracted(table(spark, PAGES), fitted([])).collect()}
    assert [rows[i].text for i in range(5)] == ["", "", "plain text", "a\nb", "x <b> y"]
    assert rows[5].text == "deep"
    assert rows[6].n_chars == 300_000 - 1
    assert extracted(table(spark, [None]).limit(0), fitted([])).count() == 0


@pytest.mark.parametrize("trained", [False, True])
def test_legal_pages(labelled, trained):
    """Pages without end tags, with words of layout on their articles, and with parts inside lines."""
    model, line = fitted(labelled if trained else []), LINE.strip()
    for page, text in [
            ("<html><head><title>T</title><body><article><p>A text</p></article>", "A text"),
            ("<head><title>T</title>Plain text", "Plain text"),
            ("<head><meta x><p>A</p><head><p>B</p>", "A\nB"),
            (f"<article class='post has-comments'><p>{line}</p></article>", line),
            (f"<main class='form-page'><p>{line}</p></main>", line),
            (f"<div class='content no-sidebar'><p>{line}</p></div>", line),
            (f"<article><p>{line}</p></article><section id='comments'>"
             f"<article class='comment-body'><p>{LINE * 5}</p></article></section>", line),
            ("<p>Hello <script>1</script>world</p>", "Hello world"),
            ("<p>See <svg/> here</p>", "See here"),
            ("<p>Take <span class='notice'>good</span> care</p>", "Take care"),
            ("<p>a <b>b <span class='ad'>x<i>y</i></span> c</b> d<p>e</p>", "a b c d\ne"),
            ("<p>a <b>b</p><p>c</b> d</p>", "a b\nc d")]:
        assert main_text(model, page) == text, page


def test_parts_inside_a_line_that_are_content():
    """What is learned to be content stands where it stood."""
    model = Model(odds={"word:notice": 30.0})
    page = "<p>Take <span class='notice'>good <i>old</i></span> care <span class='ad'>x</span>.</p>"
    assert main_text(model, page) == "Take good old care ."


@pytest.mark.parametrize("page", ["<b>" * 100_000 + "</i>" * 100_000 + "text",
                                  "<p>" + "<b>" * 50_000 + "<li>x" * 50_000])
def test_broken_markup_is_read_in_proportion(page):
    begun = time.perf_counter()
    assert main_text(fitted([]), page).endswith(("text", "x"))
    assert time.perf_counter() - begun < 10
