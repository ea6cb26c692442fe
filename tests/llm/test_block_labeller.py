import time

import numpy as np
import pytest

from planlens.llm import block_labeller as bl
from planlens.llm.html_blocks import blocks
from planlens.llm.queries import op10_block_labeller


def texts(page):
    return [b.text for b in blocks(page)]


def test_blocks_of_odd_markup():
    assert texts("<p>a <b>b</b>c<br>d\n\n e<p>f") == ["a bc d e", "f"]
    assert texts('x<script>var t="</p>";</script>y<style>p{}</style><!-- z --> w') == ["xy w"]
    assert texts("&lt;p&gt; &amp;amp; &nbsp;&eacute; &am") == ["<p> &amp; é &am"]
    assert texts('<a title="a > b" href=x>in</a> 1 < 2 <unclosed') == ["in 1 < 2"]
    assert texts("") == texts(None) == texts("<p> </p>&nbsp;") == []
    assert texts("<script>never closed <p>text") == []
    (block,) = blocks('<div class="Side-bar" id=x1><ul><li><a>one</a> two')
    assert block.path == ("div", "@side", "@bar", "@x", "@1", "ul", "li", "a") and block.linked == 3
    assert len(blocks("<p>" * 3000 + "deep")) == 1


def test_drawings_and_formulas_drop_no_text():
    assert texts('<p>one</p><svg class="i"/><p>two</p>') == ["one", "two"]
    assert texts("<p>one <svg width=1 /> on</p><svg><path d=''/></svg><p>two</p>") == ["one on", "two"]
    assert texts("<p>one</p><svg><g><p>two</p><svg><title>t</title></svg><p>three</p>") == ["one", "two", "three"]
    assert texts("<p>one</p><object data=x><p>two</p>") == ["one", "two"]
    assert texts("<p>a<object data=x>no plug-in</object>b<p>two") == ["ab", "two"]
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mspace/><mn>2</mn></math> holds</p><math/><p>two") == [
        "so x=2 holds", "two"]
    (block,) = blocks("<math/><p>two")
    assert block.path == ("p",)


def test_gradients_are_those_of_the_loss():
    pages = [blocks("<nav>a b</nav><p>text, more.</p><p>x</p>"), blocks("<p>one</p>")]
    target = np.array([0, 1, 0, 1], np.float32)
    net = bl.Labeller()
    for k in net.w:
        net.w[k] = net.w[k].astype(np.float64)
    described = bl.describe(pages)
    rows = np.arange(2)
    grad = net.gradients(described, rows, target)

    def loss():
        p = net.chances(described)
        return -np.mean(target * np.log(p) + (1 - target) * np.log(1 - p))

    rng = np.random.default_rng(0)
    for name in ("xf", "hb", "cf", "out", "path"):
        flat = net.w[name].reshape(-1)
        used = np.flatnonzero(np.abs(grad[name].reshape(-1)) > 1e-4)
        for at in rng.choice(used, 3):
            kept = flat[at]
            flat[at] = kept + 1e-3
            up = loss()
            flat[at] = kept - 1e-3
            down = loss()
            flat[at] = kept
            assert grad[name].reshape(-1)[at] == pytest.approx((up - down) / 2e-3, rel=0.05, abs=2e-4)


@pytest.fixture(scope="module")
def net(tables):
    return bl.learn(tables("pages"))


def test_pages_do_not_depend_on_their_batch(net):
    pages = [blocks(f"<nav>m</nav>{'<p>words of a text.</p>' * n}<footer>f</footer>") for n in (0, 3, 40)]
    together = bl.describe(pages)
    p = net.chances(together)
    for page, lo, hi in zip(pages, together.bounds[:-1], together.bounds[1:]):
        np.testing.assert_allclose(net.chances(bl.describe([page])), p[lo:hi], atol=1e-5)


def test_layouts_never_seen(net, tables):
    real = [blocks(r.html) for r in tables("pages").collect()]
    drawn, marks = bl.layouts(real, [bl.marked_labels(p) for p in real], count=1400)
    p = net.chances(bl.describe(drawn[-400:])) >= bl.MAIN
    assert np.mean(p == np.array([v for m in marks[-400:] for v in m])) >= 0.98


def test_article_of_every_page(spark):
    rows = op10_block_labeller(spark, "/root/testdata/sf0.01").collect()
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    assert len(rows) == len(pages)
    right = 0
    for r in rows:
        page = blocks(pages[r.page_id].html)
        expected = "\n\n".join(b.text for b, v in zip(page, bl.marked_labels(page)) if v)
        right += r.text == expected
        assert r.n_chars == len(r.text) and r.url == pages[r.page_id].url
    assert right >= 0.98 * len(rows)


def test_written_page(net):
    page = """<html><head><title>T</title></head><body><header><a href=/>Site</a></header>
    <div class="cookie-notice">We use cookies.</div><nav><ul><li><a href=/a>Home</a><li><a href=/b>News</a></ul></nav>
    <article><h1>The heading</h1><p>First paragraph of the article, with words.</p>
    <div class="ad">Buy now!</div><p>Second &amp; last paragraph of it.</p></article>
    <div class="comments"><div class="comment"><p>I do not agree.</p></div></div>
    <aside class="sidebar"><a href=/c>Most read</a></aside><footer>Copyright</footer></body></html>"""
    found = blocks(page)
    p = net.chances(bl.describe([found])) >= bl.MAIN
    assert [b.text for b, v in zip(found, p) if v] == [
        "The heading", "First paragraph of the article, with words.", "Second & last paragraph of it."]


def test_edge_rows(spark, net):
    odd = spark.createDataFrame(
        [(1, "u", None, 1), (None, None, "", 1), (2, "u", "<article><p>" + "word " * 200000 + "</p></article>", 1),
         (3, "u", "<article><p>same</p></article>", 1), (3, "u", "<article><p>same</p></article>", 1)],
        "page_id long, url string, html string, text int",
    )
    rows = bl.extract(odd, net).collect()
    assert [r.text for r in rows[:2]] == ["", ""] and rows[3] == rows[4]
    assert rows[2].n_chars in (0, 999_999)
    assert bl.extract(odd.limit(0), net).collect() == []
    assert bl.extract(odd, bl.learn(odd.limit(0), epochs=1)).count() == 5


@pytest.mark.parametrize("page, expected", [
    ("<p>a<!-- x --!>b", ["ab"]),
    ("<p>a<!-->b", ["ab"]),
    ("<p>a<script>x</script data>b", ["ab"]),
    ("<p data-x=it's>one</p><p>it's two</p>", ["one", "it's two"]),
    ("<p title='a>b'>c", ["c"]),
    ('<p title="a>b>c</p><p>d</p>', ["b>c", "d"]),
    ("x < y", ["x < y"]),
    ("<p>one<p", ["one"]),
])
def test_tags_as_browsers_read_them(page, expected):
    assert [b.text for b in blocks(page)] == expected


@pytest.mark.parametrize("unit", [
    "<svg ", "<a ", "<svg>", "<object><svg>", "<!-- ", "<!", "<script ", "</", '<a b="', "<a b='x\">", "< ",
    "<a =", '<b c="> ', "<a\t\t\t", "<a b = ", "<p x='",
])
def test_parsing_takes_linear_time(unit):
    start = time.process_time()
    blocks(unit * (500_000 // len(unit)))
    assert time.process_time() - start < 5
