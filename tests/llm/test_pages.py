import itertools
import math

import numpy as np
import pytest

from geoqa.llm import op2_html as M
from geoqa.llm.html_pages import _Page


@pytest.fixture(scope="module")
def model():
    return M.train(M.labelled_pages(400))


def texts(page):
    t = M.parse(page)
    return [(t.tag[t.parent[i]], s) for i, s in enumerate(t.text) if s is not None]


def test_parser():
    assert texts("<p>a &amp; b<br>c  <b>d</b>e<p>f") == [("p", "a & b c de"), ("p", "f")]
    assert texts("<script>var x='<p>no</p>';</script><style>p{}</style><!-- <p>no --><div>yes &am") == [("div", "yes &am")]
    assert texts("<ul><li>one<li>two <i>x</i></ul>tail") == [("li", "one"), ("li", "two x"), ("body", "tail")]
    assert texts("<title>no</title><p title='a > b'>x &lt; y &#233;&nbsp;z</p></div></p>") == [("p", "x < y é z")]
    assert texts("1 < 2 <p") == [("body", "1 < 2")] and texts("") == [] and texts("a<b>b<div>c</b>d</div>e") == [("body", "ab"), ("div", "cd"), ("body", "e")]
    assert texts("<table><tr><td>1<td>2<tr><td>3</table>") == [("td", "1"), ("td", "2"), ("td", "3")]
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    assert texts(deep) == [("div", "x")]


def test_embedded_tags_drop_no_text():
    article = "<p>one</p>two"
    after = [("p", "one"), ("body", "two")]
    for tag in ("svg", "math", "object", "iframe", "template", "noscript", "xmp"):
        assert [s for _, s in texts(f"<{tag} class=icon>{article}")] == ["one", "two"], tag  # never closed
        assert [s for _, s in texts(f"<{tag}><p>in</p></{tag}>{article}")] == ["in", "one", "two"], tag
    for tag in ("<svg class=icon/>", '<svg class="icon" />', "<math/>", "<svg><path d='M0'/><style/></svg>", "<svg><title>no</title><g><path/></g></svg>"):
        assert texts(tag + article) == texts(tag + article + "<svg></svg>") == after, tag
        assert texts(f"<p>a {tag} b</p>{article}") == [("p", "a b"), *after], tag
    assert texts("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == [("p", "so x=2 holds")]
    assert texts("<object data=x><p>in</p></object><noscript>also</noscript>") == [("p", "in"), ("noscript", "also")]
    for tag in ("script", "style", "textarea", "title"):
        assert texts(f"<p>a</p><{tag}>no<p>no</p>") == [("p", "a")]


def test_marginals_equal_enumeration():
    r = np.random.default_rng(2)
    trees = [M.parse(_Page(s).page()) for s in range(40)]
    small = [t for t in trees if len(t.parent) <= 13][:3] or [M.parse("<div><p>a</p><ul><li>b<li>c</ul></div><p>d</p>")]
    small.append(M.parse("<div><p>a</p><ul><li>b<li>c</ul></div><p>d</p>"))
    f = M.forest(small)
    model = M.Model(r.normal(0, 1, M.N_FEATURES), r.normal(0, 1, (4, 2, 2)))
    p, pair, logz = M.marginals(f, model)
    score = np.bincount(f.node, model.weight[f.feature], len(f.parent))
    for k in range(len(small)):
        nodes = np.flatnonzero(f.page == k)
        total, one = 0.0, np.zeros(len(nodes))
        for y in itertools.product((0, 1), repeat=len(nodes)):
            at = dict(zip(nodes.tolist(), y))
            s = sum(score[i] * at[i] for i in nodes) + sum(model.edge[f.group[i], at[f.parent[i]], at[i]] for i in nodes if f.parent[i] >= 0)
            total += math.exp(s)
            one += math.exp(s) * np.array(y)
        assert np.allclose(p[nodes], one / total) and abs(logz[k] - math.log(total)) < 1e-9


def test_held_out_layouts(model):
    pages = [_Page(50_000 + i).page() for i in range(200)]
    trees = [M.parse(p) for p in pages]
    f = M.forest(trees)
    p, _, _ = M.marginals(f, model)
    assert ((p > 0.5) == M.labels_of(trees))[f.leaf].mean() > 0.98


def test_extract(spark, model):
    article = "<article><h1>Title &amp; more</h1><p>First  paragraph,\n with <b>bold</b> words and a comma.</p><p>Second one; it goes on for a while.</p></article>"
    page = (f'<html><head><title>t</title></head><body><nav><ul><li><a href=/>Home</a></li></ul></nav><div class="ad">Buy now.</div>{article}'
            '<section class="comments"><h3>Comments</h3><div class="comment"><p>I like it, thanks.</p></div></section><footer>&copy; example</footer></body></html>')
    want = "Title & more First paragraph, with bold words and a comma. Second one; it goes on for a while."
    rows = [(1, "http://a", page), (2, None, None), (3, "u", ""), (None, "u", page), (5, "u", "<nav><a href=/>x</a></nav>"), (1, "http://a", page),
            (6, "u", page.replace("<article>", "<article>" + "<p>Much more text, again and again.</p>" * 20000))]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, id string, text string")
    got = M.extract(df, model=model).collect()
    assert sorted((str(r.id), str(r.url), r.text) for r in got if r.id != 6) == sorted(
        [("1", "http://a", want), ("1", "http://a", want), ("2", "None", ""), ("3", "u", ""), ("None", "u", want), ("5", "u", "")])
    assert all(r.n_chars == len(r.text) for r in got) and [r.n_chars > 500_000 for r in got if r.id == 6] == [True]
    assert M.extract(df.limit(0), model=model).count() == 0
