"""Page leaves by example; the labeller's gradients by differences; its labels on layouts and pages it was not trained on."""

import random

import numpy as np
import pytest

from tesserae.llm import html_extract, queries
from tesserae.llm.html_extract import Labeller, by_markup, extract, learn, train
from tesserae.llm.html_layouts import Layout, marked
from tesserae.llm.html_leaves import Page, leaves

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def pages(spark):
    return spark.read.parquet(f"{SF}/pages.parquet")


@pytest.fixture(scope="module")
def labeller(pages):
    return learn(pages)


@pytest.mark.parametrize(
    "html,texts",
    [
        ("", []),
        ("plain &amp; &lt;b&gt; &#233; &eacute &nosuch; &am", ["plain & <b> é é &nosuch; &am"]),
        ("<p>a<b>b</b>c<br>d\n\t e&nbsp;f</p><p>g", ["abc d e f", "g"]),
        ("<p><b>open<br><p>next</p>", ["open", "next"]),
        ("<title>t</title><style>p{}</style><script>var t='</p>';if(a<b)x();</script>x<!-- c <p> --><textarea>q</textarea>y", ["xy"]),
        ("a<script>never closed <p>b", ["a"]),
        ("a<!-- never closed <p>b", ["a"]),
        ("a <p title='x>y' class=\"q>\">b</p>", ["a", "b"]),
        ("1 < 2 <3 a<", ["1 < 2 <3 a<"]),
        ("a<p class='open>b</p>c", ["a", "b", "c"]),
        ("<ul><li>a<li>b<ul><li>c</ul>d</ul>e", ["a", "b", "c", "d", "e"]),
        ("<table><tr><td>a<td>b<tr><td>c</table>", ["a", "b", "c"]),
        ("</p></nope>a</div>", ["a"]),
        ("<P>A</P><DIV>B</DIV>", ["A", "B"]),
        ("<p>　 \x00x\ud800</p>", ["\x00x\ud800"]),
        ("<p>cut <a href='x", ["cut"]),
    ],
)
def test_leaves(html, texts):
    assert [x.text for x in leaves(html)] == texts


def test_paths():
    a, b = leaves("<nav class='Main-menu'><ul><li><a href=x>one</a> two</ul></nav><article id=x><b>open<p>text")[:2]
    assert a.tags == ("nav", "ul", "li", "a") and a.linked == 3 and b.tags == ("article", "b")
    assert leaves("<article><p><b>open<p>text")[1].tags == ("article", "p")
    assert len(set(leaves("<div class='a-b c' id='d'>t")[0].path)) == 7  # div, a, b, c, d; the innermost tag, the path of tags


def test_long_pages_in_linear_time():
    assert len(leaves("<div>" * 3_000 + "x" + "<p>y" * 100_000)) == 100_001
    assert len(leaves("<a '" * 50_000)) <= 1
    assert len(leaves("&amp; < " * 300_000)) == 1


def test_gradients():
    """Every kind of weight against differences of the loss, in double precision, on pages of different lengths."""
    r = random.Random(1)
    made = [marked(Layout(r, ["Some words. Others here", "A second text of a few more words."]).html()) for _ in range(3)]
    pages, truth = [Page(x) for x, _ in made], np.array([t for _, ts in made for t in ts])
    model = Labeller(3, kind=np.float64)
    model.begin(pages)
    _, grad = model.gradients(pages, truth)
    g = np.random.default_rng(0)
    for name, w in model.w.items():
        near = np.argwhere(np.abs(grad[name]) > 1e-5)
        for at in map(tuple, near[g.permutation(len(near))[:6]]):
            old, step = w[at], 1e-6
            w[at] = old + step
            up = model.gradients(pages, truth)[0]
            w[at] = old - step
            down = model.gradients(pages, truth)[0]
            w[at] = old
            assert grad[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7), (name, at)


def test_padding_and_company_change_nothing():
    r = random.Random(2)
    pages = [Page(marked(Layout(r, ["Some words. Others here"]).html())[0]) for _ in range(9)]
    model = Labeller(4)
    model.begin(pages)
    alone = [model.label([p])[0] for p in pages]
    assert all(np.allclose(a, b, atol=1e-5) for a, b in zip(alone, model.label([*pages, Page([])]), strict=False))


def test_context_decides(labeller):
    """The same leaf is labelled by what stands around it."""
    text = "This is a sentence of some length, and it says a thing."
    article = f"<body><div class=content><h1>Head</h1><p>{text}</p><p>{text}</p><p>{text}</p></div></body>"
    comment = f"<body><div class=content><h1>Head</h1><p>{text}</p></div><div class=comments><h3>2 comments</h3><p>{text}</p><p>{text}</p></div></body>"
    a, c = (labeller.label([Page(leaves(h))])[0] >= 0.5 for h in (article, comment))
    assert a.tolist() == [True] * 4 and c.tolist() == [True, True, False, False, False]


def test_held_out_layouts(pages, labeller):
    """Layouts of another seed, with texts that training did not see."""
    htmls = [r["html"] for r in pages.orderBy("page_id").collect()]
    texts = [x.text for h in htmls[::3] for x in leaves(h)]
    r = random.Random(99)
    made = [marked(Layout(r, texts).html()) for _ in range(300)]
    found = labeller.label([Page(x) for x, _ in made])
    hit = sum(int(((s >= 0.5) & np.array(t)).sum()) for s, (_, t) in zip(found, made, strict=True))
    said, there = sum(int((s >= 0.5).sum()) for s in found), sum(sum(t) for _, t in made)
    assert hit / said > 0.98 and hit / there > 0.98


def test_query(spark, pages):
    """Every page of the table gives what its own markup calls the article, and nothing else."""
    rows = {r["page_id"]: r for r in queries.op13_html_extract(spark, SF).collect()}
    wrong = 0
    for r in pages.collect():
        found = leaves(r["html"])
        want = " ".join(x.text for x, y in zip(found, by_markup(found), strict=True) if y)
        got = rows.pop(r["page_id"])
        assert got["url"] == r["url"] and got["n_chars"] == len(got["text"])
        wrong += got["text"] != want
    assert not rows and wrong <= 1


def test_edge_cases(spark, labeller):
    schema = "page_id long, url string, html string, row string, `a b` string, `a.b` string, TEXT string, n_blocks string"
    cases = [(1, "u", None), (2, None, ""), (None, "u", "<article><p>Some text of an article, which is long enough.</p></article>"), (4, "u", "<nav>x</nav>"), (5, "u", "<article>" + "<p>One more paragraph of the article stands here.</p>" * 30_000), (6, "u", "&#0;&#x110000;\x00")]
    cases.append(cases[2])
    found = extract(spark.createDataFrame([(*c, "r", "s", "t", "u", "v") for c in cases], schema).repartition(2), labeller)
    got = sorted(((r["row"]["page_id"], r["text"], r["n_chars"], r["n_blocks"], len(r["blocks"]), len(r["scores"])) for r in found.collect()), key=repr)
    assert [x for x in got if x[0] in (1, 2)] == [(1, "", 0, 0, 0, 0), (2, "", 0, 0, 0, 0)]
    assert [x[1] for x in got if x[0] is None] == ["Some text of an article, which is long enough."] * 2
    long = next(x for x in got if x[0] == 5)
    assert long[3] == long[5] == 30_000 and long[4] > 29_900 and found.first()["row"]["a.b"] == "t"
    assert extract(spark.createDataFrame([], schema), labeller).count() == 0


def test_without_pages(spark):
    """A table without pages still gives a labeller, and none of its pages is needed."""
    assert train([], layouts=40).label([Page([])])[0].size == 0
    assert html_extract.learn(spark.createDataFrame([], "html string"), layouts=40).w["out"].shape[1] == 1
