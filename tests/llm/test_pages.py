import html
import json
import re

import pytest
from pyspark.sql import functions as F

from flowlens.llm import wrapper
from flowlens.llm.wrapper import _Known, extract, induce, matching, parse


def _article(page):
    """The text of the article element of the given tables' pages, by patterns alone."""
    body = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    return " ".join(html.unescape(re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", body))).split())


def test_pages_match_patterns(docs):
    pages = docs.sparkSession.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r for r in wrapper.main_texts(pages).collect()}
    rows = pages.collect()
    assert len(got) == len(rows)
    for r in rows:
        g = got[r["page_id"]]
        assert g["url"] == r["url"] and g["text"] == _article(r["html"]) and g["n_chars"] == len(g["text"])


def _site(k, body, extra=""):
    return f"""<html><head><title>t{k}</title><style>a{{}}</style></head><body>
    <div class="top-menu"><a href=/a>Home</a> <a href=/b>News {k}</a></div>
    <div id="cookie-notice">We use cookies {k}</div>
    <div class="story"><h2>Story {k}</h2>{body}<p>Read more on our site</p></div>{extra}
    <div class=c1><ul><li><a href=/1>Link {k} one</a></li><li><a href=/2>Link {k} two</a></li></ul></div>
    <form><input name=q><button>Go</button></form>
    <div class="comments"><p>Reader says {k}</p></div>
    <script>var x = "</div>";</script><div class="legal">All rights reserved by the site</div></body></html>"""


def test_wrapper_without_semantic_elements():
    """Constant nodes are template, varying ones content, link lists and marked blocks furniture."""
    pages = [_site(k, f"<p>First words of {k} &amp; more.</p><p>Second   part {k}<br>after break {k}</p>") for k in range(6)]
    known = _Known(json.loads(json.dumps(induce(pages))))
    new = _site(9, "<p>Unseen <i>in</i>line text.</p><table><tr><td>cell 9</td></tr></table>")
    assert extract(new, known) == "Story 9 Unseen inline text. cell 9"
    assert extract(pages[2], known) == "Story 2 First words of 2 & more. Second part 2 after break 2"


def test_copies_as_references_keep_their_article():
    page = "<body><nav><a href=x>m</a></nav><article><h1>Same</h1><p>The same article.</p></article></body>"
    known = _Known(induce([page + f"<!-- {k} -->" for k in range(8)]))
    assert extract(page, known) == "Same The same article."


@pytest.mark.parametrize("page, text", [
    ("", ""), ("plain text", "plain text"), ("<p>a<p>b", "a b"), ("<b>bo</b>ld", "bold"),
    ("<div>a<div>b</div>c</div>", "a b c"), ("x<br/>y&nbsp;z&#33;", "x y z!"),
    ("<p>a</b></div></p><i>c", "a c"), ("<ul><li>a<li>b</ul>", "a b"), ("<!-- no --><p>yes<!-- open", "yes"),
    ("<script>if (a < b) {}</script><p>q</p>", "q"), ("<article><header><h1>T</h1></header>B</article>out", "T B"),
    ("<p title='a > b'>t</p>", "t"), ("<nav>n</nav><footer>f</footer><aside>s</aside>k", "k"), ("a < b", "a < b"),
    ('<div class="post-header"><h1>Title</h1></div><p>x', "Title x"), ('<p class="share-price">5 euros</p>', "5 euros"),
    ('<section class="notice-period">Two weeks</section>', "Two weeks"), ("<p>a <math><mi>x</mi></math> b</p>", "a x b"),
    ("<p>See <a>the long report about everything</a>.</p><p>Plain.</p>", "See the long report about everything. Plain."),
    ('<div class="site-header">h</div><div id="cookie_notice-1">c</div><div class="share">s</div><div class="ad-top">a</div>k', "k"),
    ("<object>fallback</object>", "fallback"), ("<ul><li><a>one</a><li><a>two</a></ul>k", "k"),
    ("<table><tr><td>1<td>2<tr><td>3</table>", "1 2 3"), ("<p>a</p><style>b", "a"),
])
def test_odd_markup(page, text):
    assert extract(page, None) == text


def test_deep_nesting_does_not_fail():
    assert extract("<div>" * 300 + "x", None) == "x"
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000 + "<p>y"
    assert extract(deep, _Known(induce([deep, deep + "z", deep + "w"]))) == "x y"


def test_very_many_different_children():
    pages = ["".join(f"<div class='{'abcdefgh'[k % 8] * (k // 8 + 1)}'>text {k} {v}</div>" for k in range(1200))
             for v in range(3)]
    got = extract(pages[0], _Known(induce(pages)))
    assert got == " ".join(f"text {k} 0" for k in range(1200))
    assert extract("<a b='" * 50_000, None) is not None


def test_matching_is_the_best_order_keeping_one():
    weight = lambda a, b: len(a) if a == b else 0
    assert matching(["a", "bbb", "c"], ["bbb", "a", "c"], weight) == [(1, 0), (2, 2)]


def test_tree_of_broken_markup():
    root = parse("<div><p>one<div>two</div></div><p>three")
    assert [c.tag for c in root.children] == ["div", "p"]


def test_odd_page_rows(spark, docs):
    rows = [(1, None, "<p>a</p>"), (2, "http://h/1", None), (3, "not a url", "<nav>x</nav><p>b</p>"),
            (4, "http://h/2", ""), (4, "http://h/2", ""), (None, "http://h/3", "<p>" + "w " * 50_000 + "</p>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit("clash"))
    got = wrapper.main_texts(df).collect()
    by = {r["page_id"]: r for r in got}
    assert len(got) == 6 and by[1]["text"] == "a" and by[2]["text"] == "" and by[3]["text"] == "b"
    assert by[4]["n_chars"] == 0 and by[None]["n_chars"] == 99_999
    assert wrapper.main_texts(df.where("1 = 0")).count() == 0


def _layout(k, kind):
    """Pages of a site with four layouts: each has its own legal line and link list in unmarked elements."""
    links = "".join(f"<li><a href=/{kind}{j}>Link {kind} {j} of {k}</a></li>" for j in range(3))
    inner = f"<div>Legal line of {kind}</div><div><h2>Story {k}</h2><p>Some words of page {k} alone.</p><p>Read more</p></div>"
    return (f"<html><body><div class=page-{kind}>{inner}<ul>{links}</ul></div></body></html>",
            f"Story {k} Some words of page {k} alone.")


def test_every_layout_of_a_host_has_its_template(spark, docs):
    made = [_layout(k, "abcd"[k % 4]) for k in range(40)]
    rows = [(k, f"http://site.example/{k}", page) for k, (page, _) in enumerate(made)]
    rows += [(100 + k, "http://site.example/copy", made[3][0]) for k in range(60)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_texts(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert [got[k] for k in range(40)] == [text for _, text in made]
    assert all(got[100 + k] == made[3][1] for k in range(60))


def test_layouts_with_the_same_paths(spark, docs):
    """What is constant in a layout's slot is template, also where the same slot varies in other layouts."""
    def page(k):
        if k % 3:
            return f"<body><div>Words of page {k} alone</div><section><p>More words {k}</p></section></body>"
        return f"<body><div>Legal line</div><dl><dd>Story {k} is told here</dd></dl></body>"

    pages = [page(k) for k in range(30)]
    rows = [(k, f"http://x.example/{k}", p) for k, p in enumerate(pages)]
    got = {r["page_id"]: r["text"] for r in wrapper.main_texts(
        spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == "Story 3 is told here" and got[4] == "Words of page 4 alone More words 4"
    known = _Known(induce(pages))
    assert [extract(p, known) for p in pages] == [got[k] for k in range(30)]


def test_table_and_single_process_induce_alike(spark, docs):
    pages = [_layout(k, "ab"[k % 2])[0] for k in range(12)] + [_site(k, f"<p>w {k}</p>") for k in range(9)]
    df = spark.createDataFrame([(f"http://y.example/{k}", p) for k, p in enumerate(pages + pages[:5])], "url string, html string")
    got = wrapper.wrappers(df).collect()
    assert len(got) == 1 and got[0]["wrapper"].split() == induce(pages)


def test_deep_elements_are_closed_by_their_own_end_tags():
    deep = "<div>" * 160 + "inner" + "<nav>menu</nav><p class=comment>said</p>" + "</div>" * 160
    assert extract(f"<div id=page><article>before {deep} after</article>outside</div>", None) == "before inner after"


def test_many_named_siblings_are_aligned_exactly():
    """A constant line among hundreds of uniquely named siblings, first seen far down, is template."""
    def page(v):
        names = [f"<div class=x{'abcdefghij'[v]}{'abcdefghijklmnopqrst'[k % 20]}{'abcdefghijklmnopqrst'[k // 20]}>text {k} of {v}</div>"
                 for k in range(200)]
        lines = ["<div class=first>First line</div>", "<div class=last>Last line</div>"]
        return "".join([*names[:100], *(lines if v else lines[::-1]), *names[100:]])

    pages = [page(v) for v in range(8)]
    known = _Known(induce(pages))
    for v in range(8):
        assert extract(pages[v], known) == " ".join(f"text {k} of {v}" for k in range(200))


@pytest.mark.parametrize("part, end", [("<div>", "</p>"), ("<h2>", ""), ("<i><div><b>", "</i>"), ("<span>", "</div><p>")])
def test_deep_broken_markup_takes_linear_time(part, end):
    assert extract("<p>x" + part * 20_000 + "y" + end * 20_000, None).replace(" ", "") == "xy"
