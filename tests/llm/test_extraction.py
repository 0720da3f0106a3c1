import html
import re

import pyarrow.parquet as pq
import pytest
from llm_helpers import SMALL

from raremine.llm import extraction, queries


def blocks(page):
    return [t for t, _ in extraction.Page(page, {}).blocks]


def test_blocks_and_references():
    page = "<p>a &amp;  b\n<b>c</b>d<br>e<p>&lt;x&gt; &eacute;&#8364;</p>tail<ul><li>1<li>2</ul><table><tr><td>x<td>y</table>"
    assert blocks(page) == ["a & b cd e", "<x> é€", "tail", "1", "2", "x", "y"]


def test_boilerplate_by_name():
    page = """<head><title>t</title><style>p{}</style></head><body><header>top</header><nav><a>m</a></nav><div class="cookie-notice">c</div>
    <article><header><h1>Title</h1></header><script>var t="</p><p>no";</script><p>one<p class="AdSlot">buy</p><p>two <span id="share-bar">s</span>!</p>
    <section class="comments"><p>reader</p></section><form>f<input></form></article><aside>side</aside><footer>foot</footer>"""
    assert blocks(page) == ["Title", "one", "two !"]


@pytest.mark.parametrize("page, want", [
    ("<div id='content' class='has-sidebar'><p>a</p></div>", ["a"]), ("<div class='no-sidebar comments-open'><p>a</p></div><p>b</p>", ["a", "b"]),
    ("<form><div><p>all of the text</p></div></form><p>b</p>", ["all of the text", "b"]), ("<p>more of the text here</p><form><p>a</p></form>", ["more of the text here"]),
    ("<div class='widget'><article>a</article></div>", ["a"]), ("<div class='sidebar'><p>most of the text</p></div><p>b</p>", ["most of the text", "b"]),
    ("<article>a<section id='related-work'>b</section><h2 id='search-algorithms'>c</h2><h2 id='search'>d</h2><section id='comments'>e</section></article>", list("abcde")),
    ("<article>a<div class='comments'>all that the readers wrote<article>x</article></div></article>", ["a"]),
    ("<article>a</article><div class='comments'>all that the readers wrote</div>", ["a"]), ("<article>a<div class='related-posts'>b</div></article>", ["a"]),
    ("<nav><p>many many words of a menu</p></nav><p>a</p>", ["a"])])
def test_names_are_a_hint(page, want):
    assert blocks(f"<body>{page}</body>") == want


@pytest.mark.parametrize("page", ["", "<", "<p", "</p></div>", "<!-- never ends <p>x", "<script>x", "<a href='x>y", "<p>" * 3000 + "x", "<div>" * 2000,
                                  "<b <p>x", "a < b > c", "<!DOCTYPE html>", "<p>x</P>y", "\0<p>\0", "<p a='1\"2'>x"])
def test_broken_pages_do_not_crash(page):
    extraction.Page(page, {}).own_slot()
    extraction._page_tokens(extraction.Page(page, {}))


def build(spark, rows):
    return spark.createDataFrame([(i, u, h, 1) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, text int")


def test_template_of_a_host_without_article_elements(spark):
    rows = []
    for i in range(24):
        paragraphs = "".join(f"<p>own words {i} {k} " + "x" * 40 + "</p>" for k in range(1 + i % 4))
        rows.append((f"http://One.example/{i}", f"<html><body><div id='top'><a href='/{i}'>link {i}</a></div><div class='wrap'><div class='body{i}'>"
                     f"<p>All the news</p><h2>Head {i}</h2>{paragraphs}</div></div><div class='r'>Read next {i}</div></body></html>"))
    rows += [("http://two.example/", "<body>alone<p>here</body>"), (None, "<main>m</main>x"), ("no url", None), ("http://two.example/", "")]
    got = {r.page_id: r.text for r in extraction.extract_text(build(spark, rows)).collect()}
    for i in range(24):
        assert got[i] == "\n".join([f"Head {i}"] + [f"own words {i} {k} " + "x" * 40 for k in range(1 + i % 4)])
    assert [got[k] for k in range(24, 28)] == ["alone\nhere", "m", "", ""]


@pytest.mark.parametrize("n", [4, 9, 10, 25])
def test_template_text_of_nested_classes_goes(spark, n):
    """A notice on every page, a box on most of the pages and one that stands twice a page, on hosts of any size."""
    rows, want = [], {}
    for i in range(n):
        box = "<div class='bx'><b>Box title</b><p>Read our letter</p></div>" if 4 * i < 3 * n else ""
        twice = "<div class='tw'><p>Up to the top</p></div>"
        own = [f"own words {i} {k} " + "x" * 60 for k in range(2 + i % 3)]
        rows.append((f"http://n.example/{i}", f"<body><div class='c'><p>All the news</p>{twice}<h2>Head {i}</h2>{''.join(f'<p>{p}</p>' for p in own)}{box}{twice}</div></body>"))
        want[i] = "\n".join([f"Head {i}"] + own)
    got = {r.page_id: r.text for r in extraction.extract_text(build(spark, rows)).collect()}
    assert got == want


def test_copies_of_a_page_keep_their_text(spark):
    """Pages that are copies share their articles, which are no template; what stands on all pages is."""
    page = "<body><div class='c'><p>All the news</p>{}</div></body>"
    article = "".join(f"<p>the same long paragraph {k} {'y' * 50}</p>" for k in range(5))
    texts = [article] * 5 + ["".join(f"<p>other {i} {k} {'z' * 50}</p>" for k in range(5)) for i in range(3)]
    rows = [(f"http://c.example/{i}", page.format(t)) for i, t in enumerate(texts)]
    rows += [(f"http://two.example/{i}", page.format(article)) for i in range(2)]
    got = {r.page_id: r.text.split("\n") for r in extraction.extract_text(build(spark, rows)).collect()}
    for i, t in enumerate(texts):
        assert got[i] == re.findall("<p>(.*?)</p>", t)
    for i in (8, 9):
        assert got[i][1:] == re.findall("<p>(.*?)</p>", article)


def test_named_element_that_holds_the_slot_stays_on_every_page(spark):
    rows = [(f"http://s.example/{i}", f"<body><div id='a'>{'words around ' * (8 if i == 3 else 1)}{i}</div><div class='widget'><p>article {i} "
             f"{'text ' * (2 if i == 3 else 30)}</p><p>more {i}</p><section id='comments'>section {i}</section></div></body>") for i in range(6)]
    got = {r.page_id: r.text for r in extraction.extract_text(build(spark, rows)).collect()}
    assert got == {i: f"article {i} " + " ".join(["text"] * (2 if i == 3 else 30)) + f"\nmore {i}\nsection {i}" for i in range(6)}


def test_repeated_pages_and_empty(spark):
    df = build(spark, [("http://a.b/c", "<article><p>x &copy;</p></article>y")] * 5)
    assert [(r.text, r.n_chars) for r in extraction.extract_text(df).collect()] == [("x ©", 3)] * 5
    assert extraction.extract_text(df.limit(0)).count() == 0


def test_query_on_the_page_table(spark):
    src = {r["page_id"]: r for r in pq.read_table(f"{SMALL}/pages.parquet").to_pylist()}
    out = queries.op7_extraction(spark, SMALL).collect()
    assert len(out) == len(src)
    for r in out:
        inner = re.search("<article>(.*?)</article>", src[r.page_id]["html"], re.S)[1]
        parts = (" ".join(html.unescape(re.sub("<[^>]*>", "", b)).split()) for b in re.split("</?(?:p|h1)>", inner))
        want = "\n".join(p for p in parts if p)
        assert (r.url, r.text, r.n_chars) == (src[r.page_id]["url"], want, len(want))


def test_formulas_code_and_fallbacks_are_text():
    html = ("<html><body><nav>menu</nav><article><p>Energy is <math><mi>E</mi><mo>=</mo><mi>m</mi><annotation encoding='tex'>E=m</annotation></math> here</p>"
            "<xmp>a < b &amp; <b>c</b></xmp><p>An <object data='x'>old <i>plug-in</i></object> too.</p>"
            "<script>no()</script><svg><text>no</text></svg></article></body></html>")
    page = extraction.Page(html, {})
    assert "\n".join(page.inside(page.own_slot())) == "Energy is E=m here\na < b &amp; <b>c</b>\nAn old plug-in too."


def test_hostile_pages_take_linear_time():
    """A megabyte of stray end tags, open headers, list items between deep
    elements, unclosed cells."""
    import time

    for piece, tail in (("<div></x>", ""), ("<header>", ""), ("<td>x", ""), ("<li></li>", ""), ("<p></div>", ""), ("<article><header>a", "</article>")):
        deep = "<li><ul>" + "<div>" * 20_000 if piece.startswith("<li") else ""
        html = deep + piece * (1_000_000 // len(piece)) + tail
        began = time.process_time()
        page = extraction.Page(html, {})
        page.inside(page.own_slot())
        assert time.process_time() - began < 12, piece
