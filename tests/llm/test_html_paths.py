"""Main-text extraction: given pages against a plain reading of their markup, and pages of other makes."""

import html
import random
import re
import time

import pytest

from tessera.llm.html_paths import extract, main_text

RNG = random.Random(6)
SENTENCES = [" ".join(RNG.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(RNG.randint(4, 18))).capitalize() + RNG.choice(".!?") for _ in range(60)]
PARAGRAPHS = [" ".join(SENTENCES[i : i + 3]) for i in range(0, 60, 3)]


def body(paragraphs, tag="p"):
    return "".join(f"<{tag}>{p}</{tag}>" for p in paragraphs)


MENU = "<ul>" + "".join(f'<li><a href="/{w}">{w.title()}</a></li>' for w in "home news sport about contact".split()) + "</ul>"
FOOT = "<p>&copy; 2024 Example Ltd. All rights reserved.</p>"
REMARKS = "".join(f"<p>{s}</p>" for s in SENTENCES[40:48])


@pytest.mark.parametrize("paragraphs", [PARAGRAPHS[:6], PARAGRAPHS[:1], ["Tiny."], ["Of.", PARAGRAPHS[0], "End."]])
@pytest.mark.parametrize(
    "page",
    [
        "<nav>{menu}</nav><article>{text}</article><footer>{foot}</footer>",
        "<header><h1>Site</h1>{menu}</header><main><article>{text}</article></main><aside>{remarks}</aside><footer>{foot}</footer>",
        "<div class='nav-bar'>{menu}</div><div id='main-content'>{text}</div><div class='sidebar'>{remarks}</div><div id='footer'>{foot}</div>",
        "<div role='navigation'>{menu}</div><div class='post'>{text}</div><section class='comments-list'>{remarks}</section><div role='contentinfo'>{foot}</div>",
        "<main>{text}<section id='comments'><article class='comment'>{remarks}</article></section><form><p>Write to us now, please.</p><input><textarea>x < y</textarea></form></main>",
        "<div class='cookieNotice'>We use cookies. Accept them, please.</div><article>{text}<div class='ad'>Buy now! Cheap.</div><script>var x='<p>no</p>'</script><style>p > a</style></article>",
        "<table><tr><td class='menu'>{menu}<td class='text'>{text}<tr><td colspan=2 class=footer>{foot}</table>",
        "<!-- a > b <p>no</p> --><div hidden>{remarks}</div><div style='display: none'>{remarks}</div><article title='a > b'>{text}</article><noscript>No.</noscript>",
    ],
)
def test_pages_of_many_makes(page, paragraphs):
    made = page.format(menu=MENU, foot=FOOT, remarks=REMARKS, text=body(paragraphs))
    assert main_text(f"<!DOCTYPE html><html><head><title>T. x</title></head><body class='has-sidebar'>{made}</body></html>") == "\n".join(paragraphs)


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""),
        ("", ""),
        ("<html><body></body></html>", ""),
        ("just  words &amp; no\ttags", "just words & no tags"),
        ("<p>a &lt;b&gt; &eacute;&#233;&#x1F600; &nosuch; c</p>", "a <b> éé😀 &nosuch; c"),
        ("<p>one\n  <b>two</b><i>three</i>&nbsp;four<br>five</p>", "one twothree four five"),
        ("<article><p>unclosed one<p>unclosed <b>two<p>three</article>", "unclosed one\nunclosed two\nthree"),
        ("<article><ul><li>first<ul><li>inner</ul><li>second</ul></article>", "first\ninner\nsecond"),
        ("<article><p>before<!-- never closed <p>after", "before"),
        ("<article><p>3 < 5 and 5 > 3 <i <p>x</i></p></article>", "3 < 5 and 5 > 3 x"),
        ('<article><p title="it\'s > that">q</p><p title="open>r</p></article>', "q\nr"),
        ("<article><p>&#0000000065;&#99999999999;&#x110000;</p></article>", "A\ufffd\ufffd"),
        ("<article><SCRIPT>if (a</b) {}</SCRIPT ><P>Big</P></ARTICLE>", "Big"),
    ],
)
def test_markup(page, text):
    assert main_text(page) == text


@pytest.mark.parametrize("n", [5, 20, 200])
@pytest.mark.parametrize("around", ["article", "main"])
def test_long_lists_tables_and_code_in_regions(around, n):
    items = [f"item {i} of a short list" for i in range(n)]
    cells = [f"cell {i}" for i in range(n)]
    made = body(PARAGRAPHS[:4]) + f"<ul>{body(items, 'li')}</ul><table><tr>{body(cells, 'td')}</table><pre>x = 1</pre>" + body(PARAGRAPHS[4:8])
    assert main_text(f"<nav>{MENU}</nav><{around}>{made}</{around}><footer>{FOOT}</footer>") == "\n".join([*PARAGRAPHS[:4], *items, *cells, "x = 1", *PARAGRAPHS[4:8]])


@pytest.mark.parametrize("tag", ["div class='layout has-sidebar'", "div class='content with-header'", "div id='page-with-nav'", "div class='post share-enabled'", "form action='/x'"])
@pytest.mark.parametrize("inside", ["<article>{}</article>", "<div>{}</div>"])
def test_wrappers_and_formulas_are_kept(tag, inside):
    made = inside.format(body(PARAGRAPHS[:4]) + "<p>Let <math><mi>x</mi></math> be.</p>")
    assert main_text(f"<{tag}>{made}<div class='sidebar'>{REMARKS}</div></{tag.split()[0]}>") == "\n".join([*PARAGRAPHS[:4], "Let x be."])


@pytest.mark.parametrize(
    "extra",
    [
        f"<p class='share price'>{PARAGRAPHS[5]}</p>", f"<section class='social history'><p>{PARAGRAPHS[6]}</p></section>", f"<p hidden>{PARAGRAPHS[7]}</p>",
        "<ul>" + "".join(f"<li><a href='/{i}'>see also {i}</a></li>" for i in range(12)) + "</ul>",
    ],
)
def test_article_text_stays_whatever_its_classes(extra):
    made = body(PARAGRAPHS[:3]) + extra + body(PARAGRAPHS[3:5])
    plain = [x for x in re.sub("<[^>]*>", "\n", extra).split("\n") if x]
    small = "<div class='share'><a href='/x'>Share</a></div><div class='newsletter'>Get our mail.</div>"
    for tag in ("article", "main"):
        assert main_text(f"<nav>{MENU}</nav><{tag}>{made}{small}</{tag}><footer>{FOOT}</footer>") == "\n".join([*PARAGRAPHS[:3], *plain, *PARAGRAPHS[3:5]])


def test_ratios_decide_where_nothing_is_named():
    page = f"<div><div>{MENU}</div><div class='x1'>{body(PARAGRAPHS[:5])}</div>{body(['Home', 'Imprint', 'Help', 'Terms', 'Top', 'Map'], 'div')}</div>"
    assert main_text(page) == "\n".join(PARAGRAPHS[:5])
    assert main_text(page, threshold=0) != main_text(page)
    named = f"<nav>{MENU}</nav><article>{body(PARAGRAPHS[:5])}</article><footer>{FOOT}</footer>"
    assert main_text(named) == "\n".join(PARAGRAPHS[:5]) and "rights" in main_text(named, threshold=0)


@pytest.mark.parametrize("tag", ["div class='sidebar'", "div id='footer'", "form", "div hidden", "header"])
def test_a_page_that_is_all_in_one_named_element(tag):
    assert main_text(f"<{tag}>{body(PARAGRAPHS[:4])}</{tag.split()[0]}>") == "\n".join(PARAGRAPHS[:4])


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 60_000 + "</b>" * 60_000 + "</section>" * 60_000, '<a "' * 250_000, "<div>" * 200_000, '<a ">" ' * 150_000 + '"', "<!" * 500_000, "<!-- " * 200_000, "<p><button>" + "<b>" * 90_000 + "<div>" * 90_000,
        "<script>" * 120_000, "<td>" * 200_000, "<p " + "x " * 500_000, "&#" + "9" * 1_000_000, "<b><div>" + "</b><i>" * 140_000, "<a =" * 250_000 + ">", "<title" * 170_000 + ">",
    ],
)
def test_time_is_linear(page):
    began = time.perf_counter()
    main_text(page + "<p>End.")
    assert time.perf_counter() - began < 15


def test_very_long_and_very_deep_pages():
    many = [f"Paragraph {i} says little." for i in range(20_000)]
    assert main_text(f"<article>{body(many)}</article>") == "\n".join(many)
    deep = "<div>" * 20_000 + "Deep text, at last." + "</div>" * 20_000
    assert main_text(deep) == "Deep text, at last."


def test_given_pages_equal_a_plain_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    for r in extract(pages).join(pages.drop("url"), "page_id").collect():
        inside = r.html[r.html.index("<article>") : r.html.index("</article>")]
        parts = (html.unescape(re.sub("<br>", " ", re.sub("</?b>", "", p))) for p in re.split("</?(?:p|h1|article)>", inside))
        assert r.text == "\n".join(" ".join(p.split()) for p in parts if p.strip())


def test_tables(spark):
    rows = [(1, "u", "<p>a.</p>", "x"), (1, "u", "<p>a.</p>", "x"), (None, None, None, "y"), (2, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    got = extract(pages).collect()
    assert sorted(((r.page_id, r.url, r.text) for r in got), key=str) == sorted([(1, "u", "a."), (1, "u", "a."), (None, None, ""), (2, "v", "")], key=str)
    assert extract(pages.limit(0)).count() == 0
