import re

import pytest

from cartwise.llm.html import extract, main_text

ARTICLE = "<article><h1>Title &amp; more</h1><p>First  para,\n with <b>bold</b>ness.<p>Second &lt;p&gt; &eacute;&#233;&#xe9; one.</article>"
WANT = "Title & more\nFirst para, with boldness.\nSecond <p> ééé one."


@pytest.mark.parametrize("around", [
    "{}", "<html><head><title>T</title><style>p {{}}</style><script>var a = '</p><article>';</script></head><body>{}</body></html>",
    "<nav><ul><li><a href='/x'>menu</a></ul></nav>{}<footer>&copy; someone, somewhere. With a long text, and dots.</footer>",
    "<header><h1>Site</h1></header><aside>About us, at great length. Really, very long indeed.</aside>{}",
    "<div class='cookie-notice'>We use cookies, you know. Accept all of them.</div>{}<div id=comments><p>Nice post, I like it. Yes.</p></div>",
    "{}<form action=x><label>Name</label><input><button>Send</button></form><noscript>no script, no fun</noscript>",
    "<div class=\"ad\">Buy now, pay later.</div><!-- <article>no</article> -->{}<iframe src=x>frame</iframe>",
    "<div class=sidebar><p>Links.</p></div><main>{}</main>", "<p hidden>secret</p>{}<div style='display: none'>x, y.</div>",
])
def test_article_without_furniture(around):
    assert main_text(around.format(ARTICLE)) == WANT


def test_furniture_inside_the_article():
    page = ARTICLE.replace("<p>Second", "<div class='share social'><a>tweet</a></div><nav>prev next</nav><section class='comments'><p>hm.</p></section><p>Second")
    assert main_text(page) == WANT


def test_ratios_choose_content_where_no_article_is_marked():
    links = "".join(f"<li><a href=/{i}>Link {i}</a></li>" for i in range(12))
    paras = "".join(f"<p>Paragraph {i} has some words, a comma, and ends with a full stop. Then it goes on.</p>" for i in range(6))
    page = f"<html><body><div><ul>{links}</ul></div><div><div>{paras}</div></div><div><span>2024 Somebody</span></div></body></html>"
    text = main_text(page)
    assert text.count("Paragraph") == 6 and "Link" not in text and "Somebody" not in text


@pytest.mark.parametrize(("page", "want"), [
    (None, ""), ("", ""), ("   ", ""), ("plain &amp; simple", "plain & simple"), ("a < b <p>c", "a < b\nc"), ("<p>a<br>b", "a b"),
    ("<p>one<div>two</div>three", "one\ntwo\nthree"), ("<article><p>cut off <b", "cut off"), ("<article>&amp;lt; &nbsp;x&nbsp;</article>", "&lt; x"),
    ("<ARTICLE><P>Upper</P></ARTICLE>", "Upper"), ("<article><ul><li>a<li>b</ul></article>", "a\nb"),
    ("<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"), ("<head><p>body text here", "body text here"),
    ("<article><p>x</b> y</p></article>", "x y"), ("<![CDATA[x]]><article>z</article>", "z"), ("<article></article>", ""),
])
def test_small_cases(page, want):
    assert main_text(page) == want


def test_every_fixture_page(spark, sf01):
    """The tables' pages: heading and paragraphs of the article element, as a plain reading of the markup gives them."""
    import html

    pages = spark.read.parquet(f"{sf01}/pages.parquet")
    got = {r.page_id: r for r in extract(pages.selectExpr("*", "1 as text", "2 as n_chars")).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]+>", "", b))).strip() for b in re.split(r"</?(?:p|h1)>", inner)]
        want = "\n".join(p for p in parts if p)
        assert got[r.page_id].text == want and got[r.page_id].n_chars == len(want) and got[r.page_id].url == r.url


def test_rows_repeat_and_tables_may_be_empty(spark):
    df = spark.createDataFrame([(1, None, "<p>a"), (1, None, "<p>a"), (None, "u", None)], "page_id bigint, url string, html string")
    assert sorted(map(tuple, extract(df).collect()), key=str) == [(1, None, "a", 1), (1, None, "a", 1), (None, "u", "", 0)]
    assert extract(df.limit(0)).count() == 0


def test_a_very_long_page():
    page = "<article>" + "<p>Some text, here.</p>" * 20000 + "</article>"
    assert main_text(page).count("\n") == 19999
    assert main_text("<div>" * 3000 + "deep text." + "</div>" * 3000) == "deep text."


STORY = "".join(f"<p>Paragraph {i} of the story has a good many words, a comma, and a full stop. Then it goes on, and on, to its end.</p>" for i in range(8))
TEASER = "<article><h3>Other {0}</h3><p>Short teaser {0}.</p></article>"


def test_teasers_marked_as_articles_do_not_displace_the_story():
    teasers = "".join(TEASER.format(i) for i in range(5))
    for page in (f"<div><h1>The title</h1>{STORY}</div><div>{teasers}</div>", f"<div>{teasers}</div><div>{STORY}</div>",
                 f"<div>{STORY}</div><article class=card><a href=/x>Read this too</a></article>"):
        text = main_text(f"<html><body>{page}</body></html>")
        assert text.count("Paragraph") == 8 and "teaser" not in text and "Other" not in text and "Read this" not in text


def test_a_marked_story_keeps_its_short_paths_beside_other_text():
    story = f"<article><h1>The title</h1>{STORY}<ul><li>Eggs<li>Milk</ul></article>"
    beside = "<div><p>Another text, not the story, of some words. It ends here, too.</p><p>Site, since 1999.</p></div>"
    for page in (beside + story, story + beside):
        text = main_text(page)
        assert text.startswith("The title\nParagraph 0") and text.endswith("Eggs\nMilk") and text.count("Paragraph") == 8


def test_ratios_decide_on_marked_pages():
    """The same marked text stays or goes by the lengths and punctuation of what stands beside it."""
    marked = "<article><p>A short note, marked.</p></article>"
    assert main_text(f"<div><a>Home</a></div>{marked}") == "A short note, marked."
    assert "note" not in main_text(f"<div>{STORY}</div>{marked}")


@pytest.mark.parametrize("frame", [
    '<div class="layout with-sidebar">{}</div>', "<div class='page has-sidebar'><div id=content>{}</div></div>",
    "<form id=aspnetForm method=post><input type=hidden>{}<button>Go</button></form>",
    '<div class="widget promo">{}</div>', "<div id=no-comments>{}</div>",
])
@pytest.mark.parametrize("page", ["<article><h1>The title</h1>{}</article>", "<h1>The title</h1>{}", "<div><h1>The title</h1><div>{}</div></div>"])
def test_a_page_s_frame_is_no_furniture(frame, page):
    text = main_text(f"<body><nav>Menu</nav>{frame.format(page.format(STORY))}<div class=footer>Site, 1999.</div></body>")
    assert text.count("Paragraph") == 8 and "Menu" not in text and "Site" not in text and "Go" not in text.split()
    assert text.startswith("The title\n")


def test_a_form_without_title_that_wraps_the_page():
    assert main_text(f"<body><form><div>{STORY}</div><label>Your name, please</label></form></body>").count("Paragraph") == 8
    assert "name" not in main_text(f"<body><div>{STORY}</div><form><p>Write to us, we like it.</p><label>Your name</label></form></body>")


def test_long_comments_stay_furniture():
    """Comments longer than the article, also those marked as articles themselves."""
    short = "<p>A short story, told in one breath. That is all.</p>"
    for comments in (STORY, f"<article>{STORY}</article>", f"<h3>Replies</h3><article><h4>A</h4>{STORY}</article><article>{STORY}</article>"):
        for name in ("comments", "comments-section", "post-comments"):
            page = f"<body><article><h1>T</h1>{short}</article><div class='{name}'>{comments}</div></body>"
            assert main_text(page) == "T\nA short story, told in one breath. That is all."


def test_names_of_subjects_are_no_furniture():
    assert "Search and rescue" in main_text(f"<article><h1>T</h1>{STORY}<h2 id='search-and-rescue'>Search and rescue</h2>{STORY}</article>")


def test_short_parts_of_an_unmarked_story_stay():
    body = (f"<h1>The title</h1>{STORY}<h2>Parts</h2><ul><li>Eggs<li>Milk</ul><blockquote>So it goes</blockquote>"
            f"<table><tr><td>a<td>b</table><pre>x = 1</pre>{STORY}<ol><li>Last</ol>")
    menu = "<div><ul>" + "".join(f"<li><a href=/{i}>Link {i}</a>" for i in range(9)) + "</ul></div>"
    want = ["The title", "Parts", "Eggs", "Milk", "So it goes", "a", "b", "x = 1", "Last"]
    text = main_text(f"<body>{menu}<div>{body}</div><div><ul><li>Imprint<li>Terms</ul></div></body>")
    assert [x for x in text.split("\n") if not x.startswith("Paragraph")] == want
    text = main_text(f"<body>{menu}<h1>The title</h1><div>{STORY}</div></body>")
    assert text.startswith("The title\nParagraph") and "Link" not in text


@pytest.mark.parametrize("page", ["<b>" * 100000, "<div>" * 100000, "<b>x" * 50000 + "</i>" * 50000, "<div><li>x</li>" * 50000, "<p><span>" * 50000,
                                  "<b>" * 50000 + "<div>x</div>" * 50000, "<form>" * 50000 + "x", "<div class=menu>x" * 50000])
def test_open_tags_take_linear_time(page):
    import time

    began = time.process_time()
    main_text(page + "<p>End.")
    assert time.process_time() - began < 4
