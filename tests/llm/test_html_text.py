import html
import re

from aerolith.llm import html_text, registry

MENU = '<nav><ul><li><a href="/a">Home</a><li><a href="/b">News</a></ul></nav>'
STORY = "This is the story of a man who was in the house and he had a dog that was not happy with it, and so they went out of the door of the house and into the rain, where it was cold and dark and they did not like it at all."


def test_query_gives_the_article_of_every_page(spark, sf_dir):
    pages = {r.page_id: r for r in registry.table(spark, sf_dir, "pages").collect()}
    rows = registry.op6_html_text(spark, sf_dir).collect()
    assert len(rows) == len(pages)
    for row in rows:
        article = re.search(r"<article>(.*?)</article>", pages[row.page_id].html, re.S)[1]
        parts = re.split(r"</?(?:p|h1|br)\b[^>]*>", article)
        texts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", p))).strip() for p in parts]
        assert row.text == "\n".join(t for t in texts if t)
        assert row.n_chars == len(row.text) and row.url == pages[row.page_id].url


def test_blocks_without_an_article_element():
    page = f'<body>{MENU}<div id=content><h1>Title</h1><p>{STORY}</p><p>He said: no.<p>{STORY} &amp; more</div><div class="comments"><p>{STORY}</p></div><div class="sidebar">{STORY}</div><form>{STORY}</form><footer>© me</footer>'
    assert html_text.main_text(page) == f"Title\n{STORY}\nHe said: no.\n{STORY} & more"


def test_link_lists_and_copyright_lines_are_no_text():
    links = "".join(f'<a href="/{i}">More about that and the other {i}</a> ' for i in range(9))
    page = f"<p>{STORY}</p><div>{links}</div><p>{STORY}</p><p>© 2020 by the owners of the site</p>"
    assert html_text.main_text(page) == f"{STORY}\n{STORY}"


def test_article_with_strangers_inside():
    page = '<article><header><h1>T</h1></header><p>One  two.</p><aside>x</aside><div class="share-buttons">Share</div><p>a&nbsp;&amp;\n b<br>c</p><script>if(a<b){"</p>"}</script><section id="comments">no</section><p hidden>h</p></article><p>after'
    assert html_text.main_text(page) == "T\nOne two.\na & b c"


def test_broken_pages_do_not_crash():
    for page in (None, "", "<", "<p", "<!--", "<a b='", "<script>", "</p></div>", "&amp", "a < b", "<article><p>x", "<p>" * 3000 + "deep", "<div>" * 3000 + "deep", "<p>\x00</p>"):
        assert isinstance(html_text.main_text(page), str)
    assert html_text.main_text("<div>" * 3000 + "deep") == "deep"
    assert html_text.main_text("<article><p>x") == "x"


def test_rows_with_nulls_and_clashing_columns(spark):
    pages = spark.createDataFrame([(None, None, None, "t"), (1, "u", "", "t"), (1, "u", "<p>Hi", "t")], "page_id long, url string, html string, text string")
    assert sorted((r.text, r.n_chars) for r in html_text.report(pages).collect()) == [("", 0), ("", 0), ("Hi", 2)]
    assert html_text.with_text(pages).filter("doc.text = 't'").count() == 3
    assert html_text.report(pages.limit(0)).count() == 0


def test_large_broken_pages_take_linear_time():
    for unit in ("<div>", "<title>", '<a "x>y" ', "<a", "<", "<p>", "<b><article>", "</span>"):
        assert isinstance(html_text.main_text(unit * (1_000_000 // len(unit))), str)
    assert html_text.main_text("<div>" * 100_000 + "</span>" * 100_000 + "deep") == "deep"
    assert html_text.main_text("<div><article>" + "<b>" * 100_000 + "</div>" * 100_000 + "<p>deep") == "deep"


def test_stray_tags_in_an_article_close_nothing_around_it():
    assert html_text.main_text(f"<div><article><p>{STORY}</div><p>more</article><p>© x") == f"{STORY}\nmore"
