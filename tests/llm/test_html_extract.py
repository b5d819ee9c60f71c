import pytest

from reuselens.llm.html_extract import extract, main_text

LONG = "A long paragraph that goes on and on for quite a while, as paragraphs in articles tend to do."

PAGES = [
    ("", ""),
    ("plain text &amp; no tags", "plain text & no tags"),
    (f"<article><h1>T</h1><p>{LONG}<p><b>x<br>y</article>", f"T\n{LONG}\nx\ny"),
    (f"<body><nav><ul><li><a>Home</a></ul></nav><article><p>{LONG}</p><p>Short.</p></article><footer>(c) {LONG}</footer>",
     f"{LONG}\nShort."),
    (f"<div id='cookieNotice'>{LONG}</div><div class='main'><div><h2>T</h2><p>{LONG}</p></div></div>"
     f"<div class='side-bar sidebar'><p>{LONG}</p></div>", f"T\n{LONG}"),
    (f"<article><header><a>tag</a><h1>Title</h1><p>by me</p></header><p>{LONG}</p><aside>{LONG}</aside>"
     f"<section class='comments'><article><p>{LONG}</p></article></section></article>", f"Title\n{LONG}"),
    (f"<script>var x = '<p>{LONG}</p>'</script><style>p {{}}</style><p>a&nbsp;b\n\t c&#233;&lt;p&gt;</p>", "a b cé<p>"),
    ("<nav>only <a>menu</a></nav><footer>foot</footer>", ""),
    (f"<form><p>{LONG}</p></form><main><p>{LONG}</p><form><label>l</label></form></main>", LONG),
    (f"<article><p>{LONG}</p></div></span><p>after</p>", f"{LONG}\nafter"),
    (f"<article><p>{LONG}</p></article><!-- <p>no</p> --><p hidden>{LONG}</p><div role='complementary'>{LONG}</div>", LONG),
    (f"<article><div class='ad'>Buy</div><p>in<b>li</b>ne <i>words</i> {LONG}</p><table><tr><td>1<td>2</table></article>",
     f"inline words {LONG}\n1\n2"),
    ("<article><p>" + "w " * 40000 + "</p><p>end", "w " * 39999 + "w\nend"),
]


@pytest.mark.parametrize("html, text", PAGES)
def test_main_text(html, text):
    assert main_text(html) == text


def test_pages(spark):
    rows = [(1, "u", PAGES[3][0], "x"), (1, "u", PAGES[3][0], "x"), (2, None, None, "y"), (None, "v", "<p>é", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract(pages).collect()), key=repr)
    t = f"{LONG}\nShort."
    assert got == sorted([(1, "u", t, len(t)), (1, "u", t, len(t)), (2, None, "", 0), (None, "v", "é", 1)], key=repr)
    assert extract(pages.where("false")).count() == 0


STORY = "A sentence of the story that goes on for quite a while, as sentences in stories do. " * 5


@pytest.mark.parametrize("name", ["content has-sidebar", "with-comments", "no-header", "layout-without-sidebar", "notice"])
def test_a_name_does_not_hide_the_page(name):
    page = f"<body><div class='{name}'><div class='menu'><a href=x>Home</a></div><p>{STORY}</p><p>{STORY}</p></div></body>"
    assert main_text(page) == f"{STORY.strip()}\n{STORY.strip()}"


def test_names_still_hide_what_is_beside_the_text():
    page = f"<body><div><p>{STORY}</p><p>{STORY}</p></div><div class='page-sidebar'><p>{STORY[:160]}</p></div>" \
        f"<div id='comments'><p>{STORY * 9}</p></div><section class='related-posts'><p>{STORY[:100]}</p></section></body>"
    assert main_text(page) == f"{STORY.strip()}\n{STORY.strip()}"
    assert main_text("<body><div class='menu'><a>Home</a> <a>About</a></div></body>") == ""


def test_short_articles_beside_a_long_one_stay():
    page = f"<body><article><p>{STORY * 3}</p></article><article><p>{STORY}</p></article>" \
        f"<article class='comment'><p>{STORY}</p></article></body>"
    assert main_text(page) == f"{(STORY * 3).strip()}\n{STORY.strip()}"
